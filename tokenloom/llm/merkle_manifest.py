"""Merkle manifest of a table: a tree of row hashes per group, and a tree of the groups.

Rows are put in order by key ranges, and their exact places in their group cut them into
aligned blocks of fanout^height leaves. A block hashes its own subtree alone. Then the
blocks exchange roots as a butterfly: in each round, aligned runs of ``fanout`` subtrees
swap their roots, every block asking one block of each sibling subtree, and all of them
hash the common ancestor. So every block ends with the root and with the siblings of its
whole upper path, and no pass goes back down.
"""

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from tokenloom.llm.frames import partitions, q, stash
from tokenloom.operators.joins import fits_broadcast

#: Leaves aimed at per block.
BLOCK = 4096
STEPS = T.ArrayType(
    T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())])
)
ADDED = ("steps", "subroot", "root")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def hash_fields(fields: Sequence[Column]) -> Column:
    """sha256 of columns one after the other: ``-`` if null, else byte count, ``:``, value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(
        steps,
        leaf,
        lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]).cast("binary"), 256),
    )


def proof_digest(steps: Column) -> Column:
    """sha256 of all siblings of a path, level by level, left to right."""
    listed = F.transform(steps, lambda s: F.concat(s["before"], s["after"]))
    return F.sha2(F.array_join(listed, "").cast("binary"), 256)


def block_size(fanout: int, most: int) -> tuple[int, int]:
    """Leaves of a block, a power of the fanout, and the height of its tree."""
    block, height = fanout, 1
    while block * fanout <= most:
        block, height = block * fanout, height + 1
    return block, height


def subtree(leaves: list[str], fanout: int, height: int | None) -> list[list[str]]:
    """Levels of a tree, leaves first: up to ``height``, or until one node remains."""
    levels = [leaves]
    while len(levels) <= height if height is not None else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append(
            [digest("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)]
        )
    return levels


def path_steps(levels: list[list[str]], place: int, fanout: int) -> list[tuple[str, str]]:
    """(left siblings, right siblings) of a leaf on each level below the top."""
    steps = []
    for level in levels[:-1]:
        first = place - place % fanout
        steps.append(("".join(level[first:place]), "".join(level[place + 1 : first + fanout])))
        place //= fanout
    return steps


def placed_leaves(leaves: DataFrame, block: int) -> DataFrame:
    """Adds ``block``, ``place`` (in the block) and ``leaves`` (of the group).

    ``leaves``: written table (g, k, leaf, row, rest), ``row`` unique. Groups are counted
    through key ranges, of which each group touches a few; no task gets a whole group.
    """
    spark = leaves.sparkSession
    order = [F.asc_nulls_first("g"), F.asc_nulls_first("k"), F.col("leaf"), F.col("row")]
    ranged = stash(
        leaves.repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()),
        "ranged",
    )
    part = F.shiftright("at", 33)
    in_group = Window.partitionBy("r_g")
    before = in_group.orderBy("r_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stash(
        ranged.groupBy(F.col("g").alias("r_g"), part.alias("r_part"))
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
        .withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
        .withColumn("leaves", F.sum("n").over(in_group))
        .drop("first", "n"),
        "runs",
    )
    runs = F.broadcast(runs) if fits_broadcast(runs) else runs
    place = F.col("at") + F.col("shift")
    return (
        ranged.join(runs, F.col("g").eqNullSafe(F.col("r_g")) & (part == F.col("r_part")))
        .withColumn("block", F.floor(place / block).cast("long"))
        .withColumn("place", place % block)
        .drop("r_g", "r_part", "shift", "row", "at")
    )


def exchange_roots(state: DataFrame, fanout: int) -> DataFrame:
    """Butterfly rounds over blocks (g, block, blocks, node, steps), one written table each.

    In round r, aligned runs of fanout subtrees of fanout^r blocks swap roots. A block asks
    one block of each sibling subtree, spread evenly over it, so no block answers more
    than its share. A group whose tree is finished waits.
    """
    most = state.agg(F.max("blocks")).first()[0] or 1
    size = 1
    while size < most:
        run = F.col("block") - F.col("block") % (size * fanout)
        start = run + F.col("child") * size
        width = F.least(start + size, F.col("blocks")) - start
        asked = F.when(
            F.col("child") == F.col("own"), F.col("block")
        ).otherwise(start + (F.col("block") - run) % width)
        active = state.where(F.col("blocks") > size)
        asks = (
            active.withColumn("own", F.floor((F.col("block") - run) / size).cast("int"))
            .withColumn("child", F.explode(F.array(*[F.lit(i) for i in range(fanout)])))
            .where(start < F.col("blocks"))
            .select("g", "block", "blocks", "steps", "own", "child", asked.alias("asked"))
        )
        nodes = active.select(F.col("g").alias("n_g"), F.col("block").alias("n_block"), "node")
        met = asks.join(
            nodes, F.col("g").eqNullSafe(F.col("n_g")) & (F.col("asked") == F.col("n_block"))
        )
        run_nodes = F.sort_array(F.collect_list(F.struct("child", "node"))).alias("run")
        told = met.groupBy("g", "block").agg(
            F.first("blocks").alias("blocks"), F.first("steps").alias("steps"),
            F.first("own").alias("own"), run_nodes,
        )

        def joined(keep) -> Column:
            chosen = F.filter("run", lambda x: keep(x["child"], F.col("own")))
            return F.array_join(F.transform(chosen, lambda x: x["node"]), "")

        step = F.struct(
            joined(lambda a, b: a < b).alias("before"), joined(lambda a, b: a > b).alias("after")
        )
        whole = joined(lambda a, b: F.lit(True)).cast("binary")
        after = told.select(
            "g", "block", "blocks", F.sha2(whole, 256).alias("node"),
            F.concat("steps", F.array(step)).alias("steps"),
        )
        state = stash(after.unionByName(state.where(F.col("blocks") <= size)), "round")
        size *= fanout
    return state


def group_trees(leaves: DataFrame, fanout: int, block_leaves: int) -> tuple[DataFrame, DataFrame]:
    """Placed leaves, and per block (g, block, blocks, node, steps): root and upper path."""
    block, height = block_size(fanout, block_leaves)
    placed = placed_leaves(leaves, block)
    kind = leaves.schema["g"].dataType
    schema = T.StructType(
        [
            T.StructField("g", kind),
            T.StructField("block", T.LongType()),
            T.StructField("blocks", T.LongType()),
            T.StructField("node", T.StringType()),
        ]
    )

    def root(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        total = rows.column("leaves")[0].as_py()
        levels = subtree(rows.column("leaf").to_pylist(), fanout, height if total > block else None)
        return pa.table(
            {
                "g": pa.array([key[0].as_py()], rows.schema.field("g").type),
                "block": [key[1].as_py()],
                "blocks": [-(-total // block)],
                "node": [levels[-1][0]],
            }
        )

    roots = placed.select("g", "block", "place", "leaves", "leaf").groupBy("g", "block")
    state = stash(
        roots.applyInArrow(root, schema).withColumn("steps", F.array().cast(STEPS)), "roots"
    )
    return placed, exchange_roots(state, fanout)


def merkle_manifest(
    leaves: DataFrame,
    group: str,
    key: str,
    leaf: str = "leaf",
    fanout: int = 2,
    block_leaves: int = BLOCK,
) -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and ``steps``, the siblings of each leaf's path.

    Leaves of a group ascend by key (null first; equal keys by leaf, equal leaves are
    alike). While a level has several nodes, every ``fanout`` consecutive ones, fewer in
    the last run, become the hash of their hex digests. Subroots, in order of their group
    (null first), make the upper tree in the same way. ``steps`` has one (before, after)
    per level: the siblings left and right of the path as joined hex digests, possibly
    empty; :func:`fold` gives the root from a leaf and its steps. An empty table gives no
    rows. All columns stay; the three added names must be free.
    """
    taken = {name.lower() for name in leaves.columns} & set(ADDED)
    if taken or fanout < 2:
        raise ValueError(f"fanout must be 2 or more, and these names free: {sorted(taken)}")
    rows = stash(
        leaves.select(
            q(group).alias("g"),
            q(key).alias("k"),
            q(leaf).alias("leaf"),
            F.monotonically_increasing_id().alias("row"),
            F.struct(*[q(name) for name in leaves.columns]).alias("rest"),
        ),
        "leaves",
    )
    placed, state = group_trees(rows, fanout, block_leaves)
    subroots = state.where("block = 0").select(F.col("g").alias("k"), F.col("node").alias("leaf"))
    upper = stash(
        subroots.select(
            F.lit(0).alias("g"), "k", "leaf", F.lit(0).alias("row"), F.struct("k").alias("rest")
        ),
        "subroots",
    )
    top = with_paths(*group_trees(upper, fanout, block_leaves), fanout, block_leaves).select(
        F.col("rest.k").alias("t_g"), F.col("node").alias("root"), F.col("steps").alias("t_steps")
    )
    top = stash(top, "top")
    top = F.broadcast(top) if fits_broadcast(top) else top
    blocks = state.join(top, F.col("g").eqNullSafe(F.col("t_g"))).select(
        "g", "block", "blocks", "node", "root", F.concat("steps", "t_steps").alias("steps")
    )
    return with_paths(placed, blocks, fanout, block_leaves).select(
        "rest.*", F.col("node").alias("subroot"), "root", "steps"
    )


def with_paths(placed: DataFrame, state: DataFrame, fanout: int, block_leaves: int) -> DataFrame:
    """``rest`` of every leaf with its whole path: own block first, then the block's upper one."""
    block, height = block_size(fanout, block_leaves)
    if "root" not in state.columns:
        state = state.withColumn("root", F.col("node"))
    schema = T.StructType(
        [
            placed.schema["rest"],
            T.StructField("node", T.StringType()),
            T.StructField("root", T.StringType()),
            T.StructField("steps", STEPS),
        ]
    )

    def paths(key: tuple, rows: pa.Table, state: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        total = rows.column("leaves")[0].as_py()
        levels = subtree(rows.column("leaf").to_pylist(), fanout, height if total > block else None)
        above = [(x["before"], x["after"]) for x in state.column("steps")[0].as_py()]
        n, depth = rows.num_rows, len(levels) - 1 + len(above)
        listed = [x for i in range(n) for x in (*path_steps(levels, i, fanout), *above)]
        pairs = pa.StructArray.from_arrays(
            [pa.array([x[side] for x in listed], pa.string()) for side in (0, 1)], ["before", "after"]
        )
        ends = pa.array(range(0, n * depth + 1, depth) if depth else [0] * (n + 1), pa.int32())
        return pa.table(
            {
                "rest": rows.column("rest"),
                "node": pa.array([state.column("node")[0].as_py()] * n, pa.string()),
                "root": pa.array([state.column("root")[0].as_py()] * n, pa.string()),
                "steps": pa.ListArray.from_arrays(ends, pairs),
            }
        )

    return (
        placed.select("g", "block", "place", "leaves", "leaf", "rest")
        .groupBy("g", "block")
        .cogroup(state.select("g", "block", "node", "root", "steps").groupBy("g", "block"))
        .applyInArrow(paths, schema)
    )


def tampered_manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    altered: str = "n_chars",
    every: int = 7,
    fanout: int = 2,
    block_leaves: int = BLOCK,
) -> DataFrame:
    """Manifest of a table and its check after some rows were tampered with.

    Returns key, leaf, subroot, root, proof_sha256, all of the table as it is, then
    folded_root (from the leaf as tampered and the original siblings) and verified. Where
    ``every`` divides the crc32 of the decimal key, ``altered`` is one greater; a null stays
    null, and a row without key is not tampered with. Repeated rows are leaves of their own.
    """
    more = (q(altered).cast("decimal(38,0)") + 1).cast("string")
    hit = (F.crc32(q(key).cast("string").cast("binary")) % every == 0) & q(altered).isNotNull()
    changed = [more if name == altered else q(name) for name in fields]
    leaves = docs.select(
        q(key).alias("key"),
        q(group).alias("group"),
        hash_fields([q(name) for name in fields]).alias("leaf"),
        F.when(hit, hash_fields(changed)).alias("other"),
    )
    made = merkle_manifest(leaves, "group", "key", "leaf", fanout, block_leaves)
    folded = fold(F.coalesce("other", "leaf"), F.col("steps"))
    return made.select(
        F.col("key").alias(key), "leaf", "subroot", "root",
        proof_digest(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
