"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its nearest pivots in order of closeness. Every vector of the
table is entered into the inverted lists of its first pivots; vectors that share enough
pivots are candidates, and candidates are verified by their cosine in double precision.
Equal vectors are one entry, and a list with many entries is compared tile by tile.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tokenloom.llm.components import components
from tokenloom.llm.frames import q, stash

#: Pivots (a bounded sample of the vectors), pivots that describe a vector, shared pivots
#: that make a candidate, entries per tile.
PIVOTS, PREFIX, SHARED, TILE = 256, 10, 3, 2000


def usable(vector):
    """Neither null, empty nor zero, all components finite."""
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def unit_rows(flat: np.ndarray, size: int) -> np.ndarray:
    """Rows of length one; scaled first, so that no square over- or underflows."""
    rows = flat.reshape(-1, size).astype(float)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def vectors_of(column: pa.Array) -> np.ndarray:
    """A list column without nulls as a flat array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(float)


def choose_pivots(classes: DataFrame, pivots: int) -> dict[int, np.ndarray]:
    """At most ``pivots`` vectors of each length, by hash, scaled to length one."""
    counts = {x.size: x.n for x in classes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    draw = F.pmod(F.xxhash64("vector"), F.lit(1 << 31))
    share = F.create_map(
        *[F.lit(x) for s, n in counts.items() for x in (s, int(min(1, 2 * pivots / n + 1e-9) * (1 << 31)))]
    )
    sample = classes.where(draw <= F.try_element_at(share, "size")).select("size", "vector", draw.alias("draw"))
    found: dict[int, list] = {}
    for row in sorted(sample.collect(), key=lambda x: (x.draw, x.vector)):
        kept = found.setdefault(row.size, [])
        if len(kept) < pivots:
            kept.append(row.vector)
    return {size: unit_rows(np.array(rows, float), size) for size, rows in found.items()}


def nearest_pivots(rows: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The first pivots of each row, nearest first; ties by pivot number."""
    return np.argsort(-(rows @ pivots.T), axis=1, kind="stable")[:, :prefix]


def pivot_links(
    classes: DataFrame,
    least: float,
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    shared: int = SHARED,
) -> DataFrame:
    """(id, links, low): per class of equal vectors and task, the rows it links with there
    and the least id it reaches there.

    ``classes``: written table of id, space, size, vector, n (rows). A pair is verified
    in the list of the least pivot that both share, so it counts once.
    """
    tables = choose_pivots(classes, pivots)
    names = ["space", "size", "pivot", "pivots", "id", "n", "vector"]
    kind = classes.schema["vector"].dataType.simpleString()
    schema = f"space string, size int, pivot int, pivots array<int>, id long, n long, vector {kind}"

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                rows = unit_rows(vectors_of(part.column("vector")), size)
                first = nearest_pivots(rows, tables[size], prefix)
                width = first.shape[1]
                at = pa.array(np.repeat(np.arange(len(rows)), width))
                offsets = np.arange(0, len(at) * width + 1, width, dtype=np.int32)
                all_of = np.repeat(np.sort(first, axis=1), width, axis=0).ravel().astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("space").take(at),
                        part.column("size").take(at),
                        pa.array(first.ravel().astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(all_of)),
                        *[part.column(name).take(at) for name in ("id", "n", "vector")],
                    ],
                    names=names,
                )

    source = classes.select("space", "size", "id", "n", "vector")
    entries = stash(source.mapInArrow(describe, schema), "entries")
    sizes = entries.groupBy("space", "size", "pivot").agg(
        F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("parts")
    )
    # lists above one tile: at most entries / TILE of them
    long_lists = sizes.where("parts > 1")
    cut = (
        entries.join(long_lists, ["space", "size", "pivot"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
    )

    def verify(key: tuple, tile: pa.Table) -> pa.Table:
        size, pivot, i, j = (x.as_py() for x in key[1:])
        ids, n = tile.column("id").to_numpy(), tile.column("n").to_numpy()
        part = tile.column("part").to_numpy()
        left = np.flatnonzero(part == i)
        right = left if i == j else np.flatnonzero(part == j)
        links, low = np.zeros(len(ids), np.int64), ids.copy()
        if len(left) and len(right) and len(ids) > 1:
            rows = unit_rows(vectors_of(tile.column("vector")), size)
            member = tile.column("pivots").combine_chunks()
            held = np.zeros((len(ids), len(tables[size])), np.float32)
            counts = member.value_lengths().to_numpy()
            held[np.repeat(np.arange(len(ids)), counts), member.flatten().to_numpy()] = 1
            before = held[:, :pivot]
            changed, first = True, True
            while changed:
                changed = False
                for at in range(0, len(left), 512):
                    mine = left[at : at + 512]
                    # candidates share enough pivots, none of them before this list's
                    close = held[mine] @ held[right].T >= min(shared, held.shape[1])
                    close &= before[mine] @ before[right].T == 0
                    close &= rows[mine] @ rows[right].T >= least
                    close &= ids[mine][:, None] != ids[right][None, :]
                    if not close.any():
                        continue
                    if first:
                        links[mine] += close @ n[right]
                        links[right] += n[mine] @ close if i != j else 0
                    none = np.iinfo(np.int64).max
                    down = np.minimum(np.where(close, low[right][None, :], none).min(axis=1), low[mine])
                    back = np.minimum(np.where(close, down[:, None], none).min(axis=0), low[right])
                    changed |= bool((down < low[mine]).any() or (back < low[right]).any())
                    low[mine] = down
                    low[right] = np.minimum(low[right], back)
                first = False
        used = links > 0
        return pa.table({"id": ids[used], "links": links[used], "low": low[used]})

    return cut.select("space", "size", "pivot", "i", "j", "part", "pivots", "id", "n", "vector").groupBy(
        "space", "size", "pivot", "i", "j"
    ).applyInArrow(verify, "id long, links long, low long")


def embedding_components(
    vectors: DataFrame,
    least: float = 0.93,
    key: str = "vec_id",
    vector: str = "embedding",
    space: str = "label",
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    shared: int = SHARED,
) -> DataFrame:
    """Key, n_links, component_id, kept of every vector.

    Two rows are linked if their ``space`` is equal and not null, their vectors have the
    same length and their cosine is at least ``least``; pairs that share too few pivots
    are missed (see the recall test). Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing. Equal vectors of a space are linked among
    each other without being paired. Keys are longs; rows that share a key count as
    separate vectors of one component. A null key has a null component and is not kept.
    An empty table gives no rows.
    """
    rows = stash(
        vectors.select(
            q(key).cast("long").alias("key"),
            q(space).cast("string").alias("space"),
            q(vector).alias("vector"),
        ),
        "vectors",
    )
    able = rows.where(F.col("space").isNotNull() & usable(F.col("vector")))
    # classes of equal vectors, in a written table that names each by its least key
    classes = stash(
        able.groupBy("space", "vector")
        .agg(F.min("key").alias("id"), F.count(F.lit(1)).alias("n"))
        .withColumn("size", F.size("vector")),
        "classes",
    )
    found = stash(pivot_links(classes.where(F.col("id").isNotNull()), least, pivots, prefix, shared), "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    named = (
        classes.select("id", "space", "vector", "n")
        .join(links, "id", "left")
        .join(groups.select(F.col("node").alias("id"), "component"), "id", "left")
        .select(
            F.col("space").alias("c_space"),
            F.col("vector").alias("c_vector"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    joined = rows.join(
        named,
        (F.col("space") == F.col("c_space")) & (F.col("vector") == F.col("c_vector")),
        "left",
    )
    component = F.coalesce("component", "key")
    return joined.select(
        F.col("key").alias(key),
        F.coalesce("links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        (F.col("key") == component).alias("kept"),
    )
