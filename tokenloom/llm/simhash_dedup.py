"""SimHash fingerprints of whole texts, linked exactly by vantage-point trees.

Distinct fingerprints are dealt to the shards of a vantage-point tree (Hamming distance to
a chosen point, inside or outside its median). A fingerprint is stored in the one shard it
falls into, and asks every later shard that the triangle bounds leave open for it. Within
a shard a second set of vantage points orders the stored fingerprints, so that a query
compares only with those whose distances to them differ by no more than the threshold.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.llm.components import components, even_join
from tokenloom.llm.frames import fresh, q, stash

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
#: Shingles whose bits are added at once.
BLOCK = 1 << 15
#: Fingerprints aimed at per shard, sampled per shard, deepest tree, rows of a tile.
SHARD, SAMPLED, DEEPEST, TILE = 8192, 16, 13, 1 << 16


def simhash_bytes(text: str, width: int, seed: int) -> int:
    """64-bit SimHash of the word shingles of a text, A-Z lower-cased; 0 without words."""
    words = WORDS.findall(text.encode().lower())
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    n = max(1, len(words) - width + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        hashes = np.array(
            [digest(line[a:b], seed) for a, b in zip(starts[at : at + BLOCK], stops[at : at + BLOCK])],
            np.uint64,
        )
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist()))


def simhash(text: Column, width: int = 3, seed: int = 42) -> Column:
    """Fingerprint of a text column as a signed 64-bit number; null counts as empty."""

    @F.arrow_udf("long")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [simhash_bytes(x or "", width, seed) for x in batch.to_pylist()]
            yield pa.array(np.array(found, np.uint64).view(np.int64))

    return fingerprint(text)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a, b))


def build_tree(sample: np.ndarray, depth: int) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage, radius, inside, outside); children below 0 are shards, -1 - number.

    The vantage point of a node is the one of a few candidates whose distances to the
    node's sample spread most; inside holds what is at most ``radius`` away.
    """
    nodes: list[tuple[int, int, int, int]] = []
    shards = 0

    def grow(points: np.ndarray, left: int) -> int:
        nonlocal shards
        best = None
        if left and len(points) >= 4:
            for vantage in points[:: max(1, len(points) // 8)][:8]:
                far = distance(points, vantage)
                spread = far.std()
                radius = int(np.median(far))
                if (far <= radius).all():
                    radius -= 1
                if (far <= radius).any() and (best is None or spread > best[0]):
                    best = (spread, vantage, radius, far <= radius)
        if best is None:
            shards += 1
            return -shards
        _, vantage, radius, near = best
        at = len(nodes)
        nodes.append((0, 0, 0, 0))
        inside, outside = grow(points[near], left - 1), grow(points[~near], left - 1)
        nodes[at] = (int(vantage), radius, inside, outside)
        return at

    grow(sample, depth)
    return nodes


def route(points: np.ndarray, nodes: list[tuple[int, int, int, int]], most: int):
    """Yields (shard, positions, at home): each point's shard and those its ball reaches."""
    if not nodes:
        yield 0, np.arange(len(points)), np.ones(len(points), bool)
        return
    todo = [(0, np.arange(len(points)), np.ones(len(points), bool))]
    while todo:
        node, at, home = todo.pop()
        if node < 0:
            yield -1 - node, at, home
            continue
        vantage, radius, inside, outside = nodes[node]
        far = distance(points[at], np.uint64(vantage)).astype(np.int16)
        near = far <= radius
        for child, own, reach in (
            (inside, near, far <= radius + most),
            (outside, ~near, far > radius - most),
        ):
            todo.append((child, at[reach], (home & own)[reach]))


def linked_labels(
    stored: np.ndarray, asking: np.ndarray, labels: np.ndarray, most: int, inner: bool = True
) -> np.ndarray:
    """Least label reachable through links within ``most`` bits, per point.

    Links join asking points with stored ones and, if ``inner``, stored points with each
    other. ``labels`` holds those of the stored points, then of the asking ones; points
    are distinct. Points are ordered by their distances to two vantage points, and only
    those whose distances differ by at most ``most`` are compared.
    """
    n, points = len(stored), np.concatenate([stored, asking])
    first = points[0]
    second = points[np.argmin(np.abs(distance(points, first).astype(int) - 32))]
    cell = distance(points, first).astype(np.int64) * 65 + distance(points, second)
    labels = labels.copy()
    asks = np.arange(0 if inner else n, len(points))
    holds = np.arange(n)
    held = None
    while len(asks):
        asks = asks[np.argsort(cell[asks], kind="stable")]
        holds = holds[np.argsort(cell[holds], kind="stable")]
        places, changed = cell[holds], False
        linked = np.zeros(len(points), bool)
        cells, begins = np.unique(cell[asks], return_index=True)
        for place, group in zip(cells.tolist(), np.split(asks, begins[1:]), strict=True):
            x, y = divmod(place, 65)
            bands = 65 * np.arange(max(0, x - most), min(64, x + most) + 1)
            low = np.searchsorted(places, bands + max(0, y - most), "left")
            high = np.searchsorted(places, bands + min(64, y + most), "right")
            others = np.concatenate([holds[i:j] for i, j in zip(low, high, strict=True)])
            if not len(others):
                continue
            bits = points[others]
            for i in range(0, len(group), size := max(1, (1 << 20) // len(others))):
                mine = group[i : i + size]
                close = distance(points[mine][:, None], bits[None, :]) <= most
                close &= mine[:, None] != others[None, :]
                rows = close.any(axis=1)
                if not rows.any():
                    continue
                columns = close.any(axis=0)
                close, mine, at = close[rows][:, columns], mine[rows], others[columns]
                linked[mine] = linked[at] = True
                none = np.iinfo(np.int64).max
                least = np.where(close, labels[at][None, :], none).min(axis=1)
                least = np.minimum(least, labels[mine])
                # what a point learns goes back to those it links with
                back = np.minimum(np.where(close, least[:, None], none).min(axis=0), labels[at])
                changed |= bool((least < labels[mine]).any() or (back < labels[at]).any())
                labels[mine] = least
                labels[at] = np.minimum(labels[at], back)
        if held is None:
            held = linked
            asks, holds = asks[held[asks]], holds[held[holds]]
        if not changed:
            break
    return labels


def fingerprint_links(points: DataFrame, most: int = 3) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints within ``most`` bits.

    ``points``: written table of ``fp`` (long, unique) and ``rep`` (long, unique). Links
    connect exactly the components of all pairs; a point links to the least ``rep`` it
    reaches within its shard.
    """
    spark = points.sparkSession
    rows = points.count()
    depth = min(DEEPEST, max(0, int(np.ceil(np.log2(max(1, rows / SHARD))))))
    wanted = SAMPLED << depth << 2
    sampled = points.select("fp")
    if rows > 2 * wanted:
        share = int(2**31 * wanted / rows)
        sampled = sampled.where(F.pmod(F.xxhash64("fp"), F.lit(2**31)) < share)
    sample = np.sort(np.array([x[0] for x in sampled.collect()], np.int64)).view(np.uint64)
    nodes = build_tree(np.random.default_rng(0).permutation(sample), depth)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("fp").to_numpy().view(np.uint64)
            own = np.zeros(len(bits), np.int64)
            parts = list(route(bits, nodes, most))
            for shard, at, home in parts:
                own[at[home]] = shard
            for shard, at, home in parts:
                take = at[home | (own[at] < shard)]
                if len(take):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(take), shard, np.int32)),
                            pa.array(own[take] == shard),
                            batch.column("fp").take(pa.array(take)),
                            batch.column("rep").take(pa.array(take)),
                        ],
                        names=["shard", "home", "fp", "rep"],
                    )

    dealt = stash(
        points.select("fp", "rep").mapInArrow(deal, "shard int, home boolean, fp long, rep long"),
        "dealt",
    )
    # a shard with many points is compared in tiles: stored part i with asking part j
    sizes = dealt.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("n"))
    large = [x for row in sizes.where("n > 1").collect() for x in row]
    n = F.lit(1)
    if large:
        n = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for x in large]), "shard"), n)
    every = F.sequence(F.lit(0), F.col("n") - 1)
    stores = F.transform(
        every, lambda j: F.struct(F.col("part").alias("i"), j.alias("j"), F.lit(True).alias("stored"))
    )
    asks = F.transform(
        F.filter(every, lambda i: ~F.col("home") | (i < F.col("part"))),
        lambda i: F.struct(i.alias("i"), F.col("part").alias("j"), F.lit(False).alias("stored")),
    )
    tiles = (
        dealt.withColumn("n", n)
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
        .withColumn("tile", F.explode(F.when(F.col("home"), F.concat(stores, asks)).otherwise(asks)))
        .select("shard", "tile.i", "tile.j", "tile.stored", "fp", "rep")
    )

    def link(key: tuple, tile: pa.Table) -> pa.Table:
        bits = tile.column("fp").to_numpy().view(np.uint64)
        reps, is_stored = tile.column("rep").to_numpy(), tile.column("stored").to_numpy()
        stored, asking = np.flatnonzero(is_stored), np.flatnonzero(~is_stored)
        inner = key[1].as_py() == key[2].as_py()
        at = np.concatenate([stored, asking])
        if not len(stored) or not (inner or len(asking)):
            return pa.table({"a": reps[:0], "b": reps[:0]})
        labels = linked_labels(bits[stored], bits[asking], reps[at], most, inner)
        moved = labels < reps[at]
        return pa.table({"a": reps[at][moved], "b": labels[moved]})

    return tiles.groupBy("shard", "i", "j").applyInArrow(link, "a long, b long")


def component_table(prints: DataFrame, most: int = 3) -> DataFrame:
    """Distinct ``fp`` of a written table (fp, key): component (a fingerprint), n rows."""
    points = stash(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n")), "points")
    links = fingerprint_links(points.select("fp", F.col("fp").alias("rep")), most)
    found = components(links).withColumnRenamed("node", "fp")
    return stash(
        points.join(found, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"), "n"),
        "components",
    )


def simhash_components(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 3,
    seed: int = 42,
    most: int = 3,
) -> DataFrame:
    """Key, fingerprint (16 hex digits), component_id (least key reachable) of every text.

    Fingerprints within ``most`` bits are linked; equal ones share one point, so groups of
    copies cost nothing more. Null, empty and wordless texts have fingerprint zero and are
    linked like any other. Keys are longs; a group without any key has a null component.
    Repeated rows are kept. An empty table gives no rows. Other columns are not read.
    """
    prints = stash(
        docs.select(q(key).cast("long").alias("key"), simhash(q(text), width, seed).alias("fp")),
        "fingerprints",
    )
    groups = component_table(prints, most)
    least = prints.groupBy("fp").agg(F.min("key").alias("key"))
    ids = groups.join(least, "fp").groupBy("component").agg(F.min("key").alias("component_id"))
    named = stash(groups.join(ids, "component").select("fp", "n", "component_id"), "named")
    return even_join(prints, named, "fp").select(
        F.col("key").alias(key),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 3,
    seed: int = 42,
    most: int = 3,
) -> DataFrame:
    """``docs`` with one row per group of linked texts: a row of the least key.

    Rows without key come after all others. Of rows that share the least key, one stays.
    All columns are kept as they are.
    """
    fp, row = fresh(docs, "fp"), fresh(docs, "row")
    written = stash(
        docs.withColumns({fp: simhash(q(text), width, seed), row: F.monotonically_increasing_id()}),
        "marked",
    )
    prints = written.select(q(fp).alias("fp"), q(key).alias("key"), q(row).alias("row"))
    groups = component_table(prints.select("fp"), most)
    best = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row")).alias("best")
    first = prints.groupBy("fp").agg(best)
    kept = groups.join(first, "fp").groupBy("component").agg(F.min("best").alias("best"))
    return written.join(kept.select(F.col("best.row").alias(row)), row, "left_semi").select(
        *[q(name) for name in docs.columns]
    )
