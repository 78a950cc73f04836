"""Best-fit packing of tokenized documents into fixed-length sequences.

Lengths are whole numbers up to the sequence length, so best-fit decreasing is decided by
how many pieces there are of each length. Those counts (at most one row per length) are
all that meets in one place; there the tightest open bins are found with a segment tree
over remaining capacities, all equal pieces at a time. The pieces then learn their bin
from their rank among the pieces of their length, which is counted in parallel.
"""

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

from tokenloom.llm.frames import fresh, partitions, q, slices, stash
from tokenloom.llm.subwords import subwords

BATCH_BYTES = 1 << 20


class CapacityTree:
    """Segment tree over capacities 0..most: the least non-empty one at or above a need."""

    def __init__(self, most: int):
        self.size = 1
        while self.size <= most:
            self.size *= 2
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, amount: int) -> None:
        node = self.size + capacity
        while node:
            self.count[node] += amount
            node //= 2

    def tightest(self, need: int) -> int:
        """The least capacity >= need with an open bin, or -1."""
        node = self.size + need
        if self.count[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return -1


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths.

    Returns (length, first rank, last rank, first bin, offset): the pieces of this length
    with ranks in that range go, one each, to consecutive bins at that offset.
    """
    tree = CapacityTree(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = {}
    placed = []
    bins = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room < 0:
                room, first, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            else:
                first, n = open_bins[room].pop()
                tree.add(room, -n)
            each = room // length
            whole = min(n, left // each)
            rest = left - whole * each if whole < n else 0
            used = [(first, whole, each)] * bool(whole) + [(first + whole, 1, rest)] * bool(rest)
            for at, many, copies in used:
                for i in range(copies):
                    offset = capacity - room + i * length
                    placed.append((length, rank, rank + many - 1, at, offset))
                    rank += many
                left -= many * copies
                keep(open_bins, tree, room - copies * length, at, many)
            taken = sum(many for _, many, _ in used)
            if taken < n:
                keep(open_bins, tree, room, first + taken, n - taken)
    return placed


def keep(open_bins: dict, tree: CapacityTree, room: int, first: int, n: int) -> None:
    """Leave bins open with this room."""
    if room:
        open_bins.setdefault(room, []).append((first, n))
        tree.add(room, n)


def piece_rows(ids: bytes, end_id: int, most: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids and its end id."""
    ids += end_id.to_bytes(4, "little")
    total = len(ids) // 4
    start, piece = 0, 0
    while start < total:
        length = (total - start) % most or most if piece == 0 else most
        yield piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])
        start += length
        piece += 1


def cut_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, most: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The pieces of every document: key, piece, start, length, ids_crc32.

    The first piece of a longer document is the shorter one; all others are full.
    """
    kind = docs.schema[key].dataType
    source = docs.select(q(key).alias("key"), q(text).cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("key", kind),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = subwords(tokenizer)
        for batch in batches:
            keys, texts = batch.column(0), [x or "" for x in batch.column(1).to_pylist()]
            for first, last in slices([len(x) for x in texts], BATCH_BYTES):
                rows = [
                    (at, *row)
                    for at, ids in enumerate(encoder.encode(texts[first:last]), first)
                    for row in piece_rows(ids, end_id, most)
                ]
                at, piece, start, length, crc = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(at, pa.int64())),
                        pa.array(piece, pa.int32()),
                        *[pa.array(x, pa.int64()) for x in (start, length, crc)],
                    ],
                    names=schema.names,
                )

    return source.mapInArrow(cut, schema).withColumnRenamed("key", key)


def pack(pieces: DataFrame, most: int, length: str = "length") -> DataFrame:
    """Best-fit decreasing of the rows of a written table by a length column (1..most).

    Adds sequence_id and offset. Lengths that many rows share are ranked in hashed parts,
    each a bounded share of all rows. What is broadcast is bounded by ``most`` and the
    number of partitions: ranks before each part, and the placements of the histogram.
    """
    spark = pieces.sparkSession
    part, rank = fresh(pieces, "part"), fresh(pieces, "rank")
    size = q(length)
    counts = {x[0]: x[1] for x in pieces.groupBy(size).agg(F.count(F.lit(1))).collect()}
    wrong = [x for x in counts if x is None or not 0 < x <= most]
    if wrong:
        raise ValueError(f"lengths must be between 1 and {most}: {wrong[:5]}")
    placed = spark.createDataFrame(
        best_fit(counts, most),
        "p_length long, rank0 long, rank1 long, bin0 long, p_offset long",
    )
    share = max(1, sum(counts.values()) // (4 * partitions(spark)))
    parts = F.create_map(*[F.lit(x) for n, c in counts.items() if c > share for x in (n, -(-c // share))])
    order = [q(name) for name, kind in pieces.dtypes if not kind.startswith(("map", "variant"))]
    dealt = pieces.withColumn(
        part, F.pmod(F.xxhash64(*order), F.coalesce(F.try_element_at(parts, size), F.lit(1)))
    ) if any(c > share for c in counts.values()) else pieces.withColumn(part, F.lit(0).cast("long"))
    before = Window.partitionBy("o_length").orderBy("o_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(size.alias("o_length"), q(part).alias("o_part"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("o_length", "o_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranked"))
    )
    within = Window.partitionBy(size, q(part)).orderBy(*order)
    ranked = (
        dealt.withColumn(rank, F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), (size == F.col("o_length")) & (q(part) == F.col("o_part")))
        .withColumn(rank, q(rank) + F.col("ranked"))
    )
    return ranked.join(
        F.broadcast(placed),
        (q(length) == F.col("p_length")) & q(rank).between(F.col("rank0"), F.col("rank1")),
    ).select(
        *[q(name) for name in pieces.columns],
        (F.col("bin0") + q(rank) - F.col("rank0")).alias("sequence_id"),
        F.col("p_offset").alias("offset"),
    )


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    most: int = 1024,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pack every document into sequences of at most ``most`` tokens.

    Returns per piece: key, piece, start, length, ids_crc32, sequence_id, offset. A
    document is its token ids and ``end_id``; only longer ones are cut, into full pieces
    after a first one that may be shorter. The packing is best-fit decreasing over all
    pieces of the table. Null and empty texts are the end id alone. Repeated rows and null
    keys are packed like any row; equal lengths are told apart by the other columns. An
    empty table gives no rows. Other columns are not read.
    """
    return pack(stash(cut_pieces(docs, tokenizer, end_id, most, key, text), "pieces"), most)


def read_sequences(packed: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """One row per sequence: sequence_id, tokens used, pieces in order of their offset."""
    named = [q(name) for name in packed.columns if name not in {"sequence_id", "offset"}]
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("used"),
        F.sort_array(F.collect_list(F.struct(q("offset"), *named))).alias("pieces"),
    )
