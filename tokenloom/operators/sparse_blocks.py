"""Gradient steps of the sparse classifier: blocks of rows and shards of weights that talk.

A block holds the entries of some rows, their buckets numbered within the block. A shard
holds the weights of some buckets and, for each block, the places of those it asks for. Only
arrays of weights and of gradient sums travel, one for each block and shard that share
buckets; the blocks stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tokenloom.functions.draws import draw_uniform
from tokenloom.functions.optimizer import adamw_arrays
from tokenloom.session import materialize, release

#: Entries aimed at per block, and so many at least if there is more than one; buckets per
#: shard; blocks for each of which a quarter of a shard is made at least.
BLOCK_ENTRIES, LEAST_ENTRIES, SHARD_BUCKETS, SHARD_BLOCKS = 2_000_000, 50_000, 1 << 17, 4

MESSAGE = "block int, shard int, data binary"
SHARD = (
    "shard int, buckets binary, times binary, asked array<struct<block:int,places:binary>>, "
    "moments binary, sums binary"
)


def ints(data, kind=np.int64) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), kind)


def floats(data, classes: int) -> np.ndarray:
    """The rows of a matrix, one per class."""
    return np.frombuffer(data.as_buffer()).reshape(classes, -1)


def shard_of(buckets: np.ndarray, shards: int) -> np.ndarray:
    """Shards of buckets, dealt evenly whatever the buckets are."""
    mixed = buckets.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    return (mixed % np.uint64(shards)).astype(np.int64)


def block_numbers(spark: SparkSession, blocks: int) -> list[int]:
    """Numbers that a hash partitioning deals to as many partitions, one to each."""
    place = F.pmod(F.hash(F.col("id").cast("int")), F.lit(blocks)).alias("place")
    tried = spark.range(64 * blocks).select(F.col("id").cast("int"), place)
    found = {row["place"]: row["id"] for row in tried.groupBy("place").agg(F.min("id").alias("id")).collect()}
    return [found[p] for p in range(blocks)] if len(found) == blocks else list(range(blocks))


def packed(entries: pa.Table, shards: int) -> pa.Table:
    """One row: the entries (block, key, label, bucket, value, times) of a block as arrays.

    Rows with entries come first. Buckets are numbered by shard and bucket, so the buckets of
    a shard are a slice.
    """
    keys = entries["key"].combine_chunks().dictionary_encode()
    owner = keys.indices.to_numpy().astype(np.int64)
    label = np.zeros(len(keys.dictionary), np.int32)
    label[owner[::-1]] = entries["label"].to_numpy()[::-1]
    known = np.flatnonzero(entries["bucket"].is_valid().to_numpy())
    owner = owner[known]
    sizes = np.bincount(owner, minlength=len(label))
    rows = np.argsort(sizes == 0, kind="stable")
    order = np.argsort(np.argsort(rows)[owner], kind="stable")
    at = known[order]
    buckets, first, inverse = np.unique(
        entries["bucket"].fill_null(0).to_numpy().astype(np.int64)[at], return_index=True, return_inverse=True
    )
    shard = shard_of(buckets, shards)
    sorted_ = np.argsort(shard, kind="stable")
    place = np.empty(len(buckets), np.int32)
    place[sorted_] = np.arange(len(buckets))
    times = entries["times"].fill_null(0).to_numpy().astype(np.int64)[at][first][sorted_]
    buckets, shard = buckets[sorted_], shard[sorted_]
    parts = []
    for number in np.unique(shard):
        own = slice(*np.searchsorted(shard, [number, number + 1]))
        parts.append(
            {"shard": int(number), "buckets": buckets[own].tobytes(), "times": times[own].tobytes()}
        )
    part = pa.struct([("shard", pa.int32()), ("buckets", pa.binary()), ("times", pa.binary())])
    arrays = [
        label[rows],
        sizes[rows][: np.count_nonzero(sizes)].astype(np.int64),
        place[inverse],
        entries["value"].to_numpy()[at].astype(np.float64),
    ]
    listed = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), keys.dictionary.take(pa.array(rows)))
    return pa.table(
        [
            entries["block"].slice(0, 1).cast(pa.int32()),
            listed,
            *[pa.array([array.tobytes()], pa.binary()) for array in arrays],
            pa.array([parts], pa.list_(part)),
        ],
        names=["block", "keys", "labels", "sizes", "places", "values", "parts"],
    )


def gathered(parts: pa.Table, classes: int) -> pa.Table:
    """One row: the shard of what all its blocks ask for (block, shard, buckets, times)."""
    asked = [ints(data) for data in parts["buckets"]]
    buckets, first = np.unique(np.concatenate(asked), return_index=True)
    times = np.concatenate([ints(data) for data in parts["times"]])[first]
    places = [
        {"block": block, "places": np.searchsorted(buckets, own).astype(np.int32).tobytes()}
        for block, own in zip(parts["block"].to_pylist(), asked)
    ]
    zeros = np.zeros(classes * len(buckets)).tobytes()
    return shard_row(parts["shard"][0], buckets.tobytes(), times.tobytes(), places, 3 * zeros, zeros)


def shard_row(shard, buckets, times, asked, moments, sums) -> pa.Table:
    request = pa.list_(pa.struct([("block", pa.int32()), ("places", pa.binary())]))
    return pa.table(
        [
            pa.array([shard.as_py()], pa.int32()),
            pa.array([buckets], pa.binary()),
            pa.array([times], pa.binary()),
            pa.array([asked], request) if isinstance(asked, list) else asked,
            pa.array([moments], pa.binary()),
            pa.array([sums], pa.binary()),
        ],
        names=["shard", "buckets", "times", "asked", "moments", "sums"],
    )


def moved(moments, sums, classes: int, move: tuple[float, float, int] | None) -> np.ndarray:
    """Weights and both moments, one row per class each, after the move whose sums are given."""
    kept = floats(moments, 3 * classes)
    if move is None:
        return kept
    scale, rate, step = move
    own = (kept[:classes], kept[classes : 2 * classes], kept[2 * classes :])
    return np.concatenate(adamw_arrays(*own, floats(sums, classes) * scale, rate, step))


def errors(weights, places, values, sizes, labels) -> np.ndarray:
    """Probability minus one for the label, by class and row."""
    begins = np.cumsum(sizes) - sizes
    scores = np.stack([np.add.reduceat(values * own[places], begins) for own in weights])
    grown = np.exp(scores - scores.max(axis=0))
    grown /= grown.sum(axis=0)
    return grown - (labels == np.arange(len(weights))[:, None])


def block_sums(block: pa.Table, sent: pa.Table, classes: int) -> pa.Table:
    """Messages of a block back to the shards that sent weights: sums by bucket."""
    order = np.argsort(sent["shard"].to_numpy())
    shards = sent["shard"].to_numpy()[order].tolist()
    data = sent["data"].combine_chunks()
    arrived = [floats(data[int(i)], classes) for i in order]
    if not arrived:
        return pa.table([[], [], []], schema=pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("data", pa.binary())]))
    weights = np.concatenate(arrived, axis=1)
    sizes, values = ints(block["sizes"][0]), ints(block["values"][0], np.float64)
    places = ints(block["places"][0], np.int32).astype(np.intp)
    labels = ints(block["labels"][0], np.int32)[: len(sizes)]
    wrong = errors(weights, places, values, sizes, labels)
    if "drawn" in block.column_names:
        drawn = block["drawn"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        wrong = np.where(drawn[: len(sizes)].astype(bool), wrong, 0.0)
    sums = np.stack(
        [np.bincount(places, values * np.repeat(own, sizes), weights.shape[1]) for own in wrong]
    )
    ends = np.cumsum([part.shape[1] for part in arrived])[:-1]
    back = [part.tobytes() for part in np.split(sums, ends, axis=1)]
    number = [block["block"][0].as_py()] * len(shards)
    return pa.table(
        [pa.array(number, pa.int32()), pa.array(shards, pa.int32()), pa.array(back, pa.binary())],
        names=["block", "shard", "data"],
    )


class Descent:
    """Blocks of the entries (key, label, bucket, value, times), and steps over them.

    ``size`` entries at most, ``leads`` distinct buckets. Entries without key count nothing;
    rows without buckets count as rows only.
    """

    def __init__(self, entries: DataFrame, size: int, leads: int, classes: int, key: str, label: str):
        self.spark, self.classes = entries.sparkSession, classes
        cores = self.spark.sparkContext.defaultParallelism
        many = cores * -(-size // (cores * BLOCK_ENTRIES))
        blocks = max(1, min(many, -(-size // LEAST_ENTRIES)))
        shards = max(1, -(-leads // SHARD_BUCKETS), -(-blocks // SHARD_BLOCKS))
        numbers = F.array(*[F.lit(x) for x in block_numbers(self.spark, blocks)])
        number = F.get(numbers, F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)).cast("int"))
        of = F.lit(-1)
        for c in range(classes):
            of = F.when(F.col(label) == c, c).otherwise(of)
        own = entries.where(F.col(key).isNotNull()).select(
            number.alias("block"), F.col(key).alias("key"), of.alias("label"),
            "bucket", F.col("value").cast("double").alias("value"), "times",
        )
        schema = T.StructType(
            [
                T.StructField("block", T.IntegerType()),
                T.StructField("keys", T.ArrayType(own.schema["key"].dataType)),
                *[T.StructField(x, T.BinaryType()) for x in ("labels", "sizes", "places", "values")],
                T.StructField("parts", T.ArrayType(T.StructType(
                    [
                        T.StructField("shard", T.IntegerType()),
                        T.StructField("buckets", T.BinaryType()),
                        T.StructField("times", T.BinaryType()),
                    ]
                ))),
            ]
        )
        self.written = materialize(
            own.repartition(blocks, "block").groupBy("block").applyInArrow(lambda t: packed(t, shards), schema),
            "blocks",
        )
        # read at every step, and dealt out by block once
        self.blocks = self.written.drop("parts").repartition(blocks, "block").persist(
            StorageLevel.MEMORY_AND_DISK
        )

    def begin(self) -> DataFrame:
        """The shards before the first step, written."""
        parts = self.written.select("block", F.explode("parts").alias("part")).select("block", "part.*")
        classes = self.classes
        return materialize(
            parts.groupBy("shard").applyInArrow(lambda t: gathered(t, classes), SHARD),
            "weights",
            {"compression": "none"},
        )

    def _drawn(self, drawn: tuple[int, int, float]) -> Column:
        seed, step, share = drawn
        return F.transform("keys", lambda key: draw_uniform(seed, key, F.lit(step)) < share)

    def rows(self, drawn: tuple[int, int, float] | None = None) -> int:
        """Rows in all, or those drawn at a step."""
        keys = F.col("keys") if drawn is None else F.filter(self._drawn(drawn), lambda x: x)
        return self.blocks.agg(F.sum(F.size(keys))).first()[0] or 0

    def step(self, state: DataFrame, move: tuple[float, float, int] | None, drawn=None) -> DataFrame:
        """Shards after ``move``, with the gradient sums there and the ``square`` of all of them.

        Where a bucket stands for several, products and squares count them all.
        """
        classes = self.classes

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = {name: batch.column(name) for name in batch.schema.names}
                for i in range(batch.num_rows):
                    weights = moved(columns["moments"][i], columns["sums"][i], classes, move)[:classes]
                    weights = weights * ints(columns["times"][i])
                    shard = columns["shard"][i].as_py()
                    for asked in columns["asked"][i]:
                        own = weights[:, ints(asked["places"], np.int32)].tobytes()
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([asked["block"].as_py()], pa.int32()),
                                pa.array([shard], pa.int32()),
                                pa.array([own], pa.binary()),
                            ],
                            names=["block", "shard", "data"],
                        )

        def add_up(key, shard: pa.Table, arrived: pa.Table) -> pa.Table:
            moments = moved(shard["moments"][0], shard["sums"][0], classes, move)
            sums = np.zeros((classes, moments.shape[1]))
            asked = {x["block"].as_py(): x["places"] for x in shard["asked"][0]}
            blocks = arrived["block"].to_numpy()
            data = arrived["data"].combine_chunks()
            # always in the same order, so that sums are the same in every run
            for i in np.argsort(blocks):
                sums[:, ints(asked[int(blocks[i])], np.int32)] += floats(data[int(i)], classes)
            square = float((sums * sums * ints(shard["times"][0])).sum())
            row = shard.drop_columns(["moments", "sums"])
            for name, array in (("moments", moments), ("sums", sums)):
                row = row.append_column(name, pa.array([array.tobytes()], pa.binary()))
            return row.append_column("square", pa.array([square]))

        blocks = self.blocks
        if drawn is not None:
            blocks = blocks.withColumn("drawn", self._drawn(drawn))
        messages = state.select("shard", "times", "asked", "moments", "sums").mapInArrow(send, MESSAGE)
        back = blocks.drop("keys").groupBy("block").cogroup(messages.groupBy("block")).applyInArrow(
            lambda key, block, sent: block_sums(block, sent, classes), MESSAGE
        )
        return state.groupBy("shard").cogroup(back.groupBy("shard")).applyInArrow(
            add_up, f"{SHARD}, square double"
        )

    def weights(self, state: DataFrame, move: tuple[float, float, int] | None, names: list[str]) -> DataFrame:
        """(bucket, names...): weights and moments after ``move``, a row per bucket."""
        classes = self.classes

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = {name: batch.column(name) for name in batch.schema.names}
                for i in range(batch.num_rows):
                    values = moved(columns["moments"][i], columns["sums"][i], classes, move)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ints(columns["buckets"][i])), *map(pa.array, values)],
                        names=["bucket", *names],
                    )

        kinds = ", ".join(f"{name} double" for name in names)
        return state.select("buckets", "moments", "sums").mapInArrow(spread, f"bucket bigint, {kinds}")

    def close(self) -> None:
        self.blocks.unpersist()
        release(self.written)
