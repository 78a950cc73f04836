"""Written tables with snapshots, and token windows read through a manifest of files.

A write goes to a folder of its own; a snapshot becomes visible last, by one file name that
is created only if it is new. So a reader always sees a finished table, and a write that
stops midway leaves the one before it untouched. The manifest names each file with the range
of the sort key it holds, so that a few keys open a few files.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.operators.datasets import _pieces, _windows, sample_starts

#: Tokens of a stored block; bytes of a row group, so that a block is read by itself.
BLOCK_TOKENS, GROUP_BYTES = 4096, 1 << 20


class _Folder:
    """A folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm_path = spark._jvm.org.apache.hadoop.fs.Path
        self.path = path.rstrip("/")
        self.system = self.jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, below: str) -> list[str]:
        place = self.jvm_path(f"{self.path}/{below}")
        if not self.system.exists(place):
            return []
        return sorted(x.getPath().getName() for x in self.system.listStatus(place))

    def create(self, name: str) -> bool:
        """An empty file, unless it exists."""
        place = self.jvm_path(f"{self.path}/{name}")
        self.system.mkdirs(place.getParent())
        return self.system.createNewFile(place)

    def delete(self, name: str) -> None:
        self.system.delete(self.jvm_path(f"{self.path}/{name}"), True)


@dataclass(frozen=True)
class Snapshot:
    path: str
    version: int
    token: str

    @property
    def name(self) -> str:
        return f"_snapshots/{self.version:010d}-{self.token}"

    @property
    def data(self) -> str:
        return f"{self.path}/data-{self.token}"

    @property
    def manifest(self) -> str:
        return f"{self.path}/manifest-{self.token}"


def snapshots(spark: SparkSession, path: str) -> list[Snapshot]:
    """All finished snapshots of a table, oldest first."""
    found = []
    for name in _Folder(spark, path).names("_snapshots"):
        version, _, token = name.partition("-")
        found.append(Snapshot(path.rstrip("/"), int(version), token))
    return sorted(found, key=lambda x: (x.version, x.token))


def latest(spark: SparkSession, path: str) -> Snapshot:
    found = snapshots(spark, path)
    if not found:
        raise FileNotFoundError(f"no finished snapshot at {path}")
    return found[-1]


def write_snapshot(
    df: DataFrame, path: str, key: str, options: dict[str, str] | None = None, clustered: bool = False
) -> Snapshot:
    """Write a table clustered and sorted by ``key``, with its manifest, as a new snapshot.

    ``clustered`` tells that the partitions are ranges of the key already.
    """
    spark = df.sparkSession
    before = snapshots(spark, path)
    made = Snapshot(path.rstrip("/"), before[-1].version + 1 if before else 1, uuid.uuid4().hex)
    ranged = df if clustered else df.repartitionByRange(key)
    ranged.sortWithinPartitions(key).write.options(**(options or {})).parquet(made.data)
    written = spark.read.schema(df.schema).parquet(made.data)
    files = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("n_rows")
    )
    files.coalesce(1).write.parquet(made.manifest)
    if not _Folder(spark, path).create(made.name):
        raise FileExistsError(made.name)
    return made


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the last finished snapshot, or of a named one."""
    for found in reversed(snapshots(spark, path)):
        if version is None or found.version == version:
            return spark.read.parquet(found.data)
    raise FileNotFoundError(f"no snapshot {version or ''} at {path}")


def files_of(spark: SparkSession, snapshot: Snapshot, keys: list[int]) -> list[str]:
    """The files that may hold any of the keys: at most as many rows as files meet the keys."""
    if not keys:
        return []
    manifest = spark.read.parquet(snapshot.manifest)
    asked = spark.createDataFrame([(x,) for x in sorted(set(keys))], "asked long")
    within = F.col("asked").between(F.col("first"), F.col("last"))
    return sorted(
        x.file for x in manifest.join(F.broadcast(asked), within, "left_semi").select("file").collect()
    )


def expire_snapshots(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove all but the last ``keep`` snapshots and what unfinished writes left.

    Only for a table that nobody writes or reads in an older snapshot meanwhile.
    """
    folder, found = _Folder(spark, path), snapshots(spark, path)
    kept = {x.token for x in found[-keep:]} if keep else set()
    for old in found:
        if old.token not in kept:
            folder.delete(old.name)
    gone = [x for x in folder.names("") if x.partition("-")[2] not in kept and x.startswith(("data-", "manifest-"))]
    for name in gone:
        folder.delete(name)
    return len(found) - len(kept)


def write_token_blocks(
    stream: DataFrame, path: str, block: int = BLOCK_TOKENS, tokens: str = "tokens"
) -> Snapshot:
    """A token stream (offset, tokens) as blocks of ``block`` tokens: (block_id, tokens).

    Pieces are put into ranges of blocks before they are joined, so tokens are shuffled once.
    """
    pieces = _pieces(stream, block, 0, tokens).repartitionByRange("window_id")
    blocks = _windows(pieces).withColumnRenamed("window_id", "block_id")
    sized = blocks.withColumn("block", F.lit(block))
    options = {"parquet.block.size": str(GROUP_BYTES)}
    return write_snapshot(sized, path, "block_id", options, clustered=True)


@dataclass
class WindowPlan:
    """Starts of a batch of windows, and the only files that hold them."""

    starts: list[tuple[int, int]]
    block: int
    files: list[str]
    n_files: int


def plan_windows(
    spark: SparkSession, snapshot: Snapshot, batch: int, length: int, strategy: str = "random", seed: int = 42
) -> WindowPlan:
    """Draw a batch of windows and find their files; what the driver holds is bounded by the batch.

    Only the manifest and the last block are read.
    """
    manifest = spark.read.parquet(snapshot.manifest)
    n_files, last = manifest.agg(F.count(F.lit(1)), F.max("last")).first()
    if last is None:
        raise ValueError("the dataset is shorter than one window and its label")
    ending = spark.read.parquet(*files_of(spark, snapshot, [last])).where(F.col("block_id") == last)
    block, rest = ending.select("block", F.size("tokens")).first()
    drawn = sample_starts(spark, last * block + rest, batch, length, strategy, seed)
    starts = [(x["sample_id"], x["start"]) for x in drawn.collect()]
    needed = {k for _, x in starts for k in range(x // block, (x + length) // block + 1)}
    return WindowPlan(starts, block, files_of(spark, snapshot, list(needed)), n_files)


def read_windows(spark: SparkSession, plan: WindowPlan, length: int) -> DataFrame:
    """The planned windows with next-token labels: (sample_id, start, input, target).

    Only the plan's files are opened, and of them the row groups of the blocks asked for.
    """
    rows = spark.createDataFrame(plan.starts, "sample_id long, start long")
    first, last = (F.floor(x / plan.block).cast("long") for x in (F.col("start"), F.col("start") + length))
    needed = rows.withColumn("block_id", F.explode(F.sequence(first, last)))
    ids = sorted({k for _, x in plan.starts for k in range(x // plan.block, (x + length) // plan.block + 1)})
    if not ids:
        return rows.select("*", *[F.array().cast("array<int>").alias(x) for x in ("input", "target")])
    blocks = spark.read.parquet(*plan.files).where(_among(F.col("block_id"), ids))
    begin = F.greatest(F.col("start") - F.col("block_id") * plan.block, F.lit(0))
    end = F.least(F.col("start") + length + 1 - F.col("block_id") * plan.block, F.size("tokens").cast("long"))
    part = F.slice("tokens", (begin + 1).cast("int"), F.greatest(end - begin, F.lit(0)).cast("int"))
    parts = blocks.join(F.broadcast(needed), "block_id").select("sample_id", "start", "block_id", part.alias("part"))
    listed = F.array_sort(F.collect_list(F.struct("block_id", "part")))
    whole = parts.groupBy("sample_id", "start").agg(
        F.flatten(F.transform(listed, lambda x: x["part"])).alias("tokens")
    )
    return whole.select(
        "sample_id",
        "start",
        F.slice("tokens", 1, length).alias("input"),
        F.slice("tokens", 2, length).alias("target"),
    )


def _among(column: Column, values: list[int]) -> Column:
    """Membership as a union of ranges, which reaches the row groups' statistics."""
    ranges: list[list[int]] = []
    for value in values:
        if ranges and value == ranges[-1][1] + 1:
            ranges[-1][1] = value
        else:
            ranges.append([value, value])
    found = F.lit(False)
    for low, high in ranges:
        found = found | column.between(low, high)
    return found
