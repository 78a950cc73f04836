"""Structured Streaming: encode files as they arrive, keep running counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tokenloom.functions import text as tx
from tokenloom.operators.codec import Codec, encode_corpus, token_counts
from tokenloom.operators.datasets import with_offsets
from tokenloom.session import materialize, release, shared_folder
from tokenloom.sources.corpus import explode_lines

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_text_stream(
    spark: SparkSession,
    path: str,
    schema: str = "doc_id long, text string",
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    format: str = "parquet",
) -> DataFrame:
    """Files of (doc_id, text), or with ``format='text'`` lines (path, text), as a stream.

    All files that have arrived form one batch unless files or bytes are limited.
    """
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    if format == "text":
        lines = reader.option("lineSep", "\n").text(path)
        return lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return reader.schema(schema).parquet(path)


def write_arrival(rows: DataFrame, source: str, files: int) -> None:
    """Appends rows to a folder as exactly ``files`` parquet files, for streams that take so many a batch.

    Rows are dealt in turn; a file that gets none is written empty, so that an arrival and a
    batch are the same. Files of an arrival are newer than all of those before.
    """
    spark = rows.sparkSession
    before = _data_files(spark, source)
    rows.repartition(files).write.mode("append").parquet(source)
    for _ in range(files - (_data_files(spark, source) - before)):
        spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(source)


def _data_files(spark: SparkSession, folder: str) -> int:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return 0
    return sum(not x.getPath().getName().startswith(("_", ".")) for x in system.listStatus(place))


def stream_encode(
    stream: DataFrame,
    codec: Codec,
    out: str,
    checkpoint: str,
    keep: tuple[str, ...] = ("doc_id",),
    unit: str = "document",
) -> StreamingQuery:
    """Encode every arriving row once; each batch owns one folder, so a rerun overwrites.

    Runs over everything available and stops; the checkpoint lets a later run
    continue where this one ended. ``unit='line'`` encodes the lines of a text on their
    own and adds ``line_no``.
    """
    if unit not in {"document", "line"}:
        raise ValueError("unit must be 'document' or 'line'")
    shared_folder(stream.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        columns = list(keep)
        if unit == "line":
            batch, columns = explode_lines(batch, keep=tuple(keep)), [*keep, "line_no"]
        encode_corpus(batch, codec, keep=columns).write.mode("overwrite").parquet(
            f"{out}/batch_id={batch_id}"
        )

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_offsets(
    stream: DataFrame, out: str, totals: str, checkpoint: str, size: Column, key: str = "doc_id"
) -> StreamingQuery:
    """Gives every arriving row its ``offset``: the sum of ``size`` over all rows before it.

    Batches follow each other, rows of a batch stand in key order. A batch takes offsets in
    key ranges, as a table does, and starts behind the totals of the batches before it, one
    row each in ``totals``. Rows and total of a batch have folders of their own, so a batch
    that is done again after a stop gets the same offsets. Keys must be unique within a
    batch and not null; a null size counts 0.
    """
    spark = stream.sparkSession
    shared_folder(spark)
    kept = F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint"))

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = materialize(batch.withColumn("size", kept), "arrived")
        summed = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("total"))
        summed.write.mode("overwrite").parquet(f"{totals}/batch_id={batch_id}")
        earlier = spark.read.schema("total bigint, batch_id bigint").parquet(totals)
        start = earlier.where(F.col("batch_id") < batch_id).agg(F.sum("total")).first()[0] or 0
        placed = with_offsets(rows, key, F.col("size"))
        placed.withColumn("offset", F.col("offset") + F.lit(start)).write.mode("overwrite").parquet(
            f"{out}/batch_id={batch_id}"
        )
        release(rows)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _running_counts(counts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Keeps state in RocksDB, off the heap; its provider is part of the query's checkpoint."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = counts.sparkSession.conf.get(provider, None)
    counts.sparkSession.conf.set(provider, ROCKSDB)
    try:
        return _started(counts, out, checkpoint)
    finally:
        if before is None:
            counts.sparkSession.conf.unset(provider)
        else:
            counts.sparkSession.conf.set(provider, before)


def _started(counts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_pretoken_counts(
    stream: DataFrame, out: str, checkpoint: str, text: str = "text"
) -> StreamingQuery:
    """Running pretoken counts; every batch writes the counts it changed."""
    words = stream.select(F.explode(tx.pretokens(F.col(text))).alias("pretoken"))
    counts = words.groupBy("pretoken").agg(F.count(F.lit(1)).alias("freq"))
    return _running_counts(counts, out, checkpoint)


def stream_token_counts(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Running token counts over a stream of id arrays."""
    return _running_counts(token_counts(stream), out, checkpoint)


def latest_counts(spark: SparkSession, out: str, key: str, count: str) -> DataFrame:
    """The newest count of every key among the batches written so far."""
    written = spark.read.parquet(out)
    return written.groupBy(key).agg(F.max_by(count, "batch_id").alias(count))


def compact_counts(spark: SparkSession, out: str, key: str, count: str) -> None:
    """Fold all batches so far into the newest one's folder, so readers scan one snapshot.

    Run it between stream runs. The snapshot is written beside the batches and takes the
    place of the newest before the older ones go, so a stop in between loses nothing.
    """
    written = spark.read.parquet(out)
    last = written.agg(F.max("batch_id")).first()[0]
    place = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{name}")
    files = place("").getFileSystem(spark._jsc.hadoopConfiguration())
    latest_counts(spark, out, key, count).write.mode("overwrite").parquet(f"{out}/_snapshot")
    older = [row[0] for row in written.select("batch_id").distinct().collect()]
    files.delete(place(f"batch_id={last}"), True)
    files.rename(place("_snapshot"), place(f"batch_id={last}"))
    for batch_id in older:
        if batch_id != last:
            files.delete(place(f"batch_id={batch_id}"), True)
