"""Corpus readers and the token dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.functions import text as tx
from tokenloom.operators.codec import Codec, encode_corpus
from tokenloom.operators.datasets import delimited, token_stream
from tokenloom.operators.joins import fits_broadcast
from tokenloom.session import materialize

TOKEN_SCHEMA = "doc_id long, n_bytes long, tokens array<int>, offset long"


def read_corpus(spark: SparkSession, path: str, format: str = "text") -> DataFrame:
    """Whole text files as (path, text), or a parquet corpus as it is."""
    if format == "parquet":
        return spark.read.parquet(path)
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files: (path, line_no, text), with their newline.

    Files are read in splits. A last line without newline stays without one. ``line_no``
    rises within a file but is not dense: it holds the split and the line's place there.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("_size"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("text"),
    )
    # bytes of all lines, one newline each, exceed a file that lacks the last by one
    sizes = materialize(
        lines.groupBy("path").agg(
            (F.sum(F.octet_length("text") + 1) > F.max("_size")).alias("_open"),
            F.max(F.struct("_block", "_id")).alias("_last"),
        )
    )
    if fits_broadcast(sizes):
        sizes = F.broadcast(sizes)
    is_last = F.struct("_block", "_id") == F.col("_last")
    ended = F.when(F.col("_open") & is_last, F.col("text")).otherwise(F.concat("text", F.lit("\n")))
    place = F.col("_block") + F.col("_id").bitwiseAND((1 << 33) - 1)
    return lines.join(sizes, "path").select("path", place.alias("line_no"), ended.alias("text"))


def explode_lines(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Lines of a text column with their newline: (keep..., line_no, text).

    An empty text has one row without line.
    """
    lines = F.array_remove(F.split(text, r"(?<=\n)"), "")
    return df.select(*keep, F.posexplode_outer(lines).alias("line_no", "text"))


def split_documents(df: DataFrame, delimiter: str = tx.END_OF_TEXT, text: str = "text") -> DataFrame:
    """One row per document of delimited streams: (part, text); empty parts are dropped."""
    parts = F.split(text, tx.quoted(delimiter))
    others = [name for name in df.columns if name != text]
    return df.select(*others, F.posexplode(parts).alias("part", "text")).where(F.col("text") != "")


def read_documents(spark: SparkSession, path: str, delimiter: str = tx.END_OF_TEXT) -> DataFrame:
    """Documents of delimited text files, read in splits: (path, part, text).

    ``part`` rises within a file: where its split begins plus its place there.
    """
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return (
        spark.read.text(path, lineSep=delimiter)
        .select(
            F.col("_metadata.file_path").alias("path"),
            (F.col("_metadata.file_block_start") + place).alias("part"),
            F.col("value").alias("text"),
        )
        .where(F.col("text") != "")
    )


def checked_ids(df: DataFrame, limit: int = 65535, tokens: str = "tokens") -> DataFrame:
    """Fail on an id above ``limit`` instead of letting it wrap."""
    over = F.coalesce(F.array_max(tokens), F.lit(0)) > limit
    failed = F.raise_error(F.lit(f"token id above {limit}")).cast("array<int>")
    return df.withColumn(tokens, F.when(over, failed).otherwise(F.col(tokens)))


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a finished write."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def write_token_dataset(
    stream: DataFrame, path: str, split: str, overwrite: bool = False, limit: int = 65535
) -> None:
    """Write one split (doc_id, n_bytes, tokens, offset).

    A finished split stays unless told; what an interrupted write left is replaced.
    """
    folder = f"{path}/split={split}"
    if not overwrite and is_written(stream.sparkSession, folder):
        return
    columns = ["doc_id", "n_bytes", "tokens", "offset"]
    checked_ids(stream, limit).select(*columns).write.mode("overwrite").parquet(folder)


def read_token_dataset(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """The written splits; naming one prunes the others."""
    df = spark.read.schema(TOKEN_SCHEMA + ", split string").parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def tokenize_dataset(
    corpora: dict[str, DataFrame],
    codec: Codec,
    path: str,
    unit: str = "document",
    overwrite: bool = False,
    limit: int = 65535,
) -> DataFrame:
    """Encode (doc_id, text) corpora into splits and report their compression.

    A finished split is skipped before any work unless ``overwrite``; an unfinished one is
    built anew. An id above ``limit`` fails, whatever the size of the vocabulary.

    ``unit='line'`` encodes each line on its own, so whitespace runs do not cross
    line ends. Every document ends with the delimiter if the codec has one.
    """
    if unit not in {"document", "line"}:
        raise ValueError("unit must be 'document' or 'line'")
    spark = next(iter(corpora.values())).sparkSession
    for split, corpus in corpora.items():
        if not overwrite and is_written(spark, f"{path}/split={split}"):
            continue
        rows = corpus if unit == "document" else explode_lines(corpus)
        keep = ["doc_id", "n_bytes"] if unit == "document" else ["doc_id", "line_no", "n_bytes"]
        sized = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
        encoded = encode_corpus(sized, codec, keep=keep)
        if unit == "line":
            listed = F.array_sort(F.collect_list(F.struct("line_no", "tokens")))
            encoded = encoded.groupBy("doc_id").agg(
                F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"),
                F.flatten(F.transform(listed, lambda line: line["tokens"])).alias("tokens"),
            )
        if codec.end_id is not None:
            encoded = delimited(encoded, codec.end_id)
        write_token_dataset(token_stream(materialize(encoded)), path, split, overwrite, limit)
    written = read_token_dataset(spark, path).where(F.col("split").isin(list(corpora)))
    return written.groupBy("split").agg(
        F.sum("n_bytes").alias("n_bytes"),
        F.sum(F.size("tokens")).alias("n_tokens"),
        (F.sum("n_bytes") / F.sum(F.size("tokens"))).alias("bytes_per_token"),
        (F.sum("n_bytes") / (2 * F.sum(F.size("tokens")))).alias("uint16_ratio"),
    )
