"""Vocabulary tables: validity filters, finalizing, sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def valid_merge_filter(merges: DataFrame, vocab: DataFrame) -> DataFrame:
    """Merges whose halves are both in the vocabulary."""
    known = vocab.select("token_bytes")
    left = known.withColumnRenamed("token_bytes", "left_bytes")
    right = known.withColumnRenamed("token_bytes", "right_bytes")
    return merges.join(left, "left_bytes", "left_semi").join(right, "right_bytes", "left_semi")


def skipped_merges(merges: DataFrame, vocab: DataFrame) -> DataFrame:
    """The report of merges that :func:`valid_merge_filter` leaves out."""
    return merges.join(valid_merge_filter(merges, vocab).select("rank"), "rank", "left_anti")


def finalize_vocab(
    vocab: DataFrame, merges: DataFrame, specials: Sequence[str] = ()
) -> DataFrame:
    """Append what is missing: specials, then tokens lost at a line's last space.

    A merge line ending in a space has an empty right half; if its left half has
    no token it becomes a whole-pretoken entry. New ids follow the greatest one,
    specials in the given order first, then by rank. Present tokens keep theirs.
    """
    spark = vocab.sparkSession
    named = spark.createDataFrame(
        [(-len(specials) + i, bytearray(s.encode("utf-8"))) for i, s in enumerate(specials)],
        "place int, token_bytes binary",
    )
    lost = merges.where(F.octet_length("right_bytes") == 0).select(
        F.col("rank").alias("place"), F.col("left_bytes").alias("token_bytes")
    )
    wanted = (
        named.unionByName(lost)
        .groupBy("token_bytes")
        .agg(F.min("place").alias("place"))
        .join(vocab.select("token_bytes"), "token_bytes", "left_anti")
    )
    top = vocab.agg(F.coalesce(F.max("token_id"), F.lit(-1))).first()[0]
    # One task is enough: the rows are a part of one vocabulary.
    added = wanted.select(
        (F.row_number().over(Window.orderBy("place")) + F.lit(top)).cast("int").alias("token_id"),
        "token_bytes",
        F.lit(True).alias("is_special"),
    )
    return vocab.select("token_id", "token_bytes", "is_special").unionByName(added)


def duplicate_tokens(vocab: DataFrame) -> DataFrame:
    """Byte strings spelled by more than one id, with the id that encoding uses."""
    return (
        vocab.groupBy("token_bytes")
        .agg(F.count(F.lit(1)).alias("n_ids"), F.max("token_id").alias("used_id"))
        .where("n_ids > 1")
    )


def vocab_size(vocab: DataFrame) -> int:
    return vocab.count()
