"""Vocabulary and merge files, metrics, saved states."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tokenloom.functions import text as tx

VOCAB_SCHEMA = "token_id int, token_bytes binary, is_special boolean"


def _spelled(data, printable: bool):
    return tx.to_printable(tx.lift_binary(data)) if printable else data.cast("string")


def _bytes(spelled, printable: bool):
    return tx.unlift(tx.from_printable(spelled)) if printable else spelled.cast("binary")


def printable_tokens(df: DataFrame, column: str = "token_bytes", out: str = "token") -> DataFrame:
    """Adds the printable spelling of a binary column."""
    return df.withColumn(out, _spelled(F.col(column), True))


def write_vocab(vocab: DataFrame, path: str, printable: bool = True) -> None:
    """One JSON object {token: id}; the greatest id wins where tokens repeat."""
    spelled = vocab.select(_spelled(F.col("token_bytes"), printable).alias("token"), "token_id")
    unique = spelled.groupBy("token").agg(F.max("token_id").alias("token_id"))
    entries = F.array_sort(F.collect_list(F.struct("token_id", "token")))
    ordered = F.transform(entries, lambda e: F.struct(e["token"], e["token_id"]))
    unique.agg(F.to_json(F.map_from_entries(ordered)).alias("value")).coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def read_vocab(spark: SparkSession, path: str, printable: bool = True) -> DataFrame:
    """(token_id, token_bytes, is_special) from a JSON object {token: id}."""
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.explode(F.from_json("value", "map<string,int>")).alias("token", "token_id"))
    return entries.select(
        "token_id", _bytes(F.col("token"), printable).alias("token_bytes"), F.lit(False).alias("is_special")
    )


def write_merges(merges: DataFrame, path: str, printable: bool = True) -> None:
    """Lines 'left right' in rank order under a version line."""
    line = F.concat_ws(
        " ", _spelled(F.col("left_bytes"), printable), _spelled(F.col("right_bytes"), printable)
    )
    listed = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    body = F.array_join(F.transform(listed, lambda e: e["line"]), "\n")
    merges.agg(F.concat(F.lit("#version: 0.2\n"), body).alias("value")).coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def read_merge_lines(spark: SparkSession, path: str, printable: bool = True) -> DataFrame:
    """(rank, left_bytes, right_bytes) of every merge line, by file order.

    Version lines and blank lines do not count; a line splits at its last space.
    """
    text = spark.read.text(path, wholetext=True)
    lines = text.select(F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("line_no", "line"))
    kept = lines.where(~F.col("line").startswith("#version") & (F.col("line") != ""))
    halves = kept.select(
        "line_no",
        F.regexp_extract("line", r"^(.*) ([^ ]*)$", 1).alias("left"),
        F.regexp_extract("line", r"^(.*) ([^ ]*)$", 2).alias("right"),
    )
    # One vocabulary's merge list is small; its order is the file's.
    return halves.select(
        (F.row_number().over(Window.orderBy("line_no")) - 1).cast("int").alias("rank"),
        _bytes(F.col("left"), printable).alias("left_bytes"),
        _bytes(F.col("right"), printable).alias("right_bytes"),
    )


def read_merges(
    spark: SparkSession, path: str, vocab: DataFrame, printable: bool = True
) -> DataFrame:
    """Merge lines whose halves are both tokens; the others are left out."""
    from tokenloom.operators.vocabulary import valid_merge_filter

    return valid_merge_filter(read_merge_lines(spark, path, printable), vocab)


def write_metrics(spark: SparkSession, path: str, run: str, iteration: int, values: dict) -> None:
    """Append one row per metric: (run, iteration, split, metric, value).

    A metric named 'split/metric' goes to that split.
    """
    rows = []
    for name, value in values.items():
        split, _, metric = name.rpartition("/")
        rows.append((run, iteration, split or None, metric, float(value)))
    spark.createDataFrame(
        rows, "run string, iteration int, split string, metric string, value double"
    ).coalesce(1).write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The appended metric rows."""
    schema = "run string, iteration int, split string, metric string, value double"
    return spark.read.schema(schema).parquet(path)


def save_state(
    parameters: DataFrame, path: str, iteration: int, config: dict | None = None
) -> None:
    """Write parameters and moments, then list them in the manifest."""
    spark = parameters.sparkSession
    parameters.write.mode("overwrite").parquet(f"{path}/state-{iteration:09d}")
    spark.createDataFrame(
        [(iteration, json.dumps(config or {}))], "iteration int, config string"
    ).coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def load_state(
    spark: SparkSession, path: str, iteration: int | None = None, optimizer: bool = True
) -> tuple[DataFrame, int, dict]:
    """(parameters, iteration, config) of the named or last listed state.

    Without ``optimizer`` the moments are not read.
    """
    listed = spark.read.schema("iteration int, config string").parquet(f"{path}/manifest")
    if iteration is not None:
        listed = listed.where(F.col("iteration") == iteration)
    row = listed.orderBy(F.col("iteration").desc()).first()
    if row is None:
        raise ValueError("no saved state")
    parameters = spark.read.parquet(f"{path}/state-{row['iteration']:09d}")
    if not optimizer:
        parameters = parameters.drop("m", "v")
    return parameters, row["iteration"], json.loads(row["config"])


@dataclass
class SavedTraining:
    words: DataFrame
    base: list[bytes]
    merges: list[tuple[int, int]]


class TrainingState:
    """Progress of a vocabulary training: rewritten words and merges so far."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def save(self, words: DataFrame, base: list[bytes], merges: list[tuple[int, int]]) -> None:
        spark = words.sparkSession
        step = len(merges)
        words.write.mode("overwrite").parquet(f"{self.path}/words-{step:09d}")
        rows = [(i, bytearray(b), None, None) for i, b in enumerate(base)]
        rows += [(len(base) + i, None, left, right) for i, (left, right) in enumerate(merges)]
        spark.createDataFrame(
            rows, "token_id int, token_bytes binary, left_id int, right_id int"
        ).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/tokens-{step:09d}")
        spark.createDataFrame([(step,)], "step int").coalesce(1).write.mode("append").parquet(
            f"{self.path}/manifest"
        )

    def load(self, spark: SparkSession) -> SavedTraining | None:
        """The last complete save, or None when nothing was listed yet."""
        from pyspark.errors import AnalysisException

        try:
            step = spark.read.parquet(f"{self.path}/manifest").agg(F.max("step")).first()[0]
        except AnalysisException:
            return None
        rows = spark.read.parquet(f"{self.path}/tokens-{step:09d}").orderBy("token_id").collect()
        return SavedTraining(
            spark.read.parquet(f"{self.path}/words-{step:09d}"),
            [bytes(row["token_bytes"]) for row in rows if row["left_id"] is None],
            [(row["left_id"], row["right_id"]) for row in rows if row["left_id"] is not None],
        )
