"""Small helpers shared by the operators: names, words, splits by hash, written tables."""

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.session import scratch_path

#: Words of the contracts: runs without space, tab, line feeds, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {name.lower() for name in df.columns}
    name = f"_{base}"
    while name.lower() in taken:
        name += "_"
    return name


def q(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed."""
    return F.translate(text, UPPER, UPPER.lower())


def id_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to the shared folder and read it back: lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stash(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove written tables that nothing reads any more."""
    for table in tables:
        for path in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(sizes: Sequence[int], most: int):
    """Consecutive ranges whose sizes add up to about ``most``; at least one item each."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def unique_name(base: str) -> str:
    return f"{base}_{uuid.uuid4().hex[:8]}"
