"""A left join that stays even when a few keys hold much of the fact table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.session import materialize

HOT_ROWS = 50_000
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def row_width(df: DataFrame) -> Column:
    """Approximate bytes of a row."""
    parts = [F.lit(16)]
    for name, kind in df.dtypes:
        if kind.startswith("array"):
            parts.append(F.size(name) * (48 if kind.startswith("array<struct") else 8))
        elif kind in {"string", "binary"}:
            parts.append(F.octet_length(name))
        else:
            parts.append(F.lit(8))
    return sum((F.greatest(F.coalesce(part, F.lit(0)), F.lit(0)) for part in parts), F.lit(0))


def fits_broadcast(dim: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Measured size check of a materialized table: row count and bytes."""
    count, total = dim.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_width(dim)), F.lit(0))).first()
    return count <= rows and total <= BROADCAST_BYTES


def hot_part(dim: DataFrame, weight: str, hot_rows: int) -> DataFrame:
    """The rows that hold at least 1/hot_rows of all weight: never more than ``hot_rows``.

    The share is raised until the rows also fit a broadcast by their bytes.
    """
    total = dim.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    while hot_rows > 1:
        hot = dim.where(F.col(weight) >= total / hot_rows)
        if fits_broadcast(hot, hot_rows):
            return hot
        hot_rows //= 4
    return dim.limit(0)


def spread_left_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    weight: str,
    spread_by: Column,
    hot_rows: int = HOT_ROWS,
    salts: int = 1024,
    broadcast_rows: int = BROADCAST_ROWS,
    small: bool | None = None,
) -> DataFrame:
    """``facts`` left join ``dim`` on ``keys``; ``dim`` must be materialized and unique.

    A dim that measures small is broadcast whole (``small`` hands in an earlier measure).
    Otherwise the heaviest keys are broadcast, and the facts they answer travel under
    a salted key, so no partition of the remaining shuffle join receives a hot key.
    ``weight`` names the column of ``dim`` that the caller counts by; which keys are heavy
    is measured on the facts, so that a frequent key without an answer is spread too.
    """
    values = [name for name in dim.columns if name not in {*keys, weight}]
    plain = dim.drop(weight)
    if fits_broadcast(dim, broadcast_rows) if small is None else small:
        return facts.join(F.broadcast(plain), list(keys), "left")
    named = [F.col(key).isNotNull() for key in keys]
    counted = materialize(
        facts.where(reduce(and_, named)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    )
    heavy = materialize(hot_part(counted, "_n", hot_rows).select(*keys))
    hot = heavy.join(plain, list(keys), "left").select(
        *keys, F.lit(True).alias("_hot"), *[F.col(name).alias(f"_hot_{name}") for name in values]
    )
    salted = facts.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_salt",
        F.when(
            F.col("_hot") | F.col(keys[0]).isNull(),
            1 + F.pmod(F.xxhash64(spread_by), F.lit(salts)),
        ).otherwise(F.lit(0).cast("bigint")),
    )
    cold = plain.withColumn("_salt", F.lit(0).cast("bigint"))
    joined = salted.join(cold, [*keys, "_salt"], "left")
    return joined.select(
        *facts.columns,
        *[
            F.when(F.col("_hot"), F.col(f"_hot_{name}")).otherwise(F.col(name)).alias(name)
            for name in values
        ],
    )
