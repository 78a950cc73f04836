"""Seeded draws that depend only on their key, so retries and replans agree."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def draw_integer(seed: int, *keys: Column) -> Column:
    """A 52-bit integer from the seed and the keys."""
    text = F.concat_ws(":", F.lit(str(seed)), *[key.cast("string") for key in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def draw_uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1)."""
    return draw_integer(seed, *keys).cast("double") / float(1 << 52)
