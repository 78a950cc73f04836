"""Learning-rate schedule, clipping and parameter-update expressions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F


def cosine_rate(
    step: Column, top: float, bottom: float, warmup: int, cycle: Column | int
) -> Column:
    """Linear warm-up to ``top``, half a cosine down to ``bottom``, then flat."""
    last = cycle if isinstance(cycle, Column) else F.lit(cycle)
    progress = (step - F.lit(warmup)) / (last - F.lit(warmup))
    falling = F.lit(bottom) + F.lit(0.5 * (top - bottom)) * (1 + F.cos(F.pi() * progress))
    return (
        F.when(step < warmup, step.cast("double") * top / float(max(warmup, 1)))
        .when(step > last, F.lit(float(bottom)))
        .otherwise(falling)
    )


def clip_factor(norm: Column, limit: float) -> Column:
    """What to multiply every gradient by so that the joint norm stays below ``limit``."""
    return F.when(norm > limit, F.lit(float(limit)) / (norm + F.lit(1e-6))).otherwise(F.lit(1.0))


def sgd_value(value: Column, gradient: Column, rate: float, step: int) -> Column:
    """Plain gradient step with rate / sqrt(step + 1); no gradient, no change."""
    return value - F.coalesce(gradient, F.lit(0.0)) * rate / (float(step + 1) ** 0.5)


def adamw_columns(
    value: Column,
    first: Column,
    second: Column,
    gradient: Column,
    rate: float,
    step: int,
    decay: float = 0.01,
    betas: tuple[float, float] = (0.9, 0.999),
    epsilon: float = 1e-8,
) -> tuple[Column, Column, Column]:
    """New (value, first moment, second moment) at 1-based ``step``.

    The step size is corrected for bias and epsilon is added outside the
    correction; decay uses the plain rate and follows the step.
    """
    b1, b2 = betas
    size = rate * (1 - b2**step) ** 0.5 / (1 - b1**step)
    new_first = F.lit(b1) * first + F.lit(1 - b1) * gradient
    new_second = F.lit(b2) * second + F.lit(1 - b2) * gradient * gradient
    moved = value - F.lit(size) * new_first / (F.sqrt(new_second) + F.lit(epsilon))
    decayed = moved - F.lit(rate * decay) * moved

    def kept(new: Column, old: Column) -> Column:
        return F.when(gradient.isNull(), old).otherwise(new)

    return kept(decayed, value), kept(new_first, first), kept(new_second, second)


def adamw_arrays(
    value: np.ndarray,
    first: np.ndarray,
    second: np.ndarray,
    gradient: np.ndarray,
    rate: float,
    step: int,
    decay: float = 0.01,
    betas: tuple[float, float] = (0.9, 0.999),
    epsilon: float = 1e-8,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`adamw_columns` over arrays."""
    b1, b2 = betas
    size = rate * (1 - b2**step) ** 0.5 / (1 - b1**step)
    first = b1 * first + (1 - b1) * gradient
    second = b2 * second + (1 - b2) * gradient * gradient
    moved = value - size * first / (np.sqrt(second) + epsilon)
    return moved - (rate * decay) * moved, first, second
