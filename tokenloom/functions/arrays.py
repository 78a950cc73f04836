"""Array expressions: prefix sums, softmax, losses, norms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(values: Column, zero: Column) -> Column:
    """Running totals of an array by doubling: O(n log n), no explode, no shuffle."""

    def shifted(totals: Column, step: Column) -> Column:
        by = F.least(F.pow(F.lit(2), step).cast("int"), F.size(totals))
        return F.concat(
            F.array_repeat(zero, by), F.slice(totals, F.lit(1), F.size(totals) - by)
        )

    def doubled(start: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.ceil(F.log2(F.size(start) + 1)).cast("int")),
            start,
            lambda totals, step: F.zip_with(totals, shifted(totals, step), lambda a, b: a + b),
        )

    return bind(values, doubled)


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def dot(left: Column, right: Column) -> Column:
    return array_sum(F.zip_with(left, right, lambda a, b: a.cast("double") * b))


def checked_temperature(temperature: float) -> float:
    """The accepted range is (1e-3, 1]."""
    if not 1e-3 < temperature <= 1.0:
        raise ValueError("temperature must be in (1e-3, 1]")
    return float(temperature)


def softmax(logits: Column, temperature: float = 1.0) -> Column:
    """Probabilities of an array of logits, shifted by the maximum for stability."""
    scale = checked_temperature(temperature)

    def normalized(weights: Column) -> Column:
        return bind(array_sum(weights), lambda total: F.transform(weights, lambda w: w / total))

    def shifted(scaled: Column) -> Column:
        return bind(
            F.array_max(scaled),
            lambda top: bind(F.transform(scaled, lambda x: F.exp(x - top)), normalized),
        )

    return bind(F.transform(logits, lambda x: x.cast("double") / scale), shifted)


def log_sum_exp(logits: Column) -> Column:
    return bind(
        F.array_max(logits).cast("double"),
        lambda top: top
        + F.log(array_sum(F.transform(logits, lambda x: F.exp(x.cast("double") - top)))),
    )


def negative_log_likelihood(logits: Column, target: Column) -> Column:
    """-log softmax(logits)[target], target 0-based."""
    return log_sum_exp(logits) - F.element_at(logits, target + 1).cast("double")


def rms_normalize(values: Column, weight: Column | None = None) -> Column:
    """x / sqrt(mean(x^2) + 1e-5), times an optional weight per dimension."""
    squares = F.transform(values, lambda x: x.cast("double") * x.cast("double"))
    factor = F.lit(1.0) / F.sqrt(array_sum(squares) / F.size(values) + F.lit(1e-5))
    scaled = bind(factor, lambda by: F.transform(values, lambda x: x.cast("double") * by))
    if weight is None:
        return scaled
    return F.zip_with(scaled, weight, lambda x, w: x * w)
