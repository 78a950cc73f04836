"""A softmax classifier over sparse features whose weights stay a stored table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tokenloom.functions.buckets import bucket_counts
from tokenloom.functions.text import pretokens
from tokenloom.operators.joins import BROADCAST_ROWS, HOT_ROWS, fits_broadcast, spread_left_join
from tokenloom.operators.models import scheduled_rates
from tokenloom.operators.sparse_blocks import Descent
from tokenloom.session import collect_garbage, materialize, release

#: Most buckets that are broadcast, if they also measure small; steps between two
#: collections of the driver's garbage, with which the shuffle files of old steps go.
BROADCAST_BUCKETS, GARBAGE_STEPS = 1 << 21, 8


def hashed_entries(
    df: DataFrame, buckets: int, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """(keep..., bucket, value): share of the row's pretokens per hash bucket, present ones only.

    A row without pretokens gives one entry without bucket. ``keep`` should tell rows apart:
    then nothing is shuffled. Counts of rows that share it are added up.
    """

    def counted(rows: DataFrame) -> DataFrame:
        listed = bucket_counts(pretokens(F.col(text)), buckets).alias("_counts")
        entries = rows.select(*keep, listed).select(*keep, F.explode_outer("_counts").alias("_one"))
        return entries.select(*keep, "_one.bucket", "_one.n", "_one.total")

    def shares(entries: DataFrame) -> DataFrame:
        return entries.select(*keep, "bucket", (F.col("n") / F.col("total")).alias("value"))

    counts = df.groupBy(*keep).agg(F.count(F.lit(1)).alias("_rows"))
    shared = materialize(counts.where("_rows > 1").select(*keep))
    if shared.isEmpty():
        release(shared)
        return shares(counted(df))
    there = shared.select(*[F.col(name).alias(f"_{i}") for i, name in enumerate(keep)])
    same = reduce(and_, [df[name].eqNullSafe(F.col(f"_{i}")) for i, name in enumerate(keep)])
    merged = counted(df.join(there, same, "left_semi")).groupBy(*keep, "bucket").agg(
        F.sum("n").alias("n"), F.first("total").alias("total")
    )
    return shares(counted(df.join(there, same, "left_anti"))).unionByName(shares(merged))


def with_frequencies(entries: DataFrame, key: str = "doc_id") -> DataFrame:
    """Entries with ``n``, the entries of their bucket in the whole table; written."""
    entries = found = materialize(entries, "entries")
    counted = materialize(
        entries.where("bucket is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    )
    dim = counted.withColumn("_weight", F.col("n"))
    joined = spread_left_join(
        entries, dim, ["bucket"], "_weight", F.col(key), broadcast_rows=BROADCAST_BUCKETS
    )
    joined = materialize(joined, "entries")
    release(counted, found)
    return joined


def _columns(prefix: str, classes: int) -> list[str]:
    return [f"{prefix}{c}" for c in range(classes)]


def initial_weights(entries: DataFrame, classes: int) -> DataFrame:
    """(bucket, n, w0.., m0.., v0..): zeros for every bucket that occurs.

    Buckets that never occur have no gradient and would stay zero.
    """
    seen = entries.where("bucket is not null").groupBy("bucket").agg(F.first("n").alias("n"))
    names = [name for prefix in "wmv" for name in _columns(prefix, classes)]
    return seen.select("bucket", "n", *[F.lit(0.0).alias(name) for name in names])


def hot_floor(weights: DataFrame, classes: int) -> int:
    """Buckets with at least so many entries are broadcast: all, if they measure small.

    Otherwise those that hold at least 1/``HOT_ROWS`` of all entries: never more than
    ``HOT_ROWS`` buckets, less where classes make rows wide.
    """
    slim = weights.select("bucket", "n", *_columns("w", classes))
    if fits_broadcast(slim, BROADCAST_BUCKETS):
        return 0
    most = max(1, HOT_ROWS // max(1, classes // 16))
    return max(1, -(-weights.agg(F.sum("n")).first()[0] // most))


def lead_buckets(entries: DataFrame, key: str = "doc_id") -> DataFrame:
    """(bucket, n, lead, times), written: buckets that move alike stand as one.

    Buckets whose only entry is of the same row and value have the same gradient at every
    step, and so the same weights. The least of them, ``lead``, stands for all ``times``.
    """
    known = entries.where("bucket is not null")
    seen = materialize(
        known.groupBy("bucket").agg(
            F.first("n").alias("n"),
            F.count(F.lit(1)).alias("_entries"),
            F.first(key).alias("_row"),
            F.first("value").alias("_value"),
        )
    )
    lone = (F.col("_entries") == 1) & F.col("_row").isNotNull()
    alike = seen.where(lone).groupBy("_row", "_value").agg(
        F.min("bucket").alias("lead"), F.count(F.lit(1)).alias("times")
    )
    names = ["bucket", "n", "lead", "times"]
    alone = seen.where(lone).join(alike, ["_row", "_value"]).select(*names)
    once = F.lit(1).cast("bigint").alias("times")
    others = seen.where(~lone).select("bucket", "n", F.col("bucket").alias("lead"), once)
    led = materialize(alone.unionByName(others), "buckets")
    release(seen)
    return led


def lead_entries(entries: DataFrame, led: DataFrame, key: str = "doc_id") -> DataFrame:
    """The entries of leading buckets with their ``times``, and those without bucket.

    ``led`` must be there as long as they are read.
    """
    leads = led.where("bucket = lead").select("bucket", "times", F.col("n").alias("_weight"))
    met = spread_left_join(
        entries, leads, ["bucket"], "_weight", F.col(key), broadcast_rows=BROADCAST_BUCKETS
    )
    return met.where("bucket is null or times is not null")


def _times(table: DataFrame) -> Column:
    return F.col("times") if "times" in table.columns else F.lit(1)


def _met(entries: DataFrame, weights: DataFrame, classes: int, floor: int) -> DataFrame:
    """Entries with the weights of their bucket, or nulls; hot buckets never travel."""
    slim = weights.select("bucket", F.col("n").alias("_n"), *_columns("w", classes))
    hot_side = F.broadcast(slim.where(F.col("_n") >= floor).drop("_n"))
    if floor == 0:
        return entries.join(hot_side, "bucket", "left")
    stays = F.col("n").isNull() | (F.col("n") >= floor)
    hot = entries.where(stays).join(hot_side, "bucket", "left")
    cold = entries.where(~stays).join(slim.where(F.col("_n") < floor).drop("_n"), "bucket", "left")
    return hot.unionByName(cold)


def probabilities(
    entries: DataFrame,
    weights: DataFrame,
    classes: int,
    floor: int,
    key: str = "doc_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """(key, keep..., p0..): softmax over the summed products, one row per key of ``entries``.

    Keys without a known bucket get equal probabilities.
    """
    products = [
        F.coalesce(F.sum(F.col("value") * F.col(w)), F.lit(0.0)).alias(w)
        for w in _columns("w", classes)
    ]
    sums = _met(entries, weights, classes, floor).groupBy(key).agg(
        *[F.first(name).alias(name) for name in keep], *products
    )
    top = F.greatest(*_columns("w", classes)) if classes > 1 else F.col("w0")
    grown = sums.withColumn("_top", top).select(
        key, *keep, *[F.exp(F.col(w) - F.col("_top")).alias(w) for w in _columns("w", classes)]
    )
    total = sum((F.col(w) for w in _columns("w", classes)), F.lit(0.0))
    return grown.withColumn("_total", total).select(
        key, *keep, *[(F.col(f"w{c}") / F.col("_total")).alias(f"p{c}") for c in range(classes)]
    )


def sparse_gradient(
    entries: DataFrame,
    weights: DataFrame,
    classes: int,
    floor: int,
    key: str = "doc_id",
    label: str = "label",
    rows: int | None = None,
) -> DataFrame:
    """(bucket, g0..): sums over rows of (probability - is label) * value, one row per bucket.

    Where an entry stands for ``times`` buckets, products count them all. Errors of few
    ``rows``, if their number is known, are broadcast.
    """
    whole = entries.withColumn("value", F.col("value") * _times(entries))
    scored = probabilities(whole, weights, classes, floor, key, (label,))
    errors = scored.select(
        F.col(key),
        *[
            (F.col(f"p{c}") - F.when(F.col(label) == c, 1.0).otherwise(0.0)).alias(f"e{c}")
            for c in range(classes)
        ],
    )
    if rows is not None and rows * classes <= BROADCAST_ROWS:
        errors = F.broadcast(errors)
    known = entries.where("bucket is not null").select(key, "bucket", "value")
    return known.join(errors, key).groupBy("bucket").agg(
        *[F.sum(F.col("value") * F.col(f"e{c}")).alias(f"g{c}") for c in range(classes)]
    )


def train_sparse_classifier(
    entries: DataFrame,
    classes: int,
    steps: int,
    key: str = "doc_id",
    label: str = "label",
    rates: tuple[float, float] = (2e-3, 2e-4),
    warmup: int = 0,
    cycle: int | None = None,
    max_norm: float = 1.0,
    batch_share: float = 1.0,
    seed: int = 42,
    on_step=None,
    floor: int | None = None,
) -> DataFrame:
    """Weights (bucket, n, w0.., m0.., v0..) as ``models.train_classifier`` would learn them.

    ``entries`` (key, label, bucket, value, n) come from :func:`with_frequencies`. They are
    packed once into blocks of rows, the weights into shards of buckets. In a step the shards
    send each block the weights of the buckets it holds, and the blocks send sums of their
    gradients back (see :mod:`tokenloom.operators.sparse_blocks`); what a step moves grows with
    the distinct buckets of the blocks, not with the entries. A step is one written table of
    the weights beside their gradient sums. The driver sees the gradient norm only; the
    weights, of any number of buckets, never leave Spark, and the moves of a step are applied
    as the next one reads them. ``classes`` are columns: at most a few dozen.
    ``on_step(step, weights, norm)`` sees every step. Buckets that move alike are learned once
    (see :func:`lead_buckets`). No bucket is hot for a block, so ``floor``, which tells hot
    buckets elsewhere, changes nothing here.
    """
    spark = entries.sparkSession
    led = lead_buckets(entries, key)
    size, leads = entries.count(), led.where("bucket = lead").count()
    descent = Descent(lead_entries(entries, led, key), size, leads, classes, key, label)

    def spread_out(state: DataFrame, move) -> DataFrame:
        names = [name for prefix in "wmv" for name in _columns(prefix, classes)]
        values = descent.weights(state, move, names).withColumnRenamed("bucket", "lead")
        kind = led.schema["bucket"].dataType
        values = values.withColumn("lead", F.col("lead").cast(kind))
        # buckets of rows without key are in no block: they have no gradient and stay zero
        found = led.drop("times").join(values, "lead", "left").fillna(0.0, subset=names)
        return found.select("bucket", "n", *names)

    schedule = scheduled_rates(spark, steps, *rates, warmup, steps if cycle is None else cycle)
    state, move = descent.begin(), None
    rows = descent.rows()
    for step in range(1, steps + 1):
        drawn = None
        if batch_share < 1:
            drawn = (seed, step, batch_share)
            rows = descent.rows(drawn)
        seen = Observation()
        sums = descent.step(state, move, drawn).observe(seen, F.sum("square").alias("total"))
        before, state = state, materialize(sums.drop("square"), "weights", {"compression": "none"})
        release(before)
        scale = 1.0 / max(rows, 1)
        norm = (seen.get["total"] or 0.0) ** 0.5 * scale
        clip = max_norm / (norm + 1e-6) if norm > max_norm else 1.0
        move = (scale * clip, schedule[step], step)
        if step % GARBAGE_STEPS == 0:
            collect_garbage(spark)
        if on_step is not None:
            on_step(step, spread_out(state, move), norm)
    descent.close()
    return spread_out(state, move)


def classify_entries(
    entries: DataFrame,
    weights: DataFrame,
    classes: int,
    key: str = "doc_id",
    keep: Sequence[str] = (),
    floor: int | None = None,
) -> DataFrame:
    """(key, keep..., predicted, prob): most likely class, the smaller one on a tie.

    ``entries`` carry ``n`` from the table the weights were learned on; buckets the weights
    do not hold count nothing.
    """
    if floor is None:
        floor = hot_floor(weights, classes)
    scored = probabilities(entries, weights, classes, floor, key, keep)
    best = F.greatest(
        *[F.struct(F.round(f"p{c}", 9).alias("p"), F.lit(-c).alias("c")) for c in range(classes)]
    )
    return scored.withColumn("_best", best).select(
        key, *keep, (-F.col("_best.c")).alias("predicted"), F.col("_best.p").alias("prob")
    )


def sparse_losses(
    entries: DataFrame,
    weights: DataFrame,
    classes: int,
    by: Sequence[str] = (),
    key: str = "doc_id",
    label: str = "label",
    floor: int | None = None,
) -> DataFrame:
    """(by..., n, loss, perplexity) of a weight table on labelled entries."""
    if floor is None:
        floor = hot_floor(weights, classes)
    keep = list(dict.fromkeys([*by, label]))
    scored = probabilities(entries, weights, classes, floor, key, keep)
    listed = F.array(*[F.col(f"p{c}") for c in range(classes)])
    nll = -F.log(F.get(listed, F.col(label).cast("int")))
    return scored.select(*by, nll.alias("nll")).groupBy(*by).agg(
        F.count("nll").alias("n"),
        F.avg("nll").alias("loss"),
        F.exp(F.avg("nll")).alias("perplexity"),
    )
