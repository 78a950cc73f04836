"""Losses over logits, next-token tables and document scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tokenloom.functions import arrays as ar
from tokenloom.functions.draws import draw_uniform
from tokenloom.operators.joins import fits_broadcast, spread_left_join
from tokenloom.session import materialize


def cross_entropy(
    df: DataFrame, logits: str, target: str, by: Sequence[str] = ()
) -> DataFrame:
    """Mean loss and perplexity of logit arrays against 0-based targets."""
    nll = ar.negative_log_likelihood(F.col(logits), F.col(target))
    return summarize_nll(df.select(*by, nll.alias("nll")), by)


def summarize_nll(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., n, loss, perplexity) from a column ``nll``."""
    return df.groupBy(*by).agg(
        F.count("nll").alias("n"),
        F.avg("nll").alias("loss"),
        F.exp(F.avg("nll")).alias("perplexity"),
    )


def cross_entropy_long(logits: DataFrame, targets: DataFrame) -> DataFrame:
    """The same over long tables (row_id, token_id, logit) and (row_id, target).

    The log-sum-exp is built from mergeable pieces, so partial aggregation works
    and a wide row is never gathered.
    """
    top = logits.groupBy("row_id").agg(F.max("logit").alias("top"))
    sums = (
        logits.join(top, "row_id")
        .groupBy("row_id")
        .agg(F.max("top").alias("top"), F.sum(F.exp(F.col("logit") - F.col("top"))).alias("z"))
    )
    hit = logits.join(
        targets.withColumnRenamed("target", "token_id"), ["row_id", "token_id"]
    ).select("row_id", "logit")
    nll = sums.join(hit, "row_id").select(
        (F.col("top") - F.col("logit") + F.log("z")).alias("nll")
    )
    return summarize_nll(nll)


def softmax_long(logits: DataFrame, temperature: float = 1.0) -> DataFrame:
    """Adds ``prob`` to (row_id, token_id, logit)."""
    row = Window.partitionBy("row_id")
    scaled = F.col("logit") / ar.checked_temperature(temperature)
    weight = F.exp(scaled - F.max(scaled).over(row))
    return logits.withColumn("_w", weight).withColumn(
        "prob", F.col("_w") / F.sum("_w").over(row)
    ).drop("_w")


def split_by_draw(key: Column, share: float, seed: int = 42) -> Column:
    """'valid' for about ``share`` of the keys, else 'train'; stable per key."""
    return F.when(draw_uniform(seed, key) < share, "valid").otherwise("train")


def bigram_places(df: DataFrame, keep: Sequence[str] = (), tokens: str = "tokens") -> DataFrame:
    """(keep..., prev, next): neighbouring ids inside each row, one row per place."""
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))),
        F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda a, b: F.struct(a.alias("prev"), b.alias("next"), F.lit(True).alias("_is_pair")),
    )
    # The outer form has no size filter, whatever the optimizer infers.
    places = df.select(*keep, F.inline_outer(pairs)).where(F.col("_is_pair").isNotNull())
    return places.drop("_is_pair")


def bigrams(df: DataFrame, keep: Sequence[str] = (), tokens: str = "tokens") -> DataFrame:
    """(keep..., prev, next, n): neighbouring ids inside each row, counted."""
    return (
        bigram_places(df, keep, tokens)
        .groupBy(*keep, "prev", "next")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def ngram_model(pairs: DataFrame, vocab_size: int, add: float = 1.0) -> DataFrame:
    """(prev, next, n, ctx_n, prob) with add-k smoothing.

    A context has at most ``vocab_size`` rows, which bounds the window.
    """
    context = F.sum("n").over(Window.partitionBy("prev"))
    return pairs.select("prev", "next", "n", context.alias("ctx_n")).withColumn(
        "prob", (F.col("n") + add) / (F.col("ctx_n") + add * vocab_size)
    )


def contexts(model: DataFrame) -> DataFrame:
    """(prev, ctx_n): how often each context occurs."""
    return model.groupBy("prev").agg(F.max("ctx_n").alias("ctx_n"))


def pair_losses(
    counted: DataFrame,
    model: DataFrame,
    vocab_size: int,
    add: float,
    keep: Sequence[str],
) -> DataFrame:
    """(keep..., n_pairs, loss, perplexity) of counted pairs (keep..., prev, next, times).

    Frequent pairs are answered by broadcast. ``model`` must be materialized.
    """
    table = model.select("prev", "next", "n", "prob")
    found = spread_left_join(counted, table, ["prev", "next"], "n", F.struct(*keep, "next"))
    known = spread_left_join(
        found,
        materialize(contexts(model).withColumn("weight", F.col("ctx_n"))),
        ["prev"],
        "weight",
        F.struct(*keep, "next"),
    )
    unseen = F.lit(float(add)) / (F.coalesce(F.col("ctx_n"), F.lit(0)) + add * vocab_size)
    nll = -F.log(F.coalesce("prob", unseen)) * F.col("times")
    return (
        known.groupBy(*keep)
        .agg(F.sum("times").alias("n_pairs"), F.sum(nll).alias("_nll"))
        .select(
            *keep,
            "n_pairs",
            (F.col("_nll") / F.col("n_pairs")).alias("loss"),
            F.exp(F.col("_nll") / F.col("n_pairs")).alias("perplexity"),
        )
    )


def score_documents(
    df: DataFrame,
    model: DataFrame,
    vocab_size: int,
    add: float = 1.0,
    keep: Sequence[str] = ("doc_id",),
    tokens: str = "tokens",
) -> DataFrame:
    """(keep..., n_pairs, loss, perplexity) of every row under a next-token table.

    A model that fits a broadcast answers every pair where it stands, and only sums per row
    are shuffled; else pairs are counted per row before they are looked up. Rows without a
    pair, with fewer than two tokens, have n_pairs 0 and a null loss.
    """
    if fits_broadcast(model):
        counted = bigram_places(df, keep, tokens).withColumn("times", F.lit(1).cast("bigint"))
    else:
        counted = bigrams(df, keep, tokens).withColumnRenamed("n", "times")
    found = pair_losses(counted, model, vocab_size, add, keep)
    short = df.where(F.coalesce(F.size(tokens), F.lit(0)) < 2).select(
        *keep,
        F.lit(0).cast("bigint").alias("n_pairs"),
        F.lit(None).cast("double").alias("loss"),
        F.lit(None).cast("double").alias("perplexity"),
    )
    return found.unionByName(short)


def window_losses(
    windows: DataFrame,
    model: DataFrame,
    vocab_size: int,
    add: float = 1.0,
    keep: Sequence[str] = ("split",),
) -> DataFrame:
    """The same for sampled windows (keep..., input, target), pooled per ``keep``."""
    pairs = F.zip_with(
        "input", "target", lambda a, b: F.struct(a.alias("prev"), b.alias("next"))
    )
    counted = (
        windows.select(*keep, F.inline(pairs))
        .groupBy(*keep, "prev", "next")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    return pair_losses(counted, model, vocab_size, add, keep)


def eval_losses(scores: DataFrame, split: str = "split") -> DataFrame:
    """(split, n_pairs, loss, perplexity): token-weighted over the scored rows."""
    loss = F.sum(F.col("loss") * F.col("n_pairs")) / F.sum("n_pairs")
    return scores.groupBy(split).agg(
        F.sum("n_pairs").alias("n_pairs"), loss.alias("loss"), F.exp(loss).alias("perplexity")
    )
