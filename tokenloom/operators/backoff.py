"""Next-token models of variable order: interpolated Kneser-Ney as tables.

Counts of the highest order are plain; a lower order counts in how many contexts its tokens
were seen. Every order takes a discount off each count and gives what it took to the order
below, so the probabilities of any context add up to one. Tables hold the probability of
every seen n-gram and, per context, the share it leaves to the shorter one; an n-gram is
looked up by its longest known context.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tokenloom.functions.draws import draw_uniform
from tokenloom.operators.generation import SUM_DIGITS
from tokenloom.operators.joins import fits_broadcast, spread_left_join
from tokenloom.session import materialize

#: The token that stands before the first one of a document.
BEGIN = -1
#: Prices of n-grams are broadcast up to so many rows, if their bytes allow it.
PRICED_ROWS = 1_000_000


def context_names(order: int) -> list[str]:
    """Columns of a context, the farthest token first: c2, c1 for three tokens."""
    return [f"c{i}" for i in range(order - 1, 0, -1)]


def ngram_places(
    df: DataFrame, order: int, keep: Sequence[str] = (), tokens: str = "tokens"
) -> DataFrame:
    """(keep..., contexts..., next): every token with the tokens before it, one row per place.

    Begin marks stand before the first token, so each token comes once.
    """
    begins = F.array_repeat(F.lit(BEGIN), order - 1)
    padded = F.concat(begins, F.coalesce(tokens, F.array().cast("array<int>"))).alias("_padded")
    names = [*context_names(order), "next"]
    places = F.sequence(F.lit(0), F.size("_padded") - order)
    grams = F.transform(
        F.when(F.size("_padded") >= order, places),
        lambda i: F.struct(
            *[F.get("_padded", i + k).alias(name) for k, name in enumerate(names)],
            F.lit(True).alias("_is_gram"),
        ),
    )
    # The outer form has no size filter, whatever the optimizer infers.
    listed = df.select(*keep, padded).select(*keep, F.inline_outer(grams))
    return listed.where(F.col("_is_gram").isNotNull()).drop("_is_gram")


def ngram_counts(
    df: DataFrame, order: int, keep: Sequence[str] = (), tokens: str = "tokens"
) -> DataFrame:
    """(keep..., contexts..., next, n): every token with the tokens before it, per row."""
    names = [*context_names(order), "next"]
    return (
        ngram_places(df, order, keep, tokens)
        .groupBy(*keep, *names)
        .agg(F.count(F.lit(1)).alias("n"))
    )


@dataclass
class BackoffModel:
    """Tables by order: ``grams[k]`` (contexts..., next, n, prob), ``shares[k]`` (contexts..., weight, share).

    ``share`` is what a context leaves to the next shorter one; ``unseen`` the probability
    of a token that training never saw.
    """

    order: int
    vocab_size: int
    grams: dict[int, DataFrame]
    shares: dict[int, DataFrame]
    unseen: float
    discounts: dict[int, float]


def discount(ones: int, twos: int) -> float:
    """The usual estimate from the n-grams seen once and twice; a half if either is missing."""
    return ones / (ones + 2 * twos) if ones and twos else 0.5


def kneser_ney(grams: DataFrame, order: int, vocab_size: int) -> BackoffModel:
    """Fit on counted n-grams (contexts..., next, n) of the highest order.

    Each order is one grouping of the one above. A hot context spreads: its share comes by
    a join that broadcasts the heaviest keys.
    """
    if order < 1 or vocab_size < 1:
        raise ValueError("order and vocab_size must be positive")
    names = [*context_names(order), "next"]
    counts = {order: materialize(grams.groupBy(*names).agg(F.sum("n").alias("n")))}
    for k in range(order - 1, 0, -1):
        names = [*context_names(k), "next"]
        counts[k] = materialize(counts[k + 1].groupBy(*names).agg(F.count(F.lit(1)).alias("n")))
    tables: dict[int, DataFrame] = {}
    shares: dict[int, DataFrame] = {}
    discounts: dict[int, float] = {}
    unseen = 1 / vocab_size
    for k in range(1, order + 1):
        context = context_names(k)
        seen = counts[k].agg(
            F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.sum("n"), F.count(F.lit(1))
        ).first()
        off = discounts[k] = discount(seen[0], seen[1])
        if k == 1:
            total, types = seen[2] or 0, seen[3]
            if total:
                unseen = off * types / total / vocab_size
            prob = (F.col("n") - off) / max(total, 1) + F.lit(unseen)
            tables[1] = materialize(counts[1].withColumn("prob", prob))
            continue
        shares[k] = materialize(
            counts[k]
            .groupBy(*context)
            .agg(F.sum("n").alias("weight"), (off * F.count(F.lit(1)) / F.sum("n")).alias("share"))
        )
        totals = shares[k].select(*context, F.col("weight").alias("total"), "share", "weight")
        met = spread_left_join(counts[k], totals, context, "weight", F.col("next"))
        below = tables[k - 1].withColumnRenamed("prob", "lower").withColumnRenamed("n", "weight")
        keys = [*context_names(k - 1), "next"]
        met = spread_left_join(met, below, keys, "weight", F.struct(*context))
        prob = (F.col("n") - off) / F.col("total") + F.col("share") * F.col("lower")
        tables[k] = materialize(met.select(*context, "next", "n", prob.alias("prob")))
    return BackoffModel(order, vocab_size, tables, shares, unseen, discounts)


def with_probability(facts: DataFrame, model: BackoffModel) -> DataFrame:
    """Adds ``prob`` and ``known``, the length of the longest n-gram that training saw.

    ``facts`` holds the context columns of the model's order and ``next``. Every order adds
    its own n-gram's probability, or passes on its context's share of the shorter one's.
    """
    prob: Column = F.coalesce("_p1", F.lit(model.unseen))
    known = F.when(F.col("_p1").isNotNull(), 1).otherwise(0)
    met = facts
    whole = F.struct(*context_names(model.order), "next")
    for k in range(1, model.order + 1):
        keys = [*context_names(k), "next"]
        table = model.grams[k].select(*keys, "n", F.col("prob").alias(f"_p{k}"))
        met = spread_left_join(met, table, keys, "n", whole)
        if k > 1:
            share = model.shares[k].withColumnRenamed("share", f"_s{k}")
            met = spread_left_join(met, share, context_names(k), "weight", whole)
            seen = F.col(f"_p{k}").isNotNull()
            prob = F.when(seen, F.col(f"_p{k}")).otherwise(F.coalesce(f"_s{k}", F.lit(1.0)) * prob)
            known = F.when(seen, k).otherwise(known)
    return met.select(*facts.columns, prob.alias("prob"), known.cast("int").alias("known"))


def score_backoff(
    df: DataFrame,
    model: BackoffModel,
    keep: Sequence[str] = ("doc_id",),
    tokens: str = "tokens",
) -> DataFrame:
    """(keep..., n_pairs, loss, perplexity) of every row, each token predicted once.

    Each distinct n-gram is looked up once. If their prices fit a broadcast, every place
    meets its own where it stands and only sums per row are shuffled; else n-grams are
    counted per row first. Rows without tokens have n_pairs 0 and a null loss; ``keep``
    must tell rows apart.
    """
    names = [*context_names(model.order), "next"]
    distinct = materialize(ngram_counts(df, model.order, (), tokens).withColumnRenamed("n", "weight"))
    priced = materialize(
        with_probability(distinct, model).select(*names, "weight", (-F.log("prob")).alias("nll"))
    )
    small = fits_broadcast(priced, PRICED_ROWS)
    if small:
        counted = ngram_places(df, model.order, keep, tokens).withColumn("n", F.lit(1).cast("bigint"))
    else:
        counted = materialize(ngram_counts(df, model.order, keep, tokens))
    met = spread_left_join(counted, priced, names, "weight", F.struct(*keep), small=small)
    loss = F.sum(F.col("nll") * F.col("n")) / F.sum("n")
    found = met.groupBy(*keep).agg(
        F.sum("n").alias("n_pairs"), loss.alias("loss"), F.exp(loss).alias("perplexity")
    )
    short = df.where(F.coalesce(F.size(tokens), F.lit(0)) < 1).select(
        *keep,
        F.lit(0).cast("bigint").alias("n_pairs"),
        F.lit(None).cast("double").alias("loss"),
        F.lit(None).cast("double").alias("perplexity"),
    )
    return found.unionByName(short)


def next_tokens(contexts: DataFrame, model: BackoffModel) -> DataFrame:
    """All tokens that may follow each context row, with their probability: (..., next, prob).

    The distribution over the whole vocabulary: one row per context and token. Contexts
    are as many as the caller asks for, tokens as many as the vocabulary has.
    """
    tokens = F.explode(F.sequence(F.lit(0), F.lit(model.vocab_size - 1))).alias("next")
    return with_probability(contexts.select(*contexts.columns, tokens), model)


def draw_tables(model: BackoffModel) -> dict[int, DataFrame]:
    """Per order, (contexts..., weight, choices): running sums of the discounted counts.

    A draw above the last sum goes on to the shorter context. A context has at most one
    entry per token; the more frequent come first, of equal ones the lesser id.
    """
    out = {}
    for k in range(1, model.order + 1):
        context = context_names(k) or ["root"]
        counts = model.grams[k] if k > 1 else model.grams[1].withColumn("root", F.lit(0))
        total = F.sum("n").over(Window.partitionBy(*context))
        ordered = Window.partitionBy(*context).orderBy(F.col("n").desc(), "next")
        upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        part = (F.col("n") - model.discounts[k]) / total
        summed = counts.withColumn("part", part).select(
            *context, "next", F.round(F.sum("part").over(upto), SUM_DIGITS).alias("upper")
        )
        listed = F.array_sort(F.collect_list(F.struct("upper", "next")))
        out[k] = materialize(
            summed.groupBy(*context).agg(
                F.count(F.lit(1)).alias("weight"), listed.alias(f"choices{k}")
            )
        )
    return out


def generate_backoff(
    prompts: DataFrame,
    model: BackoffModel,
    end_id: int,
    max_tokens: int,
    seed: int = 42,
    key: str = "prompt_id",
    tokens: str = "tokens",
    checkpoint_every: int = 4,
) -> DataFrame:
    """(key, generated): ids drawn from the model's own distribution, all prompts at once.

    The context is as long as the model's. Each order draws once: among the discounted
    counts of its context, or on to the next shorter one, which is the interpolated
    distribution without ever listing the vocabulary for a prompt. Draws depend on (seed,
    key, step, order) only. A prompt stops at the delimiter, which stays in its output.
    """
    tables = draw_tables(model)
    small = {k: fits_broadcast(table) for k, table in tables.items()}
    names = context_names(model.order)
    last = [
        F.coalesce(F.try_element_at(tokens, F.lit(-int(name[1:]))), F.lit(BEGIN)).cast("int").alias(name)
        for name in names
    ]
    state = prompts.select(
        key, *last, F.lit(False).alias("done"), F.array().cast("array<int>").alias("generated")
    )
    for step in range(max_tokens):
        found, picks = state.withColumn("root", F.when(~F.col("done"), F.lit(0))), []
        for k in range(model.order, 0, -1):
            context = context_names(k) or ["root"]
            found = spread_left_join(found, tables[k], context, "weight", F.col(key), small=small[k])
            drawn = draw_uniform(seed, F.col(key), F.lit(step), F.lit(k))
            found = found.withColumn("u", drawn)
            hit = F.filter(f"choices{k}", lambda c: c["upper"] > F.col("u"))
            found = found.withColumn(f"pick{k}", F.get(hit, F.lit(0))["next"]).drop("u", f"choices{k}")
            picks.append(F.col(f"pick{k}"))
        any_token = F.floor(draw_uniform(seed, F.col(key), F.lit(step), F.lit(0)) * model.vocab_size)
        found = found.withColumn("pick", F.coalesce(*picks, any_token).cast("int"))
        ends = F.col("done") | (F.col("pick") == end_id)
        following = [F.col(name) for name in names[1:]] + [F.col("pick")]
        state = found.select(
            key,
            # a finished prompt leaves the joins: null keys are spread and find nothing
            *[F.when(~ends, value).alias(name) for name, value in zip(names, following)],
            ends.alias("done"),
            F.when(F.col("done"), F.col("generated"))
            .otherwise(F.concat("generated", F.array("pick")))
            .alias("generated"),
        )
        if (step + 1) % checkpoint_every == 0:
            state = materialize(state)
            if state.where(~F.col("done")).isEmpty():
                break
    return state.select(key, "generated")
