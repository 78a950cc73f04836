"""Prompts and continuations from a next-token table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tokenloom.functions.arrays import checked_temperature
from tokenloom.functions.draws import draw_uniform
from tokenloom.operators.joins import fits_broadcast, spread_left_join
from tokenloom.session import materialize

# Running sums are compared at this precision, so their order of addition is moot.
SUM_DIGITS = 9


def prepare_prompts(
    df: DataFrame, length: int, end_id: int, tokens: str = "tokens", out: str = "model_input"
) -> DataFrame:
    """The last ``length`` ids of each prompt, padded on the left with the delimiter.

    Also says whether ids were cut (``truncated``). An empty prompt is all padding.
    """
    kept = F.slice(tokens, F.greatest(F.size(tokens) - length, F.lit(0)) + 1, F.lit(length))
    padding = F.array_repeat(
        F.lit(end_id).cast("int"), F.greatest(F.lit(length) - F.size(tokens), F.lit(0))
    )
    return df.withColumn(out, F.concat(padding, kept)).withColumn(
        "truncated", F.size(tokens) > length
    )


def next_token_probs(counts: DataFrame, temperature: float = 1.0) -> DataFrame:
    """(prev, next, prob): softmax over ln(n) of each context's continuations."""
    context = Window.partitionBy("prev")
    logit = F.log(F.col("n").cast("double")) / checked_temperature(temperature)
    return (
        counts.select("prev", "next", logit.alias("logit"))
        .withColumn("w", F.exp(F.col("logit") - F.max("logit").over(context)))
        .withColumn("prob", F.col("w") / F.sum("w").over(context))
        .select("prev", "next", "prob")
    )


def nucleus_filter(probs: DataFrame, p: float) -> DataFrame:
    """(prev, next, rank, prob, upper): the leading ids of each context, renormalized.

    An id stays if the ids before it sum to at most ``p``; the first always stays.
    ``upper`` is the running sum used to draw. Equal probabilities go by id.
    """
    if not 0.0 < p <= 1.0:
        raise ValueError("p must be in (0, 1]")
    ordered = Window.partitionBy("prev").orderBy(F.col("prob").desc(), "next")
    before = F.sum("prob").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    ranked = probs.withColumn("rank", F.row_number().over(ordered) - 1).withColumn(
        "before", F.round(F.coalesce(before, F.lit(0.0)), SUM_DIGITS)
    )
    kept = ranked.where((F.col("rank") == 0) | (F.col("before") <= p))
    share = F.col("prob") / F.sum("prob").over(Window.partitionBy("prev"))
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return kept.withColumn("share", share).select(
        "prev",
        "next",
        "rank",
        F.col("share").alias("prob"),
        F.round(F.sum("share").over(upto), SUM_DIGITS).alias("upper"),
    )


def draw_table(nucleus: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """One row per context: (prev, weight, choices), at most one entry per token id.

    ``contexts`` (prev, ctx_n) tells how frequent a context is.
    """
    listed = F.array_sort(F.collect_list(F.struct("rank", "upper", "next")))
    table = nucleus.groupBy("prev").agg(
        F.count(F.lit(1)).alias("weight"), listed.alias("choices")
    )
    if contexts is None:
        return table
    return table.join(contexts, "prev").select("prev", F.col("ctx_n").alias("weight"), "choices")


def generate(
    prompts: DataFrame,
    table: DataFrame,
    end_id: int,
    max_tokens: int,
    seed: int = 42,
    key: str = "prompt_id",
    tokens: str = "tokens",
    checkpoint_every: int = 8,
    small: bool | None = None,
) -> DataFrame:
    """(key, generated): one id per step for all prompts at once.

    A prompt stops at the delimiter, which stays in its output. A context without
    continuation ends the prompt; an empty prompt starts from the delimiter. Draws
    depend on (seed, key, step) only. ``table`` comes from :func:`draw_table` and
    must be materialized; ``small`` says whether it is broadcast, else that is measured.
    """
    small = fits_broadcast(table) if small is None else small
    end = F.lit(end_id).cast("int")
    state = prompts.select(
        key,
        F.coalesce(F.try_element_at(tokens, F.lit(-1)), end).alias("prev"),
        F.lit(False).alias("done"),
        F.array().cast("array<int>").alias("generated"),
    )
    for step in range(max_tokens):
        drawn = draw_uniform(seed, F.col(key), F.lit(step))
        found = spread_left_join(state, table, ["prev"], "weight", F.col(key), small=small)
        hit = F.get(F.filter("choices", lambda c: c["upper"] > F.col("u")), F.lit(0))
        choice = F.coalesce(hit, F.try_element_at("choices", F.lit(-1)))
        state = (
            found.withColumn("u", drawn)
            .withColumn("pick", F.coalesce(choice["next"].cast("int"), end))
            .select(
                key,
                # a finished prompt leaves the join: null keys are spread and find nothing
                F.when(~F.col("done") & (F.col("pick") != end), F.col("pick")).alias("prev"),
                (F.col("done") | (F.col("pick") == end)).alias("done"),
                F.when(F.col("done"), F.col("generated"))
                .otherwise(F.concat("generated", F.array("pick")))
                .alias("generated"),
            )
        )
        if (step + 1) % checkpoint_every == 0:
            state = materialize(state)
            if state.where(~F.col("done")).isEmpty():
                break
    return state.select(key, "generated")
