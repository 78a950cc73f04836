"""Mixing sources to target weights by Sainte-Lague apportionment of words.

Sources get target word counts; words are given to sources, and within a source to its
shards, by highest quotients. The documents of a shard stand in a seeded order. Each shard
takes all its words as often as its quota allows, and the first ones once more.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tokenloom.llm.frames import WORD, fresh, q, stash

#: The corpus is dealt to at most so many shards (and one per source) of at least so many
#: documents.
SHARDS, SHARD_ROWS = 1 << 12, 512
#: Sources up to which their table is broadcast; beyond it a shuffled join does the same.
BROADCAST_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sources: DataFrame, weights: Sequence[float], most: float = 3, share: float = 1.0
) -> DataFrame:
    """``sources`` (source, source_size, n) plus idx, weight, target.

    Weights repeat over the sources by code point, null last. A target is its weight's
    share of ``share`` times all words, but at most ``most`` times the source's size; what
    is above goes to the others by weight until none is above. In the end all targets
    below their bound have the same ratio to their weight, and a bounded source's own
    ratio is not above it: one pass over the sources in order of that ratio finds it.
    The table of sources must be small enough for one task (one row per source).
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").isNull(), "source")
    listed = F.array(*[F.lit(float(w)) for w in weights])
    bounded = (
        sources.withColumn("idx", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.get(listed, (F.col("idx") % len(weights)).cast("int")))
        .withColumn("bound", F.col("source_size") * float(most))
    )
    before = everything.orderBy(F.col("bound") / F.col("weight"), "idx").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # words per weight if all sources before were at their bound; its maximum is the answer
    level = (
        F.sum("source_size").over(everything) * float(share)
        - F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    return (
        bounded.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least("bound", F.col("level") * F.col("weight")))
        .drop("bound", "level")
    )


def sainte_lague(
    parties: DataFrame, votes: str, seats: str, group: Sequence[str], order: str
) -> DataFrame:
    """Adds ``quota``: a group's seats go to the highest quotients votes / (2 k + 1).

    A quota differs from the exact share by less than the share times parties over twice
    the seats, plus a half. Quotients outside that span are taken or left without being
    listed, so a group lists a few quotients per party. Equal quotients go to the party
    that comes first by ``order``.
    """
    together = Window.partitionBy(*group)
    exact = F.coalesce(
        F.try_divide(F.col(seats) * F.col(votes), F.sum(votes).over(together)), F.lit(0.0)
    )
    real = F.sum((F.col(votes) > 0).cast("int")).over(together)
    sized = (
        parties.withColumn("exact", exact)
        .withColumn("span", 2 + F.coalesce(F.try_divide(F.col("exact") * real, F.col(seats)), F.lit(0.0)))
        .withColumn("sure", F.greatest(F.floor(F.col("exact") - F.col("span")), F.lit(0)))
        .withColumn("top", F.when(F.col(votes) > 0, F.ceil(F.col("exact") + F.col("span"))).otherwise(0))
        .withColumn("open", F.col(seats) - F.sum("sure").over(together))
    )
    listed = sized.select(
        "*", F.explode_outer(F.when(F.col("top") > F.col("sure"), F.sequence("sure", F.col("top") - 1))).alias("k")
    ).withColumn("quotient", F.col(votes) / (2 * F.col("k") + 1))
    ranked = listed.withColumn(
        "place", F.row_number().over(together.orderBy(F.desc_nulls_last("quotient"), order))
    )
    won = (F.col("k").isNotNull() & (F.col("place") <= F.col("open"))).cast("long")
    named = [name for name in parties.columns if name not in {*group, order}]
    return ranked.groupBy(*group, order).agg(
        *[F.first(name).alias(name) for name in named],
        (F.first("sure") + F.sum(won)).cast("long").alias("quota"),
    )


def shard_quotas(dealt: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """Words that every (idx, shard) gives: shard_size, quota."""
    sized = dealt.groupBy("idx", "shard").agg(F.sum("size").alias("shard_size"))
    given = sources.select(
        F.col("idx").alias("q_idx"),
        F.round(F.col("quota") / F.col("block")).cast("long").alias("seats"),
        "block",
    )
    joined = sized.join(given, F.col("idx") == F.col("q_idx")).drop("q_idx")
    bound = F.floor(F.col("shard_size") * float(most)).cast("long")
    return sainte_lague(joined, "shard_size", "seats", ["idx"], "shard").select(
        F.col("idx").alias("q_idx"),
        F.col("shard").alias("q_shard"),
        "shard_size",
        F.least(F.col("quota") * F.col("block"), bound).alias("quota"),
    )


def take_words(
    slim: DataFrame,
    weights: Sequence[float],
    most: float,
    share: float,
    seed: int,
    blocks: int | None,
    shards: int,
) -> DataFrame:
    """The mix of a written table (key, source, size): see ``mix_sources``."""
    named = slim.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    everything = Window.partitionBy(F.lit(0))
    words, rows = F.sum("source_size").over(everything), F.sum("rows").over(everything)
    part = F.greatest(
        F.coalesce(F.try_divide(F.col("source_size"), words), F.lit(0.0)), F.col("rows") / rows
    )
    block = F.floor(F.col("quota") / blocks) if blocks else F.lit(1)
    sources = (
        source_targets(named, weights, most, share)
        .withColumn("seats", F.round(F.sum("target").over(everything)).cast("long"))
        .withColumn(
            "shards",
            F.greatest(
                F.lit(1), F.least(F.ceil(part * shards), F.floor(F.col("rows") / SHARD_ROWS))
            ).cast("long"),
        )
        .withColumn("everything", F.lit(0))
    )
    # words by highest quotients, for sources and then for their shards
    sources = sainte_lague(sources, "target", "seats", ["everything"], "idx")
    sources = stash(sources.withColumn("block", F.greatest(F.lit(1), block).cast("long")), "sources")
    side = sources.select(
        F.col("source").alias("q_source"), "source_size", "target", "idx", "shards"
    )
    small = sources.count() <= BROADCAST_SOURCES
    if small:
        side = F.broadcast(side)
    dealt = slim.join(side, F.col("source").eqNullSafe(F.col("q_source"))).select(
        "key",
        "size",
        "source_size",
        "target",
        "idx",
        F.pmod(F.xxhash64(F.lit(seed), "key", "size"), F.col("shards")).alias("shard"),
        F.xxhash64(F.lit(seed + 1), "key", "size").alias("draw"),
    )
    in_order = Window.partitionBy("idx", "shard").orderBy("draw", "key", "size")
    up_to = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("at", F.sum("size").over(up_to) - F.col("size"))
    quotas = shard_quotas(dealt, sources, most)
    if small:
        quotas = F.broadcast(quotas)
    met = placed.join(
        quotas, (F.col("idx") == F.col("q_idx")) & (F.col("shard") == F.col("q_shard"))
    )
    # every word so often, and the first ones in the order of the draw once more
    whole = F.coalesce(F.floor(F.try_divide("quota", "shard_size")), F.lit(0)).cast("long")
    more = F.col("quota") - whole * F.col("shard_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), more - F.col("at")))
    return met.withColumn("taken", (whole * F.col("size") + part).cast("long")).select(
        "key", "size", "source_size", "target", "taken"
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    most: float = 3,
    share: float = 1.0,
    seed: int = 8,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    blocks: int | None = None,
    shards: int = SHARDS,
) -> DataFrame:
    """Words each document gives to a mix of sources by weight.

    Returns key, size (words), source_size, target (its source's), taken (words the mix
    takes of it, repeats counted; at most ``most`` times its size).
    Only (key, source, size) rows move. Sources are dealt to shards by their size, so a
    source that holds most rows is many shards. Null sources form one source, the last; a
    null or empty text has size 0 and gives nothing. ``blocks`` deals the words of every
    source to its shards in about so many equal blocks, not in single words. Rows that repeat are separate
    documents. An empty table gives no rows. The same table and seed give the same mix.
    Other columns are not read.
    """
    slim = stash(
        docs.select(q(key).alias("key"), q(source).alias("source"), word_count(q(text)).alias("size")),
        "sizes",
    )
    mixed = take_words(slim, weights, most, share, seed, blocks, shards)
    return mixed.withColumnRenamed("key", key)


def repeat_to_mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    most: float = 3,
    share: float = 1.0,
    seed: int = 8,
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``docs`` with each row as often as the mix takes its words, fractions by a seeded draw.

    Rows the mix takes nothing of go; rows without words stay once, as no target speaks of
    them. All columns are kept as they are.
    """
    row, times = fresh(docs, "row"), fresh(docs, "times")
    written = stash(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    slim = stash(
        written.select(q(row).alias("key"), q(source).alias("source"), word_count(q(text)).alias("size")),
        "sizes",
    )
    mixed = take_words(slim, weights, most, share, seed, None, SHARDS)
    chance = F.pmod(F.xxhash64(F.lit(seed + 3), "key"), F.lit(1 << 31)) / (1 << 31)
    repeats = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / F.col("size") + chance))
    copies = mixed.select(F.col("key").alias(row), repeats.cast("int").alias(times))
    return (
        written.join(copies.where(q(times) > 0), row)
        .withColumn(times, F.explode(F.sequence(F.lit(1), q(times))))
        .select(*[q(name) for name in docs.columns])
    )
