"""Adjacent-pair jobs over distinct words (sym string, freq long)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.functions import text as tx


def byte_words(counts: DataFrame) -> DataFrame:
    """Distinct pretokens as lifted byte strings: (pretoken, sym, freq)."""
    return counts.select("pretoken", tx.lift(F.col("pretoken")).alias("sym"), "freq")


def pair_counts(words: DataFrame) -> DataFrame:
    """(pair, n): weighted count of every adjacent pair, overlaps included."""
    return (
        words.select(F.explode(tx.adjacent_pairs("sym")).alias("pair"), "freq")
        .groupBy("pair")
        .agg(F.sum("freq").alias("n"))
    )


def pair_sides(pairs: DataFrame) -> DataFrame:
    """Adds the two halves of ``pair`` as hex bytes (byte symbols only)."""

    def half(place: int) -> Column:
        return F.hex(tx.unlift(F.substring("pair", place, 1)))

    return pairs.withColumn("left_hex", half(1)).withColumn("right_hex", half(2))


def top_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """The k most frequent pairs; equal counts go to the greater bytes."""
    return pairs.orderBy(F.col("n").desc(), F.col("pair").desc()).limit(k)


def top_pair(pairs: DataFrame) -> DataFrame:
    """The pair to merge next, by (count, left bytes, right bytes)."""
    best = F.max(F.struct("n", "pair")).alias("best")
    return pairs.agg(best).select("best.pair", "best.n")


def merge_pair(words: DataFrame, pair: str, symbol: str) -> DataFrame:
    """Rewrite every occurrence of ``pair``, left to right without overlap."""
    return words.withColumn("sym", F.replace(F.col("sym"), F.lit(pair), F.lit(symbol)))


# A merge list travels as one literal, three characters per merge: the pair, then
# its symbol. The optimizer folds these into literal arrays.
PAIRS = "regexp_extract_all(steps, '(?s)(..).', 1)"
SYMBOLS = "regexp_extract_all(steps, '(?s)..(.)', 1)"
REWRITE = (
    "aggregate(sequence(0, length(steps) div 3 - 1), sym, "
    f"(s, i) -> replace(s, {PAIRS}[i], {SYMBOLS}[i]))"
)


def packed_steps(steps: list[tuple[str, str]]) -> str:
    return "".join(pair + new for pair, new in steps)


def merge_pairs(words: DataFrame, steps: list[tuple[str, str]]) -> DataFrame:
    """Apply a list of merges in order: (sym, freq)."""
    return words.withColumn("steps", F.lit(packed_steps(steps))).selectExpr(
        f"{REWRITE} AS sym", "freq"
    )


def pair_deltas(words: DataFrame, steps: list[tuple[str, str]]) -> DataFrame:
    """Changes of pair counts when the merges ``steps`` are applied to ``words``.

    Only words that hold one of the pairs are rewritten and counted. A pair made
    of a symbol that ``steps`` itself creates needs no test: such a word already
    holds the pair that creates the symbol.
    """
    touched = f"exists({PAIRS}, pair -> contains(sym, pair))"
    return (
        words.withColumn("steps", F.lit(packed_steps(steps)))
        .where(touched)
        .selectExpr(
            f"inline(array(struct(sym AS s, -freq AS w), struct({REWRITE} AS s, freq AS w)))"
        )
        .selectExpr(f"explode({tx.ADJACENT_PAIRS.format('s')}) AS pair", "w AS n")
    )


def apply_deltas(counts: DataFrame, deltas: DataFrame) -> DataFrame:
    """Pair counts after the deltas; pairs that vanish are dropped."""
    return counts.union(deltas).groupBy("pair").agg(F.sum("n").alias("n")).where("n > 0")


def pair_index(words: DataFrame) -> DataFrame:
    """Inverted index as a long table: (pair, pretoken, place, freq)."""
    pairs = F.posexplode(tx.adjacent_pairs("sym")).alias("place", "pair")
    return words.select("pretoken", "freq", pairs).select("pair", "pretoken", "place", "freq")


def pair_index_sizes(words: DataFrame) -> DataFrame:
    """(pair, n_words, n): how many distinct words hold a pair, and its count.

    The first grouping keeps the partitioning by word, so only the second shuffles.
    """
    per_word = (
        pair_index(words)
        .groupBy("pretoken", "pair")
        .agg(F.sum("freq").alias("n"))
    )
    return per_word.groupBy("pair").agg(
        F.count(F.lit(1)).alias("n_words"), F.sum("n").alias("n")
    )


def words_with_pair(words: DataFrame, pair: str) -> DataFrame:
    """The distinct words that hold ``pair``."""
    return words.where(F.col("sym").contains(F.lit(pair)))
