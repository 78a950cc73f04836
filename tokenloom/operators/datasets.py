"""Token datasets: stream positions, packed windows, sampling, sizing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tokenloom.functions.draws import draw_integer
from tokenloom.operators.joins import fits_broadcast
from tokenloom.session import materialize

#: Rows aimed at per range of keys.
RANGE_ROWS = 1_000_000


def with_offsets(
    df: DataFrame, key: str, size: Column, out: str = "offset", buckets: int | None = None
) -> DataFrame:
    """Adds the sum of ``size`` over all rows with a smaller key, of any sortable type.

    A null key, or one that two rows share, is an error: it has no place of its own.
    Only (key, size) is put into key ranges and written; the totals of the ranges, whose
    number follows the rows, are added up before each range, and the offsets join the rows
    by key, so wide rows use every partition.
    """
    spark = df.sparkSession
    slim = df.select(F.col(key).alias("_key"), size.cast("bigint").alias("_size"))
    if buckets is None:
        buckets = max(
            int(spark.conf.get("spark.sql.shuffle.partitions")), -(-slim.count() // RANGE_ROWS)
        )
    ranged = materialize(
        slim.repartitionByRange(buckets, "_key").withColumn("_range", F.spark_partition_id())
    )
    totals = ranged.groupBy("_range").agg(F.sum("_size").alias("_total"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0).cast("bigint")).alias("_start")
    )
    inside = Window.partitionBy("_range").orderBy("_key")
    before = F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    wrong = F.raise_error(F.lit("keys must be unique and not null")).cast("bigint")
    twice = F.lag("_key").over(inside) == F.col("_key")
    offset = F.when(F.col("_key").isNull() | twice, wrong).otherwise(
        F.coalesce(before, F.lit(0).cast("bigint"))
    )
    placed = ranged.withColumn("_before", offset).join(F.broadcast(starts), "_range")
    found = placed.select(
        F.col("_key").alias("_found"), (F.col("_start") + F.col("_before")).alias(out)
    )
    # a null key meets its error instead of being dropped
    same = F.col(key).eqNullSafe(F.col("_found"))
    # wide rows are looked up in the slim side's hash table, so they are not sorted
    return df.join(found.hint("shuffle_hash"), same).drop("_found")


def delimited(df: DataFrame, end_id: int, tokens: str = "tokens") -> DataFrame:
    """Append the delimiter id to every document."""
    return df.withColumn(tokens, F.concat(tokens, F.array(F.lit(end_id).cast("int"))))


def token_stream(df: DataFrame, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """Documents placed one after the other: adds the global offset of each."""
    return with_offsets(df, key, F.size(tokens))


def token_rows(stream: DataFrame, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """One row per token: (key, tok_pos, global_pos, token_id)."""
    return stream.select(key, "offset", F.posexplode(tokens).alias("tok_pos", "token_id")).select(
        key, "tok_pos", (F.col("offset") + F.col("tok_pos")).alias("global_pos"), "token_id"
    )


def _pieces(stream: DataFrame, length: int, overlap: int, tokens: str) -> DataFrame:
    """Cut each document where windows begin: (window_id, start, piece).

    Window k holds positions k*length .. k*length + length + overlap - 1.
    """
    first = F.greatest(
        F.lit(0), F.floor((F.col("offset") - F.lit(overlap)) / F.lit(length))
    ).cast("bigint")
    end = F.col("offset") + F.size(tokens)
    last = F.floor((end - 1) / F.lit(length)).cast("bigint")

    def cut(window: Column) -> Column:
        start = F.greatest(F.col("offset"), window * length)
        stop = F.least(end, window * length + length + overlap)
        return F.struct(
            window.alias("window_id"),
            start.alias("start"),
            F.slice(
                F.col(tokens),
                (start - F.col("offset") + 1).cast("int"),
                F.greatest(stop - start, F.lit(0)).cast("int"),
            ).alias("piece"),
        )

    filled = stream.where(F.size(tokens) > 0)
    return filled.select(F.inline(F.transform(F.sequence(first, last), cut))).where(
        F.size("piece") > 0
    )


def _windows(pieces: DataFrame) -> DataFrame:
    """Whole windows (window_id, tokens); a group never exceeds one window."""
    listed = F.array_sort(F.collect_list(F.struct("start", "piece")))
    return (
        pieces.groupBy("window_id")
        .agg(F.flatten(F.transform(listed, lambda part: part["piece"])).alias("tokens"))
    )


def pack_sequences(stream: DataFrame, length: int, tokens: str = "tokens") -> DataFrame:
    """Every aligned window with its next-token labels: (window_id, start, input, target).

    Windows that lie inside one document stay where they are; only the pieces at the
    edges of documents are shuffled.
    """
    pieces = _pieces(stream, length, 1, tokens)
    whole = F.size("piece") == length + 1
    inside = pieces.where(whole).select("window_id", F.col("piece").alias("tokens"))
    edges = _windows(pieces.where(~whole)).where(F.size("tokens") == length + 1)
    full = inside.unionByName(edges)
    return full.select(
        "window_id",
        (F.col("window_id") * length).alias("start"),
        F.slice("tokens", 1, length).alias("input"),
        F.slice("tokens", 2, length).alias("target"),
    )


def next_token_labels(packed: DataFrame) -> DataFrame:
    """One row per position of the packed windows: (global_pos, token_id, label)."""
    pairs = F.arrays_zip("input", "target")
    return packed.select("start", F.posexplode(pairs).alias("i", "pair")).select(
        (F.col("start") + F.col("i")).alias("global_pos"),
        F.col("pair.input").alias("token_id"),
        F.col("pair.target").alias("label"),
    )


def sample_starts(
    spark: SparkSession, n_tokens: int, batch: int, length: int, strategy: str, seed: int
) -> DataFrame:
    """(sample_id, start) with replacement.

    'random' draws any start in [0, n - length); 'aligned' draws among the starts
    0, length, 2*length, ... of that range.
    """
    room = n_tokens - length
    if room < 1:
        raise ValueError("the dataset is shorter than one window and its label")
    ids = spark.range(batch).withColumnRenamed("id", "sample_id")
    draw = draw_integer(seed, F.col("sample_id"))
    if strategy == "random":
        start = draw % room
    elif strategy == "aligned":
        start = (draw % -(-room // length)) * length
    else:
        raise ValueError("strategy must be 'random' or 'aligned'")
    return ids.withColumn("start", start)


def sample_windows(
    stream: DataFrame,
    batch: int,
    length: int,
    strategy: str = "random",
    seed: int = 42,
    tokens: str = "tokens",
) -> DataFrame:
    """A batch of windows with next-token labels: (sample_id, start, input, target).

    A start touches at most two aligned blocks, so the look-up is an equi-join.
    """
    total = stream.agg(F.coalesce(F.sum(F.size(tokens)), F.lit(0))).first()[0]
    starts = sample_starts(stream.sparkSession, total, batch, length, strategy, seed)
    first = F.col("start").cast("bigint") - F.pmod("start", F.lit(length))
    needed = starts.withColumn("first", (first / length).cast("bigint")).withColumn(
        "window_id", F.explode(F.array(F.col("first"), F.col("first") + 1))
    )
    wanted = materialize(needed.select("window_id").distinct())
    if fits_broadcast(wanted):
        wanted = F.broadcast(wanted)
    # Only the pieces of drawn windows are shuffled.
    pieces = _pieces(stream, length, 0, tokens).join(wanted, "window_id", "left_semi")
    blocks = _windows(pieces)
    listed = F.array_sort(F.collect_list(F.struct("window_id", "tokens")))
    whole = (
        needed.join(blocks, "window_id")
        .groupBy("sample_id", "start", "first")
        .agg(F.flatten(F.transform(listed, lambda part: part["tokens"])).alias("tokens"))
    )
    skip = (F.col("start") - F.col("first") * length).cast("int")
    return whole.select(
        "sample_id",
        "start",
        F.slice("tokens", skip + 1, F.lit(length)).alias("input"),
        F.slice("tokens", skip + 2, F.lit(length)).alias("target"),
    )


def window_start_histogram(starts: DataFrame, n_starts: int) -> DataFrame:
    """(start, n, expected, within): draws per start against 5 standard deviations."""
    total = starts.count()
    share = 1.0 / n_starts
    expected = total * share
    margin = 5 * (total * share * (1 - share)) ** 0.5
    return (
        starts.groupBy("start")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("expected", F.lit(expected))
        .withColumn("within", F.abs(F.col("n") - expected) <= margin)
    )


def epoch_plan(
    stream: DataFrame, batch: int, length: int, total_tokens: int, schedule_epochs: int
) -> DataFrame:
    """One row of sizes: tokens and iterations per epoch, iterations, epochs, cycle."""
    per_step = batch * length
    sized = stream.agg(F.sum(F.size("tokens")).cast("bigint").alias("n_tokens"))
    steps = F.floor(F.col("n_tokens") / per_step).cast("bigint")
    return sized.select(
        "n_tokens",
        steps.alias("iters_per_epoch"),
        F.lit(total_tokens // per_step).cast("bigint").alias("max_iters"),
        (F.lit(float(total_tokens // per_step)) / steps).alias("epochs"),
        (steps * schedule_epochs).alias("cycle_iters"),
    )
