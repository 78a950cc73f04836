"""Jobs over vectors: normalization, windowed attention votes, a softmax classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.functions import arrays as ar
from tokenloom.functions import optimizer as opt
from tokenloom.functions.draws import draw_uniform
from tokenloom.functions.text import pretokens
from tokenloom.operators.datasets import with_offsets

MAX_PARAMETERS = 1_000_000


def normalize_embeddings(
    df: DataFrame, vector: str = "embedding", out: str = "normalized", weight: Column | None = None
) -> DataFrame:
    """Root-mean-square normalization of a vector column."""
    return df.withColumn(out, ar.rms_normalize(F.col(vector), weight))


def soft_knn(
    df: DataFrame,
    length: int,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Causal attention over sequences of ``length`` rows, with labels as values.

    Rows in key order form sequences. Each row weighs the earlier rows of its
    sequence by softmax(q.k / sqrt(d)) and adds up the weights per label. The
    answer is the heaviest label (the smaller one on a tie): (key, label,
    predicted, weight). A sequence never exceeds ``length`` rows; its first row
    has nothing to look at. ``df`` must be materialized.
    """
    placed = with_offsets(df.select(key, vector, label), key, F.lit(1))
    item = F.struct(
        F.col("offset"), F.col(key).alias("id"), F.col(vector).alias("v"), F.col(label).alias("y")
    )
    sequences = placed.groupBy(F.floor(F.col("offset") / length).alias("sequence")).agg(
        F.array_sort(F.collect_list(item)).alias("items")
    )

    def vote(query: Column, place: Column) -> Column:
        earlier = F.slice(F.col("items"), F.lit(1), place)
        scores = F.transform(
            earlier, lambda k: ar.dot(query["v"], k["v"]) / F.sqrt(F.size(query["v"]).cast("double"))
        )

        def votes(weights: Column) -> Column:
            pairs = F.zip_with(weights, earlier, lambda w, k: F.struct(w.alias("w"), k["y"].alias("y")))
            labels = F.array_distinct(F.transform(earlier, lambda k: k["y"]))
            totals = F.transform(
                labels,
                lambda y: F.struct(
                    F.round(
                        F.aggregate(
                            F.filter(pairs, lambda p: p["y"] == y),
                            F.lit(0.0),
                            lambda total, p: total + p["w"],
                        ),
                        9,
                    ).alias("weight"),
                    (-y).alias("negative"),
                ),
            )
            return F.array_max(totals)

        return F.when(place > 0, ar.bind(ar.softmax(scores), votes))

    rows = F.transform(
        "items",
        lambda q, i: F.struct(q["id"].alias(key), q["y"].alias(label), vote(q, i).alias("best")),
    )
    return sequences.select(F.inline(rows)).select(
        key,
        label,
        (-F.col("best.negative")).alias("predicted"),
        F.col("best.weight").alias("weight"),
    )


def hashed_features(
    df: DataFrame, buckets: int, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """(keep..., features): share of the row's pretokens per hash bucket, zeros without any.

    ``keep`` must tell rows apart.
    """
    places = df.select(*keep, F.explode_outer(pretokens(F.col(text))).alias("pretoken"))
    bucket = F.conv(F.substring(F.md5("pretoken"), 1, 8), 16, 10).cast("bigint") % buckets
    counts = places.groupBy(*keep, bucket.cast("int").alias("bucket")).agg(
        F.count("pretoken").alias("n")
    )
    entry = F.when(F.col("bucket").isNotNull(), F.struct("bucket", "n"))
    listed = F.map_from_entries(F.collect_list(entry))
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(buckets - 1)),
        lambda b: F.coalesce(F.element_at("listed", b), F.lit(0)) / F.greatest("total", F.lit(1)),
    )
    return (
        counts.groupBy(*keep)
        .agg(listed.alias("listed"), F.sum("n").alias("total"))
        .select(*keep, dense.alias("features"))
    )


def initial_parameters(spark: SparkSession, classes: int, dims: int) -> DataFrame:
    """(class, dim, value, m, v), all zero."""
    if classes * dims > MAX_PARAMETERS:
        raise ValueError(f"more than {MAX_PARAMETERS} parameters")
    return spark.range(classes * dims).select(
        F.expr(f"cast(id div {dims} as int)").alias("class"),
        (F.col("id") % dims).cast("int").alias("dim"),
        F.lit(0.0).alias("value"),
        F.lit(0.0).alias("m"),
        F.lit(0.0).alias("v"),
    )


def _matrix(parameters: DataFrame) -> list[list[float]]:
    """The parameter table as rows per class; its size was bounded when created."""
    rows = parameters.select("class", "dim", "value").collect()
    table: dict[int, dict[int, float]] = {}
    for row in rows:
        table.setdefault(row["class"], {})[row["dim"]] = row["value"]
    return [[table[c][d] for d in sorted(table[c])] for c in sorted(table)]


def class_probabilities(features: Column, matrix: list[list[float]]) -> Column:
    """softmax(W x) as an array with one entry per class."""
    rows = F.expr(
        "array(" + ", ".join("array(" + ", ".join(f"{x!r}D" for x in row) + ")" for row in matrix) + ")"
    )
    return ar.softmax(F.transform(rows, lambda row: ar.dot(features, row)))


def classifier_gradient(
    batch: DataFrame, matrix: list[list[float]], features: str, label: str
) -> DataFrame:
    """(class, dim, gradient) of the mean cross-entropy, summed by Spark per dimension."""
    classes = len(matrix)
    errors = F.transform(
        class_probabilities(F.col(features), matrix),
        lambda p, c: p - F.when(F.col(label) == c, 1.0).otherwise(0.0),
    )
    means = [F.sum(F.get("e", F.lit(c)) * F.col("x")) / F.count("x") for c in range(classes)]
    sums = (
        batch.select(errors.alias("e"), features)
        .select("e", F.posexplode_outer(features).alias("dim", "x"))
        .groupBy("dim")
        .agg(F.array(*means).alias("g"))
    )
    return sums.select("dim", F.posexplode("g").alias("class", "gradient"))


def grad_norm(gradients: DataFrame) -> DataFrame:
    """One row: the joint L2 norm; missing gradients do not count."""
    squares = F.col("gradient") * F.col("gradient")
    return gradients.agg(F.sqrt(F.coalesce(F.sum(squares), F.lit(0.0))).alias("grad_norm"))


def clip_gradients(gradients: DataFrame, limit: float) -> DataFrame:
    """Scale all gradients so that their joint norm (kept as a column) stays below ``limit``."""
    one = F.lit(0).alias("_one")
    norm = grad_norm(gradients).select("grad_norm", one)
    clipped = F.col("gradient") * opt.clip_factor(F.col("grad_norm"), limit)
    # the norm is a single row
    joined = gradients.select("*", one).join(F.broadcast(norm), "_one").drop("_one")
    return joined.withColumn("gradient", clipped)


def apply_adamw(
    parameters: DataFrame, gradients: DataFrame, rate: float, step: int, **options
) -> DataFrame:
    """Parameters and moments after one step; rows without gradient stay.

    Other gradient columns are carried along.
    """
    joined = parameters.join(gradients, ["class", "dim"], "left")
    value, first, second = opt.adamw_columns(
        F.col("value"), F.col("m"), F.col("v"), F.col("gradient"), rate, step, **options
    )
    others = [name for name in gradients.columns if name not in {"class", "dim", "gradient"}]
    return joined.select(
        "class", "dim", value.alias("value"), first.alias("m"), second.alias("v"), *others
    )


def apply_sgd(parameters: DataFrame, gradients: DataFrame, rate: float, step: int) -> DataFrame:
    """Parameters after one plain step; ``step`` counts from 0."""
    joined = parameters.join(gradients, ["class", "dim"], "left")
    value = opt.sgd_value(F.col("value"), F.col("gradient"), rate, step)
    return joined.select("class", "dim", value.alias("value"), "m", "v")


def scheduled_rates(
    spark: SparkSession, steps: int, top: float, bottom: float, warmup: int, cycle: int
) -> list[float]:
    """Learning rate of every step from 0 to ``steps``."""
    rate = opt.cosine_rate(F.col("id"), top, bottom, warmup, cycle)
    rows = spark.range(steps + 1).select("id", rate.alias("rate")).orderBy("id").collect()
    return [row["rate"] for row in rows]


def train_classifier(
    rows: DataFrame,
    classes: int,
    steps: int,
    features: str = "features",
    label: str = "label",
    rates: tuple[float, float] = (2e-3, 2e-4),
    warmup: int = 0,
    cycle: int | None = None,
    max_norm: float = 1.0,
    start: DataFrame | None = None,
    start_step: int = 1,
    on_step=None,
    batch_share: float = 1.0,
    key: str | None = None,
    seed: int = 42,
    evaluate: dict[str, DataFrame] | None = None,
    evaluate_every: int = 1,
) -> DataFrame:
    """Parameters after steps over batches: gradient, clip, schedule, AdamW.

    A step sees all rows, or those that a draw by (``seed``, ``key``, step) puts into its
    ``batch_share``. ``start`` and ``start_step`` continue a saved run with the step after
    the saved one. ``on_step(step, parameters, log)`` sees every state, for metrics and
    saves; every ``evaluate_every`` steps its log holds the loss of each named table, as
    ``name/loss``.
    """
    if batch_share < 1 and key is None:
        raise ValueError("batches need a key to draw by")
    spark = rows.sparkSession
    parameters = start
    if parameters is None:
        dims = rows.select(F.max(F.size(features))).first()[0]
        parameters = initial_parameters(spark, classes, dims)
    schedule = scheduled_rates(spark, steps, *rates, warmup, steps if cycle is None else cycle)
    schema = "class int, dim int, value double, m double, v double"
    for step in range(start_step, steps + 1):
        batch = rows
        if batch_share < 1:
            batch = rows.where(draw_uniform(seed, F.col(key), F.lit(step)) < batch_share)
        gradients = classifier_gradient(batch, _matrix(parameters), features, label)
        clipped = clip_gradients(gradients, max_norm)
        moved = apply_adamw(parameters, clipped, schedule[step], step)
        # One job per step; the bounded parameter table comes back as a literal, so
        # the plan does not grow.
        listed = moved.collect()
        parameters = spark.createDataFrame([tuple(row)[:5] for row in listed], schema)
        if on_step is not None:
            norm = next((row["grad_norm"] for row in listed if row["grad_norm"] is not None), 0.0)
            log = {"grad_norm": norm, "learning_rate": schedule[step]}
            if step % evaluate_every == 0:
                for name, table in (evaluate or {}).items():
                    scored = classifier_losses(table, parameters, (), features, label)
                    log[f"{name}/loss"] = scored.first()["loss"]
            on_step(step, parameters, log)
    return parameters


def classify(
    df: DataFrame, parameters: DataFrame, features: str = "features", keep: Sequence[str] = ()
) -> DataFrame:
    """(keep..., predicted, prob): most likely class, the smaller one on a tie."""
    probs = class_probabilities(F.col(features), _matrix(parameters))
    best = F.array_max(
        F.transform("_p", lambda p, c: F.struct(F.round(p, 9).alias("p"), (-c).alias("c")))
    )
    return (
        df.withColumn("_p", probs)
        .withColumn("_best", best)
        .select(*keep, (-F.col("_best.c")).alias("predicted"), F.col("_best.p").alias("prob"))
    )


def classifier_losses(
    df: DataFrame,
    parameters: DataFrame,
    by: Sequence[str] = (),
    features: str = "features",
    label: str = "label",
) -> DataFrame:
    """(by..., n, loss, perplexity) of a parameter table on labelled rows."""
    probs = class_probabilities(F.col(features), _matrix(parameters))
    nll = -F.log(F.get(probs, F.col(label).cast("int")))
    return df.select(*by, nll.alias("nll")).groupBy(*by).agg(
        F.count("nll").alias("n"),
        F.avg("nll").alias("loss"),
        F.exp(F.avg("nll")).alias("perplexity"),
    )
