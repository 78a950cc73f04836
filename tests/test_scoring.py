import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import arrays as ar, optimizer as opt
from tokenloom.operators import generation as gen, models as md, scoring as sc


def vectors(spark, matrix, label=None):
    rows = [(i, [float(x) for x in row], int(label[i]) if label is not None else 0) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def np_softmax(x, temperature=1.0):
    z = np.exp(x / temperature - (x / temperature).max(axis=-1, keepdims=True))
    return z / z.sum(axis=-1, keepdims=True)


@pytest.fixture(scope="module")
def matrix():
    return np.random.default_rng(0).normal(size=(12, 5))


def test_softmax_is_stable_and_shift_free(spark, matrix):
    for shift, temperature in ((0, 1.0), (100, 1.0), (0, 0.3)):
        df = vectors(spark, matrix + shift).select(ar.softmax(F.col("embedding"), temperature).alias("p"), "vec_id")
        got = np.array([r["p"] for r in df.orderBy("vec_id").collect()])
        np.testing.assert_allclose(got, np_softmax(matrix, temperature), atol=1e-9)


@pytest.mark.parametrize("temperature", [0.0, 1e-3, 1.5, -1.0])
def test_temperature_range(temperature):
    with pytest.raises(ValueError):
        ar.checked_temperature(temperature)


@pytest.mark.parametrize("scale", [1, 1000])
def test_cross_entropy(spark, matrix, scale):
    label = np.arange(12) % 5
    logits = matrix * scale
    top = logits.max(axis=1, keepdims=True)
    nll = (np.log(np.exp(logits - top).sum(axis=1)) + top[:, 0]) - logits[np.arange(12), label]
    df = vectors(spark, logits, label)
    row = sc.cross_entropy(df, "embedding", "label").first()
    assert row["loss"] == pytest.approx(nll.mean(), rel=1e-9)
    long = df.select(F.col("vec_id").alias("row_id"), F.posexplode("embedding").alias("token_id", "logit"))
    targets = df.select(F.col("vec_id").alias("row_id"), F.col("label").alias("target"))
    assert sc.cross_entropy_long(long, targets).first()["loss"] == pytest.approx(nll.mean(), rel=1e-9)
    if scale == 1:
        assert row["perplexity"] == pytest.approx(math.exp(nll.mean()))


def test_rms_normalize(spark, matrix):
    weight = [0.5, 1.0, 2.0, -1.0, 0.0]
    df = vectors(spark, matrix)
    scaled = ar.rms_normalize(F.col("embedding"), F.array(*[F.lit(w) for w in weight]))
    got = np.array([r[0] for r in df.orderBy("vec_id").select(scaled).collect()])
    expected = matrix / np.sqrt((matrix**2).mean(axis=1, keepdims=True) + 1e-5) * weight
    np.testing.assert_allclose(got, expected, atol=1e-9)


def test_learning_rates(spark):
    def expected(step):
        if step < 7:
            return step / 7
        if step > 21:
            return 0.1
        return 0.1 + 0.45 * (1 + math.cos(math.pi * (step - 7) / 14))

    got = md.scheduled_rates(spark, 24, 1.0, 0.1, 7, 21)
    np.testing.assert_allclose(got, [expected(step) for step in range(25)], rtol=1e-12)


def test_updates_match_numpy(spark):
    rng = np.random.default_rng(1)
    value, m, v = np.zeros(6), np.zeros(6), np.zeros(6)
    df = md.initial_parameters(spark, 2, 3)
    for step in range(1, 4):
        g = rng.normal(size=6)
        g[5] = np.nan
        rows = [(i // 3, i % 3, None if np.isnan(g[i]) else float(g[i])) for i in range(6)]
        gradients = spark.createDataFrame(rows, "class int, dim int, gradient double")
        df = md.apply_adamw(df, gradients, 0.01, step)
        live = slice(0, 5)
        m[live] = 0.9 * m[live] + (1 - 0.9) * g[live]
        v[live] = 0.999 * v[live] + (1 - 0.999) * g[live] ** 2
        size = 0.01 * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        value[live] -= size * m[live] / (np.sqrt(v[live]) + 1e-8)
        value[live] -= 0.01 * 0.01 * value[live]
    got = [r["value"] for r in df.orderBy("class", "dim").collect()]
    np.testing.assert_allclose(got, value, atol=1e-12)
    moved = md.apply_sgd(md.initial_parameters(spark, 2, 3), gradients, 0.5, 3)
    got = [r["value"] for r in moved.orderBy("class", "dim").collect()]
    np.testing.assert_allclose(got, np.nan_to_num(-0.5 * g / 2), atol=1e-12)


@pytest.mark.parametrize("limit", [1e-2, 1e3])
def test_clipping_uses_the_joint_norm(spark, limit):
    g = np.random.default_rng(2).normal(size=10)
    rows = [(0, i, float(x)) for i, x in enumerate(g)] + [(1, 0, None)]
    df = spark.createDataFrame(rows, "class int, dim int, gradient double")
    norm = np.sqrt((g**2).sum())
    assert md.grad_norm(df).first()["grad_norm"] == pytest.approx(norm)
    got = [r["gradient"] for r in md.clip_gradients(df, limit).where("class = 0").orderBy("dim").collect()]
    factor = limit / (norm + 1e-6) if norm > limit else 1.0
    np.testing.assert_allclose(got, g * factor)


def test_classifier_learns_and_resumes(spark):
    rng = np.random.default_rng(3)
    label = rng.integers(0, 3, 90)
    matrix = np.eye(3)[label] * 2 + rng.normal(size=(90, 3)) * 0.1
    df = vectors(spark, matrix, label).persist()
    options = {"features": "embedding", "rates": (0.3, 0.1), "cycle": 6}
    losses = []

    def log(step, parameters, values):
        losses.append(md.classifier_losses(df, parameters, (), "embedding").first()["loss"])
        assert values["grad_norm"] > 0

    learned = md.train_classifier(df, 3, 6, on_step=log, **options)
    assert losses == sorted(losses, reverse=True)
    right = md.classify(df, learned, "embedding", ("label",)).where("label = predicted").count()
    assert right == 90
    part = md.train_classifier(df, 3, 4, **options)
    rest = md.train_classifier(df, 3, 6, start=part, start_step=5, **options)
    assert sorted(rest.collect()) == sorted(learned.collect())


def test_soft_knn_looks_back_only(spark, matrix):
    label = np.arange(12) % 3
    df = vectors(spark, matrix, label)
    rows = {r["vec_id"]: r for r in md.soft_knn(df, 5).collect()}
    for i in range(12):
        first = i // 5 * 5
        if i == first:
            assert rows[i]["predicted"] is None
            continue
        weights = np_softmax(matrix[first:i] @ matrix[i] / math.sqrt(5))
        votes = {y: weights[label[first:i] == y].sum() for y in label[first:i]}
        best = min(votes, key=lambda y: (-round(votes[y], 9), y))
        assert rows[i]["predicted"] == best
        assert rows[i]["weight"] == pytest.approx(votes[best], abs=1e-8)


def probs(spark, values):
    return spark.createDataFrame([(0, i, p) for i, p in enumerate(values)], "prev int, next int, prob double")


@pytest.mark.parametrize(
    "p, kept", [(0.45, 1), (0.5, 2), (0.6, 2), (0.75, 3), (0.8, 3), (1.0, 4), (0.01, 1)]
)
def test_nucleus_keeps_the_crossing_token(spark, p, kept):
    rows = gen.nucleus_filter(probs(spark, [0.125, 0.5, 0.25, 0.125]), p).orderBy("rank").collect()
    assert [r["next"] for r in rows] == [1, 2, 0, 3][:kept]
    assert sum(r["prob"] for r in rows) == pytest.approx(1.0)
    assert rows[-1]["upper"] == pytest.approx(1.0)


@pytest.mark.parametrize("p", [0.0, 1.1])
def test_nucleus_range(spark, p):
    with pytest.raises(ValueError):
        gen.nucleus_filter(probs(spark, [1.0]), p)


def test_scores_with_and_without_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(5)
    docs = [(i, [int(t) for t in rng.integers(0, 6, rng.integers(0, 30))]) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, tokens array<int>")
    model = sc.materialize(sc.ngram_model(sc.bigrams(df.where("doc_id % 2 = 0")), 6, 0.5))
    counts = {(r["prev"], r["next"]): r["n"] for r in model.collect()}
    totals = {}
    for (prev, _), n in counts.items():
        totals[prev] = totals.get(prev, 0) + n

    def check(rows):
        got = {r["doc_id"]: r for r in rows}
        for doc, tokens in docs:
            pairs = list(zip(tokens, tokens[1:]))
            if not pairs:
                assert (got[doc]["n_pairs"], got[doc]["loss"]) == (0, None)
                continue
            nll = [
                -math.log((counts.get(pair, 0) + 0.5) / (totals.get(pair[0], 0) + 3.0)) for pair in pairs
            ]
            assert got[doc]["n_pairs"] == len(pairs)
            assert got[doc]["loss"] == pytest.approx(np.mean(nll))

    check(sc.score_documents(df, model, 6, 0.5).collect())
    import tokenloom.operators.joins as joins

    monkeypatch.setattr(joins, "fits_broadcast", lambda *_: False)
    monkeypatch.setattr(joins.spread_left_join, "__defaults__", (2, 3, 0, None))
    check(sc.score_documents(df, model, 6, 0.5).collect())


def test_prompts_are_cut_and_padded(spark):
    df = spark.createDataFrame([(0, []), (1, [1, 2]), (2, [1, 2, 3, 4])], "prompt_id long, tokens array<int>")
    rows = gen.prepare_prompts(df, 3, 9).orderBy("prompt_id").collect()
    assert [r["model_input"] for r in rows] == [[9, 9, 9], [9, 1, 2], [2, 3, 4]]
    assert [r["truncated"] for r in rows] == [False, False, True]


def test_generation_follows_the_table(spark):
    counts = spark.createDataFrame(
        [(1, 2, 5), (2, 3, 5), (3, 9, 5), (5, 5, 1), (9, 1, 4), (6, 1, 1), (6, 2, 1)],
        "prev int, next int, n long",
    )
    nucleus = gen.nucleus_filter(gen.next_token_probs(counts, 0.5), 1.0)
    table = sc.materialize(gen.draw_table(nucleus))
    prompts = spark.createDataFrame(
        [("a", [7, 1]), ("b", []), ("c", [5]), ("d", [42]), ("e", [6])],
        "prompt_id string, tokens array<int>",
    )
    done = gen.generate(prompts, table, 9, 5, seed=3, checkpoint_every=2)
    got = {r["prompt_id"]: r["generated"] for r in done.collect()}
    assert got["a"] == [2, 3, 9]
    assert got["b"] == [1, 2, 3, 9]
    assert got["c"] == [5] * 5
    assert got["d"] == [9]
    assert got["e"][0] in (1, 2) and got["e"][-1] == 9
    again = gen.generate(prompts, table, 9, 5, seed=3, checkpoint_every=4)
    assert {r["prompt_id"]: r["generated"] for r in again.collect()} == got


def test_draws_follow_the_probabilities(spark):
    counts = spark.createDataFrame([(6, 1, 3), (6, 2, 1)], "prev int, next int, n long")
    table = sc.materialize(gen.draw_table(gen.nucleus_filter(gen.next_token_probs(counts), 1.0)))
    prompts = spark.range(4000).select(F.col("id").alias("prompt_id"), F.array(F.lit(6)).alias("tokens"))
    done = gen.generate(prompts, table, 9, 1)
    ones = done.where("generated[0] = 1").count()
    assert abs(ones - 3000) < 5 * math.sqrt(4000 * 0.75 * 0.25)
