"""Kneser-Ney tables against the formulas, sums of probabilities, held-out perplexity."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import backoff as bo, joins, scoring as sc
from tokenloom.session import materialize


def brute(docs: list[list[int]], order: int, vocab: int):
    """P(next | context) by recursion over the definitions."""
    counts = {order: Counter()}
    for ids in docs:
        line = [-1] * (order - 1) + ids
        for i in range(len(ids)):
            counts[order][tuple(line[i : i + order])] += 1
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(gram[1:] for gram in counts[k + 1])
    totals = {k: defaultdict(list) for k in counts}
    for k, table in counts.items():
        for gram, n in table.items():
            totals[k][gram[:-1]].append(n)
    offs = {}
    for k, table in counts.items():
        ones, twos = (sum(n == x for n in table.values()) for x in (1, 2))
        offs[k] = ones / (ones + 2 * twos) if ones and twos else 0.5

    def p(k: int, gram: tuple) -> float:
        if k == 0:
            return 1 / vocab
        seen = totals[k].get(gram[:-1])
        if not seen:
            return p(k - 1, gram[1:])
        own = max(counts[k][gram] - offs[k], 0) / sum(seen)
        return own + offs[k] * len(seen) / sum(seen) * p(k - 1, gram[1:])

    return lambda gram: p(order, gram)


def made(seed: int, n: int = 60, vocab: int = 7) -> list[list[int]]:
    rng = random.Random(seed)
    return [[rng.choices(range(vocab), [8, 4, 2, 1, 1, 0.2, 0])[0] for _ in range(rng.randrange(12))] for _ in range(n)]


def frame(spark, docs):
    return spark.createDataFrame(list(enumerate(docs)), "doc_id long, tokens array<int>")


@pytest.mark.parametrize("order,small", [(1, True), (2, True), (3, True), (3, False)])
def test_probabilities_by_the_formulas(spark, monkeypatch, order, small):
    if not small:  # no table is broadcast whole: hot keys and salted joins
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(bo, "spread_left_join", lambda *a: joins.spread_left_join(*a, hot_rows=4, small=False))
        monkeypatch.setattr(joins, "hot_part", lambda dim, weight, hot: dim.orderBy(F.desc(weight)).limit(3))
    docs = made(order)
    model = bo.kneser_ney(bo.ngram_counts(frame(spark, docs), order), order, 7)
    p = brute(docs, order, 7)
    contexts = [(a, b)[3 - order :] for a in range(-1, 8) for b in range(-1, 8)]
    contexts = sorted(set(contexts))
    names = bo.context_names(order)
    rows = spark.createDataFrame([(*c, i) for i, c in enumerate(contexts)], [*names, "place"])
    found = bo.next_tokens(rows.select(*[F.col(x).cast("int") for x in names], "place"), model).collect()
    assert len(found) == 7 * len(contexts)
    sums = defaultdict(float)
    for row in found:
        gram = (*contexts[row.place], row.next)
        assert row.prob == pytest.approx(p(gram), rel=1e-12)
        sums[row.place] += row.prob
    assert all(x == pytest.approx(1) for x in sums.values())


def test_scores(spark):
    docs = [*made(5), [], [3]]
    df = frame(spark, docs)
    model = bo.kneser_ney(bo.ngram_counts(df.where("doc_id < 40"), 3), 3, 7)
    p = brute(docs[:40], 3, 7)
    rows = {x.doc_id: x for x in bo.score_backoff(df, model).collect()}
    assert len(rows) == len(docs)
    for i, ids in enumerate(docs):
        line = [-1, -1, *ids]
        logs = [-math.log(p(tuple(line[k : k + 3]))) for k in range(len(ids))]
        assert rows[i].n_pairs == len(ids)
        if ids:
            assert rows[i].loss == pytest.approx(sum(logs) / len(logs))
        else:
            assert rows[i].loss is None


def test_empty_training_is_uniform(spark):
    model = bo.kneser_ney(bo.ngram_counts(frame(spark, []), 2), 2, 10)
    found = bo.with_probability(spark.createDataFrame([(1, 2)], "c1 int, next int"), model).first()
    assert found.prob == pytest.approx(0.1) and found.known == 0


def test_lower_held_out_perplexity_than_the_bigram(spark, small_docs):
    tokens = small_docs.select("doc_id", F.transform(F.split(F.substring("text", 1, 3000), ""), lambda c: F.ascii(c) % 256).alias("tokens"))
    split = sc.split_by_draw(F.col("doc_id"), 0.2)
    train, valid = (tokens.where(split == x) for x in ("train", "valid"))
    bigram = materialize(sc.ngram_model(sc.bigrams(train), 256))
    before = sc.eval_losses(sc.score_documents(valid, bigram, 256).withColumn("split", F.lit("v"))).first()
    model = bo.kneser_ney(bo.ngram_counts(train, 4), 4, 256)
    after = sc.eval_losses(bo.score_backoff(valid, model).withColumn("split", F.lit("v"))).first()
    assert after.perplexity < 0.8 * before.perplexity


def test_draws_follow_the_distribution(spark):
    """First tokens of many prompts, against the probabilities of their contexts."""
    docs = made(8, 200)
    model = bo.kneser_ney(bo.ngram_counts(frame(spark, docs), 3), 3, 7)
    p = brute(docs, 3, 7)
    contexts = [[0, 1], [5, 4], [], [6, 6]]
    rows = [(f"{c}:{i}", contexts[c]) for c in range(4) for i in range(4000)]
    prompts = spark.createDataFrame(rows, "prompt_id string, tokens array<int>")
    found = bo.generate_backoff(prompts, model, 99, 1).collect()
    counts = Counter((int(x.prompt_id[0]), x.generated[0]) for x in found)
    for c, context in enumerate(contexts):
        line = ([-1, -1] + context)[-2:]
        for token in range(7):
            wanted = p((*line, token))
            assert abs(counts[c, token] / 4000 - wanted) < 5 * (wanted * (1 - wanted) / 4000) ** 0.5 + 1e-3


def test_generation_is_stable_and_stops(spark):
    docs = made(9, 100)
    model = bo.kneser_ney(bo.ngram_counts(frame(spark, docs), 3), 3, 7)
    prompts = spark.createDataFrame([(i, [i % 7]) for i in range(30)], "prompt_id int, tokens array<int>")
    rows = {x.prompt_id: x.generated for x in bo.generate_backoff(prompts, model, 4, 9).collect()}
    again = bo.generate_backoff(prompts.repartition(3), model, 4, 9, checkpoint_every=1).collect()
    assert rows == {x.prompt_id: x.generated for x in again}
    assert all(x[-1] == 4 or len(x) == 9 for x in rows.values())
    assert all(4 not in x[:-1] for x in rows.values()) and any(len(x) == 9 for x in rows.values())
