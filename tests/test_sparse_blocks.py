"""Sparse training in blocks: nothing per entry is shuffled, sums are those of the entries."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import sparse_blocks as sb, sparse_models as sm
from tokenloom.session import materialize

BUCKETS = 1 << 20
KEEP = ("doc_id", "label")


def bucket(word):
    return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % BUCKETS


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hashing_of_rows_told_apart_shuffles_nothing(spark):
    rows = [(1, 0, "a a b"), (2, None, "b"), (None, 1, "c"), (4, 1, ""), (5, 1, None)]
    entries = sm.hashed_entries(spark.createDataFrame(rows, "doc_id long, label int, text string"), BUCKETS, keep=KEEP)
    assert "Exchange" not in plan_of(entries)
    found = {(r["doc_id"], r["bucket"]): r["value"] for r in entries.collect()}
    expected = {
        (1, bucket("a")): 1 / 3, (1, bucket(" a")): 1 / 3, (1, bucket(" b")): 1 / 3,
        (2, bucket("b")): 1.0, (None, bucket("c")): 1.0, (4, None): None, (5, None): None,
    }
    assert found == expected


def test_rows_that_share_what_is_kept_add_up_their_counts(spark):
    rows = [(1, 0, "a b"), (1, 0, "a b"), (None, 1, "c"), (None, 1, "c"), (1, 1, "a"), (7, 0, "d")]
    entries = sm.hashed_entries(spark.createDataFrame(rows, "doc_id long, label int, text string"), BUCKETS, keep=KEEP)
    found = Counter((r["doc_id"], r["label"], r["bucket"], r["value"]) for r in entries.collect())
    assert found == Counter(
        [(1, 0, bucket("a"), 1.0), (1, 0, bucket(" b"), 1.0), (None, 1, bucket("c"), 2.0),
         (1, 1, bucket("a"), 1.0), (7, 0, bucket("d"), 1.0)]
    )


def test_blocks_and_shards_give_the_sums_of_the_entries(spark, monkeypatch):
    monkeypatch.setattr(sb, "LEAST_ENTRIES", 30)
    monkeypatch.setattr(sb, "SHARD_BUCKETS", 5)
    words = "a b c d e f g h i j k l m".split()
    rows = [(i, i % 3, " ".join(words[(i * k) % 13] for k in range(1, 3 + i % 6))) for i in range(60)]
    rows += [(60, 1, ""), (None, 0, "a b"), (61, None, "c q")]
    df = spark.createDataFrame(rows, "doc_id long, label int, text string")
    entries = sm.with_frequencies(sm.hashed_entries(df, BUCKETS, keep=KEEP))
    once = materialize(entries.withColumn("times", F.lit(1).cast("bigint")))
    leads = once.select("bucket").distinct().count()
    descent = sb.Descent(once, once.count(), leads, 3, "doc_id", "label")
    assert descent.rows() == 62
    state = descent.begin()
    assert state.count() > 1 and descent.written.count() > 1
    for move, rate in ((None, 0.0), ((1 / 62, 0.05, 1), 0.05)):
        weights = descent.weights(state, move, [f"{p}{c}" for p in "wmv" for c in range(3)])
        weights = materialize(weights.join(entries.groupBy("bucket").agg(F.first("n").alias("n")), "bucket"))
        state = materialize(descent.step(state, move).drop("square"))
        sums = descent.weights(state.withColumn("moments", F.concat("sums", "sums", "sums")), None,
                               [f"{p}{c}" for p in "gxy" for c in range(3)])
        found = {r["bucket"]: [r[f"g{c}"] for c in range(3)] for r in sums.collect()}
        plain = sm.sparse_gradient(entries, weights, 3, 0).collect()
        assert len(plain) == len(found)
        for r in plain:
            assert found[r["bucket"]] == pytest.approx([r[f"g{c}"] for c in range(3)], abs=1e-12)
    descent.close()
