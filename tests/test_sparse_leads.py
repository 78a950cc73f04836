"""Sparse training: buckets that move alike are learned once."""

from pyspark.sql import functions as F

from tokenloom.operators import sparse_models as sm


def test_lone_buckets_of_a_row_share_a_lead_and_weights(spark):
    rows = [
        (1, 0, "a b c c d"), (2, 1, "a e"), (3, 1, "f a g"), (4, 0, "h"), (5, 1, ""), (None, 0, "x y"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, label int, text string")
    entries = sm.with_frequencies(sm.hashed_entries(df, 1 << 20, keep=("doc_id", "label")))
    led = sm.lead_buckets(entries)
    found = led.groupBy("lead").agg(F.count("bucket").alias("n"), F.first("times").alias("times"))
    assert all(r["n"] == r["times"] for r in found.collect())
    assert found.count() < led.count() == entries.select("bucket").where("bucket is not null").distinct().count()
    steps = []
    learned = sm.train_sparse_classifier(entries, 2, 5, on_step=lambda step, w, norm: steps.append((w.count(), norm)))
    assert [n for n, _ in steps] == [led.count()] * 5
    # the merged training and the plain sums of the first step agree
    zeros = sm.initial_weights(entries, 2)
    plain = sm.sparse_gradient(entries, zeros, 2, 0)
    norm = plain.agg(F.sum(F.col("g0") ** 2 + F.col("g1") ** 2)).first()[0] ** 0.5 / 5
    assert abs(steps[0][1] - norm) < 1e-12
    alike = learned.join(led.select("bucket", "lead"), "bucket").groupBy("lead")
    assert alike.agg(F.count_distinct("w0").alias("n")).where("n <> 1").isEmpty()
