"""Tiled attention against the row form, the sparse classifier against the dense one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.operators import attention as at, models as md, sparse_models as sm
from tokenloom.session import materialize


def votes(df):
    return {
        row["vec_id"]: (row["label"], row["predicted"], row["weight"] and round(row["weight"], 7))
        for row in df.collect()
    }


@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.default_rng(3)
    rows = [
        (3 * i - 40, draw.normal(size=8).tolist(), None if i % 29 == 5 else int(draw.integers(5)))
        for i in range(330)
    ]
    return materialize(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))


@pytest.mark.parametrize("length,tile", [(330, 16), (100, 16), (64, 64), (1, 16), (1000, 7)])
def test_tiles_equal_the_row_form(vectors, length, tile):
    labelled = materialize(vectors.where("label is not null"))
    expected = votes(md.soft_knn(labelled, length))
    assert votes(at.soft_knn_blocks(labelled, length, tile=tile)) == expected


def test_a_block_of_ten_thousand_rows(spark):
    draw = np.random.default_rng(4)
    matrix, labels = draw.normal(size=(10_000, 4)), draw.integers(3, size=10_000)
    rows = [(i, matrix[i].tolist(), int(labels[i])) for i in range(10_000)]
    df = materialize(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    found = votes(at.soft_knn_blocks(df, 10_000))
    assert len(found) == 10_000 and found[0] == (labels[0], None, None)
    for i in (1, 255, 256, 257, 5_000, 9_999):
        scores = matrix[:i] @ matrix[i] / 2.0
        weights = np.exp(scores - scores.max())
        shares = np.bincount(labels[:i], weights, minlength=3) / weights.sum()
        assert found[i][:2] == (labels[i], shares.argmax())
        assert abs(found[i][2] - shares.max()) < 1e-6


def test_attention_without_labels_vectors_or_rows(spark, vectors):
    found = votes(at.soft_knn_blocks(vectors, 330, tile=32))
    assert len(found) == 330
    second = vectors.where("vec_id < -34").withColumn("label", F.lit(None).cast("int"))
    assert votes(at.soft_knn_blocks(materialize(second), 10)) == {
        -40: (None, None, None),
        -37: (None, None, None),
    }
    assert votes(at.soft_knn_blocks(vectors.limit(0), 10)) == {}
    broken = materialize(vectors.limit(3).withColumn("embedding", F.lit(None).cast("array<double>")))
    with pytest.raises(Exception, match="must not be null"):
        at.soft_knn_blocks(broken, 10).collect()


@pytest.fixture(scope="module")
def labelled_texts(spark):
    words = "red green blue one two three four".split()
    rows = []
    for i in range(60):
        text = " ".join(words[(i * k) % 7] for k in range(1, 2 + i % 5))
        rows.append((i, text if i % 11 else "", i % 3))
    rows.append((60, None, 1))
    return materialize(spark.createDataFrame(rows, "doc_id long, text string, label int"))


@pytest.mark.parametrize("share,floor", [(1.0, 0), (1.0, 9), (0.6, 9)])
def test_sparse_classifier_equals_the_dense_one(labelled_texts, share, floor):
    keep = ("doc_id", "label")
    dense = materialize(md.hashed_features(labelled_texts, 64, keep=keep))
    entries = sm.with_frequencies(sm.hashed_entries(labelled_texts, 64, keep=keep))
    learn = {"rates": (0.05, 0.01), "max_norm": 0.1, "batch_share": share, "key": "doc_id"}
    norms, expected_norms = [], []
    weights = sm.train_sparse_classifier(
        entries, 3, 4, floor=floor, on_step=lambda step, w, norm: norms.append(norm), **learn
    )
    parameters = md.train_classifier(
        dense, 3, 4, on_step=lambda step, p, log: expected_norms.append(log["grad_norm"]), **learn
    )
    assert norms == pytest.approx(expected_norms, abs=1e-12)
    expected = {(r["dim"], r["class"]): r["value"] for r in parameters.collect() if r["value"]}
    found = {(r["bucket"], c): r[f"w{c}"] for r in weights.collect() for c in range(3) if r[f"w{c}"]}
    assert found == pytest.approx(expected, abs=1e-12)

    def rows(df):
        return sorted((r["doc_id"], r["label"], r["predicted"], round(r["prob"], 7)) for r in df.collect())

    mine = sm.classify_entries(entries, weights, 3, keep=("label",), floor=floor)
    assert rows(mine) == rows(md.classify(dense, parameters, keep=keep))
    losses = sm.sparse_losses(entries, weights, 3, ["label"], floor=floor).collect()
    wanted = md.classifier_losses(dense, parameters, ["label"]).collect()
    assert {r["label"]: (r["n"], round(r["loss"], 9)) for r in losses} == {
        r["label"]: (r["n"], round(r["loss"], 9)) for r in wanted
    }


def test_buckets_the_weights_do_not_hold(labelled_texts):
    entries = sm.with_frequencies(sm.hashed_entries(labelled_texts, 1 << 20, keep=("doc_id", "label")))
    weights = sm.train_sparse_classifier(entries.where("doc_id = 1"), 3, 1, floor=2)
    found = sm.classify_entries(entries, weights, 3, floor=2).collect()
    assert len(found) == 61
    empty = next(row for row in found if row["doc_id"] == 60)
    assert (empty["predicted"], round(empty["prob"], 6)) == (0, 0.333333)


def test_sparse_classifier_of_no_rows(labelled_texts):
    entries = sm.with_frequencies(sm.hashed_entries(labelled_texts.limit(0), 64, keep=("doc_id", "label")))
    weights = sm.train_sparse_classifier(entries, 3, 2)
    assert weights.count() == 0
    assert sm.classify_entries(entries, weights, 3).count() == 0
