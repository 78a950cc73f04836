"""p_toxic means the same whatever the bound of the sample."""

import numpy as np

from tokenloom.llm import toxicity as tx


def test_bounded_sample_keeps_the_shares_of_grades(spark):
    """4,000 clean and 200 toxic rows: a sample of 250 a grade gives the same prior."""
    draw = np.random.default_rng(1)
    rows = [
        (i, " ".join([f"w{x}" for x in draw.integers(0, 50, 20)] + ["bad"] * (draw.random() < (0.7 if i < 200 else 0.1))))
        for i in range(4200)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    graded = spark.createDataFrame([(i, int(i < 200)) for i in range(4200)], "doc_id long, grade int")
    texts = ["nothing known", "bad"]
    full = tx.learn_severity(docs, graded, per_grade=10_000).above(texts)[:, 0]
    part = tx.learn_severity(docs, graded, per_grade=250).above(texts)[:, 0]
    assert full[0] < 0.05 and full[1] < 0.5
    logit = lambda p: np.log(p / (1 - p))
    assert (abs(logit(part) - logit(full)) < 0.8).all()
