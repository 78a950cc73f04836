"""Severity of toxic texts by cumulative-link ordinal regression.

P(grade <= k) = sigmoid(threshold_k - w . x): one weight per word, shared by all ordered
thresholds. Features are the distinct lower-cased words of the whole text, as hashes. The
fit takes a bounded sample of graded rows and keeps the words that go with higher grades.
"""

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.llm.frames import fresh, q

WORDS = re.compile(r"[^\W_]+")
#: Bound of the sample: rows per grade. Words need so many rows, and a likelihood ratio that
#: none of the sample's words would reach by chance.
PER_GRADE, LEAST_ROWS = 3000, 3
#: Penalty on squared weights, steps and rate of the fit.
PENALTY, STEPS, RATE = 0.0005, 1000, 0.1


def word_hashes(text: str | None) -> list[int]:
    """Distinct words of a whole text as 32-bit hashes."""
    return [zlib.crc32(word.encode()) for word in set(WORDS.findall((text or "").lower()))]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class SeverityModel:
    """Grades in order, thresholds between them, weights by word hash."""

    grades: list[int]
    thresholds: np.ndarray
    weights: dict[int, float]

    def above(self, texts: Sequence[str | None]) -> np.ndarray:
        """P(grade > k) for every text and threshold."""
        get = self.weights.get
        sums = np.array([sum(get(x, 0.0) for x in word_hashes(text)) for text in texts], float)
        return sigmoid(sums[:, None] - self.thresholds[None, :])


def evidence(y: np.ndarray, owner: np.ndarray, column: np.ndarray, held: np.ndarray, levels: int):
    """Greatest likelihood ratio of a word and a grade being at least k, k = 1.., if it rises."""
    best = np.zeros(len(held))
    for k in range(1, levels):
        high = y >= k
        rate = high.mean()
        hits = np.bincount(column, weights=high[owner], minlength=len(held))
        part = np.clip(hits / held, 1e-12, 1 - 1e-12)
        ratio = 2 * (hits * np.log(part / rate) + (held - hits) * np.log((1 - part) / (1 - rate)))
        best = np.maximum(best, np.where(part > rate, ratio, 0.0))
    return best


def fit_severity(
    rows: list[Sequence[int]], grades: Sequence[int], row_weights: Sequence[float] | None = None
) -> SeverityModel:
    """Fit by Adam on the penalized log-likelihood of the ordinal model.

    ``row_weights``: how many rows each one stands for; their mean counts as one row.
    """
    levels = sorted(set(grades))
    y = np.array([levels.index(g) for g in grades], int)
    if len(levels) < 2:
        return SeverityModel(levels, np.zeros(0), {})
    size = np.array([len(x) for x in rows])
    owner = np.repeat(np.arange(len(rows)), size)
    codes, column = np.unique(np.concatenate([np.asarray(x, np.int64) for x in rows]), return_inverse=True)
    n, held = len(y), np.bincount(column, minlength=len(codes))
    chosen = np.flatnonzero(
        (held >= LEAST_ROWS) & (evidence(y, owner, column, held, len(levels)) >= 2 * np.log(len(codes)))
    )
    place = np.full(len(codes), -1)
    place[chosen] = np.arange(len(chosen))
    used = place[column] >= 0
    owner, column = owner[used], place[column[used]]
    w = np.zeros(len(chosen))
    stands = np.ones(n) if row_weights is None else np.asarray(row_weights, float)
    stands = stands / stands.mean()
    share = np.cumsum(np.bincount(y, weights=stands))[:-1] / n
    first = np.log(share / (1 - share))
    cut = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    values = np.concatenate([w, cut])
    m, v = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, STEPS + 1):
        w, cut = values[: len(chosen)], values[len(chosen) :]
        thresholds = cut[0] + np.concatenate([[0.0], np.cumsum(np.exp(cut[1:]))])
        score = np.bincount(owner, weights=w[column], minlength=n)
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        upper, lower = sigmoid(edges[y + 1] - score), sigmoid(edges[y] - score)
        upper, lower = np.where(y + 1 == len(levels), 1.0, upper), np.where(y == 0, 0.0, lower)
        inside = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / inside, lower * (1 - lower) / inside
        up, low = up * stands, low * stands
        by_score = up - low
        by_threshold = np.zeros(len(thresholds))
        np.add.at(by_threshold, y[y + 1 < len(levels)], -up[y + 1 < len(levels)])
        np.add.at(by_threshold, y[y > 0] - 1, low[y > 0])
        tail = np.cumsum(by_threshold[::-1])[::-1]
        by_cut = np.concatenate([tail[:1], tail[1:] * np.exp(cut[1:])])
        slope = np.concatenate(
            [np.bincount(column, weights=by_score[owner], minlength=len(chosen)) + PENALTY * w, by_cut]
        )
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        values = values - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    w, cut = values[: len(chosen)], values[len(chosen) :]
    thresholds = cut[0] + np.concatenate([[0.0], np.cumsum(np.exp(cut[1:]))])
    return SeverityModel(levels, thresholds, dict(zip(codes[chosen].tolist(), w.tolist(), strict=True)))


def learn_severity(
    docs: DataFrame,
    graded: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    grade: str = "grade",
    per_grade: int = PER_GRADE,
) -> SeverityModel:
    """Fit on at most about ``per_grade`` rows a grade, taken by the hash of their key.

    ``graded``: key and a whole number; rows without either are not used, of several
    grades of a key the highest counts. Rows of a grade weigh as many as they stand for, so
    a bounded sample keeps the shares of the grades. Only word hashes of the sample reach
    the driver.
    """
    known = (
        graded.select(q(key).alias("key"), q(grade).cast("int").alias("grade"))
        .where(F.col("key").isNotNull() & F.col("grade").isNotNull())
        .groupBy("key")
        .agg(F.max("grade").alias("grade"))
    )
    counts = {x.grade: x.n for x in known.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return SeverityModel([], np.zeros(0), {})
    share = F.create_map(
        *[F.lit(x) for g, n in counts.items() for x in (g, int(min(1, per_grade / n) * (1 << 31)))]
    )
    draw = F.pmod(F.xxhash64(F.lit(9), "key"), F.lit(1 << 31))
    taken = known.where(draw < F.try_element_at(share, "grade"))

    @F.arrow_udf("array<long>")
    def hashes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([word_hashes(x) for x in batch.to_pylist()], pa.list_(pa.int64()))

    rows = (
        docs.select(q(key).alias("key"), q(text).alias("text"))
        .join(F.broadcast(taken), "key")
        .select("key", "grade", hashes(F.col("text")).alias("words"))
        .collect()
    )
    rows = sorted(rows, key=lambda x: (x.key, x.grade, sorted(x.words)))
    held = {x.grade: x.n for x in taken.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    return fit_severity(
        [x.words for x in rows], [x.grade for x in rows], [counts[x.grade] / held[x.grade] for x in rows]
    )


def predicted_severity(text: Column, model: SeverityModel) -> Column:
    """struct(severity, p_above, grade): expected grade, P(above the lowest), likeliest."""

    @F.arrow_udf("struct<severity:double,p_above:double,grade:int>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        levels = np.array(model.grades or [0])
        for batch in batches:
            above = model.above(batch.to_pylist())
            steps = np.hstack([np.ones((len(above), 1)), above, np.zeros((len(above), 1))])
            each = steps[:, :-1] - steps[:, 1:]
            severe = levels[0] + above @ np.diff(levels) if above.shape[1] else np.full(len(above), float(levels[0]))
            first = above[:, 0] if above.shape[1] else np.zeros(len(above))
            yield pa.StructArray.from_arrays(
                [
                    pa.array(severe, pa.float64()),
                    pa.array(first, pa.float64()),
                    pa.array(levels[each.argmax(axis=1)], pa.int32()),
                ],
                ["severity", "p_above", "grade"],
            )

    return predict(text)


def score_severity(
    docs: DataFrame,
    model: SeverityModel,
    least: float = 0.5,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """``keep`` columns plus severity, p_toxic, grade, toxic (p_toxic >= ``least``).

    Whole texts are scored; a null or empty text has no word and the severity of the
    thresholds alone. A model without two grades finds nothing toxic. Repeated rows are
    scored alike. No shuffle; other columns are not read.
    """
    source = docs.select(*[q(name) for name in dict.fromkeys([*keep, text])])
    found = fresh(source, "found")
    return source.withColumn(found, predicted_severity(q(text), model)).select(
        *[q(name) for name in keep],
        q(found)["severity"].alias("severity"),
        q(found)["p_above"].alias("p_toxic"),
        q(found)["grade"].alias("grade"),
        (q(found)["p_above"] >= least).alias("toxic"),
    )


def keep_harmless(
    docs: DataFrame, model: SeverityModel, least: float = 0.5, text: str = "text"
) -> DataFrame:
    """``docs`` without the rows found toxic."""
    found = fresh(docs, "found")
    marked = docs.withColumn(found, predicted_severity(q(text), model))
    return marked.where(q(found)["p_above"] < least).select(*[q(name) for name in docs.columns])


def severity_grades(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Grades of the given labels: their toxic column, 0 or 1. More grades need labels that
    tell them apart; rows without a label have no grade."""
    return labels.select(q(key).alias(key), q("toxic").cast("int").alias("grade"))
