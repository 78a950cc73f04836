"""Language identification with blended-spectrum presence kernels.

The kernel of two texts counts the byte n-grams (n = 1..3, letters lower-cased) that both
hold, over the geometric mean of how many each holds, among the n-grams of the landmark
texts. Kernel ridge regression, one class against the rest, is fitted on a bounded sample
through Nystroem landmarks: a text is described by its kernels with the landmarks, all
texts of a batch in one matrix product. Long texts are scored in windows that cover them
whole, weighted by their bytes.
"""

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.llm.frames import fresh, id_remainder, q, slices

#: Bytes of a window, windows scored at once.
WINDOW, BATCH = 4096, 128
#: Bounds of the sample and model: windows per language and in all, landmarks per language
#: and in all, n-grams.
PER_LANGUAGE, SAMPLE, PER_LANDMARK, LANDMARKS, GRAMS = 300, 12_000, 40, 1024, 16_384
#: Ridge, and how sharply margins become scores.
RIDGE, SHARP = 1e-3, 3.0
#: What stands for a text without a language.
UNKNOWN = "und"
#: First number of the 2-grams and of the 3-grams.
PAIRS, TRIPLES = 1 << 8, (1 << 8) + (1 << 16)


def windows(text: str) -> list[bytes]:
    """Consecutive windows of a lower-cased text's bytes; together they are all of it."""
    data = text.lower().encode()
    return [data[i : i + WINDOW] for i in range(0, len(data), WINDOW)]


def grams(data: bytes) -> np.ndarray:
    """Numbers of all n-grams (n = 1..3), repeats included."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    pairs = raw[:-1] << 8 | raw[1:]
    return np.concatenate([raw, pairs + PAIRS, (pairs[:-1] << 8 | raw[2:]) + TRIPLES])


@functools.lru_cache(2)
def places(codes: bytes) -> np.ndarray:
    """n-gram number -> 1 + its column, or 0."""
    known = np.frombuffer(codes, np.uint32)
    table = np.zeros(TRIPLES + (1 << 24), np.uint16)
    table[known] = np.arange(1, len(known) + 1, dtype=np.uint16)
    return table


def presence(texts: Sequence[bytes], codes: bytes) -> np.ndarray:
    """Rows of known n-grams held, scaled so that a product of two rows is their kernel."""
    table = places(codes)
    held = np.zeros((len(texts), 1 + len(codes) // 4), np.float32)
    for row, data in zip(held, texts, strict=True):
        row[table[grams(data)]] = 1
    held = held[:, 1:]
    return held / np.sqrt(np.maximum(held.sum(axis=1, keepdims=True), 1))


@dataclass
class LanguageModel:
    """Languages, n-grams of the landmarks, their packed presence, kernel weights."""

    languages: list[str]
    codes: bytes
    landmarks: np.ndarray
    weights: np.ndarray

    @functools.cached_property
    def rows(self) -> np.ndarray:
        held = np.unpackbits(self.landmarks, axis=1, count=len(self.codes) // 4).astype(np.float32)
        return held / np.sqrt(np.maximum(held.sum(axis=1, keepdims=True), 1))

    def margins(self, texts: Sequence[bytes]) -> np.ndarray:
        """One margin per text and language: kernels with all landmarks, then weights."""
        parts = [
            presence(texts[i : i + BATCH], self.codes) @ self.rows.T @ self.weights
            for i in range(0, len(texts), BATCH)
        ]
        return np.concatenate(parts)

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of whole texts."""
        cut = [windows(x) if x and any(map(str.isalpha, x)) else [] for x in texts]
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        for first, last in slices([len(x) for x in cut], BATCH):
            flat = [piece for pieces in cut[first:last] for piece in pieces]
            if not flat or not self.languages:
                continue
            owner = np.repeat(np.arange(last - first), [len(x) for x in cut[first:last]])
            size = np.array([len(x) for x in flat], float)
            total = np.zeros((last - first, len(self.languages)))
            np.add.at(total, owner, self.margins(flat) * size[:, None])
            for i in np.unique(owner).tolist():
                margin = SHARP * total[i] / size[owner == i].sum()
                odds = np.exp(margin - margin.max())
                best = int(odds.argmax())
                names[first + i], scores[first + i] = self.languages[best], float(odds[best] / odds.sum())
        return names, scores


def fit_languages(texts: list[bytes], labels: list[str], ridge: float = RIDGE) -> LanguageModel:
    """Kernel ridge regression, one language against the rest, through landmarks."""
    languages = sorted(set(labels), key=str.encode)
    if not languages:
        return LanguageModel([], b"", np.zeros((0, 0), np.uint8), np.zeros((0, 0), np.float32))
    known = np.array([languages.index(x) for x in labels])
    each = max(1, min(PER_LANDMARK, LANDMARKS // len(languages)))
    chosen = np.concatenate([np.flatnonzero(known == i)[:each] for i in range(len(languages))])
    found = [np.unique(grams(texts[i])) for i in chosen]
    codes, held = np.unique(np.concatenate(found), return_counts=True)
    codes = np.sort(codes[np.lexsort((codes, -held))[:GRAMS]]).astype(np.uint32).tobytes()
    bits = np.packbits(presence([texts[i] for i in chosen], codes) > 0, axis=1)
    model = LanguageModel(languages, codes, bits, np.eye(len(chosen), dtype=np.float32))
    kernels = model.margins(texts).astype(float)
    between = model.rows.astype(float) @ model.rows.astype(float).T
    target = np.where(known[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # every language weighs alike, however many texts it brought
    weight = (1 / np.bincount(known, minlength=len(languages)))[known][:, None]
    left = kernels.T @ (weight * kernels) + ridge * between + 1e-9 * np.eye(len(chosen))
    model.weights = np.linalg.solve(left, kernels.T @ (weight * target)).astype(np.float32)
    return model


def learn_languages(
    docs: DataFrame, lang: str = "lang", text: str = "text", per_language: int = PER_LANGUAGE
) -> LanguageModel:
    """Fit on a bounded sample of labelled rows: at most ``per_language`` windows a language.

    Rows are taken by the hash of their text; of a long text any window may be the one.
    """
    rows = docs.select(q(lang).alias("lang"), q(text).alias("text")).where(
        F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    counts = {x.lang: x.n for x in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return fit_languages([], [])
    if len(counts) > LANDMARKS:
        raise ValueError(f"{len(counts)} languages; at most {LANDMARKS} can be told apart")
    each = max(4, min(per_language, SAMPLE // len(counts)))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 31))
    share = F.create_map(
        *[F.lit(x) for name, n in counts.items() for x in (name, int(min(1, 2 * each / n) * (1 << 31)))]
    )
    n_windows = F.ceil(F.length("text") / WINDOW)
    start = F.pmod(F.xxhash64(F.lit(1), "text"), n_windows) * WINDOW + 1
    sample = (
        rows.withColumn("draw", draw)
        .where(F.col("draw") < F.try_element_at(share, "lang"))
        .groupBy("lang", "draw")
        .agg(F.min(F.substring("text", start.cast("int"), F.lit(WINDOW))).alias("text"))
    )
    taken: dict[str, list[bytes]] = {name: [] for name in counts}
    for row in sorted(sample.collect(), key=lambda x: (x.draw, x.lang, x.text)):
        if len(taken[row.lang]) < each:
            taken[row.lang].append(row.text.lower().encode()[:WINDOW])
    return fit_languages(
        [x for texts in taken.values() for x in texts],
        [name for name, texts in taken.items() for _ in texts],
    )


def predicted_language(text: Column, model: LanguageModel) -> Column:
    """struct(lang, score) of a text column."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, scores = model.predict(batch.to_pylist())
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"]
            )

    return predict(text)


def has_letter(text: Column) -> Column:
    """Whether a text has a letter, by the same rule as predictions."""

    @F.arrow_udf("boolean")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([any(map(str.isalpha, x or "")) for x in batch.to_pylist()])

    return found(text)


def identify_languages(
    docs: DataFrame, model: LanguageModel, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """``keep`` columns plus lang_pred and score (0 to 1) of every whole text.

    A null text, or one without a letter, is ``und`` with score 0; so is any text if the
    model has learned no language. Repeated rows are predicted alike, ties go to the first
    language by code point. No shuffle; other columns are not read.
    """
    source = docs.select(*[q(name) for name in dict.fromkeys([*keep, text])])
    found = fresh(source, "found")
    return source.withColumn(found, predicted_language(q(text), model)).select(
        *[q(name) for name in keep],
        q(found)["lang"].alias("lang_pred"),
        q(found)["score"].alias("score"),
    )


def keep_known(
    docs: DataFrame, model: LanguageModel, least: float = 0.0, text: str = "text"
) -> DataFrame:
    """``docs`` without the rows whose language is unknown or scored below ``least``.

    A model that has learned no language knows none: then only rows without a letter go.
    """
    if not model.languages:
        return docs.where(F.coalesce(has_letter(q(text)), F.lit(False)))
    found = fresh(docs, "found")
    marked = docs.withColumn(found, predicted_language(q(text), model))
    return marked.where((q(found)["lang"] != UNKNOWN) & (q(found)["score"] >= least)).select(
        *[q(name) for name in docs.columns]
    )


def training_rows(docs: DataFrame, key: str = "doc_id", modulus: int = 3, held_out: int = 1) -> DataFrame:
    """Rows that may be learned from."""
    return docs.where(id_remainder(q(key), modulus) != held_out)
