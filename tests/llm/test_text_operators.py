"""Language, token counts, toxicity, fingerprints, language model: whole texts, odd rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tokenloom.llm import language_id as li, lm_scoring as lm, merkle as mk, toxicity as tx
from tokenloom.llm.frames import slices
from tokenloom.llm.subwords import long_slices, subwords
from tokenloom.llm.token_counts import token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_slices():
    assert list(slices([], 5)) == []
    assert list(slices([9, 1, 1, 9], 3)) == [(0, 1), (1, 3), (3, 4)]


def test_ids_equal_the_library():
    own, whole = subwords(BPE), Tokenizer.from_file(BPE)
    draw = np.random.default_rng(1)
    parts = ["a", "Bc", "é", " ", "  ", "\n", "'s", "'", "ſ", "1", "²", "<|endoftext|>", "<|endof", "|>",
             ".", "\x1c", "\u00a0", "\u3000", "中", "😀", "\u0301", "_", "don't", "ß", "\r\n", "\x85"]
    texts = ["".join(draw.choice(parts, draw.integers(0, 14))) for _ in range(3000)]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_long_slices_are_cut_safely():
    text = "some words and more, " * 400
    pieces = list(long_slices(text, 100))
    assert "".join(pieces) == text and len(pieces) > 50
    assert list(long_slices("x" * 500, 100)) == ["x" * 500]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts(odd_docs, clashing_docs, no_docs, name):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    want = sorted(
        (
            (x.doc_id, len((x.text or "").encode()), n := len(whole.encode(x.text or "", add_special_tokens=False)), n > 20)
            for x in odd_docs.collect()
        ),
        key=repr,
    )
    assert sorted_rows(token_counts(odd_docs, path, limit=20)) == want
    assert sorted_rows(token_counts(clashing_docs, path, limit=20)) == want
    assert token_counts(no_docs, path).collect() == []


def test_token_counts_by_sentencepiece(documents):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = documents.orderBy("doc_id").limit(10)
    want = [len(model.encode(x.text)) for x in docs.collect()]
    assert [x.n_tokens for x in token_counts(docs, path).orderBy("doc_id").collect()] == want


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = li.learn_languages(li.training_rows(docs))
    found = li.identify_languages(docs, model, keep=("doc_id", "lang"))
    held = found.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    assert found.where("score < 0 or score > 1").isEmpty()


def test_language_margins_are_kernel_sums():
    """The batched product equals kernels counted pair by pair."""
    texts = [b"the dog runs home", b"der hund geht heim", b"the cat sat there", b"die katze sass dort"]
    model = li.fit_languages(texts, ["en", "de", "en", "de"])
    known = set(np.frombuffer(model.codes, np.uint32).tolist())
    held = [set(li.grams(x).tolist()) & known for x in texts]
    order = [1, 3, 0, 2]  # landmarks by language
    kernel = [[len(a & held[j]) / (len(a) * len(held[j])) ** 0.5 for j in order] for a in held]
    assert np.allclose(model.margins(texts), np.array(kernel) @ model.weights, atol=1e-4)


def test_language_odd_rows(odd_docs, clashing_docs, no_docs):
    model = li.learn_languages(odd_docs)
    assert model.languages == ["de", "en"]
    found = {x.doc_id: (x.lang_pred, x.score) for x in li.identify_languages(odd_docs, model).collect()}
    assert found[2] == found[3] == found[4] == ("und", 0.0)
    assert found[6][0] == "de" and found[1][0] == "en" and len(found) == 11
    assert li.identify_languages(no_docs, model).collect() == []
    kept = li.keep_known(clashing_docs, model)
    assert kept.columns == clashing_docs.columns and kept.count() == 9
    nothing = li.learn_languages(no_docs)
    assert {x.lang_pred for x in li.identify_languages(odd_docs, nothing).collect()} == {"und"}


def test_severity_of_three_grades():
    """Shared weights and ordered thresholds tell three grades apart on rows not seen."""
    draw = np.random.default_rng(5)
    grades = draw.integers(0, 3, 900)
    texts = [
        " ".join([f"w{i}" for i in draw.integers(0, 400, 30)] + [f"bad{i}" for i in draw.permutation(8)[: 2 * g]])
        for g in grades
    ]
    model = tx.fit_severity([tx.word_hashes(x) for x in texts[:600]], grades[:600].tolist())
    above = model.above(texts[600:])
    assert model.grades == [0, 1, 2] and (np.diff(model.thresholds) > 0).all()
    assert (np.diff(above, axis=1) <= 0).all()
    assert abs(above.sum(axis=1) - grades[600:]).mean() < 0.15


def test_severity_slope_is_that_of_the_likelihood():
    model = tx.fit_severity([[1], [1], [1], [2], [2], [2], [3], [3], [3]] * 3, [1, 1, 1, 0, 0, 0, 0, 0, 0] * 3)
    assert model.weights.get(1, 0) > 5 and set(model.weights) == {1}


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    grades = tx.severity_grades(spark.read.parquet(f"{sf}/labels.parquet"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    model = tx.learn_severity(docs, grades.where(~held))
    found = tx.score_severity(docs, model).drop("grade").join(grades.where(held), "doc_id")
    rates = {x.grade: x.r for x in found.groupBy("grade").agg(F.avg(F.col("toxic").cast("int")).alias("r")).collect()}
    assert rates[0] < 0.01 and rates[1] > 0.75


def test_toxicity_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    graded = spark.createDataFrame([(1, 0), (6, 1), (6, 0), (None, 1), (9, None), (5, 0)], "doc_id long, grade int")
    model = tx.learn_severity(odd_docs, graded)
    assert model.grades == [0, 1]
    found = tx.score_severity(odd_docs, model).collect()
    assert len(found) == 12 and all(0 <= x.severity <= 1 for x in found)
    assert tx.score_severity(no_docs, model).collect() == []
    kept = tx.keep_harmless(clashing_docs, model)
    assert kept.columns == clashing_docs.columns
    nothing = tx.learn_severity(odd_docs, graded.limit(0))
    assert not any(x.toxic for x in tx.score_severity(odd_docs, nothing).collect())


def brute_root(text):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    leaves, sections = set(), ""
    for section in re.sub(r"\n(\n+)", "\n\\1\x02", text).split("\x02") if text else []:
        paragraphs = ""
        for paragraph in section.split("\n"):
            marked = re.sub(r"([!-/:-@\[-`{-~])([ \t]+)", "\\1\\2\x01", paragraph)
            hashes = [sha(x) for x in re.sub("([^\x01]{256})", "\\1\x01", marked).split("\x01")]
            leaves |= set(hashes)
            paragraphs += sha("".join(hashes))
        sections += sha(paragraphs)
    return sha(f"{len(text)}:{sections}"), leaves


def test_merkle_by_brute_force(odd_docs, no_docs, monkeypatch):
    found = mk.edited_fingerprints(odd_docs).collect()
    order = sorted(odd_docs.collect(), key=lambda x: (x.doc_id is not None, x.doc_id or 0, x.text or ""))
    texts = [x.text or "" for x in order]
    want = []
    for i, x in enumerate(order):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        (r, a), (s, b), (_, c) = map(brute_root, (text, edited, after))
        like = lambda p, q: len(p & q) / len(p | q) if p | q else 1.0
        want.append((x.doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), r, s, like(a, b), like(a, c)))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert mk.edited_fingerprints(no_docs).collect() == []


def test_merkle_single_row_and_equal_texts(spark):
    one = spark.createDataFrame([(4, "abcdefgh")], "doc_id long, text string")
    assert mk.edited_fingerprints(one).first().edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    two = spark.createDataFrame([(1, "x\n\ny"), (2, "x\n\ny"), (3, "x\n\nz")], "doc_id long, text string")
    a, b, c = mk.fingerprints(two).orderBy("doc_id").collect()
    assert a.fingerprint == b.fingerprint != c.fingerprint
    trees = mk.fingerprints(two).alias("a").join(mk.fingerprints(two).alias("b"), F.expr("a.doc_id = 1 and b.doc_id = 3"))
    changed = trees.select(mk.differing_branches(F.col("a.tree"), F.col("b.tree")).alias("x")).first().x
    assert [(x.section, x.paragraph) for x in changed] == [(1, 0)]


def base_scores(rows):
    tokens = [[*re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x.text or "")), None] for x in rows]
    held = [zlib.crc32(str("" if x.doc_id is None else x.doc_id).encode()) % 7 == 2 for x in rows]
    counts = collections.Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(counts.values()), len(counts)
    return [
        (h, len(t), sum(counts[w] > 0 for w in t), n, sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in t))
        for t, h in zip(tokens, held, strict=True)
    ]


@pytest.mark.parametrize("hot", [1 << 19, 20])
def test_language_model_counts(odd_docs, no_docs, monkeypatch, hot):
    """Words counted at hand and words joined give the same; so does the mixed score."""
    monkeypatch.setattr(lm, "HOT_WORDS", hot)
    rows = odd_docs.collect()
    want = collections.defaultdict(list)
    for x, y in zip(rows, base_scores(rows), strict=True):
        want[x.doc_id].append(y)
    found = lm.score_texts(odd_docs, RANKS).collect()
    assert len(found) == 12
    for x in found:
        assert any(
            (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == y[:4] and abs(x.base_score - y[4]) < 1e-6
            for y in want[x.doc_id]
        ), x
        assert x.score < 0
    assert lm.score_texts(no_docs, RANKS).collect() == []


def test_language_model_beats_word_rates_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 5000")
    found = lm.score_texts(docs, RANKS).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]


def test_language_model_slopes():
    draw = np.random.default_rng(0)
    w = {k: x.astype(float) for k, x in lm.start_weights(np.full(lm.SYMBOLS, 1 / lm.SYMBOLS)).items()}
    x, y = draw.integers(0, lm.SYMBOLS, (2, 3, 10))
    used = np.ones((3, 10), bool)
    used[1, 5:] = False
    loss = lambda w: -(lm.log_shares(lm.forward(w, x)[0], y) * used).sum() / used.sum()
    slopes = lm.slopes(w, x, y, used)
    for name, value in w.items():
        at = np.unravel_index(np.abs(slopes[name]).argmax(), value.shape)
        before = value[at]
        value[at] = before + 1e-5
        up = loss(w)
        value[at] = before - 1e-5
        assert abs((up - loss(w)) / 2e-5 - slopes[name][at]) < 1e-6, name
        value[at] = before


def test_language_model_is_a_distribution():
    """Probabilities of all ids after any context add up to one."""
    counts = np.random.default_rng(2).integers(0, 50, 1 << 16).astype(float)
    symbols = lm.make_symbols(counts, [np.arange(60, dtype=np.uint16)], 50256)
    shares = np.bincount(symbols.of, weights=10.0**symbols.within, minlength=lm.SYMBOLS)
    assert np.allclose(shares[np.bincount(symbols.of, minlength=lm.SYMBOLS) > 0], 1)


@pytest.mark.parametrize("steady", [True, False])
def test_language_model_masses_of_words_add_up_to_one(steady):
    """All words after a context, the end, and what words longer than three ids keep."""
    counts = np.zeros(1 << 16)
    counts[:6] = np.array([9, 5, 3, 7, 4, 2]) * 1e7  # symbols without ids get next to nothing
    counts[lm.STOP] = 4e7
    symbols = lm.make_symbols(counts, [], 6)
    begins = np.zeros(1 << 16, bool)
    begins[[0, 1, 2, lm.STOP]] = True
    scorer = lm.Scorer(lm.start_weights(symbols.rates), symbols, begins)
    scorer.steady &= steady
    context = [0, 3, 1]
    tails = [(), *[(c,) for c in (3, 4, 5)], *[(c, d) for c in (3, 4, 5) for d in (3, 4, 5)]]
    words = [(b, *tail) for b in (0, 1, 2) for tail in tails]
    texts = [np.array([*context, *word, 0], np.uint16) for word in words]
    tokens, opening = scorer.token_logs([np.array(context, np.uint16), *texts], begins)
    total = 10 ** (tokens[0][3] - opening[0][3])
    for word, logs, chance in zip(words, tokens[1:], opening[1:], strict=True):
        end = 3 + len(word)
        path = 10 ** (logs[3:end].sum() - chance[3])
        total += path * 10 ** chance[end] + (len(word) == 3) * path * (1 - 10 ** chance[end])
    assert abs(total - 1) < 1e-4
    # mixed with rates of three seen words and one type of all unseen ones
    c = np.array([3.0, 1, 1, 0])
    mass = (10 ** lm.mixed_log(np.log10([0.2, 0.1, 0.1, 0.6]), np.log10(c + 1), np.log10(c.sum() + 4))).sum()
    assert abs(mass - 1) < 1e-9


def test_language_model_word_scores_by_hand():
    pieces = [b"a", b" a", b"b", b" b", b"s"]
    begins = np.zeros(1 << 16, bool)
    begins[[1, 3, lm.STOP]] = True
    ids = [np.array(x, np.uint16) for x in ([0, 4, 3, 1], [], [2])]
    tokens = [np.array(x) for x in ([-1, -0.5, -0.7, -0.3, -0.2], [-0.9], [-0.6, -0.8])]
    opening = [np.array(x) for x in ([0, 0, -0.1, -0.25, -0.4], [0.0], [0, -0.35])]
    known = {b"as": np.log10(3), b"b": 0.0, lm.END: np.log10(4)}
    n, seen, base, score, rare = lm.word_scores(ids, tokens, opening, known, pieces, begins, 1.0)
    assert n.tolist() == [4, 1, 2] and seen.tolist() == [2, 1, 1]
    own = {"as": -1.5 - 0.1, "b": -0.7 + 0.1 - 0.25, "a": -0.3 + 0.25 - 0.4, "end": -0.2 + 0.4}
    mix = lambda x, logs: lm.mixed_log(np.array([x]), np.array([logs]), 1.0)[0]
    wanted = mix(own["as"], np.log10(3)) + mix(own["b"], 0.0) + mix(own["end"], np.log10(4))
    assert abs(score[0] - wanted) < 1e-9 and abs(score[1] - mix(-0.9, np.log10(4))) < 1e-9
    assert abs(score[2] - mix(-0.6 - 0.35, 0.0) - mix(-0.8 + 0.35, np.log10(4))) < 1e-9
    assert [[x["word"] for x in row] for row in rare] == [[b"a"], [], []]
    assert abs(rare[0][0]["log"] - own["a"]) < 1e-9


def test_language_model_windows_see_each_token_once():
    symbols = lm.make_symbols(np.ones(1 << 16), [], 50256)
    scorer = lm.Scorer(lm.start_weights(symbols.rates), symbols)
    draw = np.random.default_rng(3)
    texts = [draw.integers(0, 50000, n).astype(np.uint16) for n in (0, 1, 31, 32, 33, 100, 777)]
    for ids, logs in zip(texts, scorer.token_logs(texts)[0], strict=True):
        marks = symbols.of[np.concatenate([[lm.BEGIN], ids, [lm.STOP]]).astype(np.uint16)].astype(int)
        assert len(logs) == len(ids) + 1
        for t in range(len(logs)):
            k = max(0, -(-(t + 1 - lm.LENGTH) // lm.STRIDE))
            z, _ = lm.forward(scorer.w, marks[None, k * lm.STRIDE : t + 1])
            want = lm.log_shares(z[:, -1:], marks[None, t + 1 : t + 2])[0, 0] / np.log(10)
            target = (ids.tolist() + [lm.STOP])[t]
            assert abs(want + symbols.within[target] - logs[t]) < 1e-4
