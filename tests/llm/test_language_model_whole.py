"""What the language model gathers comes from all training texts."""

import numpy as np
import public_tokenizers

from tokenloom.llm import lm_scoring as lm

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_symbols_before_ids_are_counted_over_all_texts(spark):
    draw = np.random.default_rng(1)
    texts = [draw.integers(0, 900, n).astype(np.uint16) for n in draw.integers(0, 60, 400)]
    counts = np.bincount(np.concatenate(texts), minlength=1 << 16).astype(float)
    of = lm.frequent_symbols(counts)
    want = np.zeros((1 << 16, lm.MARKS))
    for ids in texts:
        for a, b in zip([lm.BEGIN, *ids.tolist()], ids.tolist()):
            if of[b] < 0:
                want[b, lm.HEAD if of[a] < 0 else min(of[a], lm.HEAD + 1)] += 1
    table = spark.createDataFrame([(x.tobytes(),) for x in texts], "ids binary").repartition(5)
    assert (lm.counts_before(table, of) == want).all()


def test_classes_come_from_all_training_texts(spark, monkeypatch):
    """Every id that occurs three times in the training texts is counted for its class."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    seen, make = {}, lm.make_symbols

    def spy(counts, before, vocabulary):
        seen.update(counts=counts, before=before)
        return make(counts, before, vocabulary)

    monkeypatch.setattr(lm, "make_symbols", spy)
    lm.score_texts(docs, RANKS).count()
    of = lm.frequent_symbols(seen["counts"])
    tail = (of < 0) & (seen["counts"] > 0)
    assert tail.sum() > 100 and (seen["before"][tail].sum(axis=1) == seen["counts"][tail]).all()


def test_every_training_token_is_learned_once(spark, monkeypatch):
    """Over all rounds each id and each end of a training text is a target exactly once."""
    draw = np.random.default_rng(2)
    for n in (0, 1, 31, 32, 33, 95, 96, 97, 1000):
        ids = draw.integers(0, 50_000, n).astype(np.uint16)
        found = [x for turn in range(lm.ROUNDS) for x in lm.text_windows(ids.tobytes(), turn)]
        targets = np.concatenate([np.frombuffer(x, np.uint16)[1:] for x in found])
        assert sorted(targets.tolist()) == sorted([*ids.tolist(), lm.STOP])
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    seen, train = [], lm.train_round

    def spy(texts, vector, symbols, rate, seed, turn):
        seen.append((turn, texts.count()))
        return train(texts, vector, symbols, rate, seed, turn)

    monkeypatch.setattr(lm, "train_round", spy)
    held = lm.score_texts(docs, RANKS).where("not held_out").count()
    assert seen == [(k, held) for k in range(lm.ROUNDS)]


def test_groups_hold_ids_that_begin_words_or_others():
    """The chance of a word is that of its groups, as summed over all symbols."""
    draw = np.random.default_rng(5)
    pieces = lm.token_bytes(RANKS)
    begins = lm.word_begins(pieces)
    for used in (0, 40, 400, 20_000):
        counts = np.zeros(1 << 16)
        counts[draw.integers(0, 50_000, used)] = draw.integers(1, 1000, used)
        counts[lm.STOP] = 7
        lines = [draw.integers(0, 50_000, 3 * used).astype(np.uint16)]
        symbols = lm.make_symbols(counts, lines, pieces)
        groups = symbols.of // lm.GROUP
        ids = np.arange(len(pieces))
        assert not set(groups[ids[begins[ids]]]) & set(groups[ids[~begins[ids]]])
        assert symbols.of[lm.BEGIN] == lm.SYMBOLS - 1
        shares = np.bincount(symbols.of, weights=10.0**symbols.within, minlength=lm.SYMBOLS)
        assert np.allclose(shares[np.bincount(symbols.of, minlength=lm.SYMBOLS) > 0], 1)
        scorer = lm.Scorer(lm.start_weights(symbols.rates), symbols, begins)
        texts = [draw.integers(0, 50_000, n).astype(np.uint16) for n in (0, 5, 90)]
        logs, quick = scorer.token_logs(texts, begins)
        assert scorer.pure is not None
        scorer.pure = None
        again, summed = scorer.token_logs(texts, begins)
        for a, b in zip(logs + quick, again + summed, strict=True):
            assert np.allclose(a, b, atol=2e-5)
