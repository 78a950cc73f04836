import random

import brute
import pytest
from pyspark.sql import functions as F

from tokenloom.operators import pairs as pr, pretokens as pt, training as tr
from tokenloom.sources.artifacts import TrainingState


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def byte_pairs(model):
    tokens = model.tokens
    return [(tokens[left], tokens[right]) for left, right in model.merges]


@pytest.mark.parametrize("top_k", [2, 64])
def test_rounds_equal_one_merge_at_a_time(spark, top_k):
    rng = random.Random(top_k)
    words = ["".join(rng.choices("aabcdé", k=rng.randint(1, 7))) for _ in range(60)]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(6)]
    model = tr.train_bpe(
        frame(spark, texts), 256 + 20, specials=(), top_k=top_k, checkpoint_every=6
    )
    assert byte_pairs(model) == brute.train(texts, 20)


def test_documents_match_brute_force(spark, small_docs):
    texts = [row["text"] for row in small_docs.collect()]
    model = tr.train_bpe(small_docs, 256 + 1 + 14)
    assert byte_pairs(model) == brute.train(texts, 14)
    assert model.tokens[-1] == b"<|endoftext|>" and len(model.tokens) == 271


def test_rounds_read_the_words_of_their_own_pairs(spark, small_docs):
    """One candidate list serves many rounds; few words are read, fewer as training goes on."""
    report = []
    texts = [row["text"] for row in small_docs.collect()]
    model = tr.train_bpe(small_docs, 256 + 1 + 60, report=report, checkpoint_every=10)
    assert byte_pairs(model) == brute.train(texts, 60)
    words = pt.pretoken_counts(small_docs).count()
    assert sum(x.resorted for x in report) == 1 and report[0].resorted
    read = [x.words_read / (b.merges - a.merges) for a, b, x in zip(report, report[1:], report[1:])]
    assert max(read) < words and sum(read[-5:]) < sum(read[:5])
    few = []
    again = tr.train_bpe(small_docs, 256 + 1 + 60, report=few, top_k=40)
    assert again.merges == model.merges and sum(x.resorted for x in few) > 1


def test_index_joints(spark):
    words = spark.createDataFrame([("abc", 2), ("xbc", 1)], "sym string, freq long")
    parts = {256: (ord("a"), ord("b")), 257: (256, ord("c"))}
    index = tr.WordIndex(words, 256, parts.__getitem__)
    assert index.joint(257, 256) == "ca" and index.joint(ord("x"), 257) == "xa"
    changes, read = index.changes([(ord("a"), ord("b"))], [("ab", chr(256))], 0)
    assert read == 1 and dict(changes) == {"ab": -2, "bc": -2, chr(256) + "c": 2}
    changes, read = index.changes([(256, ord("c"))], [(chr(256) + "c", chr(257))], 0)
    assert read == 2 and dict(changes) == {chr(256) + "c": -2}


def test_ties_go_to_the_greater_bytes(spark):
    model = tr.train_bpe(frame(spark, ["ab cd"]), 257, specials=())
    assert byte_pairs(model) == [(b"c", b"d")]


def test_self_pairs_merge_left_to_right(spark):
    model = tr.train_bpe(frame(spark, ["aaaaa"]), 256 + 3, specials=())
    assert byte_pairs(model) == brute.train(["aaaaa"], 3)


def test_training_stops_when_no_pair_is_left(spark):
    model = tr.train_bpe(frame(spark, ["ab ab"]), 1000, specials=())
    assert byte_pairs(model) == brute.train(["ab ab"], 100)
    assert tr.train_bpe(frame(spark, [""]), 300, specials=()).merges == []


def test_budget_leaves_room_for_specials():
    assert tr.merge_budget(500, 256, ["<|endoftext|>"]) == 243
    with pytest.raises(ValueError):
        tr.merge_budget(100, 256, [])


def test_specials_are_text_unless_split(spark):
    texts = ["<|endoftext|>" * 5 + "no"]
    plain = tr.train_bpe(frame(spark, texts), 256 + 1 + 2)
    assert plain.merges and b"no" not in plain.tokens
    apart = tr.train_bpe(frame(spark, texts), 256 + 1 + 2, split_special=True)
    assert byte_pairs(apart) == [(b"n", b"o")]


def test_character_alphabet_matches_a_known_trainer(spark, small_docs):
    from tokenizers import Regex, Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import Split
    from tokenizers.trainers import BpeTrainer

    from tokenloom.functions.text import PRETOKEN_PATTERN

    size = 112
    model = tr.train_bpe(small_docs, size, specials=(), alphabet="char")
    other = Tokenizer(BPE(unk_token="�"))
    other.pre_tokenizer = Split(pattern=Regex(PRETOKEN_PATTERN), behavior="isolated")
    texts = [row["text"] for row in small_docs.collect()]
    other.train_from_iterator(
        texts, BpeTrainer(special_tokens=["�"], vocab_size=size, show_progress=False)
    )
    expected = sorted(other.get_vocab().items(), key=lambda item: item[1])
    assert [t.decode() for t in model.tokens] == [token for token, _ in expected]


def test_resumed_training_equals_one_run(spark, small_docs, tmp_path):
    state = TrainingState(str(tmp_path / "state"))
    assert state.load(spark) is None
    tr.train_bpe(small_docs, 256 + 6, specials=(), state=state, checkpoint_every=2)
    saved = state.load(spark)
    assert 0 < len(saved.merges) <= 6
    resumed = tr.train_bpe(small_docs, 256 + 10, specials=(), state=state, resume=True)
    assert resumed.merges == tr.train_bpe(small_docs, 256 + 10, specials=()).merges


def test_pair_jobs(spark):
    counts = pt.pretoken_counts(frame(spark, ["aaab aaab b"]))
    words = pr.byte_words(counts)
    got = {row["pair"]: row["n"] for row in pr.pair_counts(words).collect()}
    assert got == {"aa": 4, "ab": 2, " a": 1, " b": 1}
    assert pr.top_pair(pr.pair_counts(words)).first()["pair"] == "aa"
    assert [row["pair"] for row in pr.top_pairs(pr.pair_counts(words), 3).collect()] == ["aa", "ab", " b"]
    merged = pr.merge_pair(words, "aa", "X")
    assert {row["sym"] for row in merged.collect()} == {"Xab", " Xab", " b"}
    places = pr.pair_index(words).where("pair = 'aa' AND pretoken = 'aaab'").select("place").collect()
    assert sorted(row["place"] for row in places) == [0, 1]
    sizes = {row["pair"]: (row["n_words"], row["n"]) for row in pr.pair_index_sizes(words).collect()}
    assert sizes["aa"] == (2, 4)


def test_deltas_equal_a_recount(spark, small_docs):
    words = pr.byte_words(pt.pretoken_counts(small_docs)).select("sym", "freq")
    steps = [("th", chr(256)), (chr(256) + "e", chr(257)), ("ll", chr(258))]
    by_delta = pr.apply_deltas(pr.pair_counts(words), pr.pair_deltas(words, steps))
    recount = pr.pair_counts(pr.merge_pairs(words, steps))
    assert by_delta.exceptAll(recount).isEmpty() and recount.exceptAll(by_delta).isEmpty()
