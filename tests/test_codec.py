import random
import time

import brute
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import merging as mg
from tokenloom.operators import codec as cd, training as tr

END = "<|endoftext|>"


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.fixture(scope="module")
def learned(spark, small_docs):
    return tr.train_bpe(small_docs, 256 + 2 + 14, specials=[END, END + END])


@pytest.fixture(scope="module")
def texts(small_docs):
    rng = random.Random(1)
    rows = [row["text"] for row in small_docs.orderBy("doc_id").limit(15).collect()]
    odd = ["", "s", "🙃", "Héllò hôw are ü? 🙃", "the" + END + "cat", END + END + END + " x" + END]
    odd += ["".join(rng.choices(["th", "e ", "\n", END, " in", "é", "  "], k=12)) for _ in range(30)]
    return rows + odd


def plain(model):
    ids = {}
    for token_id, data in enumerate(model.tokens):
        ids[data] = token_id
    tokens = model.tokens
    return ids, [(tokens[left], tokens[right]) for left, right in model.merges]


def tokens_of(df):
    return [row["tokens"] for row in df.orderBy("doc_id").collect()]


def test_all_plans_match_brute_force(spark, learned, texts):
    ids, merges = plain(learned)
    expected = [brute.encode(t, ids, merges, learned.specials) for t in texts]
    codec = cd.Codec.from_model(learned)
    df = frame(spark, texts)
    assert tokens_of(cd.encode_inline(df, codec)) == expected
    assert tokens_of(cd.encode_by_words(df, codec)) == expected
    assert tokens_of(cd.encode_by_words(df, codec, broadcast_rows=0, hot_rows=5, salts=3)) == expected
    assert tokens_of(cd.encode_map(df, codec)) == expected


def test_every_text_comes_back(spark, learned, texts):
    codec = cd.Codec.from_model(learned)
    row = cd.roundtrip_check(frame(spark, texts), codec).first()
    assert (row["n_rows"], row["n_changed"]) == (len(texts), 0)


def test_loaded_lists_in_any_order(spark):
    base = [bytes([b]) for b in range(256)]
    merges = [(b"ab", b"c"), (b"b", b"c"), (b"a", b"b"), (b"a", b"bc"), (b"a", b"a"), (b"aa", b"a")]
    vocab = base + sorted({left + right for left, right in merges})
    ids = {data: i for i, data in enumerate(vocab)}
    codec = cd.Codec(enumerate(vocab), merges)
    assert not codec.in_rank_order
    rng = random.Random(4)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(80)]
    expected = [brute.encode(word, ids, merges) for word in words]
    assert tokens_of(cd.encode_corpus(frame(spark, words), codec)) == expected
    assert tokens_of(cd.encode_by_words(frame(spark, words), codec)) == expected
    with pytest.raises(ValueError):
        cd.encode_inline(frame(spark, words), codec)


def test_whole_pretokens_skip_the_merges(spark):
    base = [bytes([b]) for b in range(256)]
    vocab = base + [b"bc", b"abc"]
    codec = cd.Codec(enumerate(vocab), [(b"b", b"c")])
    df = frame(spark, ["abc abc xabc"])
    expected = [[257, 32, 97, 256, 32, 120, 97, 256]]
    assert tokens_of(cd.encode_inline(df, codec)) == expected
    assert tokens_of(cd.encode_by_words(df, codec)) == expected
    assert tokens_of(cd.encode_map(df, codec)) == expected


def test_equal_bytes_use_the_greatest_id(spark):
    vocab = [(b, bytes([b])) for b in range(256)] + [(256, b"ab"), (300, b"ab")]
    codec = cd.Codec(vocab, [(b"a", b"b")])
    assert tokens_of(cd.encode_inline(frame(spark, ["ab xab"]), codec)) == [[300, 32, 120, 300]]
    assert cd.decode_tokens(
        spark.createDataFrame([(0, [256, 300])], "doc_id long, tokens array<int>"), codec
    ).first()["decoded"] == "abab"


@pytest.mark.parametrize("plan", [cd.encode_inline, cd.encode_by_words, cd.encode_map])
def test_bytes_without_token(spark, plan):
    vocab = [(b, bytes([b])) for b in range(128)] + [(500, b"ab")]
    df = frame(spark, ["aéb"])
    drop = cd.Codec(vocab, [(b"a", b"b")], oov="drop")
    assert tokens_of(plan(df, drop)) == [[500]]
    unknown = cd.Codec(vocab, [(b"a", b"b")], oov="unk", unknown_id=7)
    assert tokens_of(plan(df, unknown)) == [[97, 7, 7, 98]]
    with pytest.raises(Exception, match="byte without a token"):
        tokens_of(plan(df, cd.Codec(vocab, [(b"a", b"b")])))


def test_end_of_text_is_the_longest_special(learned):
    codec = cd.Codec.from_model(learned)
    assert codec.bytes_of[codec.end_id] == (END + END).encode()
    chosen = cd.Codec.from_model(learned, end_of_text=END)
    assert chosen.bytes_of[chosen.end_id] == END.encode()
    assert cd.Codec([(0, b"a")], []).end_id is None


def test_decoding(spark, learned):
    codec = cd.Codec.from_model(learned)
    smile = list("🙃".encode())
    df = spark.createDataFrame([(0, smile), (1, smile[:2]), (2, [])], "doc_id long, tokens array<int>")
    got = [row["decoded"] for row in cd.decode_tokens(df, codec).orderBy("doc_id").collect()]
    assert got == ["🙃", bytes(smile[:2]).decode(errors="replace"), ""]
    with pytest.raises(Exception):
        cd.decode_tokens(df, codec, strict=True).collect()
    lost = spark.createDataFrame([(0, [99999])], "doc_id long, tokens array<int>")
    with pytest.raises(Exception, match="token id without a token"):
        cd.decode_tokens(lost, codec).collect()
    assert cd.decode_tokens(lost, codec, unknown="null").first()["decoded"] is None


def test_hot_pretoken_does_not_gather(spark, learned):
    codec = cd.Codec.from_model(learned)
    texts = ["the " * 400] * 20 + ["rare" + str(i) for i in range(20)]
    ids, merges = plain(learned)
    got = tokens_of(cd.encode_by_words(frame(spark, texts), codec, broadcast_rows=0, hot_rows=2))
    assert got == [brute.encode(t, ids, merges) for t in texts]


def test_counts_and_ratios(spark, learned, small_docs):
    codec = cd.Codec.from_model(learned)
    done = cd.encode_corpus(small_docs, codec)
    total = done.agg(F.sum(F.size("tokens"))).first()[0]
    assert cd.token_counts(done).agg(F.sum("n")).first()[0] == total
    stats = cd.compression_stats(small_docs.join(done, "doc_id")).first()
    assert stats["n_tokens"] == total
    assert stats["bytes_per_token"] == pytest.approx(stats["n_bytes"] / total)
    assert stats["uint16_ratio"] == pytest.approx(stats["n_bytes"] / (2 * total))


@pytest.mark.parametrize("plan", cd.PLANS)
def test_whole_words_are_looked_up_before_bytes_are_dropped(spark, plan):
    vocab = [(b, bytes([b])) for b in range(128)] + [(300, b"ab"), (301, "é".encode())]
    codec = cd.Codec(vocab, [], oov="drop")
    got = tokens_of(cd.encode_corpus(frame(spark, ["aéb", "ab", "é", "é é"]), codec, plan=plan))
    assert got == [[97, 98], [300], [301], [301, 32]]


@pytest.mark.parametrize("plan", cd.PLANS)
def test_rows_with_equal_keys_stay_apart(spark, plan):
    vocab = [(b, bytes([b])) for b in range(256)] + [(256, b"ab")]
    df = spark.createDataFrame([(1, "ab"), (1, "cd"), (None, "ab"), (1, None), (2, "")], "doc_id long, text string")
    done = cd.encode_corpus(df, cd.Codec(vocab, [(b"a", b"b")]), plan=plan)
    got = sorted(((row["doc_id"], row["tokens"]) for row in done.collect()), key=repr)
    assert got == sorted([(1, [256]), (1, [99, 100]), (None, [256]), (1, []), (2, [])], key=repr)


def test_long_words_merge_like_short_ones(spark, learned):
    ids, merges = plain(learned)
    texts = ["th" * 100 + "e", "in" * 31, "thin" * 16, "x" * 64 + "th", "a", "a" * 301]
    expected = [brute.encode(t, ids, merges) for t in texts]
    assert tokens_of(cd.encode_corpus(frame(spark, texts), cd.Codec.from_model(learned))) == expected
    rng = random.Random(9)
    vocab = [bytes([b]) for b in range(256)]
    pairs = []
    while len(pairs) < 200:
        left, right = rng.choice(vocab[97:100] + vocab[256:]), rng.choice(vocab[97:100] + vocab[256:])
        if left + right not in vocab and len(left + right) < 9:
            vocab.append(left + right)
            pairs.append((left, right))
    rng.shuffle(pairs)
    ranks = {pair: rank for rank, pair in enumerate(pairs)}
    for _ in range(200):
        word = [bytes([rng.choice(b"abc")]) for _ in range(rng.randint(1, 64))]
        assert mg.merge_long(list(word), ranks) == list(mg.merge_pairs(list(word), ranks))


def test_a_very_long_word_with_many_merges():
    rng = random.Random(3)
    vocab, pairs = [bytes([b]) for b in range(97, 123)], []
    for _ in range(10_000):
        pairs.append((rng.choice(vocab), rng.choice(vocab)))
        vocab.append(pairs[-1][0] + pairs[-1][1])
    rng.shuffle(pairs)
    ranks = {pair: rank for rank, pair in enumerate(pairs) if len(pair[0] + pair[1]) < 40}
    word = [bytes([rng.choice(range(97, 123))]) for _ in range(100_000)]
    began = time.time()
    merged = mg.merge_pairs(list(word), ranks)
    assert time.time() - began < 20 and b"".join(merged) == b"".join(word)
