import random

import brute
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import text as tx
from tokenloom.operators import pretokens as pt

PIECES = [
    "a", "Zé", "ß", "7", "½", "'s", "'ll", "'", " ", "  ", "\n", "\t", " ", "　", "\u0085",
    " ", "\x1c", "🙃", "日本", "!", "...", "é", "​", "_", "don't", "they've", "\r\n",
]


def random_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_pretokens_match_the_pattern(spark, small_docs):
    texts = random_texts(800) + [row["text"] for row in small_docs.limit(50).collect()]
    rows = frame(spark, texts).select("text", tx.pretokens(F.col("text")).alias("p")).collect()
    for row in rows:
        assert row["p"] == brute.pretokens(row["text"])
        assert "".join(row["p"]) == row["text"]


@pytest.mark.parametrize(
    "specials", [[], ["<|endoftext|>"], ["<|endoftext|>", "<|endoftext|><|endoftext|>", "a+b"]]
)
def test_segments_are_atomic_and_longest_first(spark, specials):
    rng = random.Random(5)
    parts = ["<|endoftext|>", "<|endoftext|><|endoftext|>", "a+b", "foo", " bar", "\\E", "<|", "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 8))) for _ in range(200)]
    rows = frame(spark, texts).select("text", tx.segments(F.col("text"), specials).alias("s")).collect()
    for row in rows:
        got = [(part["segment"], part["is_special"]) for part in row["s"]]
        assert got == brute.split_specials(row["text"], specials)


def test_long_segments_do_not_overflow(spark):
    text = "word " * 200_000 + "<|endoftext|>" + "x" * 300_000
    row = frame(spark, [text]).select(tx.segments(F.col("text"), ["<|endoftext|>"]).alias("s")).first()
    assert [len(part["segment"]) for part in row["s"]] == [1_000_000, 13, 300_000]


def test_lifted_strings_round_trip(spark):
    texts = random_texts(200) + ["", "\0", "ÿþ"]
    back = tx.lenient_text(tx.unlift(tx.lift(F.col("text"))))
    rows = frame(spark, texts).select("text", tx.lift(F.col("text")).alias("l"), back.alias("b")).collect()
    for row in rows:
        assert row["l"] == row["text"].encode().decode("latin-1")
        assert row["b"] == row["text"]


def test_lenient_decode_replaces_malformed_bytes(spark):
    samples = [b"ok", b"\xff", b"a\xc3", b"\xe2\x82", b"\xf0\x9f\x99\x83", b"\xed\xa0\x80x"]
    df = spark.createDataFrame([(bytearray(s),) for s in samples], "b binary")
    got = [row[0] for row in df.select(tx.lenient_text(F.col("b"))).collect()]
    assert got == [s.decode("utf-8", errors="replace") for s in samples]


def test_adjacent_pairs_go_by_character(spark):
    words = ["", "a", "ab", "aaa", "a🙃b🙃", "".join(map(tx.symbol, [55295, 55296, 70000, 300]))]
    df = spark.createDataFrame([(w,) for w in words], "sym string")
    got = [row[0] for row in df.select(tx.adjacent_pairs("sym")).collect()]
    assert got == [[a + b for a, b in zip(w, w[1:])] for w in words]


def test_symbol_codes_skip_surrogates(spark):
    codes = [0, 255, 256, 0xD7FF, 0xD800, 0xFFFF, 70000]
    df = spark.createDataFrame([(tx.symbol(code),) for code in codes], "c string")
    assert [row[0] for row in df.select(tx.symbol_code(F.col("c"))).collect()] == codes


@pytest.mark.parametrize("needle", ["aa", "ab", "aba", ".", "\\", "é".encode().decode("latin-1")])
def test_overlapping_offsets(spark, needle):
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab.\\é", k=rng.randint(0, 20))) for _ in range(100)]
    lifted = tx.lift(F.col("text"))
    rows = frame(spark, texts).select("text", tx.overlapping_offsets(lifted, needle).alias("o")).collect()
    for row in rows:
        data = row["text"].encode().decode("latin-1")
        expected = [i for i in range(len(data)) if data.startswith(needle, i)]
        assert row["o"] == expected


def test_printable_form_round_trips(spark):
    every = "".join(map(chr, range(256)))
    df = spark.createDataFrame([(every,)], "l string")
    printed = tx.to_printable(F.col("l"))
    row = df.select(printed.alias("p"), tx.from_printable(printed).alias("b")).first()
    assert row["b"] == every
    assert len(set(row["p"])) == 256 and row["p"][32] == "Ġ" and row["p"][10] == "Ċ"


def test_spans_and_lookups(spark):
    texts = ["", "Héllo  wörld's\n\n end", "x"]
    spans = pt.pretoken_spans(frame(spark, texts))
    for row in spans.collect():
        data = texts[row["doc_id"]].encode()
        assert data[row["start"] : row["end"]].decode() == row["pretoken"]
    assert "".join(r["pretoken"] for r in spans.orderBy("doc_id", "pos").collect()) == "".join(texts)
    wanted = spark.createDataFrame([(1, 0), (2, 0), (2, 9)], "doc_id long, pos int")
    got = pt.pretokens_at(spans, wanted).orderBy("doc_id").collect()
    assert [row["pretoken"] for row in got] == ["Héllo", "x"]
    assert pt.pretoken_spans(frame(spark, texts), least=2).where("pretoken = 'x'").isEmpty()


def test_in_vocab_filter_deletes_unknown_bytes(spark):
    df = frame(spark, ["aébc"])
    kept = pt.in_vocab_filter(tx.lift(F.col("text")), [ord("a"), ord("c")])
    assert df.select(kept).first()[0] == "ac"
