"""Many byte strings found in one pass, against the search of one string at a time."""

import random

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import pretokens as pt


def test_equals_one_search_per_string(spark, small_docs):
    docs = small_docs.limit(20)
    spans = pt.pretoken_spans(docs).persist()
    needles = [b"th", b"aa", b"e", b" t", "é".encode(), b"\xc3", b"the", b"he"]
    found = {}
    for row in pt.find_all_occurrences(spans, needles).collect():
        found.setdefault(row.needle, []).append((row.doc_id, row.pos, row.offset))
    for place, needle in enumerate(needles):
        one = pt.find_occurrences(spans, needle.decode("latin-1")).collect()
        assert sorted(found.get(place, [])) == sorted((x.doc_id, x.pos, x.offset) for x in one)


def test_a_thousand_strings_by_hand(spark):
    rng = random.Random(0)
    texts = [" ".join("".join(rng.choice("abcé") for _ in range(rng.randrange(1, 90))) for _ in range(9)) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    needles = ["".join(rng.choice("abcé ") for _ in range(rng.randrange(1, 5))).encode() for _ in range(1000)]
    spans = pt.pretoken_spans(docs)
    wanted = []
    for row in spans.collect():
        data = row.pretoken.encode()
        for place, needle in enumerate(needles):
            at = data.find(needle)
            while at >= 0:
                wanted.append((row.doc_id, row.pos, row.start + at, place))
                at = data.find(needle, at + 1)
    assert sorted(map(tuple, pt.find_all_occurrences(spans, needles).collect())) == sorted(wanted)
    assert len(wanted) > 5000


def test_odd_needles(spark, small_docs):
    spans = pt.pretoken_spans(small_docs.limit(2))
    assert pt.find_all_occurrences(spans, []).count() == 0
    assert pt.find_all_occurrences(spans.where(F.lit(False)), [b"a"]).count() == 0
    with pytest.raises(ValueError, match="empty"):
        pt.find_all_occurrences(spans, [b"a", b""])
