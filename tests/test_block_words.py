"""The plan by words: rows travel as numbers, blocks of any size give the same ids."""

import numpy as np
import pyarrow as pa
import pytest

from tokenloom.functions import merging as mg
from tokenloom.operators import codec as cd


def codec():
    merges = [(b"a", b"b"), (b" ", b"a"), (b"ab", b"c"), (b" a", b"b")]
    return cd.Codec(enumerate([bytes([b]) for b in range(256)] + [x + y for x, y in merges]), merges)


def rows(df):
    return sorted((str(r["doc_id"]), str(r["lang"]), r["tokens"]) for r in df.collect())


TEXTS = ["ab abc ab", None, "", "abc", "  ab\n", "xyz ab abc", "ab abc ab", "ab " * 40, "é ab"]


@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 0, "hot_rows": 2, "salts": 3}])
def test_rows_that_repeat_or_have_no_key_keep_their_own_ids(spark, options):
    data = [(None if i % 4 == 1 else i % 3, "en" if i % 2 else None, t) for i, t in enumerate(TEXTS * 3)]
    df = spark.createDataFrame(data, "doc_id long, lang string, text string").repartition(3)
    keep = ("lang", "doc_id")
    found = cd.encode_by_words(df, codec(), keep=keep, **options)
    assert found.columns == ["lang", "doc_id", "tokens"]
    assert rows(found) == rows(cd.encode_map(df, codec(), keep=keep))


def test_pretokens_do_not_travel_one_by_one(spark):
    # 4,000 places of 41 distinct pretokens: at most those of each task look for their ids
    data = [(i, " ".join(f"w{(i * k) % 40}" for k in range(40))) for i in range(100)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(2)
    found = cd.encode_by_words(df, codec(), broadcast_rows=0, hot_rows=2)
    assert found.count() == 100
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "_listed" not in plan


def test_blocks_number_their_pretokens(monkeypatch):
    monkeypatch.setattr(mg, "AT_ONCE", 4)
    monkeypatch.setattr(mg, "BLOCK_PLACES", 6)
    lists = pa.array([["a", "b"], [], ["b", "c"], ["a"], ["d"] * 9, ["a", "c"]], pa.list_(pa.string()))
    block, found = None, []
    for piece in mg.pieces(lists):
        size = sum(piece.value_lengths().to_pylist())
        if block is None or not block.has_room(len(piece), size):
            block = mg.BlockWords(len(found))
        numbered = block.numbered(piece)
        places, sizes = mg.unpacked(numbered.field("places"))
        lists_of = np.split(places, np.cumsum(sizes)[:-1])
        found += [{**row, "places": own.tolist()} for row, own in zip(numbered.to_pylist(), lists_of)]
    known = {}
    for row in found:
        for i, word in enumerate(row["fresh"]):
            known[row["block"], row["first"] + i] = word
    assert [[known[row["block"], n] for n in row["places"]] for row in found] == lists.to_pylist()
    assert len({row["block"] for row in found}) == 3
    assert sum(len(row["fresh"]) for row in found) == len(known) == 6


def test_packed_numbers_come_back():
    draw = np.random.default_rng(5)
    sizes = draw.integers(0, 9, 200)
    values = draw.integers(0, 1 << 31, sizes.sum()) >> draw.integers(0, 31, sizes.sum())
    runs = mg.packed(values, sizes.tolist())
    for begin, end in ((0, 200), (17, 60), (5, 5)):
        found, lengths = mg.unpacked(runs.slice(begin, end - begin))
        assert lengths.tolist() == sizes[begin:end].tolist()
        assert found.tolist() == values[sizes[:begin].sum() : sizes[:end].sum()].tolist()
    found, lengths = mg.unpacked(mg.packed(np.zeros(0, np.int32), [0, 0]))
    assert found.tolist() == [] and lengths.tolist() == [0, 0]


def test_a_pretoken_without_ids_is_an_error():
    with pytest.raises(ValueError, match="without ids"):
        mg.spelled(mg.packed(np.array([0]), [1]), np.array([0]), pa.array([None], pa.binary()))
