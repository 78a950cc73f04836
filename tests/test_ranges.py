"""Files read in byte ranges of any size give the same pretokens, spans and lines."""

import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from tokenloom.functions import text as tx
from tokenloom.operators import pretokens as pt
from tokenloom.sources import corpus, ranges


def made_text(seed: int, n: int = 6000) -> str:
    rng = random.Random(seed)
    letters = "abcdef   \n\n\t\r.,'s  　\x85é中文한😀1"
    return "".join(rng.choice(letters) for _ in range(n))


@pytest.mark.parametrize("seed", range(30))
def test_pieces_have_the_pretokens_of_the_whole(seed):
    """Every single safe place, one at a time and all at once."""
    whole = made_text(seed, 800)
    data = whole.encode()
    words = regex.findall(tx.PRETOKEN_PATTERN, whole)
    places = [x.start() for x in ranges.PRETOKEN_EDGE.finditer(data)]
    assert places
    for place in places:
        parts = [data[:place].decode(), data[place:].decode()]
        assert [w for part in parts for w in regex.findall(tx.PRETOKEN_PATTERN, part)] == words
    edges = [0, *places, len(data)]
    cut = [data[a:b].decode() for a, b in zip(edges, edges[1:])]
    assert [w for part in cut for w in regex.findall(tx.PRETOKEN_PATTERN, part)] == words


@pytest.mark.parametrize("range_bytes,row_bytes", [(7, 3), (7, 1 << 20), (1024, 100), (1 << 30, 1 << 20)])
def test_spans_and_counts_do_not_depend_on_the_ranges(spark, tmp_path, range_bytes, row_bytes):
    texts = {"a.txt": made_text(1), "b.txt": "x" * 500 + " y " + "中" * 300, "empty.txt": ""}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "_SUCCESS").write_text("")
    # a task per range: the smallest ranges read the small file alone
    path = str(tmp_path / "b.txt") if range_bytes < 100 else str(tmp_path)
    rows = ranges.read_ranges(spark, path, range_bytes, row_bytes)
    found: dict[str, list] = {}
    for row in ranges.file_spans(rows).collect():
        found.setdefault(row.path.rsplit("/", 1)[-1], []).append((row.start, row.end, row.pretoken))
    for name, text in texts.items():
        wanted, at = [], 0
        for word in regex.findall(tx.PRETOKEN_PATTERN, text):
            wanted.append((at, at + len(word.encode()), word))
            at = wanted[-1][1]
        if name == "b.txt" or range_bytes >= 100:
            assert sorted(found.get(name, [])) == wanted
    whole = corpus.read_corpus(spark, path)
    counts = lambda df: {tuple(x) for x in pt.pretoken_counts(df).collect()}
    assert counts(rows) == counts(whole)


def test_rows_follow_each_other(spark, tmp_path):
    data = made_text(3, 20_000).encode()
    (tmp_path / "f").write_bytes(data)
    rows = ranges.read_ranges(spark, str(tmp_path / "f"), 1000, 64).orderBy("start").collect()
    assert len(rows) > 50 and b"".join(x.text.encode() for x in rows) == data
    assert [x.start for x in rows] == [sum(len(y.text.encode()) for y in rows[:i]) for i in range(len(rows))]


@pytest.mark.parametrize("range_bytes", [7, 1000, 1 << 20])
def test_lines(spark, tmp_path, range_bytes):
    text = "\n".join(made_text(4, 200).split(" ")) + "\n\nlast\n" * (range_bytes != 1000)
    (tmp_path / "f").write_bytes(text.encode())
    rows = ranges.range_lines(spark, f"file://{tmp_path}/f", range_bytes).orderBy("start").collect()
    wanted = re.findall(r"[^\n]*\n|[^\n]+$", text)
    assert [x.text for x in rows] == wanted
    assert [x.start for x in rows] == [len("".join(wanted[:i]).encode()) for i in range(len(wanted))]
    by_reader = corpus.read_lines(spark, str(tmp_path / "f")).orderBy("line_no").collect()
    assert [x.text for x in by_reader] == wanted


def test_plans_and_errors(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"a b " * 1000)
    rows = ranges.read_ranges(spark, str(tmp_path / "f"), 1000)
    assert rows.select(F.spark_partition_id()).distinct().count() == 4
    with pytest.raises(Exception, match="edge"):
        ranges.read_ranges(spark, str(tmp_path / "f"), edge="other").count()
    with pytest.raises(Exception, match="FileNotFound|none"):
        ranges.read_ranges(spark, str(tmp_path / "none")).count()
    (tmp_path / "bad").write_bytes(b"a \xff\xff b")
    with pytest.raises(Exception, match="utf-8"):
        ranges.read_ranges(spark, str(tmp_path / "bad")).count()
