"""Steps whose cost must not grow faster than their input."""

import pyarrow as pa
import pytest

from tokenloom.functions import merging
from tokenloom.operators import backoff as bo, datasets as ds, pretokens as pt, scoring as sc
from tokenloom.plans import queries as q
from tokenloom.session import materialize, scratch_path
from tokenloom.sources import ranges, snapshots
from tokenloom.streaming import jobs


def explained(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_encoder_hands_on_small_pieces_and_forgets_long_words():
    encoder = merging.WordEncoder({}, {bytes([b]): b for b in range(256)}, "error", None)
    rows = [["ab"] * merging.AT_ONCE, ["c"], None, [], ["d" * 500, "e"]]
    batch = pa.array(rows, pa.list_(pa.string()))
    pieces = list(encoder.pieces(batch))
    assert [len(piece) for piece in pieces] == [1, 4]
    got = [ids for piece in pieces for ids in encoder.lists(piece).to_pylist()]
    assert got == [[97, 98] * merging.AT_ONCE, [99], [], [], [100] * 500 + [101]]
    assert set(encoder.known) == {"ab", "c", "e"}
    empty = list(encoder.pieces(batch.slice(0, 0)))
    assert [encoder.lists(piece).to_pylist() for piece in empty] == [[]]


def test_ngrams_are_listed_once_and_scored_without_counting_per_row(spark):
    df = spark.createDataFrame([(1, [5, 6, 5, 6]), (2, []), (3, None), (4, [7])], "doc_id long, tokens array<int>")
    assert "size(transform" not in explained(bo.ngram_places(df, 3))
    assert "Filter ((size" not in explained(bo.ngram_counts(df, 3))
    model = bo.kneser_ney(bo.ngram_counts(df, 3), 3, 10)
    scores = bo.score_backoff(df, model)
    assert "array" not in explained(scores).split("Generate")[0]
    assert {r["doc_id"]: r["n_pairs"] for r in scores.collect()} == {1: 4, 2: 0, 3: 0, 4: 1}


def test_a_small_model_answers_pairs_in_place(spark):
    df = spark.createDataFrame([(1, [5, 6, 5, 6]), (2, [6])], "doc_id long, tokens array<int>")
    model = materialize(sc.ngram_model(sc.bigrams(df), 10))
    scores = sc.score_documents(df, model, 10)
    assert "Aggregate [doc_id" in explained(scores)
    assert ", prev#" not in explained(scores).partition("Aggregate [doc_id")[2].partition("]")[0]
    assert explained(scores).count("Aggregate [doc_id") == 1
    assert {r["doc_id"]: r["n_pairs"] for r in scores.collect()} == {1: 3, 2: 0}


def test_offsets_by_name_move_sizes_only(spark, monkeypatch):
    rows = spark.createDataFrame([(1, [5, 6]), (2, [7])], "doc_id long, tokens array<int>")
    monkeypatch.setattr(q, "encoded", lambda spark, sf: materialize(rows))
    found = q.token_offsets_by_name(spark, "")
    assert " tokens#" not in explained(found).partition("Join")[0]
    assert sorted(r["n_tokens"] for r in found.collect()) == [1, 2]


def test_blocks_are_shuffled_once(spark, monkeypatch):
    seen = []
    write = snapshots.write_snapshot
    monkeypatch.setattr(snapshots, "write_snapshot", lambda df, *args, **more: seen.append((df, more)) or write(df, *args, **more))
    rows = spark.createDataFrame([(1, list(range(10))), (2, [10, 11])], "doc_id long, tokens array<int>")
    path = scratch_path(spark, "blocks")
    snapshots.write_token_blocks(ds.token_stream(materialize(rows)), path, 4)
    df, more = seen[0]
    plan = df._jdf.queryExecution().executedPlan().toString().partition("Join")[0]
    assert more == {"clustered": True} and plan.count("Exchange") == 1
    got = snapshots.read_snapshot(spark, path).orderBy("block_id").collect()
    assert [r["tokens"] for r in got] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10, 11]]


def test_an_arrival_has_its_files(spark):
    source = scratch_path(spark, "files")
    df = spark.range(3).withColumnRenamed("id", "doc_id").selectExpr("doc_id", "string(doc_id) text")
    for part in (df, df.where("doc_id > 1"), df.where("doc_id > 5")):
        jobs.write_arrival(part, source, 4)
    assert jobs._data_files(spark, source) == 12
    out, totals = scratch_path(spark, "offsets"), scratch_path(spark, "totals")
    arriving = jobs.read_text_stream(spark, source, files_per_batch=4)
    from pyspark.sql import functions as F

    jobs.stream_offsets(arriving, out, totals, scratch_path(spark, "progress"), F.length("text")).awaitTermination()
    rows = sorted((r["batch_id"], r["doc_id"], r["offset"]) for r in spark.read.parquet(out).collect())
    assert rows == [(0, 0, 0), (0, 1, 1), (0, 2, 2), (1, 2, 3)]


def test_small_ranges_share_a_task(tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).write_bytes(b"a b " * 1000)
    options = {"path": str(tmp_path), "rangebytes": "1000", "rowbytes": "100", "taskbytes": "6000"}
    reader = ranges.RangeReader(options)
    tasks = reader.partitions()
    assert [len(task.ranges) for task in tasks] == [6, 2]
    read = [row for task in tasks for batch in reader.read(task) for row in batch.to_pylist()]
    alone = ranges.RangeReader({**options, "taskbytes": "0"})
    assert len(alone.partitions()) == 8
    assert read == [row for task in alone.partitions() for batch in alone.read(task) for row in batch.to_pylist()]
    assert b"".join(row["text"].encode() for row in read) == b"a b " * 2000


def test_short_words_are_merged_together(monkeypatch):
    ranks = {(b"a", b"a"): 0, (b"aa", b"b"): 1, (b"b", b"a"): 2, (b"c", b"\xc3"): 3}
    id_of = {bytes([b]): b for b in range(256)} | {a + b: 256 + i for (a, b), i in ranks.items()}
    words = ["aaab", "", "x", "baab", "aaaaa", "aa", "cé", "ba" * 40, "aaab", "abba"]
    del id_of[b"x"]
    for oov, unknown in (("drop", None), ("unk", 7)):
        for dense in (merging.DENSE, 0):
            monkeypatch.setattr(merging, "DENSE", dense)
            encoder = merging.WordEncoder(ranks, id_of, oov, unknown)
            assert encoder.encode_all(words) == [encoder.encode(word) for word in words]
    with pytest.raises(ValueError, match="byte without a token"):
        merging.WordEncoder(ranks, id_of, "error", None).encode_all(["ab", "x"])
    alone = []
    merge = merging.merge_pairs
    monkeypatch.setattr(merging, "merge_pairs", lambda parts, ranks: alone.append(1) or merge(parts, ranks))
    encoder = merging.WordEncoder(ranks, id_of, "drop", None)
    got = encoder.lists(pa.array([words, [], None, ["abba"] * 3], pa.list_(pa.string()))).to_pylist()
    assert len(alone) == 1  # the long word
    assert got == [[256, 97, 98, 98, 257, 256, 256, 97, 256, 259, 169, *[258] * 40, 256, 97, 98, 97, 98, 258], [], [], [97, 98, 258] * 3]


def test_distinct_pretokens_are_searched_as_one_text():
    needles = pt.Needles([b"a", b"aa", b"a", b"\xa9", b"\xff"])
    found, sizes = needles.hits(["aa", "", "é", "ba", "x"])
    assert sizes.tolist() == [5, 0, 1, 2, 0]
    assert found.tolist()[-3:] == [[1, 3], [1, 0], [1, 2]]
    assert sorted(found.tolist()[:5]) == [[0, 0], [0, 1], [0, 2], [1, 0], [1, 2]]
    for none in (pt.Needles([]).hits(["a"]), needles.hits(["xyz"]), needles.hits([])):
        assert not len(none[0]) and not none[1].sum()
