import math

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import codec as cd, datasets as ds
from tokenloom.sources import corpus


@pytest.fixture(scope="module")
def stream(spark):
    """The tokens 0..99 spread over documents of 0, 1, 2, ... tokens."""
    docs, start, size = [], 0, 0
    while start < 100:
        docs.append((len(docs) * 7, list(range(start, min(start + size, 100)))))
        start, size = start + size, size + 1
    df = spark.createDataFrame(docs, "doc_id long, tokens array<int>")
    return ds.token_stream(df).persist()


def test_offsets_are_prefix_sums(spark):
    rows = [(i * i * (-1) ** i, i % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, n int").repartition(4)
    got = {r["k"]: r["offset"] for r in ds.with_offsets(df, "k", F.col("n"), buckets=16).collect()}
    total = 0
    for key, n in sorted(rows):
        assert got[key] == total
        total += n


def test_offsets_of_nothing(spark):
    empty = spark.createDataFrame([], "k long, n int")
    assert ds.with_offsets(empty, "k", F.col("n")).collect() == []


def test_token_rows(stream):
    rows = ds.token_rows(stream).collect()
    assert sorted((r["global_pos"], r["token_id"]) for r in rows) == [(i, i) for i in range(100)]


@pytest.mark.parametrize("length", [1, 3, 7, 99])
def test_packed_windows(stream, length):
    rows = ds.pack_sequences(stream, length).orderBy("window_id").collect()
    starts = list(range(0, 100 - length, length))
    assert [r["start"] for r in rows] == starts
    for row in rows:
        assert row["input"] == list(range(row["start"], row["start"] + length))
        assert row["target"] == [t + 1 for t in row["input"]]


@pytest.mark.parametrize("strategy", ["random", "aligned"])
def test_sampled_windows(stream, strategy):
    rows = ds.sample_windows(stream, 200, 7, strategy).collect()
    assert len(rows) == 200
    for row in rows:
        assert 0 <= row["start"] < 93
        assert row["input"] == list(range(row["start"], row["start"] + 7))
        assert row["target"] == [t + 1 for t in row["input"]]
        if strategy == "aligned":
            assert row["start"] % 7 == 0
    again = ds.sample_windows(stream, 200, 7, strategy).collect()
    assert sorted(rows) == sorted(again)


def test_starts_are_uniform(spark):
    starts = ds.sample_starts(spark, 100, 32_000, 7, "random", 1)
    rows = ds.window_start_histogram(starts, 93).collect()
    assert {r["start"] for r in rows} == set(range(93))
    assert all(r["within"] for r in rows)


def test_sampling_needs_room(stream):
    assert len(ds.sample_windows(stream, 3, 99).collect()) == 3
    with pytest.raises(ValueError):
        ds.sample_windows(stream, 3, 100)
    with pytest.raises(ValueError):
        ds.sample_windows(stream, 3, 7, "sorted")


def test_epoch_plan(stream):
    row = ds.epoch_plan(stream, 2, 7, 1000, 3).first()
    assert (row["n_tokens"], row["iters_per_epoch"], row["max_iters"]) == (100, 7, 71)
    assert row["epochs"] == pytest.approx(71 / 7) and row["cycle_iters"] == 21


def test_token_dataset_files(spark, tmp_path):
    codec = cd.Codec(
        [(b, bytes([b])) for b in range(256)] + [(256, b"\n\n"), (257, b"<|endoftext|>")],
        [(b"\n", b"\n")],
        ["<|endoftext|>"],
    )
    docs = spark.createDataFrame([(0, "a\n\nb"), (1, ""), (2, "c")], "doc_id long, text string")
    path = str(tmp_path / "tokens")
    stats = corpus.tokenize_dataset({"train": docs, "valid": docs}, codec, path)
    assert {r["split"]: (r["n_bytes"], r["n_tokens"]) for r in stats.collect()} == {
        "train": (5, 8), "valid": (5, 8)
    }
    rows = corpus.read_token_dataset(spark, path, "train").orderBy("doc_id").collect()
    # The run of two newlines parts before 'b', so no merge happens in a document.
    assert [r["tokens"] for r in rows] == [[97, 10, 10, 98, 257], [257], [99, 257]]
    assert [r["offset"] for r in rows] == [0, 5, 6]
    # An existing split stays unless told otherwise.
    other = docs.where("doc_id = 2")
    corpus.tokenize_dataset({"train": other}, codec, path)
    assert corpus.read_token_dataset(spark, path, "train").count() == 3
    corpus.tokenize_dataset({"train": other}, codec, path, overwrite=True)
    assert corpus.read_token_dataset(spark, path, "train").count() == 1


def test_lines_are_encoded_alone(spark, tmp_path):
    codec = cd.Codec(
        [(b, bytes([b])) for b in range(256)] + [(256, b"\n\n")], [(b"\n", b"\n")]
    )
    docs = spark.createDataFrame([(0, "a\n\n"), (1, "")], "doc_id long, text string")
    for unit, expected in (("document", [[97, 256], []]), ("line", [[97, 10, 10], []])):
        path = str(tmp_path / unit)
        corpus.tokenize_dataset({"train": docs}, codec, path, unit=unit)
        rows = corpus.read_token_dataset(spark, path).orderBy("doc_id").collect()
        assert [r["tokens"] for r in rows] == expected


def test_ids_above_the_limit_fail(spark):
    df = spark.createDataFrame([(0, [1, 70000])], "doc_id long, tokens array<int>")
    with pytest.raises(Exception, match="token id above"):
        corpus.checked_ids(df).collect()
    assert corpus.checked_ids(df, 70000).first()["tokens"] == [1, 70000]


def test_corpus_readers(spark, tmp_path):
    file = tmp_path / "corpus.txt"
    file.write_bytes("one\r\ntwo<|endoftext|>é\n\n<|endoftext|>last\n".encode())
    assert corpus.read_corpus(spark, str(file)).first()["text"].encode() == file.read_bytes()
    for data in (file.read_bytes(), file.read_bytes()[:-1], b"", b"\n\n", b"x"):
        other = tmp_path / f"lines{len(data)}.txt"
        other.write_bytes(data)
        lines = [r["text"] for r in corpus.read_lines(spark, str(other)).orderBy("line_no").collect()]
        assert "".join(lines).encode() == data
    docs = [r["text"] for r in corpus.read_documents(spark, str(file)).collect()]
    assert docs == ["one\r\ntwo", "é\n\n", "last\n"]
    whole = corpus.read_corpus(spark, str(file))
    assert [r["text"] for r in corpus.split_documents(whole).orderBy("part").collect()] == docs
    with pytest.raises(Exception):
        corpus.read_corpus(spark, str(tmp_path / "absent.txt")).collect()


def test_windows_at_start_histogram_margin():
    share = 1 / 93
    assert 5 * math.sqrt(32_000 * share * (1 - share)) < 32_000 * share


def test_offsets_by_text_keys_and_bad_keys(spark):
    rows = [(f"k{i * 7919 % 500:03d}", i % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, n int")
    got = {r["k"]: r["offset"] for r in ds.with_offsets(df, "k", F.col("n")).collect()}
    total = 0
    for key, n in sorted(rows):
        assert got[key] == total
        total += n
    for bad in ([("a", 1), (None, 2)], [("a", 1), ("a", 2)]):
        with pytest.raises(Exception, match="keys must be unique and not null"):
            ds.with_offsets(spark.createDataFrame(bad, "k string, n int"), "k", F.col("n")).collect()


def test_unfinished_splits_are_rebuilt_and_finished_ones_skipped(spark, tmp_path):
    codec = cd.Codec([(b, bytes([b])) for b in range(256)] + [(70_000, b"ab")], [(b"a", b"b")])
    docs = spark.createDataFrame([(0, "xy"), (1, "")], "doc_id long, text string")
    broken = docs.withColumn("text", F.raise_error(F.lit("worked")).cast("string"))
    path = str(tmp_path / "set")
    (tmp_path / "set" / "split=train" / "_temporary").mkdir(parents=True)
    assert corpus.tokenize_dataset({"train": docs}, codec, path).first()["n_tokens"] == 2
    assert corpus.tokenize_dataset({"train": broken}, codec, path).first()["n_tokens"] == 2
    with pytest.raises(Exception, match="worked"):
        corpus.tokenize_dataset({"train": broken}, codec, path, overwrite=True)
    wide = spark.createDataFrame([(0, "ab")], "doc_id long, text string")
    with pytest.raises(Exception, match="token id above 65535"):
        corpus.tokenize_dataset({"wide": wide}, codec, path)
    corpus.tokenize_dataset({"wide": wide}, codec, path, limit=70_000)
    assert {r["split"] for r in corpus.tokenize_dataset({"wide": wide}, codec, path).collect()} == {"wide"}


def test_only_edges_of_documents_are_shuffled(spark):
    """A long document's windows stay in place; the packing equals that of short ones."""
    docs = spark.createDataFrame([(0, list(range(50))), (1, list(range(50, 1000)))], "doc_id long, tokens array<int>")
    stream = ds.token_stream(docs).persist()
    rows = ds.pack_sequences(stream, 16).orderBy("window_id").collect()
    assert [r["input"] for r in rows] == [list(range(i, i + 16)) for i in range(0, 1000 - 16, 16)]
