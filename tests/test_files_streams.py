import pytest
from pyspark.sql import functions as F

from tokenloom.operators import codec as cd, pretokens as pt, training as tr, vocabulary as vc
from tokenloom.sources import artifacts
from tokenloom.streaming import jobs

END = "<|endoftext|>"


@pytest.fixture(scope="module")
def learned(spark, small_docs):
    return tr.train_bpe(small_docs, 256 + 1 + 6)


def test_vocab_and_merges_files(spark, learned, tmp_path):
    vocab, merges = learned.vocab_frame(spark), learned.merges_frame(spark)
    artifacts.write_vocab(vocab, str(tmp_path / "vocab"))
    artifacts.write_merges(merges, str(tmp_path / "merges"))
    back = artifacts.read_vocab(spark, str(tmp_path / "vocab"))
    assert sorted(back.select("token_id", "token_bytes").collect()) == sorted(
        vocab.select("token_id", "token_bytes").collect()
    )
    lines = artifacts.read_merges(spark, str(tmp_path / "merges"), back)
    columns = ["rank", "left_bytes", "right_bytes"]
    assert sorted(lines.select(*columns).collect()) == sorted(merges.select(*columns).collect())
    loaded = cd.Codec.from_frames(back, lines, [END])
    assert loaded.steps == cd.Codec.from_model(learned).steps
    assert loaded.end_id == 256 + 6


def test_merge_lines(spark, tmp_path):
    (tmp_path / "merges.txt").write_text("#version: 0.2\n\na b\nab  c\nx y\n  \nlost \n", encoding="utf-8")
    vocab = spark.createDataFrame(
        [(i, bytearray(t)) for i, t in enumerate([b"a", b"b", b"ab ", b"c", b" "])],
        "token_id int, token_bytes binary",
    ).withColumn("is_special", F.lit(False))
    lines = artifacts.read_merge_lines(spark, str(tmp_path / "merges.txt"), printable=False)
    halves = [(bytes(r["left_bytes"]), bytes(r["right_bytes"])) for r in lines.orderBy("rank").collect()]
    assert halves == [(b"a", b"b"), (b"ab ", b"c"), (b"x", b"y"), (b" ", b""), (b"lost", b"")]
    valid = vc.valid_merge_filter(lines, vocab).orderBy("rank").collect()
    assert [bytes(r["left_bytes"]) for r in valid] == [b"a", b"ab "]
    assert vc.skipped_merges(lines, vocab).count() == 3
    done = vc.finalize_vocab(vocab, lines, [END, "c"]).orderBy("token_id").collect()
    assert [bytes(r["token_bytes"]) for r in done][5:] == [END.encode(), b"lost"]
    assert [r["token_id"] for r in done] == list(range(7))


def test_duplicate_tokens_report(spark):
    vocab = spark.createDataFrame(
        [(0, bytearray(b"a")), (1, bytearray(b"ab")), (2, bytearray(b"ab"))], "token_id int, token_bytes binary"
    )
    rows = vc.duplicate_tokens(vocab).collect()
    assert [(bytes(r["token_bytes"]), r["n_ids"], r["used_id"]) for r in rows] == [(b"ab", 2, 2)]


def test_saved_states(spark, tmp_path):
    path = str(tmp_path / "state")
    for step in (3, 10):
        df = spark.createDataFrame(
            [(0, 0, float(step), 0.5, 0.25)], "class int, dim int, value double, m double, v double"
        )
        artifacts.save_state(df, path, step, {"classes": 1})
    parameters, step, config = artifacts.load_state(spark, path)
    assert (step, config, parameters.first()["value"]) == (10, {"classes": 1}, 10.0)
    parameters, step, _ = artifacts.load_state(spark, path, iteration=3, optimizer=False)
    assert (step, parameters.columns) == (3, ["class", "dim", "value"])


def test_metrics_append(spark, tmp_path):
    path = str(tmp_path / "metrics")
    artifacts.write_metrics(spark, path, "run", 10, {"train/loss": 2.0, "grad_norm": 1})
    artifacts.write_metrics(spark, path, "run", 20, {"valid/loss": 1.5})
    rows = artifacts.read_metrics(spark, path).orderBy("iteration", "metric").collect()
    assert [(r["iteration"], r["split"], r["metric"], r["value"]) for r in rows] == [
        (10, None, "grad_norm", 1.0), (10, "train", "loss", 2.0), (20, "valid", "loss", 1.5)
    ]


def test_streams_equal_batches_and_restart_cleanly(spark, small_docs, learned, tmp_path):
    codec = cd.Codec.from_model(learned)
    source, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    words, words_progress = str(tmp_path / "words"), str(tmp_path / "words_progress")

    def run():
        stream = jobs.read_text_stream(spark, source, files_per_batch=1)
        jobs.stream_encode(stream, codec, out, progress).awaitTermination()
        stream = jobs.read_text_stream(spark, source, files_per_batch=1)
        jobs.stream_pretoken_counts(stream, words, words_progress).awaitTermination()

    def check(docs):
        expected = {r["doc_id"]: r["tokens"] for r in cd.encode_corpus(docs, codec).collect()}
        rows = spark.read.parquet(out).select("doc_id", "tokens").collect()
        assert len(rows) == len(expected) and {r["doc_id"]: r["tokens"] for r in rows} == expected
        counts = jobs.latest_counts(spark, words, "pretoken", "freq")
        assert sorted(counts.collect()) == sorted(pt.pretoken_counts(docs).collect())

    first = small_docs.where("doc_id < 100")
    first.repartition(3).write.parquet(source)
    run()
    batches = spark.read.parquet(out).select("batch_id").distinct().count()
    assert batches >= 3
    check(first)
    run()
    assert spark.read.parquet(out).select("batch_id").distinct().count() == batches
    small_docs.where("doc_id >= 100").coalesce(1).write.mode("append").parquet(source)
    run()
    check(small_docs)


def test_lines_of_text_files_arrive_and_are_encoded(spark, learned, tmp_path):
    codec = cd.Codec.from_model(learned)
    source, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one two\n\nthe end", encoding="utf-8")
    stream = jobs.read_text_stream(spark, source, format="text")
    jobs.stream_encode(stream, codec, out, progress, keep=("path",), unit="line").awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted(bytes(b for i in r["tokens"] for b in codec.bytes_of[i]) for r in rows) == [b"", b"one two", b"the end"]


def test_compacted_counts_are_the_latest(spark, small_docs, tmp_path):
    source, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    small_docs.limit(40).repartition(4).write.parquet(source)
    stream = jobs.read_text_stream(spark, source, files_per_batch=1)
    jobs.stream_pretoken_counts(stream, out, progress).awaitTermination()
    before = sorted(jobs.latest_counts(spark, out, "pretoken", "freq").collect())
    jobs.compact_counts(spark, out, "pretoken", "freq")
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 1
    assert sorted(jobs.latest_counts(spark, out, "pretoken", "freq").collect()) == before
    small_docs.limit(60).coalesce(1).write.mode("append").parquet(source)
    jobs.stream_pretoken_counts(
        jobs.read_text_stream(spark, source, files_per_batch=1), out, progress
    ).awaitTermination()
    total = jobs.latest_counts(spark, out, "pretoken", "freq").agg(F.sum("freq")).first()[0]
    both = spark.read.parquet(source)
    assert total == pt.pretoken_counts(both).agg(F.sum("freq")).first()[0]
