"""Snapshots that stay readable, and windows read from few files."""

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import datasets as ds
from tokenloom.sources import snapshots as sn


@pytest.fixture(scope="module")
def stream(spark):
    rows = [(i, [(i * 37 + k * k) % 251 for k in range(i * 13 % 97)]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<int>")
    return ds.token_stream(docs).persist()


@pytest.fixture
def few_partitions(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


@pytest.mark.parametrize("strategy", ["random", "aligned"])
@pytest.mark.parametrize("block,length", [(16, 24), (64, 24), (4096, 7)])
def test_windows_equal_the_scan(spark, stream, tmp_path, few_partitions, strategy, block, length):
    made = sn.write_token_blocks(stream, str(tmp_path / "t"), block)
    plan = sn.plan_windows(spark, made, 40, length, strategy, seed=5)
    rows = sn.read_windows(spark, plan, length)
    scan = ds.sample_windows(stream, 40, length, strategy, seed=5)
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, scan.collect()))
    assert len(plan.files) <= plan.n_files


def test_few_windows_open_few_files(spark, stream, tmp_path, few_partitions):
    made = sn.write_token_blocks(stream, str(tmp_path / "t"), 16)
    plan = sn.plan_windows(spark, made, 1, 8, "random", seed=1)
    assert plan.n_files == 8 and 1 <= len(plan.files) <= 2
    rows = sn.read_windows(spark, plan, 8)
    assert {x.rsplit("/", 1)[-1] for x in rows.inputFiles()} == {x.rsplit("/", 1)[-1] for x in plan.files}
    assert "PushedFilters: [Or" in rows._jdf.queryExecution().toString() or "GreaterThanOrEqual(block_id" in rows._jdf.queryExecution().toString()


def test_an_interrupted_write_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sn.read_snapshot(spark, path)
    first = sn.write_snapshot(spark.range(10).toDF("k"), path, "k")
    broken = spark.range(50).select(F.when(F.col("id") == 49, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("long").alias("k"))
    with pytest.raises(Exception, match="stop"):
        sn.write_snapshot(broken, path, "k")
    assert sn.read_snapshot(spark, path).count() == 10
    # stopped after the data, before the snapshot's name
    monkeypatch.setattr(sn._Folder, "create", lambda *_: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError, match="killed"):
        sn.write_snapshot(spark.range(20).toDF("k"), path, "k")
    monkeypatch.undo()
    assert sn.snapshots(spark, path) == [first] and sn.read_snapshot(spark, path).count() == 10
    sn.write_snapshot(spark.range(30).toDF("k"), path, "k")
    assert sn.read_snapshot(spark, path).count() == 30
    assert sn.read_snapshot(spark, path, version=1).count() == 10
    assert sn.expire_snapshots(spark, path) == 1
    assert sn.read_snapshot(spark, path).count() == 30 and len(sn.snapshots(spark, path)) == 1
    assert len([x for x in (tmp_path / "t").iterdir() if x.name.startswith("data-")]) == 1


def test_errors(spark, stream, tmp_path):
    made = sn.write_token_blocks(stream.where("doc_id < 3"), str(tmp_path / "t"), 8)
    with pytest.raises(ValueError, match="shorter"):
        sn.plan_windows(spark, made, 4, 10_000)
    empty = sn.write_token_blocks(stream.where("doc_id < 0"), str(tmp_path / "e"), 8)
    with pytest.raises(ValueError, match="shorter"):
        sn.plan_windows(spark, empty, 4, 4)
