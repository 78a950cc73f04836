"""Running positions: a batch that is done again gets the same places."""

from pyspark.sql import functions as F

from tokenloom.session import scratch_path
from tokenloom.streaming import jobs


def test_batches_follow_each_other_and_reruns_agree(spark):
    source, out, totals = (scratch_path(spark, name) for name in ("files", "offsets", "totals"))

    def run(progress):
        arriving = jobs.read_text_stream(spark, source, files_per_batch=1)
        jobs.stream_offsets(arriving, out, totals, progress, F.length("text")).awaitTermination()
        rows = spark.read.parquet(out).collect()
        return sorted((r["batch_id"], r["doc_id"], r["offset"], r["size"]) for r in rows)

    for rows in ([(2, "abc"), (1, "de")], [(1, None), (0, "fghi")]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        df.coalesce(1).write.mode("append").parquet(source)
    want = [(0, 1, 0, 2), (0, 2, 2, 3), (1, 0, 5, 4), (1, 1, 9, 0)]
    assert run(scratch_path(spark, "progress")) == want
    # progress lost: all batches are done again over what the first run left
    assert run(scratch_path(spark, "progress")) == want
