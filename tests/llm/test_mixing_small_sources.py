"""Every source meets its own target, however small it is beside the others."""

from pyspark.sql import functions as F

from tokenloom.llm import mixing as mx


def test_small_sources_meet_their_own_targets(spark):
    """Sources of a few words beside one of 6,000,000 words; the third's bound is 3 words."""
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.repeat(F.lit("w "), 2000).alias("text")
    )
    small = [(10_000 + i, "b", "x " * 5) for i in range(5)] + [(20_000, "c", "y")]
    both = docs.unionByName(spark.createDataFrame(small, "doc_id long, source string, text string"))
    for size, weights in ((None, (5, 2, 1)), (None, (600_000, 1, 1)), (400, (5, 2, 1))):
        found = mx.mix_sources(both, weights=weights, blocks=size).join(both.select("doc_id", "source"), "doc_id")
        sums = found.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
        for x in sums.collect():
            assert abs(x.taken - x.target) <= max(1, 0.003 * x.target), (size, x)
        assert found.where("taken > 3 * size or taken < 0").isEmpty()
