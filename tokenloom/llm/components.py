"""Connected components of link tables, with the smallest key of each component."""

from pyspark.sql import DataFrame, functions as F

from tokenloom.llm.frames import drop_stash, partitions, stash


def even_join(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """``facts`` inner join ``dim`` (unique ``key``, with ``n``, its number of facts).

    Keys that hold more than a share of all facts are few by that share; their rows of
    ``dim`` are broadcast, and only the other facts are shuffled.
    """
    spark = facts.sparkSession
    total = dim.agg(F.sum("n")).first()[0] or 0
    most = max(1, total // (4 * partitions(spark)))
    hot = dim.where(F.col("n") > most).drop("n")
    marked = facts.join(
        F.broadcast(hot.select(F.col(key).alias("hot_key"))), F.col(key) == F.col("hot_key"), "left"
    )
    one = marked.where(F.col("hot_key").isNotNull()).drop("hot_key").join(F.broadcast(hot), key)
    other = marked.where(F.col("hot_key").isNull()).drop("hot_key")
    return one.unionByName(other.join(dim.where(F.col("n") <= most).drop("n"), key))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the least node reachable.

    Each round sends the greater neighbours of a node to its least one, then the lesser
    ones, and keeps distinct links, until all links are stars around their least node.
    Rounds are written to the shared folder, so a lost executor costs at most one.
    """
    spark = links.sparkSession
    now = stash(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    while not now.isEmpty():
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stash(
            both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
            .withColumn("m", F.least("m", "a")),
            "least",
        )
        # greater neighbours (now holds the greater node first): b < a, seen from b
        large = even_join(
            now.select(F.col("b").alias("a"), F.col("a").alias("v")), least, "a"
        ).select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = stash(large.where(F.col("a") != F.col("b")).distinct(), "large")
        lower = stash(
            large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "lower"
        )
        small = even_join(large, lower, "a")
        after = stash(
            small.where(F.col("b") != F.col("m"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lower.select("a", F.col("m").alias("b")))
            .distinct(),
            "links",
        )
        same = after.count() == now.count() and after.exceptAll(now).isEmpty()
        drop_stash(spark, now, least, large, lower)
        now = after
        if same:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
