"""Allow and block rules for urls, found by a sorted sweep over reversed-host keys.

A rule (host, path) covers the interval of all keys that begin with its own key: the
labels of the host from the right, then the path. Intervals of prefixes either nest or
are apart, so a sweep in key order only needs the rule that began last and the rules
around it (its stack). Urls bring one key for each host they belong to (their own and
its parents). Keys are dealt to ranges of about equal size; a key that fills several
ranges is spread over them, and a rule goes to every range its interval touches.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tokenloom.llm.frames import UPPER, fresh, partitions, q

#: Keys sampled for each range limit, most ranges, separator of labels and path.
SAMPLED, MOST_RANGES = 24, 8192
GAP = "\x01"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the right, each ended by a mark, so that parents are prefixes."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), GAP), F.lit(GAP))


def parent_hosts(host: Column) -> Column:
    """The host and every host it is a subdomain of."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Each rule key with the rules around it, outermost first, itself last.

    ``rules``: unique key, rule, verdict.
    """
    prefixes = rules.select(
        "key",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("key")), lambda n: F.substr(F.col("key"), F.lit(1), n)
            )
        ).alias("outer"),
    )
    found = prefixes.join(rules.withColumnRenamed("key", "outer"), "outer")
    return found.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("outer", "rule", "verdict"))).alias("stack")
    )


def range_limits(keys: DataFrame, key: str, row: str, ranges: int) -> list[str]:
    """About equally spaced keys, from a sample of bounded size taken by hash."""
    rows = keys.count()
    wanted = SAMPLED * ranges
    if rows > 2 * wanted:
        share = int(2**31 * wanted / rows)
        keys = keys.where(F.pmod(F.xxhash64(q(row), q(key)), F.lit(2**31)) < share)
    sample = sorted((x[0] for x in keys.select(q(key)).collect()), key=str.encode)
    return [sample[i * len(sample) // ranges] for i in range(1, ranges)] if sample else []


def position(limits: Column, n: int, before) -> Column:
    """How many of the sorted limits satisfy ``before`` (true for a first part of them)."""
    steps = max(1, math.ceil(math.log2(n + 1)))

    def halve(span: Column, _: Column) -> Column:
        low, high = span["low"], span["high"]
        middle = F.floor((low + high) / 2).cast("int")
        right = (low < high) & before(F.get(limits, middle))
        return F.struct(
            F.when(right, middle + 1).otherwise(low).alias("low"),
            F.when(right | (low >= high), high).otherwise(middle).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(n).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda span: span["low"])


def sweep(points: DataFrame, rules: DataFrame, row: str, ranges: int | None = None) -> DataFrame:
    """Adds ``found``: the innermost rule whose interval holds the point's ``key``, or null.

    Points need ``key`` and a row number; rules need a unique key, rule, verdict.
    """
    spark = points.sparkSession
    most = ranges or min(MOST_RANGES, max(4 * partitions(spark), 2))
    limits = range_limits(points, "key", row, most)
    n = len(limits)
    # no key holds \x02, which parts the limits in one literal
    table = F.split(F.lit("\x02".join(limits)), "\x02")
    key = F.col("key")
    low = position(table, n, lambda limit: limit < key)
    high = position(table, n, lambda limit: limit <= key)
    last = position(table, n, lambda limit: (limit <= key) | F.startswith(limit, key))
    stacks = rule_stacks(rules)
    dealt = points.withColumns({"low": low, "high": high}).select(
        *points.columns,
        (F.col("low") + F.pmod(F.xxhash64(q(row)), F.col("high") - F.col("low") + 1))
        .cast("int")
        .alias("range"),
        F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"),
    )
    blank = [
        F.lit(None).cast(points.schema[name].dataType).alias(name)
        for name in points.columns
        if name != "key"
    ]
    starts = stacks.select("key", *blank, F.explode(F.sequence(low, last)).alias("range"), "stack")
    order = Window.partitionBy("range").orderBy("key", F.col("stack").isNull())
    active = F.last("stack", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    around = F.filter("active", lambda rule: F.startswith(F.col("key"), rule["outer"]))
    return (
        dealt.unionByName(starts)
        .withColumn("active", active)
        .where(F.col("stack").isNull())
        .select(*points.columns, F.try_element_at(around, F.lit(-1)).alias("found"))
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    url: str = "url",
    keep: Sequence[str] = ("page_id",),
    ranges: int | None = None,
) -> DataFrame:
    """``keep`` columns plus host, path, rule (``host + path``) and verdict of every url.

    ``rules``: host, path, verdict. A rule fits its host and all subdomains if the url's
    path begins with the rule's. The longest rule wins (host and path together), of equally
    long ones the last in key order; of equal rules the least verdict. Urls that no rule fits get a null rule and
    ``default``. A null url, or one without ``://``, has an empty host and path.
    Null rule parts count as empty, and a rule without host fits no url. Repeated rows are
    judged alike; an empty table gives no rows. Other columns are not read.
    Control characters \\x01 and \\x02 in a url never match a rule's.
    """
    source = pages.select(*[q(name) for name in dict.fromkeys([*keep, url])])
    row, host, path = (fresh(source, name) for name in ("row", "host", "path"))
    judged = source.withColumns(
        {row: F.monotonically_increasing_id(), host: url_host(q(url)), path: url_path(q(url))}
    )
    kept = [q(name).alias(f"k{i}") for i, name in enumerate(keep)]
    plain = lambda x: F.translate(x, GAP + "\x02", "��")
    points = judged.select(
        *kept,
        q(row).alias("row"),
        q(host).alias("host"),
        q(path).alias("path"),
        F.explode(parent_hosts(plain(q(host)))).alias("parent"),
    ).select(
        *[f"k{i}" for i in range(len(keep))],
        "row",
        "host",
        "path",
        F.concat(host_key(F.col("parent")), F.lit(GAP), plain(F.col("path"))).alias("key"),
    )
    named = rules.select(
        F.coalesce(F.translate("host", UPPER, UPPER.lower()), F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "verdict",
    ).where(F.col("host") != "")
    unique = (
        named.groupBy("host", "path")
        .agg(F.min("verdict").alias("verdict"))
        .select(
            F.concat(host_key(F.col("host")), F.lit(GAP), F.col("path")).alias("key"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        )
    )
    rule = F.col("found")
    top = (
        sweep(points, unique, "row", ranges)
        .groupBy("row")
        .agg(
            *[F.first(f"k{i}").alias(f"k{i}") for i in range(len(keep))],
            F.first("host").alias("host"),
            F.first("path").alias("path"),
            F.max(
                F.when(
                    rule.isNotNull(),
                    F.struct(F.length(rule["rule"]).alias("n"), rule["outer"].alias("o"), rule),
                )
            ).alias("best"),
        )
    )
    return top.select(
        *[F.col(f"k{i}").alias(name) for i, name in enumerate(keep)],
        "host",
        "path",
        F.col("best.found.rule").alias("rule"),
        F.coalesce("best.found.verdict", F.lit(default)).alias("verdict"),
    )


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rules of a short list as a table."""
    rows = [
        F.struct(*[F.lit(x).alias(name) for x, name in zip(rule, ("host", "path", "verdict"), strict=True)])
        for rule in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))
