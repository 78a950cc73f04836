"""Document fingerprints as Merkle trees over sections, paragraphs and their passages.

A text is cut into sections at blank lines, sections into paragraphs at line ends, and
paragraphs into passages after punctuation (or every so many characters). Passages are
the leaves; every inner node hashes its children in order, and the root also holds the
length. Nothing of the text is left out, so equal roots mean equal texts, and where roots
differ the branches that differ show where the edit is.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tokenloom.llm.frames import fresh, partitions, q

#: Characters of a passage without punctuation.
PASSAGE = 256
MARK, END = "\x02", "\x01"
#: Most range limits for neighbours in key order.
MOST_RANGES = 4096


def passages(paragraph: Column, most: int = PASSAGE) -> Column:
    """Passages of a paragraph; joined they are the paragraph."""
    marked = F.regexp_replace(paragraph, r"([!-/:-@\[-`{-~])([ \t]+)", f"$1$2{END}")
    cut = F.regexp_replace(marked, f"([^{END}]{{{most}}})", f"$1{END}")
    return F.split(cut, END)


def parent(children: Column) -> Column:
    """A node from its children's hashes, in order."""
    return F.sha2(F.array_join(children, ""), 256)


def tree(text: Column, most: int = PASSAGE) -> Column:
    """Sections > paragraphs > leaf hashes of a text; none for an empty one."""
    sections = F.when(F.length(text) > 0, F.split(F.regexp_replace(text, r"\n(\n+)", f"\n$1{MARK}"), MARK))
    return F.transform(
        F.coalesce(sections, F.array().cast("array<string>")),
        lambda section: F.transform(
            F.split(section, "\n"),
            lambda paragraph: F.transform(passages(paragraph, most), lambda x: F.sha2(x, 256)),
        ),
    )


def section_hashes(nodes: Column) -> Column:
    return F.transform(nodes, lambda section: parent(F.transform(section, parent)))


def root(nodes: Column, text: Column) -> Column:
    """The fingerprint: length and section hashes."""
    return F.sha2(
        F.concat_ws(":", F.length(text).cast("string"), F.array_join(section_hashes(nodes), "")), 256
    )


def leaves(nodes: Column) -> Column:
    """Distinct leaf hashes."""
    return F.array_distinct(F.flatten(F.flatten(nodes)))


def likeness(one: Column, other: Column) -> Column:
    """Shared leaves over all leaves of two distinct lists; 1 for two empty ones."""
    both = F.size(F.array_intersect(one, other))
    all_of = F.size(one) + F.size(other) - both
    return F.when(all_of == 0, F.lit(1.0)).otherwise(both / all_of)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, fingerprint (root) and tree of section, paragraph and leaf hashes of every text.

    A null text counts as empty: no section, a root of its length alone. Equal texts have
    equal roots. Repeated rows and null keys are kept; other columns are not read.
    """
    whole = F.coalesce(q(text), F.lit(""))
    nodes = tree(whole)
    return docs.select(q(key).alias(key), root(nodes, whole).alias("fingerprint"), nodes.alias("tree"))


def differing_branches(one: Column, other: Column) -> Column:
    """(section, paragraph) numbers whose hashes differ between two trees."""
    def paragraphs(nodes: Column) -> Column:
        return F.flatten(
            F.transform(
                nodes,
                lambda section, i: F.transform(
                    section,
                    lambda leaf, j: F.struct(
                        i.alias("section"), j.alias("paragraph"), parent(leaf).alias("hash")
                    ),
                ),
            )
        )

    mine, theirs = paragraphs(one), paragraphs(other)
    changed = F.array_union(F.array_except(mine, theirs), F.array_except(theirs, mine))
    places = F.transform(changed, lambda x: F.struct(x["section"].alias("section"), x["paragraph"].alias("paragraph")))
    return F.array_sort(F.array_distinct(places))


def with_next(docs: DataFrame, key: str, order: Sequence[str], wanted: Column, name: str) -> DataFrame:
    """Adds ``name``: ``wanted`` of the next row by ``order``; of the first row after the last.

    ``key`` is a long and leads the order. Rows move once, dealt to ranges of the key; each
    range also gets the rows that share the first key of the range after it.
    """
    spark = docs.sparkSession
    ranges = min(MOST_RANGES, 4 * partitions(spark))
    shares = [i / ranges for i in range(1, ranges)]
    limits = docs.agg(F.approx_percentile(q(key), shares, 20 * ranges)).first()[0] or []
    limits = sorted(set(limits))
    part, after, ahead = fresh(docs, "part"), fresh(docs, "after"), fresh(docs, "ahead")
    place = F.coalesce(below(limits, q(key)), F.lit(0))
    least = F.min(F.struct(q(key).isNotNull().alias("real"), q(key).alias("key")))
    found = docs.groupBy(place.alias("p")).agg(least.alias("least")).collect()
    starts = sorted((x.p, x.least.real, x.least.key) for x in found)
    before = dict(zip([x[0] for x in starts], [x[0] for x in starts[-1:] + starts[:-1]], strict=True))
    pairs = [F.lit(x) for item in before.items() for x in item]
    first = [k for _, real, k in starts if real]
    is_first = q(key).isin(first) if first else F.lit(False)
    if any(not real for _, real, _ in starts):
        is_first = (is_first & (place != starts[0][0])) | q(key).isNull()
    once = F.struct(F.lit(False).alias("a"), place.alias("p"))
    if starts:
        previous = F.try_element_at(F.create_map(*pairs), place)
        again = F.struct(F.lit(True).alias("a"), previous.alias("p"))
        copies = F.when(is_first, F.array(once, again)).otherwise(F.array(once))
    else:
        copies = F.array(once)
    dealt = docs.withColumn(ahead, F.explode(copies)).withColumns(
        {part: q(ahead)["p"], after: q(ahead)["a"]}
    )
    by = Window.partitionBy(part).orderBy(after, *[q(x).asc_nulls_first() for x in order])
    return dealt.withColumn(name, F.lead(wanted).over(by)).where(~q(after)).drop(part, after, ahead)


def below(limits: list[int], value: Column) -> Column:
    """How many of the sorted limits are at most the value."""
    if not limits:
        return F.lit(0)
    table = F.array(*[F.lit(int(x)) for x in limits])
    steps = max(1, math.ceil(math.log2(len(limits) + 1)))

    def halve(span: Column, _: Column) -> Column:
        low, high = span["low"], span["high"]
        middle = F.floor((low + high) / 2).cast("int")
        right = (low < high) & (F.get(table, middle) <= value)
        return F.struct(
            F.when(right, middle + 1).otherwise(low).alias("low"),
            F.when(right | (low >= high), high).otherwise(middle).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(limits)).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda span: span["low"])


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of an edit of it, and how alike they are.

    The edit replaces the last floor(n_chars / 4) code points by the first as many (or all)
    of the next document by key; after the last comes the first, a single document is its
    own next. Returns key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. Keys are longs; null keys come first, rows with equal keys are
    ordered by their text. Null texts count as empty. An empty table gives no rows.
    """
    slim = docs.select(q(key).cast("long").alias("key"), F.coalesce(q(text), F.lit("")).alias("text"))
    paired = with_next(slim, "key", ["key", "text"], F.col("text"), "next")
    length = F.length("text")
    cut = F.floor(length / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), length - cut), F.substring("next", F.lit(1), cut)
    )
    ready = paired.withColumn("edited", edited)
    trees = ready.select(
        "key",
        length.cast("long").alias("n_chars"),
        "text",
        "edited",
        F.sha2("edited", 256).alias("edited_sha256"),
        tree(F.col("text")).alias("own"),
        tree(F.col("edited")).alias("other"),
        leaves(tree(F.col("next"))).alias("next_leaves"),
    ).select(
        "key",
        "n_chars",
        "edited_sha256",
        root(F.col("own"), F.col("text")).alias("fingerprint"),
        root(F.col("other"), F.col("edited")).alias("edited_fingerprint"),
        leaves(F.col("own")).alias("own_leaves"),
        leaves(F.col("other")).alias("edited_leaves"),
        "next_leaves",
    )
    return trees.select(
        F.col("key").alias(key),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("own_leaves"), F.col("edited_leaves")).alias("near_edited"),
        likeness(F.col("own_leaves"), F.col("next_leaves")).alias("near_next"),
    )
