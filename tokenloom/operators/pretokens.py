"""Pretoken jobs: splitting, counting, spans, occurrences, look-ups."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tokenloom.functions import arrays, text as tx
from tokenloom.functions.merging import dealt

#: Rows of a batch of occurrences; what stands between pretokens and in none of them.
FOUND_ROWS, PARTED = 1 << 18, chr(256)


def split_special(
    df: DataFrame, specials: Sequence[str], text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """One row per segment: (keep..., seg_pos, segment, is_special)."""
    parts = tx.segments(F.col(text), specials)
    return df.select(*keep, F.posexplode(parts).alias("seg_pos", "part")).select(
        *keep, "seg_pos", "part.segment", "part.is_special"
    )


def pretokenize(
    df: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    specials: Sequence[str] = (),
) -> DataFrame:
    """One row per pretoken: (keep..., pos, pretoken)."""
    words = tx.pretokens_with_specials(F.col(text), specials)
    return df.select(*keep, F.posexplode(words).alias("pos", "pretoken"))


def pretoken_counts(
    df: DataFrame,
    text: str = "text",
    by: Sequence[str] = (),
    specials: Sequence[str] = (),
) -> DataFrame:
    """Multiset of pretokens, (by..., pretoken, freq); counted map-side first."""
    words = tx.pretokens_with_specials(F.col(text), specials)
    return (
        df.select(*by, F.explode(words).alias("pretoken"))
        .groupBy(*by, "pretoken")
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def min_bytes(df: DataFrame, least: int = 2, pretoken: str = "pretoken") -> DataFrame:
    """Drop pretokens shorter than ``least`` bytes."""
    return df.where(F.octet_length(pretoken) >= least)


def explode_bytes(df: DataFrame, keep: Sequence[str], pretoken: str = "pretoken") -> DataFrame:
    """One row per byte: (keep..., byte_pos, byte)."""
    values = F.transform(tx.characters(tx.lift(F.col(pretoken))), lambda c: F.ascii(c))
    return df.select(*keep, F.posexplode(values).alias("byte_pos", "byte"))


def in_vocab_filter(lifted: Column, known_bytes: Sequence[int]) -> Column:
    """Delete the bytes that have no token from a lifted string."""
    missing = "".join(chr(b) for b in range(256) if b not in set(known_bytes))
    return F.translate(lifted, missing, "") if missing else lifted


def pretoken_spans(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    least: int = 1,
    specials: Sequence[str] = (),
) -> DataFrame:
    """Byte span of every pretoken: (key, pos, pretoken, start, end).

    Ends are prefix sums inside the row, so the job needs no shuffle.
    """
    words = df.select(key, tx.pretokens_with_specials(F.col(text), specials).alias("words"))
    lengths = F.transform("words", lambda w: F.octet_length(w).cast("bigint"))
    ends = arrays.prefix_sums(lengths, F.lit(0).cast("bigint"))
    rows = words.select(key, F.arrays_zip(F.col("words"), ends.alias("ends")).alias("rows"))
    # The outer form keeps Spark from evaluating the array again in a size filter.
    exploded = rows.select(key, F.posexplode_outer("rows").alias("pos", "row"))
    spans = exploded.where(F.col("pos").isNotNull()).select(
        key,
        "pos",
        F.col("row.words").alias("pretoken"),
        (F.col("row.ends") - F.octet_length("row.words")).alias("start"),
        F.col("row.ends").alias("end"),
    )
    return min_bytes(spans, least) if least > 1 else spans


def find_occurrences(
    spans: DataFrame, needle: str, merged: DataFrame | None = None, key: str = "doc_id"
) -> DataFrame:
    """Every overlapping occurrence of a byte string inside pretoken spans.

    ``needle`` is lifted. Occurrences that begin or end inside a region listed in
    ``merged`` (key, offset) are dropped.
    """
    lifted = tx.lift(F.col("pretoken"))
    found = (
        spans.where(lifted.contains(F.lit(needle)))
        .select(
            key,
            "pos",
            "start",
            F.explode(tx.overlapping_offsets(lifted, needle)).alias("inner"),
        )
        .select(key, "pos", (F.col("start") + F.col("inner")).alias("offset"))
    )
    if merged is None:
        return found
    taken = merged.select(F.col(key), F.col("offset").alias("_taken"))
    for edge in (F.col("offset"), F.col("offset") + len(needle)):
        found = (
            found.withColumn("_taken", edge).join(taken, [key, "_taken"], "left_anti").drop("_taken")
        )
    return found


class Needles:
    """Byte strings to search for, all at once."""

    def __init__(self, needles: Sequence[bytes]):
        if not all(needles):
            raise ValueError("byte strings must not be empty")
        places: dict[str, list[int]] = {}
        for place, needle in enumerate(needles):
            places.setdefault(bytes(needle).decode("latin-1"), []).append(place)
        self.lifted = list(places)
        self.lengths = np.array([len(needle) for needle in places], np.int64)
        self.many = np.array([len(own) for own in places.values()], np.int64)
        self.places = np.array([place for own in places.values() for place in own], np.int64)
        self.automaton = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "automaton": None}

    def hits(self, pretokens: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(offset, place) of what the pretokens hold, and how many each holds.

        They are searched as one text, with a character between them that is no byte.
        """
        if not self.lifted:
            return np.zeros((0, 2), np.int64), np.zeros(len(pretokens), np.int64)
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for number, needle in enumerate(self.lifted):
                self.automaton.add_word(needle, number)
            self.automaton.make_automaton()
        words = [word.encode().decode("latin-1") for word in pretokens]
        ends = np.cumsum([0, *(len(word) + 1 for word in words)])
        found = chain.from_iterable(self.automaton.iter(PARTED.join(words)))
        last, number = np.fromiter(found, np.int64).reshape(-1, 2).T
        owner = np.searchsorted(ends, last, "right") - 1
        places, _ = dealt(self.places, self.many, number)
        inner = np.repeat(last + 1 - self.lengths[number] - ends[owner], self.many[number])
        owner = np.repeat(owner, self.many[number])
        return np.stack([inner, places], axis=1), np.bincount(owner, minlength=len(words))


def find_all_occurrences(
    spans: DataFrame, needles: Sequence[bytes], key: str = "doc_id"
) -> DataFrame:
    """Every occurrence of many byte strings inside pretoken spans, in one pass.

    (key, pos, offset, needle): ``needle`` is the place of the string in ``needles``,
    ``offset`` the byte where it begins. One automaton over bytes serves all strings, so the
    cost is that of the text and of what is found; overlaps are kept. The strings are
    bounded by a vocabulary; empty ones are refused, equal ones found under each place.
    """
    searched = Needles(needles)
    rows = spans.select(F.col(key).alias("key"), "pos", "start", "pretoken")
    schema = T.StructType(
        [
            rows.schema["key"],
            rows.schema["pos"],
            T.StructField("offset", T.LongType()),
            T.StructField("needle", T.IntegerType()),
        ]
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # the distinct pretokens are searched; what they hold is dealt out to their rows
            coded = batch.column(3).dictionary_encode()
            flat, sizes = searched.hits(coded.dictionary.to_pylist())
            kinds, starts = coded.indices.to_numpy(), batch.column(2).to_numpy()
            upto = np.cumsum(sizes[kinds])
            first = 0
            while first < len(kinds):
                # rows that bring FOUND_ROWS occurrences, one row at least
                before = upto[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(upto, before + FOUND_ROWS, "right")))
                found, ends = dealt(flat, sizes, kinds[first:last])
                at = np.repeat(np.arange(first, last), np.diff(ends))
                if len(at):
                    yield handed(batch, at, starts[at] + found[:, 0], found[:, 1])
                first = last

    def handed(batch: pa.RecordBatch, at: np.ndarray, offsets: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
        rows = pa.array(at, pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(rows),
                batch.column(1).take(rows),
                pa.array(offsets, pa.int64()),
                pa.array(found.astype(np.int32)),
            ],
            names=["key", "pos", "offset", "needle"],
        )

    return rows.mapInArrow(find, schema).withColumnRenamed("key", key)


def pretokens_at(spans: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """The spans whose (key, pos) is listed in ``wanted``."""
    return spans.join(wanted.select(key, "pos"), [key, "pos"], "left_semi")
