"""Encoding text to token ids and decoding ids to text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tokenloom.functions import text as tx
from tokenloom.functions.arrays import bind
from tokenloom.functions.merging import (
    WordEncoder,
    block_words,
    merged_bytes,
    packed_ids,
    spelled,
    word_ids,
)
from tokenloom.operators import pairs as pr
from tokenloom.operators.joins import spread_left_join
from tokenloom.operators.pretokens import pretoken_counts
from tokenloom.operators.training import BpeModel
from tokenloom.session import materialize

MAX_VOCAB = 2_000_000
PLANS = ("map", "inline", "words")
IN_BLOCK = ("block", "places", "first", "fresh")
# Bytes that cannot occur in UTF-8 text.
NEVER_IN_TEXT = {0xC0, 0xC1, *range(0xF5, 0x100)}


class Codec:
    """A vocabulary and ranked merges, ready to be put into expressions.

    Where two tokens spell the same bytes the greater id is used. Merges are
    keyed by the ids of their halves; a repeated pair keeps its last rank.
    """

    def __init__(
        self,
        tokens: Iterable[tuple[int, bytes]],
        merges: Iterable[tuple[bytes, bytes]],
        specials: Sequence[str] = (),
        end_of_text: str | None = None,
        oov: str = "error",
        unknown_id: int | None = None,
    ):
        if oov not in {"error", "drop", "unk"}:
            raise ValueError("oov must be 'error', 'drop' or 'unk'")
        self.bytes_of = dict(tokens)
        if len(self.bytes_of) > MAX_VOCAB:
            raise ValueError(f"more than {MAX_VOCAB} tokens")
        self.id_of: dict[bytes, int] = {}
        for token_id in sorted(self.bytes_of):
            self.id_of[self.bytes_of[token_id]] = token_id
        self.specials = tx.longest_first(specials)
        chosen = end_of_text or (self.specials[0] if self.specials else None)
        self.end_id = None if chosen is None else self.id_of[chosen.encode("utf-8")]
        self.oov, self.unknown_id = oov, unknown_id
        ranked, by_bytes = {}, {}
        for rank, (left, right) in enumerate(merges):
            ranked[self._code(left) + self._code(right)] = (rank, left, right)
            by_bytes[left, right] = rank
        ordered = sorted(ranked.items(), key=lambda item: item[1][0])
        self.steps = [(pair, self._code(left + right)) for pair, (_, left, right) in ordered]
        self.in_rank_order = self._halves_come_first()
        self.encoder = WordEncoder(
            by_bytes, self.id_of, oov, unknown_id if oov == "unk" else None
        )
        self.whole = [
            (token, self._code(token))
            for token in self.id_of
            if len(token) > 1 and len(merged_bytes(token, by_bytes)) > 1
        ]

    @classmethod
    def from_model(cls, model: BpeModel, **options) -> Codec:
        tokens = model.tokens
        merges = [(tokens[left], tokens[right]) for left, right in model.merges]
        return cls(enumerate(tokens), merges, model.specials, **options)

    @classmethod
    def from_frames(
        cls, vocab: DataFrame, merges: DataFrame, specials: Sequence[str] = (), **options
    ) -> Codec:
        """From (token_id, token_bytes) and (rank, left_bytes, right_bytes) tables."""
        rows = vocab.select("token_id", "token_bytes").limit(MAX_VOCAB + 1).collect()
        columns = ["rank", "left_bytes", "right_bytes"]
        ranked = merges.select(*columns).orderBy("rank").limit(MAX_VOCAB + 1).collect()
        if len(ranked) > MAX_VOCAB:
            raise ValueError(f"more than {MAX_VOCAB} merges")
        return cls(
            [(row["token_id"], bytes(row["token_bytes"])) for row in rows],
            [(bytes(row["left_bytes"]), bytes(row["right_bytes"])) for row in ranked],
            specials,
            **options,
        )

    def _code(self, token: bytes) -> str:
        if len(token) == 1:
            return chr(token[0])
        return tx.symbol(256 + self.id_of[token])

    def _halves_come_first(self) -> bool:
        last_made = {new: rank for rank, (_, new) in enumerate(self.steps)}
        return all(
            last_made.get(half, -1) < rank
            for rank, (pair, _) in enumerate(self.steps)
            for half in pair
        )

    @property
    def size(self) -> int:
        return len(self.bytes_of)

    @property
    def missing_bytes(self) -> str:
        return "".join(
            chr(b)
            for b in range(256)
            if bytes([b]) not in self.id_of and b not in NEVER_IN_TEXT
        )

    def fold(self, lifted: Column) -> Column:
        """All merges in rank order over a lifted string."""
        if not self.steps:
            return lifted
        packed = F.lit(pr.packed_steps(self.steps))
        pairs = F.regexp_extract_all(packed, F.lit("(?s)(..)."), F.lit(1))
        symbols = F.regexp_extract_all(packed, F.lit("(?s)..(.)"), F.lit(1))
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(len(self.steps) - 1)),
            lifted,
            lambda s, i: F.replace(s, F.get(pairs, i), F.get(symbols, i)),
        )

    def drop_missing(self, lifted: Column) -> Column:
        if self.oov == "drop" and self.missing_bytes:
            return F.translate(lifted, self.missing_bytes, "")
        return lifted

    def ids(self, symbols: Column) -> Column:
        """Token ids of a string of symbols."""
        by_byte = F.array(
            *[F.lit(self.id_of.get(bytes([b]))).cast("int") for b in range(256)]
        )
        if self.oov == "unk":
            absent = F.lit(self.unknown_id).cast("int")
        else:
            absent = F.raise_error(F.lit("byte without a token")).cast("int")

        plain = 256 + max(self.bytes_of, default=0) < 0xD800

        def one(character: Column) -> Column:
            code = F.ascii(character) if plain else tx.symbol_code(character)
            return F.when(code >= 256, code - 256).otherwise(
                F.coalesce(F.get(by_byte, code), absent)
            )

        return F.transform(tx.characters(symbols), one)


def encode_inline(
    df: DataFrame,
    codec: Codec,
    text: str = "text",
    out: str = "tokens",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """(keep..., token ids) of a text column without moving any row.

    The whole text becomes one string of symbols with a boundary around every
    pretoken, so no merge can cross one, and each merge is one ``replace``.
    """
    if not codec.in_rank_order:
        raise ValueError("this merge list needs another plan")
    symbols = tx.bounded_join(tx.pretokens_with_specials(F.col(text), codec.specials))
    for token, code in codec.whole:
        edged = tx.BOUNDARY + token.decode("latin-1") + tx.BOUNDARY
        symbols = F.replace(symbols, F.lit(edged), F.lit(tx.BOUNDARY + code + tx.BOUNDARY))
    symbols = codec.drop_missing(symbols)
    ids = codec.ids(F.translate(codec.fold(symbols), tx.BOUNDARY, ""))
    empty = F.array().cast("array<int>")
    return df.select(*keep, F.coalesce(ids, empty).alias(out))


def encode_words(counts: DataFrame, codec: Codec) -> DataFrame:
    """Token ids of distinct pretokens: (pretoken, freq, tokens)."""
    return counts.select(
        "pretoken", "freq", word_ids(F.array("pretoken"), codec.encoder).alias("tokens")
    )


def encode_map(
    df: DataFrame,
    codec: Codec,
    text: str = "text",
    out: str = "tokens",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """(keep..., token ids) of a text column in one pass, without moving any row.

    Texts are split in the JVM; Arrow batches of pretokens are looked up in what the
    worker has merged before.
    """
    listed = tx.pretokens_with_specials(F.col(text), codec.specials)
    empty = F.array().cast("array<string>")
    ids = word_ids(F.coalesce(listed, empty), codec.encoder)
    return df.select(*keep, ids.alias(out))


def encode_by_words(
    df: DataFrame,
    codec: Codec,
    text: str = "text",
    out: str = "tokens",
    keep: Sequence[str] = ("doc_id",),
    **join_options,
) -> DataFrame:
    """(keep..., token ids) by encoding every distinct pretoken of the table once.

    For inputs where merging costs more than a shuffle. Rows are gathered into blocks that
    number their distinct pretokens; only these look for their ids. The most frequent ones get
    them by broadcast, the others by a shuffle that no frequent pretoken takes part in. Then
    the numbers of a block's rows, not the texts, meet the ids of its pretokens.
    """
    counts = pretoken_counts(df, text, specials=codec.specials)
    words = encode_words(counts, codec)
    words = materialize(words.select("pretoken", "freq", packed_ids(F.col("tokens")).alias("tokens")))
    listed = tx.pretokens_with_specials(F.col(text), codec.specials)
    empty = F.array().cast("array<string>")
    rows = df.select(
        *keep, F.coalesce(listed, empty).alias("_listed"), F.monotonically_increasing_id().alias("_row")
    )
    blocks = rows.select(*keep, block_words(F.col("_listed"), F.col("_row")).alias("_in"))
    numbered = materialize(blocks.select(*keep, *[F.col(f"_in.{x}").alias(f"_{x}") for x in IN_BLOCK]))
    fresh = numbered.select("_block", "_first", F.posexplode("_fresh").alias("_pos", "pretoken"))
    places = fresh.select("_block", (F.col("_first") + F.col("_pos")).alias("_number"), "pretoken")
    found = spread_left_join(
        places, words, ["pretoken"], "freq", F.struct("_block", "_number"), **join_options
    )
    ids = found.select(F.col("_block").alias("_of"), "_number", "tokens").groupBy("_of")

    def spell(key, block: pa.Table, known: pa.Table) -> pa.Table:
        numbers, tokens = known["_number"].to_numpy(), known["tokens"].combine_chunks()
        lists = spelled(block["_places"].combine_chunks(), numbers, tokens)
        return block.select(list(keep)).append_column(out, lists)

    kept = [field for field in numbered.schema if field.name in set(keep)]
    schema = T.StructType([*kept, T.StructField(out, T.ArrayType(T.IntegerType()))])
    met = numbered.select(*keep, "_block", "_places").groupBy("_block").cogroup(ids)
    return met.applyInArrow(spell, schema).select(*keep, out)


def encode_corpus(
    df: DataFrame,
    codec: Codec,
    text: str = "text",
    out: str = "tokens",
    keep: Sequence[str] = ("doc_id",),
    plan: str = "map",
) -> DataFrame:
    """Token ids per row. All plans give the same ids: ``map`` looks pretokens up in one
    pass, ``inline`` rewrites short rank-ordered lists in the JVM, ``words`` merges every
    distinct pretoken of the table once."""
    if plan not in PLANS:
        raise ValueError(f"plan must be one of {PLANS}")
    chosen = {"map": encode_map, "inline": encode_inline, "words": encode_by_words}[plan]
    return chosen(df, codec, text, out, keep)


def decode_tokens(
    df: DataFrame,
    codec: Codec,
    tokens: str = "tokens",
    out: str = "decoded",
    unknown: str = "error",
    strict: bool = False,
) -> DataFrame:
    """Text of an id array: bytes are joined first, then decoded once per row.

    Malformed bytes become U+FFFD, or an error when ``strict``. An id without a
    token is an error, or makes the text null with ``unknown='null'``.
    """
    if unknown not in {"error", "null"}:
        raise ValueError("unknown must be 'error' or 'null'")
    gap, edge = chr(0x101), chr(0x100)
    top = max(codec.bytes_of, default=-1)
    listed = [
        codec.bytes_of[i].decode("latin-1") if i in codec.bytes_of else gap for i in range(top + 1)
    ]
    table = F.split(F.lit(edge.join(listed)), edge)
    joined = F.array_join(F.transform(tokens, lambda i: F.get(table, i)), "", gap)
    if unknown == "error":
        failed = F.raise_error(F.lit("token id without a token")).cast("string")
    else:
        failed = F.lit(None).cast("string")
    data = tx.unlift(bind(joined, lambda text: F.when(text.contains(gap), failed).otherwise(text)))
    decoded = F.decode(data, "UTF-8") if strict else tx.lenient_text(data)
    return df.withColumn(out, decoded)


def roundtrip_check(
    df: DataFrame, codec: Codec, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row: how many rows were checked and how many came back different."""
    back = decode_tokens(encode_corpus(df, codec, text, keep=(key,)), codec).join(
        df.select(key, text), key
    )
    changed = F.col("decoded") != F.col(text)
    return back.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(changed).alias("n_changed")
    )


def token_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(token_id, n) over an id-array column."""
    return (
        df.select(F.explode(tokens).alias("token_id"))
        .groupBy("token_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def delimiter_check(df: DataFrame, codec: Codec, delimiter: str = tx.END_OF_TEXT) -> DataFrame:
    """Delimiter ids against delimiter texts in the decoded rows: one row."""
    decoded = decode_tokens(df, codec)
    per_row = decoded.select(
        F.size(F.filter("tokens", lambda t: t == F.lit(codec.end_id))).alias("ids"),
        F.regexp_count("decoded", F.lit(tx.quoted(delimiter))).alias("texts"),
    )
    return per_row.agg(
        F.sum("ids").cast("bigint").alias("n_ids"),
        F.sum("texts").cast("bigint").alias("n_texts"),
        ((F.sum("ids") > 0) & (F.sum("ids") == F.sum("texts"))).alias("ok"),
    )


def compression_stats(
    df: DataFrame, by: Sequence[str] = (), text: str = "text", tokens: str = "tokens"
) -> DataFrame:
    """Bytes, tokens, bytes per token and the ratio against 2-byte ids, per group."""
    sizes = df.select(
        *by,
        F.octet_length(text).cast("bigint").alias("b"),
        F.size(tokens).cast("bigint").alias("t"),
    )
    return sizes.groupBy(*by).agg(
        F.sum("b").alias("n_bytes"),
        F.sum("t").alias("n_tokens"),
        (F.sum("b") / F.sum("t")).alias("bytes_per_token"),
        (F.sum("b") / (F.sum("t") * 2)).alias("uint16_ratio"),
    )


def word_compression(counts: DataFrame, codec: Codec, by: Sequence[str] = ()) -> DataFrame:
    """Token totals from pretoken counts alone, in one pass over them."""
    ids = word_ids(F.array("pretoken"), codec.encoder)
    sized = counts.select(*by, "freq", F.octet_length("pretoken").alias("b"), F.size(ids).alias("t"))
    return sized.groupBy(*by).agg(
        F.sum(F.col("freq") * F.col("b")).alias("n_bytes"),
        F.sum(F.col("freq") * F.col("t")).alias("n_tokens"),
    )
