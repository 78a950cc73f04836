"""Byte-level BPE encoding and decoding by backtracking over longest matches.

A list of tokens is the encoding of a text exactly if every token, and every two adjacent
tokens, are the encoding of their own bytes: merges happen in order of rank, so none ever
crosses a place that it does not cross for the two tokens beside it. The encoder therefore
takes the longest token at each place (found by an automaton over bytes mapped to Latin-1),
shortens it until it goes with the token before, and steps back where none does. The
tokens before a place are unique, so a place that failed once is never tried again.
"""

import base64
import functools
import itertools
import re
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from tokenloom.llm.frames import q, slices

#: Bytes of text encoded at once; ids per batch decoded; pieces of a text held at once.
BATCH_BYTES, BATCH_IDS, BATCH_PIECES = 1 << 20, 1 << 18, 1 << 16
#: Bytes of remembered pieces, remembered token pairs, longest remembered piece.
KEPT_BYTES, KEPT_PAIRS, KEPT_PIECE = 96 << 20, 1 << 19, 64
NONE = -1
#: A match of the public pattern always ends before a single space between two other
#: characters, and the next one begins with it; other patterns are not cut there.
SPACES = [c for c in map(chr, range(0x3001)) if c.isspace()]
SINGLE_SPACE = re.compile(r" (?<=\S )(?=\S)")


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of every token of a rank file: base64 bytes and rank, one token a line."""
    ranks = {}
    with open(path, "rb") as file:
        for line in file:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return ranks


def merged(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids by the definition: merge the leftmost adjacent pair of the least rank, repeat."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while True:
        best = min(
            ((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks),
            default=None,
        )
        if best is None:
            return [ranks[part] for part in parts]
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


class Learned(dict):
    """A dictionary whose missing values are made, and kept, by a function."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, name: str) -> bytes:
        return self.make(name)


class ByteCodec:
    """Encoder and decoder of a rank file; texts are split by ``pattern`` first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a token: {missing[:5]}")
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.many = max(ranks.values()) + 1
        #: Length of each token less one: from its first byte to its last.
        self.size = [0] * self.many
        for token, rank in ranks.items():
            self.size[rank] = len(token) - 1
        #: The longest token that begins each token and is shorter; ``NONE`` after one byte.
        self.shorter = [NONE] * self.many
        for token, rank in ranks.items():
            shorter = (ranks.get(token[:n], NONE) for n in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((x for x in shorter if x != NONE), NONE)
        #: Per left token (the last row: none) what is known of right ones.
        self.pairs: list[dict[int, bool]] = [{} for _ in range(self.many + 1)]
        self.known_pairs = 0
        self.pieces: dict[str, bytes] = {}
        self.words = Learned(self.spaced)
        self.kept = 0
        self.known_id = np.zeros(self.many, bool)
        self.known_id[list(ranks.values())] = True
        self.lengths = np.array(self.size, np.int64) + 1
        self.starts = np.zeros(self.many, np.int64)
        held = sorted(ranks.items(), key=lambda x: x[1])
        self.starts[[rank for _, rank in held]] = np.cumsum([0, *(len(x) for x, _ in held[:-1])])
        self.all_bytes = np.frombuffer(b"".join(x for x, _ in held), np.uint8)
        self.by_space = pattern == public_tokenizers.PATTERN

    def together(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are the encoding of their bytes; remembered.

        Without a token on the left (``NONE``): whether a token is that of its own bytes.
        """
        if self.known_pairs >= KEPT_PAIRS:
            for row in self.pairs:
                row.clear()
            self.known_pairs = 0
        pair = [x for x in (left, right) if x != NONE]
        found = merged(b"".join(map(self.bytes_of.__getitem__, pair)), self.ranks) == pair
        self.pairs[left][right] = found
        self.known_pairs += 1
        return found

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one match of the pattern."""
        data = piece.encode()
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n, size, pairs, shorter = len(data), self.size, self.pairs, self.shorter
        longest = [NONE] * n
        for end, token in self.automaton.iter(data.decode("latin-1")):
            longest[end - size[token]] = token  # ends ascend, so the longest stays
        failed: set[int] = set()
        out: list[int] = []
        at, before, token = 0, NONE, longest[0]
        while True:
            row = pairs[before]
            while token != NONE:
                end = at + size[token] + 1
                if end not in failed:
                    fits = row.get(token)
                    if fits or (fits is None and self.together(before, token)):
                        break
                token = shorter[token]
            if token != NONE:
                out.append(token)
                if end == n:
                    return out
                at, before, token = end, token, longest[end]
            else:
                # no token goes on from here: the one before must be shorter
                failed.add(at)
                token = shorter[out.pop()]
                at -= size[before] + 1
                before = out[-1] if out else NONE

    def remember(self, known: dict[str, bytes], name: str, ids: bytes) -> bytes:
        """Keep the ids of a short string within the budget of this worker."""
        if len(name) <= KEPT_PIECE:
            if self.kept > KEPT_BYTES:
                self.pieces.clear()
                self.words.clear()
                self.kept = 0
            known[name] = ids
            self.kept += 160 + len(name) + len(ids)
        return ids

    def ids_of(self, piece: str) -> bytes:
        """Ids of a match of the pattern as 32-bit numbers."""
        return self.remember(self.pieces, piece, array("i", self.encode_piece(piece)).tobytes())

    def pieces_of(self, text: str) -> bytes:
        """Ids of a text, match by match."""
        known, learn = self.pieces, self.ids_of
        if len(text) <= BATCH_BYTES:
            found = self.find.findall(text)
            if len(found) == 1:
                return array("i", self.encode_piece(text)).tobytes()
            return b"".join([known.get(x) or learn(x) for x in found])
        out = bytearray()
        matches = self.find.finditer(text)
        while held := [x.group() for x in itertools.islice(matches, BATCH_PIECES)]:
            out += b"".join([known.get(x) or learn(x) for x in held])
        return bytes(out)

    def spaced(self, word: str) -> bytes:
        """Ids of a word and the single space before it."""
        if word.isascii() and word.isalpha():
            found = array("i", self.encode_piece(" " + word)).tobytes()
        else:
            found = self.pieces_of(" " + word)
        return self.remember(self.words, word, found)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, each match of the pattern on its own, as 32-bit numbers."""
        if not self.by_space:
            return self.pieces_of(text)
        alone = not any(c in text and (" " + c in text or c + " " in text) for c in SPACES)
        first, *rest = text.split(" ") if alone else SINGLE_SPACE.split(text)
        return self.pieces_of(first) + b"".join(map(self.words.__getitem__, rest))

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a list of ids."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0)
        places += np.repeat(self.starts[ids] - ends + lengths, lengths)
        return self.all_bytes[places].tobytes()


@functools.lru_cache(2)
def byte_codec(path: str, pattern: str) -> ByteCodec:
    """One codec per worker, rank file and pattern."""
    return ByteCodec(read_ranks(path), pattern)


def encode_texts(
    docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Key and ``ids`` (array of int) of every whole text; a null text has no ids.

    No shuffle: one pass, batches cut by bytes. Repeated rows and null keys are encoded
    like any row, an empty table gives no rows, other columns are not read.
    """
    schema = T.StructType(
        [
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_codec(ranks, pattern)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for first, last in slices(sizes, BATCH_BYTES):
                found = [codec.encode(x or "") for x in texts[first:last].to_pylist()]
                ends = (np.cumsum([0, *map(len, found)]) // 4).astype(np.int32)
                ids = np.frombuffer(b"".join(found), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [keys[first:last], pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))],
                    names=["key", "ids"],
                )

    source = docs.select(q(key).alias("key"), q(text).cast("string").alias("text"))
    return source.mapInArrow(encode, schema).withColumnRenamed("key", key)


def decode_ids(encoded: DataFrame, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded`` (binary): the bytes that a list of ids stands for; null counts as none.

    All columns stay; an id that the rank file does not hold fails. ``decoded`` must be a
    free name.
    """
    if "decoded" in {x.lower() for x in encoded.columns}:
        raise ValueError("the table already has a column 'decoded'")
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    place = encoded.columns.index(ids)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_codec(ranks, pattern)
        for batch in batches:
            lists = batch.column(place)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_pylist()
            for first, last in slices(sizes, BATCH_IDS):
                part = batch.slice(first, last - first)
                ids = pc.list_flatten(part.column(place)).to_numpy(zero_copy_only=False)
                if len(ids) and not (codec.known_id[np.clip(ids, 0, codec.many - 1)] & (ids >= 0) & (ids < codec.many)).all():
                    raise ValueError("an id without a token")
                data = codec.decode(ids)
                ends = np.cumsum([0, *sizes[first:last]])
                at = np.concatenate([[0], np.cumsum(codec.lengths[ids])])[ends]
                decoded = pa.Array.from_buffers(
                    pa.large_binary(), last - first, [None, pa.py_buffer(at), pa.py_buffer(data)]
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, decoded.cast(pa.binary())], names=schema.names
                )

    return encoded.mapInArrow(decode, schema)


def coding_digests(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 of every text."""
    coded = decode_ids(encode_texts(docs, ranks, pattern, key, text), ranks, pattern)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        q(key),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
