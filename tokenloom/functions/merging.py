"""Byte-pair merging of one pretoken, and an Arrow column function over lists of them."""

import heapq
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

#: Pretokens kept per worker and their longest; pretokens encoded at once; up to so many
#: parts are searched anew for every merge; up to so many parts all pairs have a table.
KEPT, LETTERS, AT_ONCE, SHORT, DENSE = 100_000, 64, 1 << 16, 64, 1024
#: A block of rows holds about so many pretokens, letters of distinct ones and rows at most.
BLOCK_PLACES, BLOCK_LETTERS, BLOCK_ROWS = 1 << 21, 1 << 23, 1 << 16


def merge_pairs(parts: list[bytes], ranks: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    """Merge the lowest-ranked adjacent pair everywhere, left to right, until none is left."""
    if len(parts) > SHORT:
        return merge_long(parts, ranks)
    get = ranks.get
    none = len(ranks)
    while len(parts) > 1:
        found = [get(pair, none) for pair in zip(parts, parts[1:])]
        low = min(found)
        if low == none:
            break
        merged, i = [], 0
        while i < len(parts):
            if i < len(found) and found[i] == low:
                merged.append(parts[i] + parts[i + 1])
                i += 2
            else:
                merged.append(parts[i])
                i += 1
        parts = merged
    return parts


def merge_long(parts: list[bytes], ranks: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    """The same with a heap of places over a linked list: length times its logarithm."""
    after = [*range(1, len(parts)), -1]
    before = [-1, *range(len(parts) - 1)]
    heap = [(ranks[pair], i) for i, pair in enumerate(zip(parts, parts[1:])) if pair in ranks]
    heapq.heapify(heap)
    gone = b""
    while heap:
        low = heap[0][0]
        fresh = set()
        while heap and heap[0][0] == low:
            i = heapq.heappop(heap)[1]
            j = after[i]
            if parts[i] == gone or j < 0 or ranks.get((parts[i], parts[j])) != low:
                continue
            parts[i] += parts[j]
            parts[j] = gone
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            fresh |= {before[i], i}
        for i in fresh:
            if i >= 0 and parts[i] != gone and after[i] >= 0:
                rank = ranks.get((parts[i], parts[after[i]]))
                if rank is not None:
                    heapq.heappush(heap, (rank, i))
    return [part for part in parts if part != gone]


class Merges:
    """Merges many short words at once: a round does the next merge of every word."""

    def __init__(self, ranks: dict[tuple[bytes, bytes], int]):
        number = {bytes([b]): b for b in range(256)}
        for left, right in ranks:
            for part in (left, right, left + right):
                number.setdefault(part, len(number))
        self.parts = list(number)
        self.none = len(ranks)
        self.end = max(self.none, *ranks.values(), 0) + 1
        coded = sorted(
            (number[left] * len(number) + number[right], rank, number[left + right])
            for (left, right), rank in ranks.items()
        )
        # what no pair reaches ends the list, so every search has an answer
        coded.append((len(number) ** 2, self.none, 0))
        self.codes, self.rank, self.made = np.array(coded, np.int64).T.copy()
        self.place = None
        if len(number) <= DENSE:
            self.place = np.full(len(number) ** 2, len(coded) - 1, np.int32)
            self.place[self.codes[:-1]] = np.arange(len(coded) - 1)

    def places(self, symbols: np.ndarray) -> np.ndarray:
        """Of every symbol and the next one, the place of their pair among all pairs."""
        codes = symbols[:-1] * len(self.parts) + symbols[1:]
        if self.place is not None:
            return self.place[codes]
        found = np.searchsorted(self.codes, codes)
        return np.where(self.codes[found] == codes, found, len(self.codes) - 1)

    def apply(
        self, words: Sequence[bytes], drop: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the parts of all words, one word after the other, and how many each has.

        Bytes marked in ``drop`` are left out first. As one at a time, the lowest rank of a
        word is merged everywhere in it, left to right.
        """
        symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(words)), [len(word) for word in words])
        if drop is not None:
            kept = ~drop[symbols]
            symbols, owner = symbols[kept], owner[kept]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            inside = owner[:-1] == owner[1:]
            place = self.places(symbols)
            rank = np.append(np.where(inside, self.rank[place], self.end), self.end)
            begins = np.flatnonzero(np.concatenate([[True], ~inside]))
            low = np.repeat(
                np.minimum.reduceat(rank, begins), np.diff(np.append(begins, len(symbols)))
            )
            open_ = (low != self.none) & (low != self.end)
            done.append((owner[~open_], symbols[~open_]))
            hit = open_ & (rank == low)
            # of hits in a row every other one counts
            line = np.arange(len(symbols))
            hit &= (line - np.maximum.accumulate(np.where(hit, -1, line))) % 2 == 1
            at = np.flatnonzero(hit)
            symbols[at] = self.made[place[at]]
            open_[at + 1] = False
            symbols, owner = symbols[open_], owner[open_]
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        owner, symbols = (np.concatenate(x) for x in zip(*done))
        return symbols[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


class WordEncoder:
    """Ids of pretokens; equal ones are merged once per worker."""

    def __init__(
        self,
        ranks: dict[tuple[bytes, bytes], int],
        id_of: dict[bytes, int],
        oov: str,
        unknown_id: int | None,
    ):
        self.ranks, self.id_of, self.oov, self.unknown_id = ranks, id_of, oov, unknown_id
        self.known: dict[str, bytes] = {}
        self.merges, self.ids, self.lacking = None, None, None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "known": {}, "merges": None, "ids": None, "lacking": None}

    def encode(self, word: str) -> bytes:
        """A pretoken that is a token as it stands is that token; else its bytes are merged."""
        data = word.encode()
        whole = self.id_of.get(data)
        if whole is not None:
            return struct.pack("<i", whole)
        parts = [data[i : i + 1] for i in range(len(data))]
        if self.oov == "drop":
            parts = [part for part in parts if part in self.id_of]
        ids = [self.id_of.get(part, self.unknown_id) for part in merge_pairs(parts, self.ranks)]
        if None in ids:
            raise ValueError("byte without a token")
        return struct.pack(f"<{len(ids)}i", *ids)

    def encode_all(self, words: Sequence[str]) -> list[bytes]:
        """The same for many words; the short ones that need merges are merged together."""
        out, at, parts = [], [], []
        for place, word in enumerate(words):
            data = word.encode()
            if len(data) > SHORT or data in self.id_of:
                out.append(self.encode(word))
            else:
                out.append(b"")
                at.append(place)
                parts.append(data)
        if not at:
            return out
        if self.merges is None:
            self.merges = Merges(self.ranks)
        merges = self.merges
        if self.ids is None:
            ids = [self.id_of.get(part, self.unknown_id) for part in merges.parts]
            self.lacking = np.array([x is None for x in ids])
            self.ids = np.array([0 if x is None else x for x in ids], "<i4")
        drop = None
        if self.oov == "drop":
            drop = np.array([bytes([b]) not in self.id_of for b in range(256)])
        symbols, sizes = merges.apply(parts, drop)
        if self.lacking[symbols].any():
            raise ValueError("byte without a token")
        data, ends = self.ids[symbols].tobytes(), (4 * np.cumsum(sizes)).tolist()
        for place, begin, end in zip(at, [0, *ends], ends):
            out[place] = data[begin:end]
        return out

    def pieces(self, batch: pa.ListArray) -> Iterator[pa.ListArray]:
        return pieces(batch)

    def lists(self, batch: pa.ListArray) -> pa.ListArray:
        """Lists of pretokens to lists of ids; null lists to empty ones.

        Python sees the distinct pretokens of the batch only; their ids are dealt out to the
        places by number.
        """
        coded = batch.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.known) > KEPT:
            self.known = {}
        known = self.known
        fresh = [word for word in words if word not in known]
        known.update(zip(fresh, self.encode_all(fresh)))
        spelled = list(map(known.__getitem__, words))
        for word in fresh:
            if len(word) > LETTERS:
                del known[word]
        found = np.frombuffer(b"".join(spelled), "<i4")
        values, ends = dealt(found, [len(ids) // 4 for ids in spelled], coded.indices.to_numpy())
        bounds = np.cumsum([0, *batch.value_lengths().fill_null(0).to_pylist()])
        return pa.ListArray.from_arrays(pa.array(ends[bounds], pa.int32()), pa.array(values, pa.int32()))


def pieces(batch: pa.ListArray) -> Iterator[pa.ListArray]:
    """The rows of a batch, so many at a time as hold ``AT_ONCE`` pretokens, one at least."""
    begin, held = 0, 0
    for row, size in enumerate(batch.value_lengths().fill_null(0).to_pylist()):
        if row > begin and held + size > AT_ONCE:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += size
    yield batch.slice(begin)


def dealt(flat: np.ndarray, sizes: Sequence[int], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``flat``, of these sizes, in the order ``at``; and where each ends, from 0 on."""
    sizes = np.array(sizes, np.int64)
    begins = np.cumsum(sizes) - sizes
    taken = sizes[at]
    ends = np.concatenate([[0], np.cumsum(taken)])
    return flat[np.arange(ends[-1]) + np.repeat(begins[at] - ends[:-1], taken)], ends


def packed(values: np.ndarray, sizes: Sequence[int]) -> pa.BinaryArray:
    """Runs of whole numbers from 0 on, of these sizes: seven bits a byte, low ones first."""
    values = values.astype(np.int64)
    widths = 1 + sum((values >= 1 << bits).astype(np.int64) for bits in (7, 14, 21, 28))
    ends = np.cumsum(widths)
    data = np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    for k in range(5):
        there = widths > k
        part = values[there] >> 7 * k & 127
        data[(ends - widths)[there] + k] = part | np.where(widths[there] > k + 1, 128, 0)
    bounds = np.concatenate([[0], ends])[np.cumsum([0, *sizes])].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def unpacked(runs: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all runs, one run after the other, and how many each has."""
    lengths = np.frombuffer(runs.buffers()[1], np.int32)[runs.offset : runs.offset + len(runs) + 1]
    data = np.frombuffer(runs.buffers()[2] or b"", np.uint8)[lengths[0] : lengths[-1]]
    last = data < 128
    ends = np.flatnonzero(last) + 1
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    values = np.zeros(len(ends), np.int64)
    for k in range(5):
        there = ends - begins > k
        values[there] |= (data[begins[there] + k] & 127).astype(np.int64) << 7 * k
    upto = np.concatenate([[0], np.cumsum(last)])[lengths - lengths[0]]
    return values, np.diff(upto)


def packed_ids(tokens: Column) -> Column:
    """Arrays of token ids as packed numbers."""

    @F.arrow_udf("binary")
    def pack(lists: pa.Array) -> pa.Array:
        return packed(lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_pylist())

    return pack(tokens)


class BlockWords:
    """Numbers the distinct pretokens of a block in the order they first appear."""

    def __init__(self, block: int):
        self.block, self.known = block, {}
        self.places = self.letters = self.rows = 0

    def has_room(self, rows: int, places: int) -> bool:
        most = (self.rows + rows <= BLOCK_ROWS) and (self.places + places <= BLOCK_PLACES)
        return self.rows == 0 or (most and self.letters <= BLOCK_LETTERS)

    def numbered(self, batch: pa.ListArray) -> pa.StructArray:
        """Of every row its block, the numbers of its pretokens, those that are new to the
        block, and the number of the first of them."""
        sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        coded = batch.flatten().dictionary_encode()
        indices = coded.indices.to_numpy()
        before = len(self.known)
        words = coded.dictionary.to_pylist()
        numbers = np.array([self.known.setdefault(word, len(self.known)) for word in words], np.int32)
        new = np.flatnonzero(numbers >= before)
        # a dictionary lists words as they first appear
        seen = np.flatnonzero(np.diff(np.maximum.accumulate(indices), prepend=-1))
        owner = np.searchsorted(np.cumsum(sizes), seen[new], "right")
        ends = np.cumsum([0, *np.bincount(owner, minlength=len(sizes))])
        self.rows += len(sizes)
        self.places += len(indices)
        self.letters += sum(len(words[i]) for i in new.tolist())
        columns = [
            pa.array(np.full(len(sizes), self.block)),
            packed(numbers[indices], sizes),
            pa.array(before + ends[:-1], pa.int32()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), coded.dictionary.take(pa.array(new))),
        ]
        return pa.StructArray.from_arrays(columns, names=["block", "places", "first", "fresh"])


def block_words(pretokens: Column, row: Column) -> Column:
    """Rows of a task gathered into blocks: (block, places, first, fresh) of each row.

    ``places`` are the packed numbers of its pretokens within the block, ``fresh`` those pretokens no
    earlier row of the block has; they are numbered from ``first`` on. ``row`` tells rows apart.
    """

    @F.arrow_udf("struct<block:bigint,places:binary,first:int,fresh:array<string>>")
    def number(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        block = None
        for lists, rows in batches:
            at = 0
            for piece in pieces(lists):
                if not len(piece):
                    continue
                places = sum(piece.value_lengths().fill_null(0).to_pylist())
                if block is None or not block.has_room(len(piece), places):
                    block = BlockWords(rows[at].as_py())
                yield block.numbered(piece)
                at += len(piece)

    return number(pretokens, row)


def spelled(places: pa.BinaryArray, numbers: np.ndarray, tokens: pa.BinaryArray) -> pa.ListArray:
    """Packed runs of numbers to lists of the ids that these numbers have, which are packed too."""
    if tokens.null_count:
        raise ValueError("pretoken without ids")
    flat, sizes = unpacked(tokens.take(pa.array(np.argsort(numbers))))
    at, lengths = unpacked(places)
    values, ends = dealt(flat.astype(np.int32), sizes, at)
    bounds = np.cumsum([0, *lengths])
    return pa.ListArray.from_arrays(pa.array(ends[bounds], pa.int32()), pa.array(values, pa.int32()))


def word_ids(pretokens: Column, encoder: WordEncoder) -> Column:
    """Token ids of an array of pretokens, in order."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            # Spark hands over whole batches; what is made of them at once stays small
            for piece in pieces(batch):
                yield encoder.lists(piece)

    return encode(pretokens)


def merged_bytes(token: bytes, ranks: dict[tuple[bytes, bytes], int]) -> Sequence[bytes]:
    """The parts a token's own bytes merge to."""
    return merge_pairs([token[i : i + 1] for i in range(len(token))], ranks)
