"""Spelling variants: words one edit apart, found by bidirectional FM-index search schemes.

A word and a near one share the first or the last half of the word exactly. Words are
therefore stored by their first and by their last halves, and each word asks the two
shards that hold its own. A shard is a bidirectional FM-index over its words between
delimiters. One half and its delimiter are matched exactly, from the middle outwards; then
the search turns and goes on across the other half with one error. All words of a shard
move through the index together.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tokenloom.llm.frames import drop_stash, q, slices, stash
from tokenloom.operators.joins import fits_broadcast

#: Runs of the contract once A-Z is lower-cased; distinct words a task holds before it
#: hands on their counts.
RUN = re.compile("[a-zÀ-ÿ]+")
HELD_WORDS, BATCH_BYTES = 200_000, 1 << 20
#: Letters aimed at per index, words that ask it at once, places between two rows of the
#: table of ranks.
INDEX_LETTERS, ASKING, GAP = 400_000, 8192, 16


def variant_runs(key: str, text: str, every: int = 31) -> Counter:
    """Runs of letters of a text, counted; those that ``every`` picks lose one letter."""
    out: Counter = Counter()
    for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
        h = zlib.crc32(f"{key}:{run}".encode())
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def word_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = 7, least: int = 2
) -> DataFrame:
    """(word, n): runs of letters of all whole texts, altered ones included, that occur often.

    Counted in the tasks first, so a frequent word is one row per task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def handed() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                names=["word", "n"],
            )
            held.clear()
            return found

        for batch in batches:
            keys, texts = batch.columns
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for first, last in slices(sizes, BATCH_BYTES):
                part = zip(keys[first:last].to_pylist(), texts[first:last].to_pylist(), strict=True)
                for name, value in part:
                    for word, n in variant_runs(name or "", value or "").items():
                        if len(word) >= least_letters:
                            held[word] += n
                if len(held) > HELD_WORDS:
                    yield handed()
        if held:
            yield handed()

    source = docs.select(q(key).cast("string").alias("key"), q(text).cast("string").alias("text"))
    counted = source.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by doubling of sorted prefixes."""
    n, step = len(text), 1
    rank = text.astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        pair = rank * (int(rank.max()) + 2) + after
        order = np.argsort(pair, kind="stable")
        fresh = np.empty(n, np.int64)
        sorted_pair = pair[order]
        fresh[order] = np.concatenate([[0], np.cumsum(sorted_pair[1:] != sorted_pair[:-1])])
        rank = fresh
        if rank.max() == n - 1:
            return order
        step *= 2


class Ranks:
    """Burrows-Wheeler transform of a text and, at any place, counts of all symbols before."""

    def __init__(self, text: np.ndarray, symbols: int, order: np.ndarray):
        last = text[order - 1].astype(np.uint8)
        n = len(text)
        rows = -(-n // GAP) + 1
        padded = np.full(rows * GAP, symbols, np.uint8)
        padded[:n] = last
        self.blocks = padded.reshape(rows, GAP)
        flat = np.repeat(np.arange(rows), GAP) * (symbols + 1) + padded
        here = np.bincount(flat, minlength=rows * (symbols + 1)).reshape(rows, symbols + 1)
        self.before = np.zeros((rows, symbols), np.int32)
        np.cumsum(here[:-1, :symbols], axis=0, out=self.before[1:])
        self.symbols = symbols

    def all(self, places: np.ndarray) -> np.ndarray:
        """Counts of every symbol before each place: (places, symbols)."""
        row, rest = np.divmod(places, GAP)
        n, width = len(places), self.symbols + 1
        found = self.blocks[row].astype(np.int64)
        found[np.arange(GAP) >= rest[:, None]] = self.symbols
        found += (np.arange(n) * width)[:, None]
        part = np.bincount(found.ravel(), minlength=n * width).reshape(n, width)
        return self.before[row] + part[:, : self.symbols]

    def one(self, places: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Counts of one symbol before each place."""
        row, rest = np.divmod(places, GAP)
        same = self.blocks[row] == symbol[:, None].astype(np.uint8)
        same &= np.arange(GAP) < rest[:, None]
        return self.before[row, symbol] + same.sum(axis=1)


class Index:
    """Bidirectional FM-index over words between delimiters.

    A match is an interval of suffixes of the text (``low``) and one of the same ``size`` of
    the reversed text (``low_r``). Extending it on one side narrows that side's interval by
    ranks, and moves the other by the counts of lesser symbols.
    """

    def __init__(self, words: list[str]):
        text = np.frombuffer("\n".join(["", *words, ""]).encode("utf-32-le"), np.uint32)
        self.letters, codes = np.unique(text, return_inverse=True)
        self.symbols = len(self.letters)
        codes = codes.astype(np.int64)
        # the first delimiter of the text may follow its last: one circle of words
        self.first = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=self.symbols))])
        self.total = len(codes)
        self.order = suffix_order(codes)
        self.left = Ranks(codes, self.symbols, self.order)
        backwards = codes[::-1]
        self.order_r = suffix_order(backwards)
        self.right = Ranks(backwards, self.symbols, self.order_r)
        self.word_at = np.cumsum(codes == 0) - 1

    def codes(self, text: np.ndarray) -> np.ndarray:
        """Symbols of code points; -1 for those that no word has."""
        at = np.minimum(np.searchsorted(self.letters, text), self.symbols - 1)
        return np.where(self.letters[at] == text, at, -1)

    def extend(self, state: tuple, symbol: np.ndarray, right: bool) -> tuple:
        """Matches longer by one symbol each on a side; empty ones have size 0."""
        low, low_r, size = state
        ranks, near, far = (self.right, low_r, low) if right else (self.left, low, low_r)
        known = np.where(symbol < 0, 0, symbol)
        begin, end = ranks.all(near), ranks.all(near + size)
        inside = end - begin
        at = np.arange(len(known))
        width = np.where(symbol < 0, 0, inside[at, known])
        lesser = np.cumsum(inside, axis=1)[at, known] - inside[at, known]
        near = self.first[known] + begin[at, known]
        far = far + lesser
        return (far, near, width) if right else (near, far, width)

    def narrow(self, near: np.ndarray, size: np.ndarray, symbol: np.ndarray, right: bool):
        """As ``extend`` for a search that never turns again: one interval only."""
        ranks = self.right if right else self.left
        known = np.where(symbol < 0, 0, symbol)
        begin, end = ranks.one(near, known), ranks.one(near + size, known)
        return self.first[known] + begin, np.where(symbol < 0, 0, end - begin)

    def branches(self, near: np.ndarray, size: np.ndarray, right: bool):
        """All extensions by a letter: (row, symbol, interval, size)."""
        ranks = self.right if right else self.left
        begin = ranks.all(near)
        inside = ranks.all(near + size) - begin
        row, symbol = np.nonzero(inside[:, 1:])
        symbol = symbol + 1
        return row, symbol, self.first[symbol] + begin[row, symbol], inside[row, symbol]


def near_pairs(index: Index, words: list[str], forward: bool) -> tuple[np.ndarray, np.ndarray]:
    """(asking word, end interval) pairs: words of the index one error away across one half.

    ``forward``: the first half and the delimiter before it match exactly, the error is in
    the second half; else mirrored. Returns the asking word's place and the place of the
    match in the suffixes of the text (forward: of the reversed text), one per match.
    """
    sizes = np.array([len(word) for word in words])
    starts = np.concatenate([[0], np.cumsum(sizes + 2)])
    joined = "".join(f"\n{word}\n" for word in words)
    codes = index.codes(np.frombuffer(joined.encode("utf-32-le"), np.uint32))
    half = sizes // 2
    n = len(words)
    # positions count from the delimiter before a word (0) to the one after it (size + 1)
    at_code = lambda word, place: codes[starts[word] + place]
    outward = half + 1 if forward else sizes - half + 1
    state = (np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, index.total))
    live = np.arange(n)
    for step in range(int(outward.max())):
        # from the middle to the outer delimiter
        going = outward[live] > step
        mine = live[going]
        if not len(mine):
            break
        place = half[mine] - step if forward else half[mine] + 1 + step
        longer = index.extend(tuple(x[going] for x in state), at_code(mine, place), not forward)
        for whole, part in zip(state, longer, strict=True):
            whole[going] = part
        alive = state[2] > 0
        live, state = live[alive], tuple(x[alive] for x in state)
    # turn: the other side's interval goes on alone; left counts symbols not yet matched
    near, size = (state[1] if forward else state[0]), state[2]
    word, error = live, np.zeros(len(live), bool)
    done = np.zeros(len(live), np.int64)
    span = np.where(forward, sizes - half, half)
    found_word, found_at = [], []
    while len(word):
        # (word, done, near, size, error): ``done`` letters of the other half are consumed
        ended = done == span[word]
        place = half[word] + 1 + done if forward else half[word] - done
        code = at_code(word, place)  # the delimiter when all letters are consumed
        rows = []
        # the next symbol matches
        go = error | ~ended
        to, width = index.narrow(near[go], size[go], code[go], forward)
        final = ended[go]
        hit = final & (width > 0)
        # words are distinct, so a whole word between delimiters is found once
        found_word.append(word[go][hit])
        found_at.append(to[hit])
        stay = ~final & (width > 0)
        rows.append((word[go][stay], done[go][stay] + 1, to[stay], width[stay], error[go][stay]))
        clean = np.flatnonzero(~error)
        if len(clean):
            row, symbol, to, width = index.branches(near[clean], size[clean], forward)
            row = clean[row]
            other = symbol != code[row]
            row, symbol, to, width = row[other], symbol[other], to[other], width[other]
            yes = np.ones(len(row), bool)
            inside = ~ended[row]
            # another letter instead of the next one, or before it
            rows.append((word[row][inside], done[row][inside] + 1, to[inside], width[inside], yes[inside]))
            rows.append((word[row], done[row], to, width, yes))
            # the next letter is missing; of equal ones in a row, the last
            left = clean[~ended[clean]]
            step = 1 if forward else -1
            following = at_code(word[left], place[left] + step)
            left = left[following != code[left]]
            rows.append((word[left], done[left] + 1, near[left], size[left], np.ones(len(left), bool)))
        word, done, near, size, error = (np.concatenate(x) for x in zip(*rows, strict=True))
    none = [np.zeros(0, np.int64)]
    return np.concatenate(found_word or none), np.concatenate(found_at or none)


class Shard:
    """Stored words with their counts, asked for near words on one side."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.counts = words, np.array(counts, np.int64)
        self.index = index = Index(words)
        # rows that begin with a delimiter: the word after it, or before it
        self.after = index.word_at[index.order[: index.first[1]]]
        self.before = index.word_at[index.total - 1 - index.order_r[: index.first[1]]] - 1
        self.place = np.empty(len(words), np.int64)
        self.place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))

    def ask(self, words: list[str], forward: bool) -> Iterator[tuple[str, int, int, str]]:
        """(word, near words here, greatest count, its word) of the asking words with any."""
        for first in range(0, len(words), ASKING):
            part = words[first : first + ASKING]
            asking, at = near_pairs(self.index, part, forward)
            found = self.before[at] if forward else self.after[at]
            if not forward:
                # a match that shares the first half too was found from the other side
                apart = [
                    not self.words[b].startswith(part[a][: len(part[a]) // 2])
                    for a, b in zip(asking.tolist(), found.tolist(), strict=True)
                ]
                apart = np.array(apart, bool)
                asking, found = asking[apart], found[apart]
            count = self.counts[found]
            order = np.lexsort((self.place[found], -count, asking))
            mine, heads, totals = np.unique(asking[order], return_index=True, return_counts=True)
            for a, head, n in zip(mine.tolist(), heads.tolist(), totals.tolist(), strict=True):
                best = order[head]
                yield part[a], n, int(count[best]), self.words[found[best]]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words of a written table (word, n) with near ones.

    ``best`` is the near word of the greatest count, of equal ones the least. A word is
    stored under the halves of all words that may be one edit away, on both sides, and asks
    under its own. Shards beyond the letters of an index are cut into tiles of stored by
    asking words, so no task holds more than a share, and no pair is left out.
    """
    letters = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    # every word is stored under two keys on each side
    buckets = max(1, -(-2 * letters // INDEX_LETTERS))
    size = F.length("word")
    own = {True: F.floor(size / 2), False: F.ceil(size / 2)}
    near = {
        True: [F.floor((size - 1) / 2), own[True], F.floor((size + 1) / 2)],
        False: [F.ceil((size - 1) / 2), own[False], F.ceil((size + 1) / 2)],
    }

    def keyed(forward: bool) -> DataFrame:
        halves = F.array_distinct(F.array(*[x.cast("int") for x in near[forward]]))
        edge = F.left("word", F.col("half")) if forward else F.right("word", F.col("half"))
        return (
            words.withColumn("half", F.explode(halves))
            .withColumn("asks", F.col("half") == own[forward])
            .withColumn("bucket", F.pmod(F.xxhash64("half", edge), F.lit(buckets)).cast("int"))
            .select(F.lit(forward).alias("forward"), "bucket", "word", "n", "asks")
        )

    rows = keyed(True).unionByName(keyed(False))
    sizes = stash(
        rows.groupBy("forward", "bucket")
        .agg(F.sum(F.length("word") + 1).alias("letters"))
        .select("forward", "bucket", F.ceil(F.col("letters") / INDEX_LETTERS).cast("int").alias("parts")),
        "sizes",
    )
    sizes = F.broadcast(sizes) if fits_broadcast(sizes) else sizes
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    stored = F.transform(every, lambda j: F.struct(F.col("part").alias("i"), j.alias("j"), F.lit(True).alias("stored")))
    asking = F.transform(every, lambda i: F.struct(i.alias("i"), F.col("part").alias("j"), F.lit(False).alias("stored")))
    tiles = (
        rows.join(sizes, ["forward", "bucket"])
        .withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
        .withColumn("tile", F.explode(F.when(F.col("asks"), F.concat(stored, asking)).otherwise(stored)))
        .select("forward", "bucket", "tile.i", "tile.j", "tile.stored", "word", "n")
    )

    def ask(key: tuple, tile: pa.Table) -> pa.Table:
        held = tile.filter(tile.column("stored"))
        asks = tile.filter(pc.invert(tile.column("stored"))).column("word").to_pylist()
        found = []
        if held.num_rows and asks:
            shard = Shard(held.column("word").to_pylist(), held.column("n").to_pylist())
            asks.sort(key=len)
            found = list(shard.ask(asks, key[0].as_py()))
        word, n, best_n, best = zip(*found, strict=True) if found else ((), (), (), ())
        return pa.table(
            {
                "word": pa.array(word, pa.string()),
                "n_near": pa.array(n, pa.int64()),
                "best_n": pa.array(best_n, pa.int64()),
                "best": pa.array(best, pa.string()),
            }
        )

    found = tiles.groupBy("forward", "bucket", "i", "j").applyInArrow(
        ask, "word string, n_near long, best_n long, best string"
    )
    best = F.min(F.struct((-F.col("best_n")).alias("least"), "best")).alias("top")
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best)
        .select("word", "n_near", (-F.col("top.least")).alias("best_n"), "top.best")
    )


def last_forms(forms: DataFrame, most_steps: int) -> DataFrame:
    """(word, root) by following a written table (word, form) to its ends.

    Chains are at most ``most_steps`` long; each round doubles the steps taken.
    """
    chain, steps = forms.select("word", F.col("form").alias("root")), 1
    while steps < most_steps:
        further = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = chain.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root")
        )
        longer, before = stash(longer, "chain"), chain
        if steps > 1:
            drop_stash(forms.sparkSession, before)
        chain, steps = longer, 2 * steps
    return chain


def spelling_variants(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_letters: int = 7,
    least: int = 2,
    ratio: int = 10,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts.

    Words are runs of letters, A-Z lower-cased, of at least ``least_letters`` code points
    that occur ``least`` times; of the runs that crc32 of ``<key>:<run>`` picks one letter
    is left out first (a null key is an empty one). Words are near if they differ by exactly
    one inserted, deleted or replaced code point. ``form`` is the near word of the greatest
    count (ties: the least), if that is at least ``ratio`` times the word's own; ``root``
    the end of the chain of forms. Null and empty texts have no words, repeated rows count
    again, an empty table gives no rows, other columns are not read. ``least_letters`` must
    be at least 2, so that each half has a letter.
    """
    if least_letters < 2 or ratio < 2:
        raise ValueError("least_letters and ratio must be 2 or more")
    words = stash(word_counts(docs, key, text, least_letters, least), "words")
    near = near_words(words)
    is_form = F.col("best_n") >= ratio * F.col("n")
    named = stash(
        words.join(near, "word", "left").select(
            "word",
            F.when(is_form, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    # every step multiplies the count by ``ratio`` at least
    most, steps = words.agg(F.max("n")).first()[0] or 1, 1
    while ratio**steps <= most:
        steps += 1
    roots = last_forms(named.where(F.col("form").isNotNull()), steps)
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
