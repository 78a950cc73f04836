"""Learning byte-pair merges over distinct pretokens, in exact batched rounds."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tokenloom.functions import text as tx
from tokenloom.operators import pairs as pr
from tokenloom.operators.pretokens import pretoken_counts
from tokenloom.session import materialize, release

BYTE_ALPHABET = 256
UNKNOWN = "�"
#: Pairs of a candidate list, of them ranked at first per round; bytes of an index row group.
TOP_PAIRS, RANKED_PAIRS, INDEX_BLOCK = 20_000, 1024, 4 << 20


@dataclass
class BpeModel:
    """A learned vocabulary; its size is bounded by the requested vocabulary size."""

    base: list[bytes]
    merges: list[tuple[int, int]] = field(default_factory=list)
    specials: list[str] = field(default_factory=list)

    @property
    def tokens(self) -> list[bytes]:
        """Bytes of every token, by id: base, merges in order, then specials."""
        table = list(self.base)
        for left, right in self.merges:
            table.append(table[left] + table[right])
        return table + [token.encode("utf-8") for token in self.specials]

    def vocab_frame(self, spark: SparkSession) -> DataFrame:
        """(token_id, token_bytes, is_special)."""
        tokens = self.tokens
        first_special = len(tokens) - len(self.specials)
        rows = [(i, bytearray(b), i >= first_special) for i, b in enumerate(tokens)]
        return spark.createDataFrame(
            rows, "token_id int, token_bytes binary, is_special boolean"
        )

    def merges_frame(self, spark: SparkSession) -> DataFrame:
        """(rank, left_id, right_id, new_id, left_bytes, right_bytes)."""
        tokens = self.tokens
        rows = [
            (rank, left, right, len(self.base) + rank, bytearray(tokens[left]), bytearray(tokens[right]))
            for rank, (left, right) in enumerate(self.merges)
        ]
        return spark.createDataFrame(
            rows,
            "rank int, left_id int, right_id int, new_id int, left_bytes binary, right_bytes binary",
        )


def exact_batch(
    ranked: list[tuple[str, int]],
    tie_key: Callable[[str], tuple],
    floor: int,
    budget: int,
    spelled_before: Callable[[str], bool] = lambda pair: False,
) -> list[str]:
    """The leading pairs that one-at-a-time merging would also pick, in its order.

    ``ranked`` holds all pairs above the count ``floor``. Pairs without a common token do
    not change each other's counts, and a pair born from a merge can never be more
    frequent than the first pair refused here, so everything strictly above that
    count is safe. An empty answer means that no pair is above the floor.
    """
    ordered = sorted(
        (item for item in ranked if item[1] > floor),
        key=lambda item: (-item[1], tie_key(item[0])),
    )
    taken: list[tuple[str, int]] = []
    used: set[str] = set()
    for pair, count in ordered:
        lone = pair[0] == pair[1] or spelled_before(pair)
        if lone and not taken:
            return [pair]
        if lone or used & set(pair):
            floor = count
            break
        taken.append((pair, count))
        used |= set(pair)
    while len(taken) > 1 and taken[-1][1] <= floor:
        taken.pop()
    return [pair for pair, _ in taken[:budget]]


class _Order:
    """How equal counts are decided: greater bytes first, or smaller ids first."""

    def __init__(self, tokens: list[bytes], by_bytes: bool):
        self.tokens = tokens
        self.by_bytes = by_bytes

    def id_of(self, character: str) -> int:
        code = ord(character)
        return code if code < 0xD800 else code - 0x800

    def key(self, pair: str) -> tuple:
        left, right = (self.id_of(c) for c in pair)
        if not self.by_bytes:
            return (left, right)
        # Complement each byte so that the greater byte string sorts first; of equal
        # bytes the smaller ids.
        return (*([255 - b for b in self.tokens[i]] + [256] for i in (left, right)), left, right)

    def best(self, ties: DataFrame, spark: SparkSession) -> str:
        """Decide among any number of equal pairs inside Spark."""
        codes = spark.createDataFrame(
            [(tx.symbol(i), bytearray(b), i) for i, b in enumerate(self.tokens)],
            "symbol string, data binary, id int",
        )
        rows = ties
        for place, side in ((1, "l"), (2, "r")):
            named = codes.toDF(f"{side}_symbol", f"{side}_data", f"{side}_id")
            rows = rows.withColumn(f"{side}_symbol", F.substring("pair", place, 1)).join(
                F.broadcast(named), f"{side}_symbol"
            )
        order = (
            F.max_by("pair", F.struct("l_data", "r_data", -F.col("l_id"), -F.col("r_id")))
            if self.by_bytes
            else F.min_by("pair", F.struct("l_id", "r_id"))
        )
        return rows.agg(order.alias("pair")).first()["pair"]


@dataclass
class Round:
    """What a round of training took: merges learned so far, words read, a new candidate list."""

    merges: int
    words_read: int
    resorted: bool


class Candidates:
    """All pairs above a count, kept on the driver from the changes of each round.

    A pair of older symbols only loses occurrences when others merge, so what is not in the
    list stays below its floor; only pairs of a new symbol can enter. Spark sorts all pairs
    again only when the list is used up.
    """

    def __init__(self, top: list[tuple[str, int]], most: int):
        self.floor = 0 if len(top) < most else top[-1][1]
        self.counts = {pair: n for pair, n in top if n > self.floor}

    def update(self, changes: list[tuple[str, int]]) -> None:
        for pair, change in changes:
            n = self.counts.get(pair, 0) + change
            if n > self.floor and (pair in self.counts or change > 0):
                self.counts[pair] = n
            else:
                self.counts.pop(pair, None)

    def ranked(self, most: int) -> tuple[list[tuple[str, int]], int]:
        """The most frequent pairs, and the count above which none is missing."""
        if len(self.counts) <= most:
            return list(self.counts.items()), self.floor
        top = heapq.nlargest(most, self.counts.items(), key=lambda item: item[1])
        return top, top[-1][1]


class WordIndex:
    """Stored words under each of their pairs, so a round reads the words of its own pairs.

    The table is clustered and sorted by pair: a filter on pairs skips all other row groups,
    and the words of a frequent pair spread over several files. Symbols made later are
    looked up by the older ones at their joint, and the words found are rewritten then.
    """

    def __init__(self, words: DataFrame, n_tokens: int, parts: Callable[[int], tuple[int, int]]):
        self.words, self.n_tokens, self.parts = words, n_tokens, parts
        self.pending: list[tuple[str, str]] = []
        entries = words.select(
            F.explode(F.array_distinct(tx.adjacent_pairs("sym"))).alias("pair"), "sym", "freq"
        )
        clustered = entries.repartitionByRange("pair", "sym").sortWithinPartitions("pair")
        self.table = materialize(clustered, "pair_index", {"parquet.block.size": str(INDEX_BLOCK)})

    def joint(self, left: int, right: int) -> str:
        """The pair of symbols of the index that lies where two symbols meet."""
        while left >= self.n_tokens:
            left = self.parts(left)[1]
        while right >= self.n_tokens:
            right = self.parts(right)[0]
        return tx.symbol(left) + tx.symbol(right)

    def changes(self, batch: list[tuple[int, int]], steps: list[tuple[str, str]], floor: int):
        """Changes of pair counts by a batch of merges, and the number of words read.

        Lost occurrences come back for every pair that lost some, at most two pairs per
        merge and symbol; born pairs only above the floor.
        """
        joints = sorted({self.joint(left, right) for left, right in batch})
        own = reduce(or_, [F.col("pair") == F.lit(joint) for joint in joints])
        seen = Observation()
        found = self.table.where(own).observe(seen, F.count(F.lit(1)).alias("n")).select("sym", "freq")
        if len(joints) > 1:
            found = found.dropDuplicates(["sym"])
        if self.pending:
            found = pr.merge_pairs(found, self.pending)
        deltas = pr.pair_deltas(found, steps).groupBy("pair").agg(F.sum("n").alias("n"))
        rows = deltas.where((F.col("n") < 0) | (F.col("n") > floor)).collect()
        self.pending += steps
        return [(row["pair"], row["n"]) for row in rows], seen.get["n"]

    def current(self) -> DataFrame:
        """All words as they are now."""
        return pr.merge_pairs(self.words, self.pending) if self.pending else self.words

    def release(self) -> None:
        release(self.table, self.words)


def learn_merges(
    words: DataFrame,
    base: list[bytes],
    n_merges: int,
    by_bytes: bool = True,
    done: Sequence[tuple[int, int]] = (),
    top_k: int = TOP_PAIRS,
    checkpoint_every: int = 24,
    on_checkpoint: Callable[[DataFrame, list[tuple[int, int]]], None] | None = None,
    report: list[Round] | None = None,
) -> list[tuple[int, int]]:
    """Merges as id pairs, continuing after ``done``.

    ``words`` is (sym, freq), one row per distinct pretoken, already rewritten by
    ``done``. The driver holds the pairs above a floor count, at most ``top_k`` when the
    list is made; each round takes all merges that are certain (see :func:`exact_batch`)
    and is one job over the stored words of their own pairs, which returns the changed
    counts. All words are read when the list is used up, and when words and index are
    written anew to the shared folder, every ``checkpoint_every`` rounds. ``report`` gets
    one entry per round.
    """
    spark = words.sparkSession
    merges = list(done)[:n_merges]
    if len(merges) == n_merges:
        return merges
    tokens = list(base)
    for left, right in merges:
        tokens.append(tokens[left] + tokens[right])
    known = set(tokens)
    order = _Order(tokens, by_bytes)

    def spelled_before(pair: str) -> bool:
        left, right = (order.id_of(c) for c in pair)
        return tokens[left] + tokens[right] in known

    def indexed(now: DataFrame) -> WordIndex:
        return WordIndex(
            materialize(now.select("sym", "freq"), "words"),
            len(tokens),
            lambda token: merges[token - len(base)],
        )

    index, candidates, rounds, resorted = indexed(words), None, 0, False
    while len(merges) < n_merges:
        pairs: list[str] = []
        if candidates is None or (not candidates.counts and candidates.floor):
            counts = pr.pair_counts(index.current())
            top = [(row["pair"], row["n"]) for row in counts.orderBy(F.col("n").desc()).limit(top_k).collect()]
            candidates, resorted = Candidates(top, top_k), True
            if top and not candidates.counts:
                pairs = [order.best(counts.where(F.col("n") == top[0][1]), spark)]
        for most in (RANKED_PAIRS, len(candidates.counts)):
            if not pairs:
                ranked, floor = candidates.ranked(most)
                pairs = exact_batch(ranked, order.key, floor, n_merges - len(merges), spelled_before)
        if not pairs:
            break
        batch = [tuple(order.id_of(c) for c in pair) for pair in pairs]
        steps = []
        for pair, (left, right) in zip(pairs, batch, strict=True):
            steps.append((pair, tx.symbol(len(tokens))))
            merges.append((left, right))
            tokens.append(tokens[left] + tokens[right])
            known.add(tokens[-1])
        if len(merges) >= n_merges:
            break
        changed, words_read = index.changes(batch, steps, candidates.floor)
        candidates.update(changed)
        rounds += 1
        if report is not None:
            report.append(Round(len(merges), words_read, resorted))
        resorted = False
        if rounds % checkpoint_every == 0:
            older, index = index, indexed(index.current())
            older.release()
            if on_checkpoint is not None:
                on_checkpoint(index.words, merges)
    index.release()
    return merges


def merge_budget(vocab_size: int, n_base: int, specials: Sequence[str]) -> int:
    """Merges that fit: the vocabulary minus base tokens and specials."""
    budget = vocab_size - n_base - len(specials)
    if budget < 0:
        raise ValueError("vocab_size is smaller than base tokens plus specials")
    return budget


def character_alphabet(counts: DataFrame) -> list[str]:
    """Every distinct character, by code point; bounded by Unicode itself."""
    rows = (
        counts.select(F.explode(tx.characters(F.col("pretoken"))).alias("c")).distinct().collect()
    )
    return sorted(row["c"] for row in rows)


def train_bpe(
    corpus: DataFrame,
    vocab_size: int,
    specials: Sequence[str] = (tx.END_OF_TEXT,),
    text: str = "text",
    alphabet: str = "byte",
    split_special: bool = False,
    top_k: int = TOP_PAIRS,
    checkpoint_every: int = 24,
    state: "object | None" = None,
    resume: bool = False,
    report: list[Round] | None = None,
) -> BpeModel:
    """Learn a vocabulary of ``vocab_size`` tokens from a text column.

    Specials found in the corpus are ordinary text unless ``split_special``; they
    are appended to the vocabulary after the merges. ``alphabet='char'`` starts
    from the characters of the corpus (after an unknown token) and gives equal
    counts to the smaller ids. ``state`` (a ``TrainingState``) keeps progress so a
    stopped run can ``resume``. Fewer merges come back when no pair is left.
    """
    counts = pretoken_counts(corpus, text, specials=())
    if split_special:
        counts = pretoken_counts(corpus, text, specials=specials)
        counts = counts.where(~F.col("pretoken").isin(list(specials)))
    saved = state.load(corpus.sparkSession) if state is not None and resume else None
    if alphabet == "byte":
        base = [bytes([b]) for b in range(BYTE_ALPHABET)]
        words = pr.byte_words(counts).select("sym", "freq")
    elif alphabet == "char":
        counts = counts.persist()
        letters = character_alphabet(counts) if saved is None else None
        if saved is not None:
            letters = [token.decode("utf-8") for token in saved.base[1:]]
        base = [UNKNOWN.encode("utf-8")] + [c.encode("utf-8") for c in letters]
        symbols = "".join(tx.symbol(i + 1) for i in range(len(letters)))
        words = counts.select(
            F.translate("pretoken", "".join(letters), symbols).alias("sym"), "freq"
        )
    else:
        raise ValueError("alphabet must be 'byte' or 'char'")
    done: list[tuple[int, int]] = []
    if saved is not None:
        words, done = saved.words, saved.merges
    n_merges = merge_budget(vocab_size, len(base), specials)
    merges = learn_merges(
        words,
        base,
        n_merges,
        by_bytes=alphabet == "byte",
        done=done,
        top_k=top_k,
        checkpoint_every=checkpoint_every,
        report=report,
        on_checkpoint=None
        if state is None
        else lambda frame, so_far: state.save(frame, base, so_far),
    )
    counts.unpersist()
    return BpeModel(base, merges, list(specials))
