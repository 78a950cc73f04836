"""Scoring texts with a small causal self-attention model over subword ids.

The corpus is encoded once. Word and subword counts are taken over all of it, and the model
learns from every token of the training texts once, in rounds: every task trains on its
windows of the round, and the parameters of all tasks are averaged. Frequent subwords are symbols of
their own, others belong to classes and are found within theirs by their counts. Symbols
are predicted in two steps, their group and then the symbol within it. Texts are scored in overlapping windows, so that every token is predicted once, with context.
The probability of a word is the mean of what its subwords give, the end of the word
included, and its own smoothed rate.
"""

import array
import base64
import functools
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tokenloom.llm.frames import id_remainder, q, slices, stash

#: Positions of a window, of them predicted anew; width, hidden width, symbols, classes.
LENGTH, STRIDE, WIDTH, HIDDEN, SYMBOLS, CLASSES = 32, 24, 16, 24, 256, 48
#: Symbols of a group, and groups.
GROUP = 16
GROUPS = SYMBOLS // GROUP
#: Rounds, each over its share of the windows; windows of a step.
ROUNDS, STEP = 3, 64
#: Share of the words' own rates in the probability of a word.
RATES = 0.7
RATE = 0.01
#: Most words broadcast; texts encoded at once.
HOT_WORDS, BATCH_BYTES = 1 << 18, 1 << 20
#: Words held before a task hands on their counts.
HELD_WORDS = 300_000
END = b""


def split_words(text: str) -> list[bytes]:
    """Words of a text, A-Z lower-cased; bytes split at space, tab and the line separators."""
    return text.encode().lower().split()


@functools.lru_cache(2)
def token_ranks(tokenizer: str) -> dict[bytes, int]:
    """Bytes and id of every token of a rank file."""
    with open(tokenizer, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@functools.lru_cache(2)
def token_bytes(tokenizer: str) -> list[bytes]:
    """Bytes of every id."""
    names = {rank: token for token, rank in token_ranks(tokenizer).items()}
    return [names.get(i, b"") for i in range(max(names) + 1)]


@functools.lru_cache(2)
def encoding(tokenizer: str):
    """The encoder of a rank file; special strings are ordinary text."""
    import tiktoken
    from public_tokenizers import PATTERN

    return tiktoken.Encoding(
        "ranks", pat_str=PATTERN, mergeable_ranks=token_ranks(tokenizer), special_tokens={}
    )


def gather(docs: DataFrame, tokenizer: str, modulus: int, held_out: int) -> DataFrame:
    """One pass over all texts; rows of three kinds.

    0: key, held, ids of a text (lower-cased words, single spaces). 1: word, c (in training
    texts), t (in all). 3: c of a subword id.
    """
    key = docs.schema["key"].dataType
    names = ["kind", "key", "held", "ids", "word", "c", "t"]
    schema = f"kind int, key {key.simpleString()}, held boolean, ids binary, word binary, c long, t long"
    key_type = pa.int64()
    source = docs.select("key", "text", (id_remainder(F.col("key"), modulus) == held_out).alias("held"))

    def rows(kind: int, n: int, **columns) -> pa.RecordBatch:
        kinds = {"key": key_type, "held": pa.bool_(), "ids": pa.binary(), "word": pa.binary()}
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, kind, np.int32)),
                *[
                    pa.array(columns[x], kinds.get(x, pa.int64()))
                    if x in columns
                    else pa.nulls(n, kinds.get(x, pa.int64()))
                    for x in names[1:]
                ],
            ],
            names=names,
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(tokenizer).encode_ordinary
        learned, other, ends = Counter(), Counter(), [0, 0]
        counts = np.zeros(1 << 16, np.int64)

        def word_rows():
            words = [*learned, *(word for word in other if word not in learned)]
            c = [learned[word] for word in words]
            return rows(1, len(words), word=words, c=c, t=[x + other[w] for x, w in zip(c, words)])

        for batch in batches:
            keys, held = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for first, last in slices([len(x) for x in texts], BATCH_BYTES):
                words = [split_words(x) for x in texts[first:last]]
                plain = [b" ".join(x).decode() for x in words]
                ids = [array.array("H", encode(x)).tobytes() for x in plain]
                yield rows(
                    0,
                    last - first,
                    key=keys[first:last],
                    held=held[first:last],
                    ids=ids,
                )
                for mine, out in zip(words, held[first:last], strict=True):
                    (other if out else learned).update(mine)
                    ends[1] += 1
                    ends[0] += not out
                seen = [own for own, out in zip(ids, held[first:last], strict=True) if not out]
                if seen:
                    counts += np.bincount(np.frombuffer(b"".join(seen), np.uint16), minlength=len(counts))
                if len(learned) + len(other) > HELD_WORDS:
                    yield word_rows()
                    learned.clear()
                    other.clear()
        if learned or other:
            yield word_rows()
        if ends[1]:
            yield rows(1, 1, word=[END], c=ends[:1], t=ends[1:])
        used = np.flatnonzero(counts)
        if len(used):
            yield rows(3, len(used), c=counts[used], t=used)

    return source.mapInArrow(work, schema)


#: Ids that stand before and after a text; no vocabulary file used here reaches them.
BEGIN, STOP = 65534, 65535


def word_begins(pieces: list[bytes]) -> np.ndarray:
    """By id, whether it begins a word: with a space, or the end of a text."""
    begins = np.zeros(1 + STOP, bool)
    begins[[i for i, x in enumerate(pieces) if x[:1] == b" "] + [STOP]] = True
    return begins


@dataclass
class Symbols:
    """Symbol of every id, and log10 of an id's share within its symbol."""

    of: np.ndarray
    within: np.ndarray
    rates: np.ndarray


#: Ids that are symbols of their own; what may stand before an id: one of these, an id of a
#: class, or the begin.
HEAD = SYMBOLS - CLASSES - 1
MARKS = HEAD + 2


def frequent_symbols(counts: np.ndarray) -> np.ndarray:
    """Symbol of the frequent ids and of the begin, -1 of all others."""
    order = np.argsort(-counts, kind="stable")
    order = order[order != BEGIN]
    first = [STOP, *[i for i in order[: HEAD + 1].tolist() if i != STOP][: HEAD - 1]]
    of = np.full(1 << 16, -1, np.int64)
    of[first] = np.arange(HEAD)
    of[BEGIN] = SYMBOLS - 1
    return of


def count_before(lines: list[np.ndarray], of: np.ndarray, before: np.ndarray) -> None:
    """Add to ``before`` (id, mark) how often ids without own symbol stand after each mark."""
    if not lines:
        return
    line = np.concatenate(lines)
    marks = of[line[:-1]]
    marks = np.where(marks < 0, HEAD, np.minimum(marks, HEAD + 1))
    # the begin of a text has a symbol, so no pair joins two texts
    at = np.flatnonzero(of[line[1:]] < 0)
    codes, n = np.unique(line[1:][at].astype(np.int64) * MARKS + marks[at], return_counts=True)
    before.reshape(-1)[codes] += n.astype(before.dtype)


def counts_before(texts: DataFrame, of: np.ndarray) -> np.ndarray:
    """(id, mark) counts over the ids of all texts; at most ids times marks reach the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = np.zeros((1 << 16, MARKS), np.uint32)

        for batch in batches:
            found = [np.frombuffer(x, np.uint16) for x in batch.column(0).to_pylist()]
            for first, last in slices([len(x) for x in found], 1 << 20):
                lines = [np.concatenate([[BEGIN], x]).astype(np.uint16) for x in found[first:last]]
                count_before(lines, of, before)
        codes = np.flatnonzero(before)
        for at in range(0, len(codes), 1 << 16):
            part = codes[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(before.reshape(-1)[part].astype(np.int64))],
                names=["code", "n"],
            )

    parts = texts.select("ids").mapInArrow(work, "code int, n long")
    found = parts.groupBy("code").agg(F.sum("n").cast("double").alias("n")).toArrow()
    before = np.zeros((1 << 16, MARKS), np.float32)
    before.reshape(-1)[found.column("code").to_numpy()] = found.column("n").to_numpy()
    return before


def cluster(shape: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """One of ``n`` classes for every id, by what stands before it (rows of unit length)."""
    heavy = np.argsort(-counts, kind="stable")
    centres = shape[heavy[:: max(1, min(len(shape), 8 * n) // n)][:n]]
    for _ in range(12):
        mine = (shape @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (mine == c).any():
                mean = (shape[mine == c] * np.log1p(counts[mine == c])[:, None]).sum(axis=0)
                centres[c] = mean / max(np.linalg.norm(mean), 1e-9)
    return mine


def classes_of_begins(heads: int, weight: float) -> int:
    """Classes of ids that begin a word: about their share, so that they fill whole groups.

    ``heads`` frequent ids and the class of the rarest are symbols that begin a word, too.
    """
    fitting = range(-(heads + 1) % GROUP, CLASSES - 1, GROUP)
    return min(fitting, key=lambda n: abs(n - weight * (CLASSES - 2)))


def make_symbols(
    counts: np.ndarray, before: np.ndarray | list[np.ndarray], vocabulary: int | list[bytes]
) -> Symbols:
    """Frequent ids are symbols; others are clustered by what stands before them.

    ``counts``: by id, in all training texts, text ends included. ``before``: (id, mark)
    counts over all training texts, or a list of lines of ids to count. ``vocabulary``: the
    number of ids, or the bytes of each. By their bytes, ids that begin a word share no
    symbol with others and fill the first groups alone, so the chance that a word begins is
    that of these groups.
    """
    begins = np.zeros(1 + STOP, bool)
    if not isinstance(vocabulary, int):
        begins, vocabulary = word_begins(vocabulary), len(vocabulary)
    head, of = HEAD, frequent_symbols(counts)
    if isinstance(before, list):
        lines, before = before, np.zeros((1 << 16, MARKS), np.float32)
        for line in lines:
            count_before([line], of, before)
    known = (of < 0) & (before.sum(axis=1) >= 3)
    opens = np.zeros(SYMBOLS, bool)
    opens[of[(of >= 0) & begins]] = True
    weight = np.log1p(counts[known & begins]).sum() / max(np.log1p(counts[known]).sum(), 1e-9)
    n = classes_of_begins(opens.sum(), weight) if begins.any() else 0
    # classes: those that begin a word, then others, then the rarest ids of both kinds
    last = SYMBOLS - 2
    of[(of < 0) & begins] = last - 1
    of[of < 0] = last
    sizes = ((begins, head, n), (~begins, head + n, CLASSES - 2 - n))
    for kind, first, size in sizes:
        tail = np.flatnonzero(known & kind)
        if len(tail) and size:
            shape = np.sqrt(before[tail] / np.maximum(before[tail].sum(axis=1, keepdims=True), 1))
            of[tail] = first + cluster(shape, counts[tail], size)
    opens[head : head + n] = opens[last - 1] = begins.any()
    order = np.argsort(~opens, kind="stable")
    of = np.argsort(order)[of]
    smooth = counts + 0.1
    smooth[vocabulary:STOP] = 1e-9
    total = np.bincount(of, weights=smooth, minlength=SYMBOLS)
    # symbols without ids get no share of their group
    rates = np.bincount(of, weights=counts + 0.1 / np.bincount(of)[of], minlength=SYMBOLS)
    return Symbols(of.astype(np.int16), np.log10(smooth / total[of]), rates / rates.sum())


def start_weights(rates: np.ndarray) -> dict[str, np.ndarray]:
    """Small random weights; the bias alone gives the symbols' rates."""
    draw = np.random.default_rng(6)
    scale = lambda *shape: (draw.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
    return {
        "symbol": draw.normal(size=(SYMBOLS, WIDTH)).astype(np.float32) * 0.5,
        "place": draw.normal(size=(LENGTH, WIDTH)).astype(np.float32) * 0.1,
        "query": scale(WIDTH, WIDTH),
        "key": scale(WIDTH, WIDTH),
        "value": scale(WIDTH, WIDTH),
        "mix": scale(WIDTH, WIDTH) * 0.5,
        "wide": scale(WIDTH, HIDDEN),
        "shift": np.zeros(HIDDEN, np.float32),
        "back": scale(HIDDEN, WIDTH) * 0.5,
        "out": scale(WIDTH, SYMBOLS) * 0.1,
        "bias": np.log(np.maximum(rates, 1e-9)).astype(np.float32),
        "group": scale(WIDTH, GROUPS) * 0.1,
        "group_bias": np.log(
            np.maximum(rates.reshape(GROUPS, GROUP).sum(axis=1), 1e-9)
        ).astype(np.float32),
    }


def to_vector(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([x.ravel() for x in weights.values()])


@functools.cache
def weight_shapes() -> dict[str, tuple[int, ...]]:
    return {name: x.shape for name, x in start_weights(np.ones(SYMBOLS)).items()}


def to_weights(vector: np.ndarray) -> dict[str, np.ndarray]:
    out, at, vector = {}, 0, vector.astype(np.float32)
    for name, shape in weight_shapes().items():
        size = int(np.prod(shape))
        out[name] = vector[at : at + size].reshape(shape)
        at += size
    return out


def even(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows over their root mean square."""
    scale = 1 / np.sqrt(np.einsum("...i,...i->...", x, x)[..., None] / x.shape[-1] + 1e-5)
    return x * scale, scale


def even_slope(slope: np.ndarray, x: np.ndarray, scale: np.ndarray) -> np.ndarray:
    inner = np.einsum("...i,...i->...", slope, x)[..., None] / x.shape[-1]
    return scale * (slope - x * scale**2 * inner)


LATER = np.triu(np.full((LENGTH, LENGTH), -1e9, np.float32), 1)
EARLIER = np.tril(np.ones((LENGTH, LENGTH), np.float32))
#: Row sums as products.
ONES = np.ones(LENGTH, np.float32)
#: Windows scored at once, and places where a word may begin.
BATCH, OPENED = 128, 1024


def forward(w: dict, x: np.ndarray, first: int = 0, logits: bool = True) -> tuple:
    """Logits of the next symbol, then of its group, at positions ``first``.. of windows."""
    n = x.shape[1]
    e = w["symbol"][x] + w["place"][:n]
    n1, s1 = even(e)
    q_, k, v = n1[:, first:] @ w["query"], n1 @ w["key"], n1 @ w["value"]
    a = q_ @ k.transpose(0, 2, 1)
    a *= WIDTH**-0.5
    a += LATER[first:n, :n]
    a -= a.max(axis=-1, keepdims=True)
    np.exp(a, out=a)
    a /= a.sum(axis=-1, keepdims=True)
    c = a @ v
    h = e[:, first:] + c @ w["mix"]
    n2, s2 = even(h)
    u = np.maximum(n2 @ w["wide"] + w["shift"], 0)
    g = h + u @ w["back"]
    n3, s3 = even(g)
    z = None
    if logits:
        z = np.concatenate([n3 @ w["out"] + w["bias"], n3 @ w["group"] + w["group_bias"]], axis=-1)
    return z, (e, n1, s1, q_, k, v, a, c, h, n2, s2, u, g, n3, s3)


def both_steps(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the logits: those within the target's group, those of the groups, and the group."""
    group = y // GROUP
    within = z[..., :SYMBOLS].reshape(*y.shape, GROUPS, GROUP)
    return np.take_along_axis(within, group[..., None, None], -2)[..., 0, :], z[..., SYMBOLS:], group


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=-1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=-1, keepdims=True))


def log_shares(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural log of the targets' probability: of their group, and within it."""
    within, groups, group = both_steps(z, y)
    of = lambda logs, at: np.take_along_axis(logs, at[..., None], -1)[..., 0]
    return of(log_softmax(within), y % GROUP) + of(log_softmax(groups), group)


class Space:
    """Arrays by name, whose memory the next step writes over."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, kind: np.dtype, *shape: int) -> np.ndarray:
        size, found = math.prod(shape), self.held.get(name)
        if found is None or found.size < size or found.dtype != kind:
            found = self.held[name] = np.empty(size, kind)
        return found[:size].reshape(shape)


#: Exponentials are taken without a shift of numbers up to this size.
SAFE = 30


def slopes(
    w: dict, x: np.ndarray, y: np.ndarray, used: np.ndarray, space: Space | None = None
) -> dict[str, np.ndarray]:
    """Gradient of the mean loss over the used positions, for what ``forward`` computes.

    Positions are columns, so that sums over a position's numbers run along whole rows.
    Products of weights that always follow each other (query and key, value and mix) are
    taken once, before the positions.
    """
    (n, length), kind = x.shape, w["symbol"].dtype
    size, cols = n * length, np.arange(n * length)
    space = space or Space()
    new = lambda name, *shape: space(name, kind, *shape)
    windows = lambda m: m.reshape(len(m), n, length).transpose(1, 0, 2)
    ones, flat, line = new("ones", size), new("flat", WIDTH, size), new("line", size)
    ones[:] = 1

    def evened(m: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray]:
        rows, scale = new("rows" + name, *m.shape), new("scale" + name, size)
        np.multiply(m, m, out=rows)
        np.matmul(ones[: len(m)], rows, out=scale)
        scale /= len(m)
        scale += kind.type(1e-5)
        np.sqrt(scale, out=scale)
        np.divide(1, scale, out=scale)
        return np.multiply(m, scale, out=rows), scale

    def evened_slope(slope: np.ndarray, rows: np.ndarray, scale: np.ndarray) -> np.ndarray:
        np.multiply(slope, rows, out=flat)
        np.matmul(ones[:WIDTH], flat, out=line)
        np.divide(line, -WIDTH, out=line)
        slope += np.multiply(rows, line, out=flat)
        slope *= scale
        return slope

    def softmax_slope(z: np.ndarray, hit: np.ndarray, weight: np.ndarray) -> None:
        if max(z.max(), -z.min()) > SAFE:
            z -= z.max(axis=0)
        np.exp(z, out=z)
        np.matmul(ones[: len(z)], z, out=line)
        z *= np.divide(weight, line, out=line)
        z.reshape(-1)[hit * size + cols] -= weight

    weight = used.ravel() * kind.type(1 / max(used.sum(), 1))
    at, target = x.ravel(), y.ravel()
    group = target // GROUP
    e = new("e", WIDTH, size)
    np.ascontiguousarray(w["symbol"].T).take(at, axis=1, out=e, mode="clip")
    placed = e.reshape(WIDTH, n, length)
    placed += np.ascontiguousarray(w["place"][:length].T)[:, None]
    n1, s1 = evened(e, "1")
    scale = kind.type(WIDTH**-0.5)
    joined = np.concatenate([w["query"] @ w["key"].T * scale, w["value"] @ w["mix"]], axis=1)
    middle = new("middle", 2 * WIDTH + 1, size)
    np.matmul(joined.T, n1, out=middle[:-1])
    middle[-1] = 1
    keys, asks, says = windows(n1), windows(middle[:WIDTH]), windows(middle[WIDTH:])
    a = np.matmul(asks.transpose(0, 2, 1), keys, out=new("a", n, length, length))
    if max(a.max(), -a.min()) > SAFE:
        a += LATER[:length, :length]
        a -= a.max(axis=-1, keepdims=True)
    np.exp(a, out=a)
    a *= EARLIER[:length, :length]
    share = np.matmul(a.reshape(size, length), ones[:length], out=new("share", size))
    np.divide(1, share, out=share)
    c = new("c", WIDTH, size)
    np.matmul(says[:, :-1], a.transpose(0, 2, 1), out=windows(c))
    c *= share
    h = np.add(e, c, out=new("h", WIDTH, size))
    n2, s2 = evened(h, "2")
    u = np.matmul(w["wide"].T, n2, out=new("u", HIDDEN, size))
    u += w["shift"][:, None]
    np.maximum(u, 0, out=u)
    g = np.matmul(w["back"].T, u, out=new("g", WIDTH, size))
    g += h
    n3, s3 = evened(g, "3")

    out = {}
    z = np.matmul(w["group"].T, n3, out=new("z", GROUPS, size))
    z += w["group_bias"][:, None]
    softmax_slope(z, group, weight)
    out["group"], out["group_bias"] = n3 @ z.T, z @ ones
    dn = np.matmul(w["group"], z, out=new("dn", WIDTH, size))
    # positions whose targets share a group are done in one product; the last row is the bias
    order = np.argsort(group.astype(np.uint8), kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=GROUPS)).tolist()
    rows, both = new("sorted", WIDTH + 1, size), np.concatenate([w["out"], w["bias"][None]])
    n3.take(order, axis=1, out=rows[:-1], mode="clip")
    rows[-1] = 1
    parts = [
        (slice(i, j), slice(k * GROUP, (k + 1) * GROUP))
        for k, (i, j) in enumerate(zip([0, *ends], ends))
        if j > i
    ]
    z = new("within", GROUP, size)
    for mine, part in parts:
        np.matmul(both[:, part].T, rows[:, mine], out=z[:, mine])
    softmax_slope(z, target[order] % GROUP, weight[order])
    slope, back = np.zeros_like(both), new("back", 2 * WIDTH, size)
    for mine, part in parts:
        np.matmul(rows[:, mine], z[:, mine].T, out=slope[:, part])
        np.matmul(w["out"][:, part], z[:, mine], out=back[:WIDTH, mine])
    out["out"], out["bias"] = slope[:-1], slope[-1]
    place = np.empty(size, np.int64)
    place[order] = cols
    dn += back[:WIDTH].take(place, axis=1, out=flat, mode="clip")

    dg = evened_slope(dn, n3, s3)
    out["back"] = u @ dg.T
    du = np.matmul(w["back"], dg, out=new("du", HIDDEN, size))
    du *= u > 0
    out["wide"], out["shift"] = n2 @ du.T, du @ ones
    dh = evened_slope(np.matmul(w["wide"], du, out=new("dh", WIDTH, size)), n2, s2)
    dh += dg
    # the last rows of ``says`` and ``dc`` take the mean slope off each position's own
    dc = new("dc", WIDTH + 1, size)
    np.multiply(dh, share, out=dc[:-1])
    np.matmul(ones[:WIDTH], np.multiply(dc[:-1], c, out=flat), out=dc[-1])
    np.negative(dc[-1], out=dc[-1])
    ds = np.matmul(windows(dc).transpose(0, 2, 1), says, out=new("ds", n, length, length))
    ds *= a
    np.matmul(keys, ds.transpose(0, 2, 1), out=windows(back[:WIDTH]))
    np.matmul(windows(dc[:-1]), a, out=windows(back[WIDTH:]))
    dn = np.matmul(joined, back, out=dn)
    slope = n1 @ back.T
    np.matmul(asks, ds, out=windows(flat))
    dn += flat
    asked, said = slope[:, :WIDTH] * scale, slope[:, WIDTH:]
    out["query"], out["key"] = asked @ w["key"], asked.T @ w["query"]
    out["value"], out["mix"] = said @ w["mix"].T, w["value"].T @ said
    de = evened_slope(dn, n1, s1)
    de += dh
    out["place"] = np.zeros_like(w["place"])
    out["place"][:length] = de.reshape(WIDTH, n, length).sum(axis=1).T
    out["symbol"] = np.stack([np.bincount(at, weights=row, minlength=SYMBOLS) for row in de], axis=1)
    return {name: out[name] for name in w}


def train_windows(vector: np.ndarray, windows: np.ndarray, rate: float, seed: int) -> np.ndarray:
    """Adam over shuffled windows (rows of symbols, -1 after their end), each once."""
    values = vector.astype(np.float64)
    m, v = np.zeros_like(values), np.zeros_like(values)
    size, space = np.empty_like(values), Space()
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(windows))
    for step in range(1, -(-len(windows) // STEP) + 1):
        rows = windows[order[(step - 1) * STEP : step * STEP]]
        x, y = rows[:, :-1], rows[:, 1:]
        slope = to_vector(
            slopes(to_weights(values), np.maximum(x, 0), np.maximum(y, 0), y >= 0, space)
        )
        m *= 0.9
        m += np.multiply(slope, 0.1, out=size)
        v *= 0.99
        slope *= slope
        slope *= 0.01
        v += slope
        np.sqrt(np.divide(v, 1 - 0.99**step, out=size), out=size)
        size += 1e-8
        np.divide(m, size, out=size)
        size *= rate / (1 - 0.9**step)
        values -= size
    return values


def window_places(texts: list[bytes], turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of texts for a round; over all rounds each id and each end is a target once.

    Returns a line of all ids, begins and ends, where windows start and end in it, and the
    number of windows of each text.
    """
    between = np.array([BEGIN], np.uint16).tobytes(), np.array([STOP], np.uint16).tobytes()
    line = np.frombuffer(b"".join(chain.from_iterable((between[0], x, between[1]) for x in texts)), np.uint16)
    lengths = np.array([len(x) // 2 + 2 for x in texts], np.int64)
    last = np.cumsum(lengths)
    begin = np.array([(turn + zlib.crc32(x)) % ROUNDS * LENGTH for x in texts], np.int64)
    many = np.maximum(0, -(-(lengths - 1 - begin) // (ROUNDS * LENGTH)))
    number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    starts = np.repeat(last - lengths + begin, many) + number * (ROUNDS * LENGTH)
    return line, starts, np.minimum(starts + LENGTH + 1, np.repeat(last, many)), many


def window_rows(line: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Windows of a line of symbols as rows, -1 after their end."""
    at = starts[:, None] + np.arange(LENGTH + 1)
    return np.where(at < ends[:, None], line[np.minimum(at, len(line) - 1)], line.dtype.type(-1))


def text_windows(ids: bytes, turn: int) -> list[bytes]:
    """Windows of a text for a round."""
    line, starts, ends, _ = window_places([ids], turn)
    return [line[i:j].tobytes() for i, j in zip(starts, ends, strict=True)]


def train_round(
    texts: DataFrame, vector: np.ndarray, symbols: Symbols, rate: float, seed: int, turn: int
) -> np.ndarray:
    """Every task trains on its windows of the round; the mean of their weights, by windows."""
    most = 200 * STEP

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, total, held, waiting = vector.astype(float), 0, [], 0

        def learn():
            nonlocal values, total, held, waiting
            if waiting:
                values = train_windows(values, np.concatenate(held), rate, seed + total)
            total, held, waiting = total + waiting, [], 0

        for batch in batches:
            found = batch.column(0).to_pylist()
            for first, last in slices([len(x) for x in found], BATCH_BYTES):
                line, starts, ends, many = window_places(found[first:last], turn)
                rows = window_rows(symbols.of[line], starts, ends)
                after, done = np.cumsum(many), 0
                # whole texts until there are enough windows
                while done < len(rows):
                    text = np.searchsorted(after, done + most - waiting)
                    here = after[min(text, len(after) - 1)]
                    held.append(rows[done:here])
                    waiting, done = waiting + here - done, here
                    if waiting >= most:
                        learn()
        learn()
        if total:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(values), dtype=np.int32)),
                    pa.array(values * total),
                    pa.array(np.full(len(values), total, np.int64)),
                ],
                names=["at", "value", "n"],
            )

    parts = texts.select("ids").mapInArrow(work, "at int, value double, n long")
    mean = parts.groupBy("at").agg((F.sum("value") / F.sum("n")).alias("value")).collect()
    out = vector.astype(float).copy()
    for row in mean:
        out[row.at] = row.value
    return out


class Scorer:
    """Scores windows with what depends on a symbol and its place computed beforehand."""

    def __init__(
        self, w: dict[str, np.ndarray], symbols: Symbols, begins: np.ndarray | None = None
    ):
        self.symbols, self.w = symbols, w
        #: Of each symbol, the share of its ids that begin a word.
        self.opening = None
        if begins is not None:
            shares = [
                np.bincount(symbols.of, weights=10.0**symbols.within * kind, minlength=SYMBOLS)
                for kind in (begins, ~begins)
            ]
            opens, others = (x.reshape(GROUPS, GROUP).astype(np.float32) for x in shares)
            self.opening = opens
            #: The groups whose ids all begin a word, if no group holds both kinds.
            mixed = (opens.max(axis=1) > 0) & (others.max(axis=1) > 0)
            self.pure = None if mixed.any() else (opens.max(axis=1) > 0).astype(np.float32)
        e = (w["symbol"][:, None] + w["place"][None]).reshape(-1, WIDTH)
        n1, _ = even(e)
        self.e, self.query = e, n1 @ w["query"] * np.float32(WIDTH**-0.5)
        self.key, self.value = n1 @ w["key"], n1 @ w["value"] @ w["mix"]
        #: Products that give logits, of the groups and within each; biases come last.
        self.group = np.concatenate([w["group"], w["group_bias"][None]]).T.copy()
        both = np.concatenate([w["out"], w["bias"][None]])
        self.out = np.ascontiguousarray(both.reshape(-1, GROUPS, GROUP).transpose(1, 2, 0))
        self.space = Space()
        # logits stay below this, so their exponentials need no shift
        size = lambda m: np.sqrt((m * m).sum(axis=-1)).max()
        self.steady = (
            size(w["out"].T) * WIDTH**0.5 + np.abs(w["bias"]).max() < 80
            and size(w["group"].T) * WIDTH**0.5 + np.abs(w["group_bias"]).max() < 80
            and size(self.query) * size(self.key) < 80
        )

    def softmax_log(self, z: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Natural log of the share of row ``at`` in each column; leaves exponentials."""
        if not self.steady:
            z -= z.max(axis=0)
        hit = z.reshape(-1)[at * z.shape[1] + np.arange(z.shape[1])]
        np.exp(z, out=z)
        hit -= np.log(ONES[:GROUP] @ z)
        return hit

    def opening_log(self, n: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """Natural log of the chance that the next id begins a word, over all symbols."""
        z = (n @ self.w["out"] + self.w["bias"]).reshape(len(n), GROUPS, GROUP)
        if not self.steady:
            z -= z.max(axis=-1, keepdims=True)
        np.exp(z, out=z)
        within = np.einsum("ngs,gs->ng", z, self.opening) / (z @ ONES[:GROUP])
        return np.log(np.maximum((within * groups).sum(axis=1), 1e-30))

    def shares(
        self, x: np.ndarray, y: np.ndarray, first: int, opens: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log of the target's probability at positions ``first``.. of windows.

        Where ``opens``, also of the chance that a word begins there. After the attention,
        positions are columns: sums over a position's numbers run along whole rows.
        """
        w, space, at = self.w, self.space, x * LENGTH + np.arange(LENGTH)
        mine = np.ascontiguousarray(at[:, first:])
        n, length = mine.shape
        size = n * length
        new = lambda name, *shape: space(name, np.float32, *shape)
        take = lambda table, at, name: table.take(
            at, axis=0, out=new(name, *at.shape, WIDTH), mode="clip"
        )
        keys, says = take(self.key, at, "keys"), take(self.value, at, "says")
        a = np.matmul(
            take(self.query, mine, "asks"), keys.transpose(0, 2, 1), out=new("a", n, length, LENGTH)
        )
        if not self.steady:
            a += LATER[first:]
            a -= a.max(axis=-1, keepdims=True)
        np.exp(a, out=a)
        a *= EARLIER[first:]
        h, wide, line = new("h", WIDTH, size), new("wide", HIDDEN, size), new("line", size)
        np.matmul(
            says.transpose(0, 2, 1), a.transpose(0, 2, 1), out=h.reshape(WIDTH, n, length).transpose(1, 0, 2)
        )
        h /= np.matmul(a.reshape(size, LENGTH), ONES, out=line)
        h += take(self.e, mine, "e").reshape(size, WIDTH).T

        def evened(rows: np.ndarray) -> np.ndarray:
            np.multiply(rows, rows, out=flat)
            np.matmul(ONES[:WIDTH], flat, out=line)
            np.multiply(line, np.float32(1 / WIDTH), out=line)
            np.sqrt(np.add(line, np.float32(1e-5), out=line), out=line)
            return np.divide(rows, line, out=flat)

        flat = new("flat", WIDTH, size)
        np.matmul(w["wide"].T, evened(h), out=wide)
        wide += w["shift"][:, None]
        np.maximum(wide, 0, out=wide)
        h += np.matmul(w["back"].T, wide, out=flat)
        # the last row is the bias
        rows = new("rows", WIDTH + 1, size)
        rows[:-1], rows[-1] = evened(h), 1
        target = y.ravel()
        group = target // GROUP
        z = np.matmul(self.group, rows, out=new("z", GROUPS, size))
        logs = self.softmax_log(z, group)
        opening = None
        if opens is not None and self.pure is not None:
            # the product above left the exponentials of the groups
            chance = (self.pure @ z) / (ONES[:GROUPS] @ z)
            opening = np.log(np.maximum(chance, 1e-30)).reshape(y.shape)
        elif opens is not None:
            opening = np.zeros(size, np.float32)
            at = np.flatnonzero(opens.ravel())
            for i in range(0, len(at), OPENED):
                mine = at[i : i + OPENED]
                groups = (z[:, mine] / z[:, mine].sum(axis=0)).T
                opening[mine] = self.opening_log(rows[:-1, mine].T, groups)
            opening = opening.reshape(y.shape)
        # positions whose targets share a group are done in one product
        order = np.argsort(group.astype(np.uint8), kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=GROUPS)).tolist()
        rows = rows.take(order, axis=1, out=new("sorted", WIDTH + 1, size), mode="clip")
        for g, (i, j) in enumerate(zip([0, *ends], ends)):
            if j > i:
                np.matmul(self.out[g], rows[:, i:j], out=z[:, i:j])
        logs[order] += self.softmax_log(z, (target % GROUP)[order])
        return logs.reshape(y.shape), opening

    def token_logs(
        self, texts: list[np.ndarray], begins: np.ndarray | None = None
    ) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """log10 probability of every id of each text, and of its end.

        The second list has, where an id ``begins`` a word (the first of a text excepted,
        which always does), log10 of the chance that any word begins there; 0 elsewhere.
        """
        lengths = np.array([len(ids) + 1 for ids in texts])
        base = np.cumsum(lengths + 1 + LENGTH) - (lengths + 1 + LENGTH)
        line = np.zeros(base[-1] + lengths[-1] + 1 + LENGTH, np.uint16)
        for ids, at in zip(texts, base.tolist(), strict=True):
            line[at] = BEGIN
            line[at + 1 : at + 1 + len(ids)] = ids
            line[at + 1 + len(ids)] = STOP
        marks = self.symbols.of[line].astype(np.int64)
        out = self.symbols.within[line]
        opening = np.zeros(len(line))
        opens = np.zeros(len(line), bool)
        if begins is not None:
            opens = begins[line]
            opens[base + 1] = False
        more = np.maximum(0, -(-(lengths - LENGTH) // STRIDE))
        later = np.repeat(np.arange(len(texts)), more)
        number = np.arange(len(later)) - np.repeat(np.cumsum(more) - more, more) + 1
        for owner, start, first in (
            (np.arange(len(texts)), np.zeros(len(texts), np.int64), 0),
            (later, number * STRIDE, LENGTH - STRIDE),
        ):
            for i in range(0, len(owner), BATCH):
                mine, begin = owner[i : i + BATCH], start[i : i + BATCH]
                places = (base[mine] + begin)[:, None] + np.arange(LENGTH)
                targets = places[:, first:] + 1
                used = begin[:, None] + np.arange(first, LENGTH) < lengths[mine][:, None]
                asked = None if begins is None else opens[targets] & used
                got, chance = self.shares(marks[places], marks[targets], first, asked)
                out[targets[used]] += got[used] / np.log(10)
                if asked is not None:
                    opening[targets[asked]] = chance[asked] / np.log(10)
        ends = list(zip((base + 1).tolist(), (base + 1 + lengths).tolist(), strict=True))
        return [out[i:j] for i, j in ends], [opening[i:j] for i, j in ends]


@functools.lru_cache(1)
def hot_logs(words: bytes, counts: bytes) -> dict[bytes, float]:
    """word -> log10(count + 1); 0 means never in training."""
    logs = np.log10(np.frombuffer(counts, np.int64) + 1.0).tolist()
    return dict(zip(words.split(b" "), logs, strict=True)) if logs else {}


def score_texts(
    docs: DataFrame,
    tokenizer: str,
    modulus: int = 7,
    held_out: int = 2,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Scores of all texts by a model that learns from those not held out.

    Returns key, held_out, n_tokens, n_known, train_tokens, base_score, score. Tokens are
    lower-cased words and one end; the base is their smoothed rate in the training texts,
    the score the model's log10 probability of the same words, joined by single spaces,
    and the end. A null text counts as empty: the end alone. Keys are longs; a null key is
    not held out. Repeated rows are scored alike and counted as often as they come. With
    no training text all counts are 0 and the model is untrained. An empty table gives no
    rows. Other columns are not read.
    """
    vocabulary = len(token_bytes(tokenizer))
    if vocabulary > BEGIN:
        raise ValueError(f"{vocabulary} ids; at most {BEGIN} fit")
    source = docs.select(q(key).cast("long").alias("key"), q(text).alias("text"))
    found = stash(gather(source, tokenizer, modulus, held_out), "gathered")
    words = stash(
        found.where("kind = 1").groupBy("word").agg(F.sum("c").alias("c"), F.sum("t").alias("t")), "words"
    )
    totals = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")
    ).first()
    n, v = totals.n, totals.v
    # words at or above this count in all texts are at most HOT_WORDS
    step = F.floor(F.log2("t") * 16).cast("int")
    histogram = sorted(words.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    least, total = 1 << 30, 0
    for row in histogram:
        total += row.n
        if total > HOT_WORDS:
            break
        least = row.s
    hot = words.where(step >= least).select("word", "c").toArrow()
    names = b" ".join(hot.column("word").to_pylist())
    logs = hot.column("c").to_numpy().astype(np.int64).tobytes()

    counts = np.zeros(1 << 16)
    for row in found.where("kind = 3").groupBy("t").agg(F.sum("c").alias("c")).collect():
        counts[row.t] = row.c
    ends = words.where(F.col("word") == F.lit(END)).select("c").first()
    counts[STOP] = ends.c if ends else 0
    learned_ids = found.where("kind = 0 AND NOT held").select("ids")
    begins = word_begins(token_bytes(tokenizer))
    before = counts_before(learned_ids, frequent_symbols(counts))
    symbols = make_symbols(counts, before, token_bytes(tokenizer))
    vector = to_vector(start_weights(symbols.rates)).astype(float)
    for k in range(ROUNDS):
        vector = train_round(learned_ids, vector, symbols, RATE * 0.5**k, 1000 * k, k)
    model = to_weights(vector)

    norm = float(np.log10(n + (v + 1.0)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pieces = hot_logs(names, logs), token_bytes(tokenizer)
        scorer, table = Scorer(model, symbols, begins), piece_table(pieces)
        kind = pa.list_(pa.struct([("word", pa.binary()), ("log", pa.float64())]))
        for batch in batches:
            texts = [np.frombuffer(x, np.uint16) for x in batch.column("ids").to_pylist()]
            for first, last in slices([1 + len(x) for x in texts], 1 << 17):
                part = texts[first:last]
                tokens = scorer.token_logs(part, begins)
                columns = word_scores(part, *tokens, known, pieces, begins, norm, table)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(x).slice(first, last - first) for x in ("key", "held")],
                        *[pa.array(x, pa.int64()) for x in columns[:2]],
                        *[pa.array(x, pa.float64()) for x in columns[2:4]],
                        pa.array(columns[4], kind),
                    ],
                    names=["key", "held", "tokens", "seen", "logs", "score", "rare"],
                )

    schema = (
        "key long, held boolean, tokens long, seen long, logs double, score double, "
        "rare array<struct<word:binary,log:double>>"
    )
    scored = stash(
        found.where("kind = 0")
        .select("key", "held", "ids")
        .mapInArrow(score, schema)
        .withColumn("row", F.monotonically_increasing_id()),
        "scored",
    )
    # words that are not broadcast are rare: their counts are joined by word
    asked = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.log")
    learned = words.where(step < least).select("word", "c")
    rate = F.log10(F.col("c") + 1.0)
    both = F.log10(
        (1 - RATES) * F.pow(F.lit(10.0), "log") + RATES * F.pow(F.lit(10.0), rate - norm)
    )
    extra = (
        asked.join(learned, "word")
        .groupBy("row")
        .agg(
            F.count_if(F.col("c") > 0).alias("more_seen"),
            F.sum(rate).alias("more_logs"),
            F.sum(F.when(F.col("log") <= 0, both)).alias("more_score"),
        )
    )
    none = F.lit(0.0)
    return scored.drop("rare").join(extra, "row", "left").select(
        F.col("key").alias(key),
        F.col("held").alias("held_out"),
        F.col("tokens").alias("n_tokens"),
        (F.col("seen") + F.coalesce("more_seen", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", none) - F.col("tokens") * norm).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", none)).alias("score"),
    )


def piece_table(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all ids in one array, and where those of each id start and how many they are."""
    sizes = np.array([len(x) for x in pieces], np.int64)
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(sizes) - sizes, sizes


def decode(texts: list[np.ndarray], table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[bytes]:
    """Bytes of texts given as ids."""
    data, starts, sizes = table
    line = np.concatenate(texts)
    many = sizes[line]
    ends = np.cumsum(many)
    out = data[np.repeat(starts[line] - ends + many, many) + np.arange(many.sum())].tobytes()
    last = np.append(0, ends)[np.cumsum([len(x) for x in texts])].tolist()
    return [out[i:j] for i, j in zip([0, *last], last)]


def mixed_log(own: np.ndarray, logs: np.ndarray, norm: float) -> np.ndarray:
    """log10 probability of words by subwords (``own``) and rates (``logs``: of count + 1).

    As in the base score, all unseen words are one type with the rate of a count of 0.
    """
    ten = np.log(10)
    return np.log10((1 - RATES) * np.exp(own * ten) + RATES * np.exp((logs - norm) * ten))


def word_scores(
    texts: list[np.ndarray],
    tokens: list[np.ndarray],
    opening: list[np.ndarray],
    known: dict[bytes, float],
    pieces: list[bytes],
    begins: np.ndarray,
    norm: float,
    table: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[list[dict]]]:
    """Per text: words and end, those seen in training, sum of log10(count + 1), log10
    probability, and (word, log10 by subwords) of those whose count is not at hand.

    A word's subwords count given that a word begins, and with the chance that the next id
    begins another, so the probabilities of all words after a context add up to one. They
    are mixed with the words' own rates, in which all unseen words are one type. Where
    subwords do not part at the spaces (odd white space), subwords alone count; the
    words of such a text that are not at hand are marked by a log above 0. ``table``: that
    of the pieces, if it is at hand.
    """
    words, sizes = [], []
    for data in decode(texts, table or piece_table(pieces)):
        own = data.split()
        words += own
        words.append(END)
        sizes.append(len(own) + 1)
    logs = np.array(list(map(known.get, words)), float)
    here = ~np.isnan(logs)
    logs[~here] = 0
    first_word = np.cumsum(sizes) - sizes
    lengths = np.array([len(x) for x in tokens])
    first_token = np.cumsum(lengths) - lengths
    line = np.full(lengths.sum(), STOP, np.uint16)
    for ids, at in zip(texts, first_token.tolist(), strict=True):
        line[at : at + len(ids)] = ids
    every = np.concatenate(tokens)
    starts = begins[line]
    starts[first_token] = True
    apart = np.add.reduceat(starts, first_token, dtype=np.int64) == sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    own = np.ones(len(words))
    at = np.flatnonzero(starts)
    chance = np.concatenate(opening)[at]
    # less the chance that a word begins here, plus that of another after it; ends have none
    after = np.where(line[at] == STOP, 0, np.append(chance[1:], 0))
    whole = np.add.reduceat(every, at) - chance + after
    own[apart[owner]] = whole[np.repeat(apart, np.add.reduceat(starts, first_token, dtype=np.int64))]
    both = np.where(here & apart[owner], mixed_log(own, logs, norm), 0)
    score = np.where(apart, np.add.reduceat(both, first_word), np.add.reduceat(every, first_token))
    rare: list[list[dict]] = [[] for _ in texts]
    for i in np.flatnonzero(~here).tolist():
        rare[owner[i]].append({"word": words[i], "log": own[i]})
    seen = np.add.reduceat((logs > 0).astype(np.int64), first_word)
    return np.array(sizes), seen, np.add.reduceat(logs, first_word), score, rare
