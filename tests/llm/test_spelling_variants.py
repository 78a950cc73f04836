"""Spelling variants against all pairs, on random words and on whole tables of odd rows."""

import random
import re
import zlib
from collections import Counter

import pytest

from tokenloom.llm import spelling_variants as sv
from tokenloom.llm.frames import stash


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return b[i:] in (a[i + 1 :],) or a[i:] == b[i + 1 :] or (len(a) == len(b) and a[i + 1 :] == b[i + 1 :])


def by_hand(counts: dict[str, int], ratio: int = 10) -> set:
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form, rows = {}, set()
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best is not None and counts[best] >= ratio * counts[word] else None
    for word in counts:
        root = word
        while form[root] is not None:
            root = form[root]
        named = form[word]
        rows.add((word, named, root, counts[word], len(near[word]), counts[named] if named else None))
    return rows


def words_by_hand(rows) -> dict[str, int]:
    counts: Counter = Counter()
    for row in rows:
        text = "".join(c.lower() if c.isascii() else c for c in row.text or "")
        for run in re.findall("[a-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{'' if row.doc_id is None else row.doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_index_finds_all_pairs():
    rng = random.Random(0)
    for trial in range(60):
        letters = ("ab", "abcé÷ÿ", "abcdefgh")[trial % 3]
        made = {"".join(rng.choice(letters) for _ in range(rng.randrange(4, 10))) for _ in range(50)}
        words = sorted(made, key=lambda _: rng.random())
        shard = sv.Shard(words, [rng.randrange(1, 6) for _ in words])
        asking = [*words, "a" * 12, "zzzz", "xyxyx", "a" * 300]
        found: dict[str, list] = {}
        for forward in (True, False):
            for word, n, count, best in shard.ask(asking, forward):
                found.setdefault(word, []).append((n, count, best))
        for word in asking:
            near = [v for v in words if one_edit(word, v)]
            assert sum(x[0] for x in found.get(word, [])) == len(near), word
            if near:
                counts = dict(zip(words, shard.counts.tolist(), strict=True))
                wanted = min((-counts[v], v) for v in near)
                assert min((-c, b) for _, c, b in found[word]) == wanted


def test_suffix_order():
    rng = random.Random(1)
    for text in ([0], [0, 0], [0, 1, 1, 1, 0], [rng.randrange(3) for _ in range(200)]):
        order = sv.suffix_order(sv.np.array(text))
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("letters", [400_000, 300])
def test_tiles_leave_no_pair_out(spark, monkeypatch, letters):
    """Whole index, or many shards of which hot ones are cut into tiles."""
    monkeypatch.setattr(sv, "INDEX_LETTERS", letters)
    rng = random.Random(2)
    counts = {}
    for _ in range(150):
        stem = "commonly"[: rng.randrange(3, 9)] + "".join(rng.choice("abé") for _ in range(rng.randrange(4, 6)))
        counts[stem] = rng.choice([2, 3, 40, 900])
    counts = {w: n for w, n in counts.items() if len(w) >= 7}
    words = stash(spark.createDataFrame(list(counts.items()), "word string, n long"), "words")
    rows = {tuple(r) for r in sv.near_words(words).collect()}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    wanted = set()
    for word, others in near.items():
        if others:
            best = min(others, key=lambda v: (-counts[v], v))
            wanted.add((word, len(others), counts[best], best))
    assert rows == wanted and len(rows) > 50


def test_chains_of_forms(spark):
    """Counts 2, 20, ... 2*10^5: five steps to the root."""
    words = ["abcdefg" + "h" * i for i in range(6)]
    rows = [(words[i], words[i + 1]) for i in range(5)]
    forms = stash(spark.createDataFrame(rows, "word string, form string"), "forms")
    assert {tuple(r) for r in sv.last_forms(forms, 6).collect()} == {(w, words[5]) for w in words[:5]}


def test_documents(spark, documents):
    rows = documents.limit(60).collect()
    docs = spark.createDataFrame(rows, documents.schema)
    assert {tuple(r) for r in sv.spelling_variants(docs).collect()} == by_hand(words_by_hand(rows))


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    wanted = by_hand(words_by_hand(odd_docs.collect()))
    for docs in (odd_docs, clashing_docs):
        assert {tuple(r) for r in sv.spelling_variants(docs).collect()} == wanted
    assert sv.spelling_variants(no_docs).count() == 0


def test_long_words_and_runs_of_one_letter(spark):
    long = ["a" * 700, "a" * 701, "ab" * 300, "ab" * 299 + "b", "é" * 8, "é" * 7 + "÷", "aaaaaaaa"]
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(zip(long, (2, 25, 3, 3, 30, 2, 2)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = by_hand(words_by_hand(docs.collect()))
    assert {tuple(r) for r in sv.spelling_variants(docs).collect()} == wanted


def test_arguments(no_docs):
    with pytest.raises(ValueError):
        sv.spelling_variants(no_docs, least_letters=1)
