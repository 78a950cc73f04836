"""The manifest against a tree built by hand, with small blocks so that all rounds run."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tokenloom.llm.merkle_manifest import fold, merkle_manifest, tampered_manifest


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves: list[str], fanout: int) -> tuple[str, list[list[str]]]:
    """Root, and per leaf the joined siblings of each level."""
    paths: list[list[str]] = [[] for _ in leaves]
    level, places = leaves, list(range(len(leaves)))
    while len(level) > 1:
        for i, place in enumerate(places):
            first = place - place % fanout
            run = level[first : first + fanout]
            paths[i].append("".join(run[: place - first] + run[place - first + 1 :]))
            places[i] = place // fanout
        level = [h("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
    return level[0], paths


def by_hand(groups: dict, fanout: int) -> dict:
    """(group, leaf) -> subroot, root, proof; leaves in order."""
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subtrees = {g: tree(groups[g], fanout) for g in order}
    root, above = tree([subtrees[g][0] for g in order], fanout)
    return {
        (g, i): (subtrees[g][0], root, h("".join(path + above[at])))
        for at, g in enumerate(order)
        for i, path in enumerate(subtrees[g][1])
    }


@pytest.mark.parametrize("fanout,block", [(2, 2), (2, 4), (3, 3), (2, 4096)])
def test_all_rounds(spark, fanout, block):
    sizes = {None: 1, "a": 2, "b": 5, "c": 33, "ä": 64, "z": 19}
    rows = [(g, i, h(f"{g}{i}")) for g, n in sizes.items() for i in range(n)]
    leaves = spark.createDataFrame(rows, "lang string, id int, leaf string").repartition(5)
    made = merkle_manifest(leaves, "lang", "id", "leaf", fanout, block)
    wanted = by_hand({g: [h(f"{g}{i}") for i in range(n)] for g, n in sizes.items()}, fanout)
    rows = made.withColumn("folded", fold(F.col("leaf"), F.col("steps"))).collect()
    assert len(rows) == sum(sizes.values())
    for row in rows:
        proof = h("".join(x.before + x.after for x in row.steps))
        assert (row.subroot, row.root, proof) == wanted[row.lang, row.id]
        assert row.folded == row.root


def leaf_of(row, more: int = 0) -> str:
    parts = []
    for name in ("doc_id", "source", "lang", "n_chars", "text"):
        value = row[name]
        if name == "n_chars" and value is not None:
            value += more
        parts.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return h("".join(parts))


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    source = odd_docs.collect()
    groups: dict = {}
    for row in source:
        groups.setdefault(row.lang, []).append((row.doc_id is not None, row.doc_id or 0, leaf_of(row)))
    wanted = by_hand({g: [x[2] for x in sorted(rows)] for g, rows in groups.items()}, 2)
    proofs = {g: sorted(v[2] for k, v in wanted.items() if k[0] == g) for g in groups}
    for docs in (odd_docs, clashing_docs):
        rows = tampered_manifest(docs, block_leaves=2).collect()
        assert len(rows) == len(source)
        assert sorted(r.leaf for r in rows) == sorted(map(leaf_of, source))
        assert sorted(r.proof_sha256 for r in rows) == sorted(x for v in proofs.values() for x in v)
        by_leaf = {leaf_of(row): row for row in source}
        for row in rows:
            before = by_leaf[row.leaf]
            hit = before.doc_id is not None and zlib.crc32(str(before.doc_id).encode()) % 7 == 0
            assert row.verified == (not hit or before.n_chars is None)
    assert tampered_manifest(no_docs).count() == 0


def test_documents_are_verified_but_for_tampered_ones(spark, documents):
    rows = tampered_manifest(documents, block_leaves=16).collect()
    chars = {row.doc_id: row.n_chars for row in documents.collect()}
    for row in rows:
        hit = zlib.crc32(str(row.doc_id).encode()) % 7 == 0 and chars[row.doc_id] is not None
        assert row.verified != hit
    assert 0 < sum(not row.verified for row in rows) < len(rows)


def test_names_must_be_free(spark):
    with pytest.raises(ValueError, match="free"):
        merkle_manifest(spark.createDataFrame([(1, "x", "r")], "k int, leaf string, root string"), "k", "k")
