"""Url rules, near duplicates, packing, mixing and the pipeline, by brute force."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from oracle_check import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tokenloom.llm import (
    components as cc,
    embedding_dedup as ed,
    mixing as mx,
    packing as pk,
    queries,
    simhash_dedup as sd,
    url_filters as uf,
)

BPE = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_matches_sql(spark, name):
    text, _, _ = compare(spark, connect(SMALL), SMALL, name, queries.QUERIES[name], queries.SQL[name])
    assert text.startswith("ok"), text


def test_every_query_runs(spark):
    for name, query in queries.QUERIES.items():
        assert query(spark, SMALL).count() > 0, name


URLS = [
    None, "", "no scheme", "http://", "http://Example.ORG", "https://a.example.org/es/1?x=/en/1", "x://org/",
    "http://example.org/es/", "http://example.org/es", "http://notexample.org/es/", "http://example.org/en/12#a",
    "http://example.org?/es/", "http://com/de/x", "http://a.b.com/fr/y", "http://com:80/de/", "http://a..org/z",
    "http://example.org/es/://x.com/de/", "http://\x01org/\x02", "http://example.org/es/", "http://org/a/b/c",
]
RULES = [*queries.URL_RULES, ("org", "/a/b", "block"), ("org", "/a/b", "allow"), ("", "/x", "block"), ("com", None, "allow")]


def brute_url(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fits = [
        (len(h + (p or "")), h + (p or ""), v)
        for h, p, v in RULES
        if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")
    ]
    if not fits:
        return host, path, None, "none"
    longest = max(fits)[0]
    rule = max(r for n, r, _ in fits if n == longest)
    return host, path, rule, min(v for n, r, v in fits if r == rule)


@pytest.mark.parametrize("ranges", [None, 2, 40])
def test_url_rules_by_brute_force(spark, ranges):
    pages = spark.createDataFrame(
        [(i % 19 if i % 7 else None, url, "x", "y") for i, url in enumerate(URLS * 3)],
        "page_id long, url string, host string, rule string",
    )
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = uf.judge_urls(pages, rules, default="none", ranges=ranges)
    want = [(i % 19 if i % 7 else None, *brute_url(url)) for i, url in enumerate(URLS * 3)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_url_rules_without_rows(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert uf.judge_urls(empty, rules).collect() == []
    page = spark.createDataFrame([(1, "http://org/")], "page_id long, url string")
    assert tuple(uf.judge_urls(page, rules.limit(0)).first()) == (1, "org", "/", None, "allow")


def brute_components(near):
    low = np.arange(len(near))
    while True:
        new = np.array([min(low[i], low[row].min()) if row.any() else low[i] for i, row in enumerate(near)])
        if (new == low).all():
            return low
        low = new


def test_components(spark):
    draw = np.random.default_rng(4)
    links = [*draw.integers(0, 300, (200, 2)).tolist(), *[[500, i] for i in range(501, 900)], *[[i, i + 1] for i in range(1000, 1060)], [7, 7]]
    found = {x.node: x.component for x in cc.components(spark.createDataFrame(links, "a long, b long")).collect()}
    near = np.zeros((1100, 1100), bool)
    for a, b in links:
        near[a, b] = near[b, a] = True
    want = brute_components(near)
    assert found == {i: want[i] for i in np.unique([x for p in links if p[0] != p[1] for x in p]).tolist()}
    assert cc.components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_simhash(text):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


@pytest.mark.parametrize("shard,tile", [(4096, 8192), (4, 3)])
def test_simhash_links_by_brute_force(spark, monkeypatch, shard, tile):
    """Clusters around random fingerprints, chained so that components reach far."""
    monkeypatch.setattr(sd, "SHARD", shard)
    monkeypatch.setattr(sd, "TILE", tile)
    draw = np.random.default_rng(7)
    points = set()
    for _ in range(25):
        at = int(draw.integers(0, 1 << 63))
        for _ in range(int(draw.integers(1, 12))):
            points.add(at)
            for bit in draw.integers(0, 64, int(draw.integers(1, 5))).tolist():
                at ^= 1 << bit
    fps = np.array(sorted(points), np.uint64)
    rows = [(int(x),) for x in fps.view(np.int64)]
    prints = spark.createDataFrame(rows, "fp long")
    found = {x.fp: x.component for x in sd.component_table(prints).collect()}
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 3
    low = brute_components(near)
    groups = {}
    for x, c in zip(fps.view(np.int64).tolist(), low.tolist(), strict=True):
        groups.setdefault(c, []).append(x)
    assert found == {x: min(g) for g in groups.values() for x in g}


def test_simhash_odd_rows(odd_docs, clashing_docs, no_docs):
    found = sd.simhash_components(odd_docs).collect()
    want = {x.doc_id: brute_simhash(x.text) for x in odd_docs.collect() if x.doc_id != 8}
    assert all(x.fingerprint == format(want[x.doc_id], "016x") for x in found if x.doc_id != 8)
    component = {x.doc_id: x.component_id for x in found}
    assert component[2] == component[3] == 2 and component[5] == 1 and component[None] is None
    assert len(found) == 12 and sd.simhash_components(no_docs).collect() == []
    kept = sd.keep_one(clashing_docs)
    assert kept.columns == clashing_docs.columns
    assert kept.where("doc_id = 5 or doc_id = 3").isEmpty() and kept.where("doc_id is null").count() == 1
    assert kept.count() == len({(x.component_id, x.doc_id is None) for x in found})


def test_repeated_rows_of_one_group_keep_one(spark):
    docs = spark.createDataFrame([(3, "same text here")] * 4 + [(None, "same text here"), (4, "other words")], "doc_id long, text string")
    assert sorted(sd.keep_one(docs).collect()) == [(3, "same text here"), (4, "other words")]


@pytest.mark.parametrize("tile", [2000, 7])
def test_embedding_links_by_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(ed, "TILE", tile)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(60, 32))
    vectors = np.concatenate([c + draw.normal(size=(6, 32)) * s for c, s in zip(centres, np.linspace(0.05, 0.4, 60), strict=True)])
    vectors = np.concatenate([vectors, vectors[:40], 3 * vectors[:5]])
    labels = [None if i % 50 == 0 else i // 6 % 3 for i in range(360)]
    labels = labels + labels[:40] + labels[:5]
    rows = [(i, x.tolist(), label) for i, (x, label) in enumerate(zip(vectors, labels, strict=True))]
    odd = [
        (900, None, 1), (901, [], 1), (902, [0.0] * 32, 1), (903, [float("nan")] * 32, 1), (904, [None] * 32, 1),
        (905, [float("inf")] * 32, 1), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1), (908, [1e-200] * 32, 1), (909, [1e200] * 32, 1),
    ]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    found = {x.vec_id: x for x in ed.embedding_components(table).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    same = np.array([[a is not None and a == b for b in labels] for a in labels])
    near = (unit @ unit.T >= 0.93) & same
    np.fill_diagonal(near, False)
    pairs = sum(found[i].n_links for i in range(len(rows)))
    assert near.sum() > 500 and pairs >= 0.99 * near.sum() and pairs <= near.sum()
    low = brute_components(near)
    assert np.mean([found[i].component_id == low[i] for i in range(len(rows))]) > 0.99
    for i in (900, 901, 902, 903, 904, 905):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert found[907].component_id == 906 and found[909].component_id == 908 and not found[909].kept
    assert ed.embedding_components(table.limit(0)).collect() == []


def test_embedding_recall_on_a_table(spark):
    """Recall of pairs against brute force over a table with planted near copies."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("vec_id < 1500")
    rows = table.collect()
    draw = np.random.default_rng(8)
    near = [
        (10_000 + x.vec_id, (np.array(x.embedding) + draw.normal(size=64) * 0.045).tolist(), x.label) for x in rows[:500]
    ]
    both = table.select("vec_id", F.col("embedding").cast("array<double>"), "label").unionByName(
        spark.createDataFrame(near, "vec_id long, embedding array<double>, label int")
    )
    found = ed.embedding_components(both).agg(F.sum("n_links")).first()[0]
    unit = np.array([x.embedding for x in rows] + [x[1] for x in near])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    labels = np.array([x.label for x in rows] + [x[2] for x in near])
    links = ((unit @ unit.T >= 0.93) & (labels[:, None] == labels[None])).sum() - len(unit)
    assert links > 300 and links >= found >= 0.97 * links


def test_best_fit_equals_one_at_a_time():
    """Bulk placement gives the bins of best-fit decreasing one piece at a time."""
    draw = np.random.default_rng(2)
    for most, n in ((10, 40), (64, 300), (1024, 500)):
        lengths = draw.integers(1, most + 1, n).tolist()
        counts = {x: lengths.count(x) for x in lengths}
        bins = {}
        for length, first, last, at, offset in pk.best_fit(counts, most):
            for i in range(last - first + 1):
                bins.setdefault(at + i, []).append((offset, length))
        rooms = []
        for length in sorted(lengths, reverse=True):
            fits = [r for r in rooms if r >= length]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - length)
            else:
                rooms.append(most - length)
        assert sorted(most - sum(x for _, x in b) for b in bins.values()) == sorted(rooms)
        for b in bins.values():
            at = 0
            for offset, length in sorted(b):
                assert offset == at
                at += length
        assert sorted(x for b in bins.values() for _, x in b) == sorted(lengths)


def test_packing_round_trip(odd_docs, clashing_docs, no_docs):
    whole = Tokenizer.from_file(BPE)
    packed = pk.pack_documents(odd_docs, BPE, most=64).collect()
    ids = {x.doc_id: [*whole.encode(x.text or "", add_special_tokens=False).ids, 2] for x in odd_docs.collect()}
    total = 0
    for x in packed:
        own = ids[x.doc_id][x.start : x.start + x.length]
        assert len(own) == x.length and zlib.crc32(np.array(own, "<u4").tobytes()) == x.ids_crc32
        assert x.length == 64 or x.piece == 0
        total += x.length
    assert total == sum(len(ids[x.doc_id]) for x in odd_docs.collect())
    bins = {}
    for x in packed:
        bins.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= -(-total // 64) + 1
    assert len(pk.pack_documents(clashing_docs, BPE, most=64).collect()) == len(packed)
    assert pk.pack_documents(no_docs, BPE).collect() == []
    assert pk.read_sequences(pk.pack_documents(odd_docs, BPE, most=64)).count() == len(bins)


def brute_targets(sizes, weights, most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: most * sizes[s] for s in free if target[s] > most * sizes[s]}
        if not over:
            return {**target, **capped}
        capped.update(over)


def test_mixing_targets(odd_docs, clashing_docs, no_docs):
    rows = odd_docs.collect()
    size = lambda x: len(re.findall("[^\x20\x09-\x0D]+", x.text or ""))
    sizes = {}
    for x in rows:
        sizes[x.source] = sizes.get(x.source, 0) + size(x)
    targets = brute_targets(sizes, (5, 2, 1))
    found = mx.mix_sources(odd_docs).collect()
    assert sorted((x.doc_id, x.size, x.source_size) for x in found if x.doc_id) == sorted(
        (x.doc_id, size(x), sizes[x.source]) for x in rows if x.doc_id
    )
    by_source = {x.doc_id: x.source for x in rows}
    for x in found:
        assert abs(x.target - targets[by_source[x.doc_id]]) < 1e-6 and 0 <= x.taken <= 3 * x.size
    for source, target in targets.items():
        assert abs(sum(x.taken for x in found if by_source[x.doc_id] == source) - target) <= 2, source
    again = mx.mix_sources(clashing_docs).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, again), key=repr)
    assert mx.mix_sources(no_docs).collect() == []


def test_mixing_in_blocks(documents):
    """Few, large blocks over many shards still come near the targets."""
    found = mx.mix_sources(documents, blocks=400).join(documents.select("doc_id", "source"), "doc_id")
    sums = found.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    total = sum(x.target for x in sums)
    assert all(abs(x.taken - x.target) < total / 100 for x in sums)


def test_sainte_lague_by_brute_force(spark):
    draw = np.random.default_rng(6)
    for seats in (0, 1, 7, 500):
        votes = draw.integers(0, 200, 12).tolist()
        quotas = [0] * len(votes)
        for _ in range(seats):
            best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * quotas[i] + 1), -i))
            quotas[best] += 1
        table = spark.createDataFrame([(0, i, float(v), seats) for i, v in enumerate(votes)], "g int, i int, v double, s long")
        found = mx.sainte_lague(table, "v", "s", ["g"], "i").collect()
        assert {x.i: x.quota for x in found} == dict(enumerate(quotas))


def test_pipeline_stages_by_hand(spark, tmp_path, odd_docs, clashing_docs):
    folder = str(tmp_path)
    clashing_docs.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (6, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == clashing_docs.columns
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        seen[name] = docs.collect()
    assert {x.doc_id for x in seen["language"]} == {1, 5, 6, None, 7, 8, 9, 10}
    assert {x.doc_id for x in seen["toxicity"]} <= {x.doc_id for x in seen["language"]}
    ids = [x.doc_id for x in seen["near_copies"]]
    assert 5 not in ids and len(ids) == len(set(ids))
    assert {x.doc_id for x in seen["mixing"]} <= set(ids)
    assert {x.doc_id for x in seen["packing"]} == {x.doc_id for x in seen["mixing"]}
    run = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, run.collect()), key=repr) == sorted(map(tuple, seen["packing"]), key=repr)


def test_pipeline_of_an_empty_table(spark, tmp_path, no_docs):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_language_stage_without_any_language(spark, odd_docs):
    """No label at all: documents stay, but for those without a letter."""
    docs = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    left = corpus_pipeline.known_language(spark, docs, "").collect()
    assert {x.doc_id for x in left} == {1, 5, 6, None, 7, 8, 9, 10} and len(left) == 9


def test_near_copy_stage_is_the_operator(spark, documents):
    """One document, the least id, of each component of op5 stays."""
    ids = sd.simhash_components(documents, width=3, seed=42, most=3).collect()
    left = corpus_pipeline.one_of_near_copies(spark, documents, "").collect()
    assert sorted(x.doc_id for x in left) == sorted({x.component_id for x in ids})


def test_pipeline_keeps_clean_documents(spark):
    """No clean document with a label goes before the near-copy stage."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    first = corpus_pipeline.known_language(spark, docs, "/root/testdata/sf0.01")
    assert first.count() == docs.count()
    second = corpus_pipeline.harmless(spark, docs, "/root/testdata/sf0.01")
    lost = docs.join(second, "doc_id", "left_anti").join(labels, "doc_id")
    assert lost.where("toxic = 0").count() <= 0.01 * labels.count()
