"""Queries of the subpackage over the given tables."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.llm.byte_bpe import coding_digests
from tokenloom.llm.embedding_dedup import embedding_components
from tokenloom.llm.frames import id_remainder
from tokenloom.llm.language_id import identify_languages, learn_languages, training_rows
from tokenloom.llm.lm_scoring import score_texts
from tokenloom.llm.merkle import edited_fingerprints
from tokenloom.llm.merkle_manifest import tampered_manifest
from tokenloom.llm.mixing import mix_sources
from tokenloom.llm.packing import pack_documents
from tokenloom.llm.simhash_dedup import simhash_components
from tokenloom.llm.spelling_variants import spelling_variants
from tokenloom.llm.token_counts import token_counts
from tokenloom.llm.toxicity import learn_severity, score_severity, severity_grades
from tokenloom.llm.url_filters import judge_urls, rule_table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Ranks of the vocabulary that language-model scoring and byte-level coding read texts by.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: (host, path, verdict)
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    return judge_urls(table(spark, sf, "pages"), rule_table(spark, URL_RULES))


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = learn_languages(training_rows(docs, "doc_id", 3, 1))
    found = identify_languages(docs, model)
    return found.select(
        "doc_id", (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score"
    )


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(table(spark, sf, "documents"), TOKENIZER, limit=512)


def op4_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_components(table(spark, sf, "embeddings"), least=0.93)


def op5_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_components(table(spark, sf, "documents"), width=3, seed=42, most=3)


def op6_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return score_texts(table(spark, sf, "documents"), RANKS, modulus=7, held_out=2)


def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(table(spark, sf, "documents"), TOKENIZER, end_id=2, most=1024)


def op8_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix_sources(table(spark, sf, "documents"), weights=(5, 2, 1), most=3)


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = learn_severity(docs, severity_grades(table(spark, sf, "labels")))
    return score_severity(docs, model)


def op10_merkle_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf, "documents"))


def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(table(spark, sf, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return tampered_manifest(table(spark, sf, "documents"))


def op13_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return coding_digests(table(spark, sf, "documents"), RANKS, public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_language_id": op2_language_id,
    "op3_token_counts": op3_token_counts,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_source_mixing": op8_source_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_merkle_fingerprints": op10_merkle_fingerprints,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_byte_bpe": op13_byte_bpe,
}

SQL: dict[str, str] = {
    "op1_url_filters": r"""
WITH judged AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path,
    row_number() OVER () AS n
  FROM pages),
rules(r_host, r_path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT n, arg_max(r_host || r_path, length(r_host || r_path)) AS rule,
    arg_max(verdict, length(r_host || r_path)) AS verdict
  FROM judged JOIN rules
    ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM judged LEFT JOIN fits USING (n)""",
    "op10_merkle_fingerprints": r"""
WITH docs AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, coalesce(text, '')) AS n, doc_id,
    coalesce(text, '') AS text
  FROM documents),
paired AS (
  SELECT a.n, a.doc_id, a.text, b.text AS next, length(a.text) // 4 AS cut
  FROM docs a JOIN docs b ON b.n = a.n % (SELECT count(*) FROM docs) + 1),
texts AS (
  SELECT n, 0 AS kind, text FROM paired UNION ALL
  SELECT n, 1, left(text, length(text) - cut) || left(next, cut) FROM paired),
trees AS (
  SELECT n, kind, text, CASE WHEN text = '' THEN [] ELSE list_transform(
    string_split(regexp_replace(text, '\n(\n+)', chr(10) || '\1' || chr(2), 'g'), chr(2)),
    lambda s: list_transform(string_split(s, chr(10)),
      lambda p: list_transform(string_split(
        regexp_replace(
          regexp_replace(p, '([!-/:-@\[-`{-~])([ \t]+)', '\1\2' || chr(1), 'g'),
          '([^\x01]{256})', '\1' || chr(1), 'g'), chr(1)),
        lambda x: sha256(x)))) END AS tree
  FROM texts),
roots AS (
  SELECT n, kind, text, list_distinct(flatten(flatten(tree))) AS leaves,
    sha256(length(text) || ':' || array_to_string(list_transform(tree,
      lambda s: sha256(array_to_string(list_transform(s, lambda p: sha256(array_to_string(p, ''))), ''))), ''))
      AS fingerprint
  FROM trees),
own AS (SELECT * FROM roots WHERE kind = 0),
edited AS (SELECT * FROM roots WHERE kind = 1)
SELECT d.doc_id, CAST(length(d.text) AS BIGINT) AS n_chars, sha256(e.text) AS edited_sha256,
  o.fingerprint, e.fingerprint AS edited_fingerprint,
  CASE WHEN len(o.leaves) + len(e.leaves) = 0 THEN 1.0 ELSE
    CAST(len(list_intersect(o.leaves, e.leaves)) AS DOUBLE)
    / (len(o.leaves) + len(e.leaves) - len(list_intersect(o.leaves, e.leaves))) END AS near_edited,
  CASE WHEN len(o.leaves) + len(x.leaves) = 0 THEN 1.0 ELSE
    CAST(len(list_intersect(o.leaves, x.leaves)) AS DOUBLE)
    / (len(o.leaves) + len(x.leaves) - len(list_intersect(o.leaves, x.leaves))) END AS near_next
FROM docs d JOIN own o USING (n) JOIN edited e USING (n)
JOIN own x ON x.n = d.n % (SELECT count(*) FROM docs) + 1""",
    "op11_spelling_variants": r"""
WITH RECURSIVE
crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295,
      list_transform(range(1, len(digits) // 2 + 1),
        lambda i: ('0x' || digits[2 * i - 1] || digits[2 * i])::BIGINT)),
      lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS digits FROM runs), crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT n, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::BIGINT)
      || substring(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (
  SELECT word, n, i, left(word, i - 1) AS a, substring(word, i + 1) AS b
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT x.word, y.word AS near, y.n FROM cuts x JOIN cuts y
    ON x.a || chr(10) || x.b = y.a || chr(10) || y.b AND x.word <> y.word
  UNION
  SELECT x.word, y.word, y.n FROM cuts x JOIN words y ON x.a || x.b = y.word
  UNION
  SELECT y.word, x.word, x.n FROM cuts x JOIN words y ON x.a || x.b = y.word),
near AS (
  SELECT word, count(*) AS n_near, max(n) AS best_n FROM pairs GROUP BY word),
best AS (
  SELECT p.word, min(p.near) AS best FROM pairs p JOIN near USING (word) WHERE p.n = best_n GROUP BY p.word),
named AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN best_n >= 10 * w.n THEN best END AS form, CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN near USING (word) LEFT JOIN best USING (word)),
chains AS (
  SELECT word, word AS root, form AS next FROM named
  UNION ALL
  SELECT c.word, n.word, n.form FROM chains c JOIN named n ON n.word = c.next)
SELECT word, form, root, n, n_near, form_n
FROM named JOIN (SELECT word, root FROM chains WHERE next IS NULL) USING (word)""",
    "op12_merkle_manifest": r"""
WITH RECURSIVE
crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs),
fields AS (
  SELECT doc_id, lang, n_chars, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') ||
    coalesce(strlen(source) || ':' || source, '-') ||
    coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 7 = 0 AS hit
  FROM documents, crc_table),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM (SELECT doc_id, lang,
    sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + hit::INT)::VARCHAR) || ':' || (n_chars + hit::INT), '-') || tail) AS other
    FROM (SELECT * REPLACE (coalesce(hit, false) AS hit) FROM fields))),
levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range((len(nodes) + 1) // 2),
    lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM levels WHERE len(nodes) > 1),
subroots AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
  FROM levels WHERE len(nodes) = 1),
tops AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots HAVING count(*) > 0
  UNION ALL
  SELECT level + 1, list_transform(range((len(nodes) + 1) // 2),
    lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM tops WHERE len(nodes) > 1),
steps AS (
  SELECT lang, 0 AS part, level, nodes FROM levels WHERE len(nodes) > 1
  UNION ALL
  SELECT lang, 1, level, nodes FROM subroots, tops WHERE len(nodes) > 1),
paths AS (
  SELECT l.lang, l.place, l.doc_id, l.leaf, l.other, s.subroot,
    list({own: (CASE t.part WHEN 0 THEN l.place ELSE s.place END >> t.level) % 2,
      sibling: coalesce(t.nodes[xor(CASE t.part WHEN 0 THEN l.place ELSE s.place END >> t.level, 1) + 1], '')}
      ORDER BY t.part, t.level) FILTER (t.level IS NOT NULL) AS path
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
  LEFT JOIN steps t ON t.lang IS NOT DISTINCT FROM l.lang
  GROUP BY ALL),
folded AS (
  SELECT *, list_reduce(list_prepend({own: 0::BIGINT, sibling: other}, coalesce(path, [])),
    lambda a, b: {own: 0::BIGINT, sibling: sha256(CASE b.own WHEN 0 THEN a.sibling || b.sibling
      ELSE b.sibling || a.sibling END)}).sibling AS folded_root
  FROM paths)
SELECT doc_id, leaf, subroot, nodes[1] AS root,
  sha256(array_to_string(list_transform(coalesce(path, []), lambda x: x.sibling), '')) AS proof_sha256,
  folded_root, folded_root = nodes[1] AS verified
FROM folded, tops WHERE len(nodes) = 1""",
}
