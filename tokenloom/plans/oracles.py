"""SQL that computes every query's result from the given tables, on its own terms."""

from __future__ import annotations

from tokenloom.plans import queries as q
from tokenloom.sources.snapshots import BLOCK_TOKENS

W = r"[\s\x0b\x{85}\p{Z}]"
N = r"[^\s\x0b\x{85}\p{Z}]"
# The look-ahead is written as a mark before the last blank of a run.
PATTERN = (
    r"''(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\x0b\x{85}\p{Z}\p{L}\p{N}\x{E000}]+|" + W + "+"
)
DELIMITER = "<|endoftext|>"


def words_of(text: str) -> str:
    marked = rf"regexp_replace({text}, '({W})({W}{N})', '\1' || chr(57344) || '\2', 'g')"
    return f"regexp_extract_all({marked}, '{PATTERN}')"


def lifted(text: str) -> str:
    byte = f"chr(('0x' || substr(hex(encode({text})), i::INT, 2))::INT)"
    return (
        f"CASE WHEN strlen({text}) = length({text}) THEN {text} ELSE "
        f"array_to_string(list_transform(range(1, strlen({text}) * 2 + 1, 2), lambda i: {byte}), '') END"
    )


def hexed(text: str) -> str:
    return (
        f"coalesce(array_to_string(list_transform(range(1, length({text}) + 1), "
        f"lambda i: lpad(hex(ord(substr({text}, i::INT, 1))), 2, '0')), ''), '')"
    )


def ids_of(sym: str) -> str:
    return (
        f"list_transform(range(1, length({sym}) + 1), lambda i: ord(substr({sym}, i::INT, 1)))"
    )


PRE = f"""pre AS MATERIALIZED (
  SELECT pretoken, count(*) AS freq
  FROM (SELECT unnest({words_of('text')}) AS pretoken FROM documents) GROUP BY pretoken
), w0 AS MATERIALIZED (
  SELECT pretoken, {lifted('pretoken')} AS sym, freq FROM pre
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def pairs_of(words: str) -> str:
    return f"""SELECT substr(sym, i::INT, 2) AS pair, sum(freq)::BIGINT AS n
  FROM (SELECT sym, freq, unnest(range(1, length(sym))) AS i FROM {words}) GROUP BY 1"""


def rounds(n: int, first_symbol: str = "256", by_bytes: bool = True) -> str:
    """One merge per step: pick, rewrite, remember the spelling."""
    out = ["m0 AS (SELECT '' AS sym, '' AS spelled, -1 AS rank WHERE false)"]
    order = "n DESC, l DESC, r DESC" if by_bytes else "n DESC, pair"
    for i in range(n):
        new = f"chr({first_symbol} + {i})"
        out.append(f"""t{i} AS MATERIALIZED (
  SELECT pair, coalesce(a.spelled, substr(pair, 1, 1)) AS l, coalesce(b.spelled, substr(pair, 2, 1)) AS r
  FROM ({pairs_of(f'w{i}')} QUALIFY sum(freq) = max(sum(freq)) OVER ()) p
  LEFT JOIN m{i} a ON a.sym = substr(pair, 1, 1) LEFT JOIN m{i} b ON b.sym = substr(pair, 2, 1)
  ORDER BY {order} LIMIT 1)""")
        out.append(f"""w{i + 1} AS MATERIALIZED (
  SELECT pretoken, replace(sym, (SELECT pair FROM t{i}), {new}) AS sym, freq FROM w{i})""")
        out.append(f"""m{i + 1} AS MATERIALIZED (
  SELECT * FROM m{i} UNION ALL SELECT {new}, l || r, {i} FROM t{i})""")
    merges = " UNION ALL ".join(f"SELECT {i} AS rank, l, r FROM t{i}" for i in range(n))
    out.append(f"merges AS ({merges})")
    return ",\n".join(out)


BPE = PRE + ",\n" + rounds(q.N_MERGES)
LAST = f"w{q.N_MERGES}"
ENC = f"""enc AS MATERIALIZED (
  SELECT pretoken, freq, {ids_of('sym')} AS ids FROM {LAST}
)"""
OCC = f"""occ AS MATERIALIZED (
  SELECT doc_id, unnest(w) AS pretoken, generate_subscripts(w, 1) - 1 AS pos
  FROM (SELECT doc_id, {words_of('text')} AS w FROM documents)
)"""
DOC = """doc AS MATERIALIZED (
  SELECT doc_id, lang, coalesce(ids, []::INT[]) AS ids FROM documents LEFT JOIN (
    SELECT doc_id, flatten(list(ids ORDER BY pos)) AS ids FROM occ JOIN enc USING (pretoken) GROUP BY doc_id
  ) USING (doc_id)
)"""
TOK = f"""str AS MATERIALIZED (
  SELECT doc_id, list_append(ids, {q.END_ID}) AS ids FROM doc
), tok AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS gp, id FROM (
    SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM str)
), tot AS (SELECT count(*) AS n FROM tok)"""
ENCODED = with_(BPE, ENC, OCC, DOC)
STREAM = with_(BPE, ENC, OCC, DOC, TOK)
VOCAB = f"""vocab AS (
  SELECT b::INT AS token_id, lpad(hex(b), 2, '0') AS token_hex FROM range(256) t(b)
  UNION ALL SELECT 256 + rank, {hexed('spelled')} FROM m{q.N_MERGES}
  UNION ALL SELECT {q.END_ID}, hex(encode('{DELIMITER}'))
)"""
MERGE_ROWS = f"SELECT rank, {hexed('l')} AS left_hex, {hexed('r')} AS right_hex FROM merges"
ENCODED_ROWS = (
    "SELECT doc_id, len(ids)::INT AS n_tokens, coalesce(array_to_string(ids, ','), '') AS tokens FROM doc"
)


def drawn(*keys: str) -> str:
    text = " || ':' || ".join([f"'{q.SEED}'", *keys])
    return f"('0x' || substr(md5({text}), 1, 13))::BIGINT"


def uniform(*keys: str) -> str:
    return f"({drawn(*keys)}::DOUBLE / {1 << 52}.0)"


SPLIT = f"CASE WHEN {uniform('doc_id')} < {q.VALID_SHARE} THEN 'valid' ELSE 'train' END"
BIGRAMS = f"""big AS MATERIALIZED (
  SELECT doc_id, {SPLIT} AS split, ids[i] AS prev, ids[i + 1] AS next, count(*) AS n
  FROM (SELECT doc_id, ids, unnest(range(1, len(ids))) AS i FROM str) GROUP BY ALL
), ngram AS MATERIALIZED (
  SELECT prev, next, n, sum(n) OVER (PARTITION BY prev)::BIGINT AS ctx_n FROM (
    SELECT prev, next, sum(n)::BIGINT AS n FROM big WHERE split = 'train' GROUP BY ALL)
), ng AS MATERIALIZED (
  SELECT *, (n + 1.0::DOUBLE) / (ctx_n + {q.VOCAB_SIZE}) AS prob FROM ngram
)"""
PARTS = f"""parts AS MATERIALIZED (
  SELECT split, row_number() OVER (PARTITION BY split ORDER BY doc_id, i) - 1 AS gp, id FROM (
    SELECT doc_id, {SPLIT} AS split, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM str)
)"""
SCORES = f"""scores AS MATERIALIZED (
  SELECT doc_id, split, sum(b.n)::BIGINT AS n_pairs,
    sum(b.n * -ln(coalesce(g.prob, 1.0::DOUBLE / (coalesce(c.ctx_n, 0) + {q.VOCAB_SIZE})))) / sum(b.n) AS loss
  FROM big b LEFT JOIN ng g ON g.prev = b.prev AND g.next = b.next
  LEFT JOIN (SELECT prev, max(ctx_n) AS ctx_n FROM ng GROUP BY prev) c ON c.prev = b.prev
  GROUP BY doc_id, split
)"""
PROBS = f"""probs AS MATERIALIZED (
  SELECT prev, next, wt / sum(wt) OVER (PARTITION BY prev) AS prob FROM (
    SELECT prev, next, exp(ln(n) / {q.TEMPERATURE} - max(ln(n) / {q.TEMPERATURE}) OVER (PARTITION BY prev)) AS wt
    FROM ng)
)"""
NUCLEUS = f"""ranked AS MATERIALIZED (
  SELECT prev, next, prob, row_number() OVER o - 1 AS rank,
    round(coalesce(sum(prob) OVER (PARTITION BY prev ORDER BY prob DESC, next
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 9) AS before
  FROM probs WINDOW o AS (PARTITION BY prev ORDER BY prob DESC, next)
), kept AS MATERIALIZED (
  SELECT prev, next, rank, prob / sum(prob) OVER (PARTITION BY prev) AS prob
  FROM ranked WHERE rank = 0 OR before <= {q.NUCLEUS}
), nucleus AS MATERIALIZED (
  SELECT *, round(sum(prob) OVER (PARTITION BY prev ORDER BY rank
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9) AS upper FROM kept
)"""


def turns(where: str, key: str) -> str:
    """Encoded conversation turns under the merges learned from the documents."""
    chain = [f"""c0 AS MATERIALIZED (
  SELECT DISTINCT pretoken, {lifted('pretoken')} AS sym
  FROM (SELECT unnest({words_of('text')}) AS pretoken FROM conversations)
)"""]
    for i in range(q.N_MERGES):
        chain.append(
            f"c{i + 1} AS (SELECT pretoken, replace(sym, (SELECT pair FROM t{i}), chr({256 + i})) AS sym FROM c{i})"
        )
    chain.append(f"""cenc AS MATERIALIZED (SELECT pretoken, {ids_of('sym')} AS ids FROM c{q.N_MERGES}),
turn_ids AS MATERIALIZED (
  SELECT {key}, coalesce(ids, []::INT[]) AS ids FROM conversations LEFT JOIN (
    SELECT conv_id, turn, flatten(list(ids ORDER BY pos)) AS ids FROM (
      SELECT conv_id, turn, unnest(w) AS pretoken, generate_subscripts(w, 1) AS pos
      FROM (SELECT conv_id, turn, {words_of('text')} AS w FROM conversations)
    ) JOIN cenc USING (pretoken) GROUP BY conv_id, turn
  ) USING (conv_id, turn) {where}
)""")
    return ",\n".join(chain)


def samples(strategy: str) -> str:
    draw = drawn("i")
    if strategy == "random":
        start = f"{draw} % (n - {q.WINDOW})"
    else:
        start = f"({draw} % ((n - {q.WINDOW} + {q.WINDOW - 1}) // {q.WINDOW})) * {q.WINDOW}"
    return STREAM + f"""SELECT sample_id, start,
  string_agg(id, ',' ORDER BY gp) FILTER (gp < start + {q.WINDOW}) AS input,
  string_agg(id, ',' ORDER BY gp) FILTER (gp > start) AS target
FROM (SELECT i AS sample_id, {start} AS start FROM range({q.BATCH}) r(i), tot) s
JOIN tok ON gp BETWEEN start AND start + {q.WINDOW} GROUP BY sample_id, start"""


GEN_STEPS = []
for step in range(q.NEW_TOKENS):
    GEN_STEPS.append(f"""g{step + 1} AS MATERIALIZED (
  SELECT prompt_id,
    CASE WHEN done THEN prev ELSE pick END AS prev,
    done OR pick = {q.END_ID} AS done,
    CASE WHEN done THEN generated ELSE list_append(generated, pick) END AS generated
  FROM (
    SELECT g.*, coalesce(c.next, {q.END_ID}) AS pick FROM g{step} g
    LEFT JOIN choice c ON c.prev = g.prev AND {uniform('prompt_id', f"'{step}'")} >= c.lower
      AND {uniform('prompt_id', f"'{step}'")} < c.upper))""")

VECTORS = """x AS MATERIALIZED (
  SELECT vec_id AS id, label AS y, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1)::INT - 1 AS dim
  FROM embeddings
)"""
QUALITY = f"""cnt AS MATERIALIZED (
  SELECT doc_id, (('0x' || substr(md5(pretoken), 1, 8))::BIGINT % {q.FEATURES})::INT AS dim, count(*) AS n
  FROM (SELECT doc_id, unnest({words_of('text')}) AS pretoken FROM documents) GROUP BY ALL
), all_x AS MATERIALIZED (
  SELECT d.doc_id AS id, coalesce(c.n, 0) / coalesce(t.total, 1) AS x, f.dim::INT AS dim
  FROM documents d JOIN range({q.FEATURES}) f(dim) ON true
  LEFT JOIN (SELECT doc_id, sum(n) AS total FROM cnt GROUP BY ALL) t ON t.doc_id = d.doc_id
  LEFT JOIN cnt c ON c.doc_id = d.doc_id AND c.dim = f.dim
), x AS MATERIALIZED (
  SELECT id, quality AS y, x, dim FROM all_x JOIN labels ON doc_id = id
)"""


def class_scores(classes: int, step: int) -> str:
    return f"""z{step} AS MATERIALIZED (
  SELECT id, y, class, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM (
    SELECT x.id, x.y, class, sum(x.x * value) AS z FROM x JOIN p{step} USING (dim) GROUP BY ALL)
), q{step} AS MATERIALIZED (
  SELECT id, y, class, e / sum(e) OVER (PARTITION BY id) AS prob FROM z{step}
)"""


def descent(
    features: str, classes: int, dims: int, rates: list[float], share: float | None = None
) -> str:
    """Steps over all rows, or over those drawn: gradient, clip, AdamW."""
    out = [features, f"""p0 AS (
  SELECT c::INT AS class, d::INT AS dim, 0.0::DOUBLE AS value, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v
  FROM range({classes}) a(c), range({dims}) b(d)
), size AS (SELECT count(DISTINCT id) AS n FROM x)"""]
    for t, rate in enumerate(rates, start=1):
        adjusted = rate * (1 - 0.999**t) ** 0.5 / (1 - 0.9**t)
        out.append(class_scores(classes, t - 1))
        size, drawn_now = "(SELECT n FROM size)", "true"
        if share is not None:
            size, drawn_now = "count(*)", f"{uniform('id', repr(str(t)))} < {share}"
        out.append(f"""raw{t} AS MATERIALIZED (
  SELECT class, dim, sum((prob - (class = q{t - 1}.y)::INT) * x) / {size} AS g
  FROM q{t - 1} JOIN x USING (id) WHERE {drawn_now} GROUP BY class, dim
), norm{t} AS MATERIALIZED (SELECT sqrt(sum(g * g)) AS norm FROM raw{t}),
grad{t} AS MATERIALIZED (
  SELECT class, dim, g * CASE WHEN norm > {q.MAX_NORM} THEN {q.MAX_NORM} / (norm + 1e-6::DOUBLE) ELSE 1 END AS g
  FROM raw{t} JOIN norm{t} ON true
), p{t} AS MATERIALIZED (
  SELECT class, dim, (value - {adjusted!r}::DOUBLE * m2 / (sqrt(v2) + 1e-8::DOUBLE)) * (1 - {rate * 0.01!r}::DOUBLE) AS value,
    m2 AS m, v2 AS v
  FROM (SELECT p.*, 0.9::DOUBLE * m + {1 - 0.9!r}::DOUBLE * g AS m2, 0.999::DOUBLE * v + {1 - 0.999!r}::DOUBLE * g * g AS v2
        FROM p{t - 1} p JOIN grad{t} USING (class, dim)))""")
    out.append(class_scores(classes, len(rates)))
    return with_(*out)


def cosine_rates(top: float, bottom: float, steps: int) -> list[float]:
    """The schedule without warm-up over ``steps``, for steps 1..steps."""
    from math import cos, pi

    return [bottom + 0.5 * (top - bottom) * (1 + cos(pi * t / steps)) for t in range(1, steps + 1)]


def sparse_descent(rates: list[float]) -> str:
    """Two classes over present buckets: their weights stay opposite, so one is kept.

    The weights of all steps are rows of one recursion over (step, bucket).
    """
    sizes = [rate * (1 - 0.999**t) ** 0.5 / (1 - 0.9**t) for t, rate in enumerate(rates, start=1)]
    steps = ", ".join(f"({t}, {r * 0.01!r}::DOUBLE, {s!r}::DOUBLE)" for t, (r, s) in enumerate(zip(rates, sizes), start=1))
    return f"""WITH RECURSIVE cnt AS MATERIALIZED (
  SELECT doc_id, (('0x' || substr(md5(pretoken), 1, 8))::BIGINT % {q.SPARSE_BUCKETS})::INT AS dim, count(*) AS n
  FROM (SELECT doc_id, unnest({words_of('text')}) AS pretoken FROM documents) GROUP BY ALL
), every AS MATERIALIZED (
  SELECT doc_id AS id, dim, n / sum(n) OVER (PARTITION BY doc_id) AS x FROM cnt
), labelled AS MATERIALIZED (
  SELECT l.doc_id AS id, quality AS y FROM labels l JOIN documents USING (doc_id) WHERE quality IS NOT NULL
), x AS MATERIALIZED (SELECT every.*, y FROM every JOIN labelled USING (id)
), rates(t, decay, size) AS (VALUES {steps}
), p AS (
  SELECT 0 AS t, dim, 0.0::DOUBLE AS value, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v FROM x GROUP BY dim
  UNION ALL
  SELECT t + 1, dim, (value - size * m2 / (sqrt(v2) + 1e-8::DOUBLE)) * (1 - decay), m2, v2 FROM (
    SELECT p.t, p.dim, value, decay, size, 0.9::DOUBLE * m + {1 - 0.9!r}::DOUBLE * g AS m2,
      0.999::DOUBLE * v + {1 - 0.999!r}::DOUBLE * g * g AS v2
    FROM p JOIN rates ON rates.t = p.t + 1 JOIN (
      SELECT dim, raw * CASE WHEN norm > {q.MAX_NORM} THEN {q.MAX_NORM} / (norm + 1e-6::DOUBLE) ELSE 1 END AS g
      FROM (SELECT dim, raw, sqrt(2 * sum(raw * raw) OVER ()) AS norm FROM (
        SELECT dim, sum(x * (p1 - y)) / (SELECT count(*) FROM labelled) AS raw
        FROM x JOIN (SELECT id, 1 / (1 + exp(-2 * sum(x * value))) AS p1 FROM x JOIN p USING (dim) GROUP BY id) USING (id)
        GROUP BY dim))) USING (dim))
), scored AS MATERIALIZED (
  SELECT d.doc_id, quality, 1 / (1 + exp(-2 * coalesce(z, 0))) AS p1
  FROM documents d LEFT JOIN labels USING (doc_id) LEFT JOIN (
    SELECT id, sum(x * value) AS z FROM every JOIN p USING (dim) WHERE t = {len(rates)} GROUP BY id) ON id = d.doc_id
) """


THREE_STEPS = cosine_rates(0.05, 0.01, 3)


def predictions(step: int, key: str, label: str) -> str:
    return f"""SELECT id AS {key}, y AS {label}, arg_max(class, round(prob, 9) * 1000 - class * 1e-9)::INT AS predicted,
  round(max(prob), 4) AS prob FROM q{step} GROUP BY id, y"""


def spelled_bytes(text: str) -> str:
    """Printable spelling of a lifted string."""
    code = f"ord(substr({text}, i::INT, 1))"
    return (
        f"array_to_string(list_transform(range(1, length({text}) + 1), lambda i: chr((CASE "
        f"WHEN {code} < 33 THEN 256 + {code} WHEN {code} BETWEEN 127 AND 160 THEN {code} + 162 "
        f"WHEN {code} = 173 THEN 323 ELSE {code} END)::INT)), '')"
    )


DELIMITED = f"replace(text, chr(10), '{DELIMITER}')"
SEGMENTS = f"""seg AS MATERIALIZED (
  SELECT doc_id, unnest(s) AS segment, (generate_subscripts(s, 1) - 1)::INT AS seg_pos FROM (
    SELECT doc_id, list_filter(flatten(list_transform(string_split({DELIMITED}, '{DELIMITER}'),
      lambda p, i: CASE WHEN i = 1 THEN [p] ELSE ['{DELIMITER}', p] END)), lambda p: p <> '') AS s
    FROM documents)
)"""
SPANS = f"""spans AS MATERIALIZED (
  SELECT doc_id, pos::INT AS pos, pretoken,
    (sum(strlen(pretoken)) OVER o - strlen(pretoken))::BIGINT AS start_byte,
    (sum(strlen(pretoken)) OVER o)::BIGINT AS end_byte
  FROM occ WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
)"""


def found(needle: str) -> str:
    return f"""{needle}_found AS MATERIALIZED (
  SELECT doc_id, pos, start_byte + i AS offset_byte FROM spans JOIN (
    SELECT pretoken, unnest(list_filter(range(0, length(sym) - {len(needle) - 1}),
      lambda i: substr(sym, (i + 1)::INT, {len(needle)}) = '{needle}')) AS i
    FROM w0 WHERE contains(sym, '{needle}')
  ) USING (pretoken)
)"""


LOGITS = """z AS MATERIALIZED (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1)::INT - 1 AS dim FROM embeddings
)"""
NLL = LOGITS + """, nll AS MATERIALIZED (
  SELECT vec_id, label, max(x) + ln(sum(exp(x - m))) - max(x) FILTER (dim = label) AS nll
  FROM (SELECT *, max(x) OVER (PARTITION BY vec_id) AS m FROM z) GROUP BY vec_id, label
)"""


def listed(n: int, square: int, where: str = "true") -> str:
    """Merges (rank, m = pair and new symbol): frequent byte pairs, then pairs of the first."""
    return f"""listed AS MATERIALIZED (
  WITH top AS MATERIALIZED (
    SELECT pair, row_number() OVER (ORDER BY n DESC, pair DESC) - 1 AS rank FROM (
      SELECT * FROM ({pairs_of('w0')}) ORDER BY n DESC, pair DESC LIMIT {n}) WHERE {where})
  SELECT rank, {{'pair': pair, 'new': chr((256 + rank)::INT)}} AS m, pair AS spelled FROM top
  UNION ALL SELECT {n} + a.rank * {square} + b.rank,
    {{'pair': chr((256 + a.rank)::INT) || chr((256 + b.rank)::INT),
      'new': chr((256 + {n} + a.rank * {square} + b.rank)::INT)}}, a.pair || b.pair
  FROM top a JOIN top b ON a.rank < {square} AND b.rank < {square}
)"""


def folded(
    merges: str,
    steps: str,
    more: list[str] | None = None,
    whole_id: str = "NULL",
    kept: str = "true",
    whole: str = "(SELECT NULL AS pretoken, NULL AS k WHERE false)",
) -> str:
    """Documents by merges applied one after the other to every distinct pretoken."""
    bytes_kept = f"array_to_string(list_filter(string_split(w0.sym, ''), lambda c: {kept}), '')"
    return with_(
        PRE,
        *(more or []),
        merges,
        f"steps AS MATERIALIZED (SELECT list_prepend({{'pair': '', 'new': ''}}, ({steps})) AS s)",
        f"""enc AS MATERIALIZED (
  SELECT pretoken, CASE WHEN whole_id IS NOT NULL THEN [whole_id] ELSE {ids_of('sym')} END AS ids FROM (
    SELECT w0.pretoken, coalesce({whole_id}, 256 + l.rank) AS whole_id,
      list_reduce(list_prepend({{'pair': '', 'new': {bytes_kept}}}, s[2:]),
        lambda so_far, one: {{'pair': '', 'new': replace(so_far.new, one.pair, one.new)}}).new AS sym
    FROM w0 LEFT JOIN {whole} o ON o.pretoken = w0.pretoken LEFT JOIN (
      SELECT spelled, rank FROM listed) l ON l.spelled = w0.sym, steps)
)""",
        OCC,
        DOC,
    ) + ENCODED_ROWS


def oracles() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["pretoken_counts"] = with_(PRE) + "SELECT pretoken, freq FROM pre"
    sql["pretoken_counts_top"] = sql["pretoken_counts"] + " ORDER BY freq DESC, pretoken LIMIT 100"
    sql["pretokens_per_lang_source"] = f"""SELECT lang, source, sum(f)::BIGINT AS n_pretokens,
  sum(f * strlen(pretoken))::BIGINT AS n_bytes, count(*) AS n_distinct
FROM (SELECT lang, source, pretoken, count(*) AS f
      FROM (SELECT lang, source, unnest({words_of('text')}) AS pretoken FROM documents) GROUP BY ALL)
GROUP BY lang, source"""
    sql["page_pretokens"] = f"""SELECT page_id, coalesce(n, 0) AS n_pretokens, coalesce(n_long, 0) AS n_long
FROM pages LEFT JOIN (
  SELECT page_id, count(*) AS n, count(*) FILTER (strlen(p) >= 2) AS n_long
  FROM (SELECT page_id, unnest({words_of('html')}) AS p FROM pages) GROUP BY page_id) USING (page_id)"""
    sql["pretoken_spans"] = (
        with_(OCC, SPANS) + "SELECT * FROM spans WHERE strlen(pretoken) >= 2"
    )
    sql["pretokens_at"] = with_(OCC) + """SELECT doc_id, pos::INT AS pos, pretoken FROM occ
WHERE (doc_id, pos) IN (SELECT (doc_id, quality) FROM labels)
   OR (doc_id, pos) IN (SELECT (doc_id, toxic + 5) FROM labels)"""
    sql["special_segments"] = with_(SEGMENTS) + (
        f"SELECT doc_id, seg_pos, segment, segment = '{DELIMITER}' AS is_special FROM seg"
    )
    sql["special_pretokens"] = with_(SEGMENTS) + f"""SELECT pretoken, count(*) AS freq FROM (
  SELECT unnest(CASE WHEN segment = '{DELIMITER}' THEN [segment] ELSE {words_of('segment')} END) AS pretoken FROM seg
) GROUP BY pretoken ORDER BY freq DESC, pretoken LIMIT 100"""
    sql["split_documents"] = f"""SELECT doc_id, part, text FROM (
  SELECT doc_id, unnest(p) AS text, (generate_subscripts(p, 1) - 1)::INT AS part
  FROM (SELECT doc_id, string_split({DELIMITED}, '{DELIMITER}') AS p FROM documents)) WHERE text <> ''"""
    sql["document_lines"] = """SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS line_no,
  n_bytes::INT AS n_bytes
FROM (SELECT doc_id, i, strlen(line) + (i < n)::INT AS n_bytes FROM (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i, len(l) AS n
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))) WHERE n_bytes > 0"""
    nested = "text"
    for old, made in (("chr(10)", "<|part|><|end|>"), ("', '", "<|part|>"), ("'. '", "<|end|>")):
        nested = f"replace({nested}, {old}, '{made}')"
    marked = nested
    for i, special in enumerate(sorted(q.NESTED, key=len, reverse=True)):
        marked = f"replace({marked}, '{special}', chr(57345) || chr({57346 + i}) || chr(57345))"
    named = "segment"
    for i, special in enumerate(sorted(q.NESTED, key=len, reverse=True)):
        named = f"replace({named}, chr({57346 + i}), '{special}')"
    sql["bpe_merges_500"] = with_(PRE, rounds(243)) + MERGE_ROWS
    sql["nested_specials"] = f"""SELECT doc_id, {named} AS segment, segment BETWEEN chr(57346) AND chr(57348) AS is_special,
  (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS seg_pos
FROM (SELECT doc_id, unnest(p) AS segment, generate_subscripts(p, 1) AS i
  FROM (SELECT doc_id, string_split({marked}, chr(57345)) AS p FROM documents)) WHERE segment <> ''"""
    files = f"""files AS MATERIALIZED (
  SELECT doc_id // {q.FILE_DOCUMENTS} AS part, string_agg(text || chr(10), '' ORDER BY doc_id) AS text
  FROM documents WHERE text IS NOT NULL GROUP BY 1)"""
    sql["file_pretokens"] = with_(files) + f"""SELECT part, pretoken, count(*) AS freq,
  min(last - strlen(pretoken))::BIGINT AS first_byte, max(last)::BIGINT AS last_byte
FROM (SELECT part, pretoken, sum(strlen(pretoken)) OVER (PARTITION BY part ORDER BY i) AS last FROM (
  SELECT part, unnest(w) AS pretoken, generate_subscripts(w, 1) AS i
  FROM (SELECT part, {words_of('text')} AS w FROM files))) GROUP BY ALL"""
    lines = """lines AS MATERIALIZED (
  SELECT part, i, strlen(line) + 1 AS n FROM (
    SELECT part, unnest(l) AS line, generate_subscripts(l, 1) AS i, len(l) AS n
    FROM (SELECT part, string_split(text, chr(10)) AS l FROM files)) WHERE i < n)"""
    sql["file_lines"] = with_(files, lines) + """SELECT part, n::INT AS n_bytes,
  (sum(n) OVER (PARTITION BY part ORDER BY i) - n)::BIGINT AS start_byte FROM lines"""
    sql["corpus_files"] = with_(files, lines) + """SELECT part, n_lines, line_bytes, strlen(text)::INT AS n_bytes, md5(text) AS md5
FROM files JOIN (SELECT part, count(*) AS n_lines, sum(n)::BIGINT AS line_bytes FROM lines GROUP BY part) USING (part)"""
    sql["byte_histogram"] = with_(PRE) + """SELECT byte::INT AS byte, sum(freq)::BIGINT AS n FROM (
  SELECT freq, ord(substr(sym, i::INT, 1)) AS byte FROM (
    SELECT freq, sym, unnest(range(1, length(sym) + 1)) AS i FROM w0)) GROUP BY 1"""
    sides = (
        f"n, {hexed('substr(pair, 1, 1)')} AS left_hex, {hexed('substr(pair, 2, 1)')} AS right_hex"
    )
    sql["pair_counts_top"] = with_(PRE) + (
        f"SELECT {sides} FROM ({pairs_of('w0')} ORDER BY n DESC, pair DESC LIMIT 50)"
    )
    sql["top_pair"] = with_(PRE) + (
        f"SELECT {sides} FROM ({pairs_of('w0')} ORDER BY n DESC, pair DESC LIMIT 1)"
    )
    sql["pair_index_sizes"] = with_(PRE) + f"""SELECT n_words, {sides} FROM (
  SELECT pair, count(DISTINCT pretoken) AS n_words, sum(freq)::BIGINT AS n FROM (
    SELECT pretoken, freq, substr(sym, i::INT, 2) AS pair FROM (
      SELECT pretoken, sym, freq, unnest(range(1, length(sym))) AS i FROM w0)) GROUP BY pair)"""
    sql["words_with_pair"] = with_(PRE) + "SELECT pretoken, freq FROM w0 WHERE contains(sym, 'th')"
    sql["pair_counts_after_merge"] = with_(PRE, """a AS (
  SELECT freq, replace(replace(replace(sym, 'th', chr(256)), 'in', chr(257)), ' ' || chr(256), chr(258)) AS sym FROM w0
)""") + f"""SELECT ord(substr(pair, 1, 1))::INT AS left_code, ord(substr(pair, 2, 1))::INT AS right_code, n
FROM ({pairs_of('a')})"""
    sql["pair_occurrences"] = with_(PRE, OCC, SPANS, found("th")) + "SELECT * FROM th_found"
    spelled = f"spelled AS MATERIALIZED (SELECT 256 + rank AS token_id, spelled FROM m{q.N_MERGES})"
    hits = """hits AS MATERIALIZED (
  SELECT pretoken, token_id, i - 1 AS inner_byte FROM (
    SELECT pretoken, sym, unnest(range(1, length(sym) + 1)) AS i FROM w0)
  JOIN spelled ON substr(sym, i::INT, length(spelled)) = spelled)"""
    sql["token_occurrences"] = with_(BPE, OCC, SPANS, spelled, hits) + """SELECT doc_id, token_id::INT AS token_id,
  count(*) AS n, min(start_byte + inner_byte)::BIGINT AS first_byte, max(start_byte + inner_byte)::BIGINT AS last_byte
FROM spans JOIN hits USING (pretoken) GROUP BY ALL"""
    sql["unmerged_occurrences"] = with_(PRE, OCC, SPANS, found("th"), found("he")) + """SELECT * FROM he_found h
WHERE NOT EXISTS (SELECT 1 FROM th_found t WHERE t.doc_id = h.doc_id AND t.offset_byte = h.offset_byte)
  AND NOT EXISTS (SELECT 1 FROM th_found t WHERE t.doc_id = h.doc_id AND t.offset_byte = h.offset_byte + 2)"""
    sql["bpe_merges"] = with_(BPE) + MERGE_ROWS
    sql["bpe_merges_resumed"] = sql["bpe_merges"]
    sql["merges_from_text"] = sql["bpe_merges"]
    sql["bpe_vocab"] = with_(BPE, VOCAB) + "SELECT token_id, token_hex FROM vocab"
    sql["vocab_from_json"] = sql["bpe_vocab"]
    sql["valid_merges"] = with_(BPE) + MERGE_ROWS + (
        " WHERE l <> (SELECT l || r FROM t0) AND r <> (SELECT l || r FROM t0)"
    )
    sql["finalize_vocab"] = sql["bpe_vocab"] + (
        f" UNION ALL SELECT {q.END_ID + 1}, hex(encode('<|pad|>'))"
    )
    sql["printable_vocab"] = with_(BPE) + f"""SELECT b::INT AS token_id, {spelled_bytes('c')} AS token
FROM (SELECT b, chr(b::INT) AS c FROM range(256) t(b))
UNION ALL SELECT 256 + rank, {spelled_bytes('spelled')} FROM m{q.N_MERGES}
UNION ALL SELECT {q.END_ID}, '{DELIMITER}'"""
    chars = PRE.replace(lifted("pretoken"), "pretoken")
    sql["bpe_char_vocab"] = with_(chars, """letters AS MATERIALIZED (
  SELECT c, row_number() OVER (ORDER BY ord(c)) AS id FROM (
    SELECT DISTINCT substr(sym, i::INT, 1) AS c FROM (SELECT sym, unnest(range(1, length(sym) + 1)) AS i FROM w0))
)""", rounds(q.N_MERGES, "983040", by_bytes=False)) + f"""SELECT 0 AS token_id, chr(65533) AS token
UNION ALL SELECT id::INT, c FROM letters
UNION ALL SELECT ((SELECT count(*) FROM letters) + 1 + rank)::INT, spelled FROM m{q.N_MERGES}"""
    sql["encode_documents"] = ENCODED + ENCODED_ROWS
    sql["encode_documents_by_words"] = sql["encode_documents"]
    for name in ("encode_documents_inline", "stream_encode", "stream_encode_batches"):
        sql[name] = sql["encode_documents"]
    sql["encode_duplicate_keys"] = ENCODED + ENCODED_ROWS.replace("doc_id", "lang")
    long_list = listed(q.LONG_LIST, q.LONG_SQUARE)
    sql["encode_long_list"] = folded(long_list, "SELECT list(m ORDER BY rank) FROM listed")
    sql["encode_long_list_by_words"] = sql["encode_long_list"]
    # after every pair, all merges of pairs that exist by then
    sql["encode_any_order"] = folded(
        listed(q.ANY_LIST, q.ANY_SQUARE),
        f"""SELECT list(m ORDER BY step, place) FROM (
    SELECT m, rank AS step, 0 AS place FROM listed WHERE rank < {q.ANY_LIST} UNION ALL
    SELECT m, step, rank FROM listed, range({q.ANY_LIST}) r(step)
    WHERE rank >= {q.ANY_LIST}
      AND greatest((rank - {q.ANY_LIST}) // {q.ANY_SQUARE}, (rank - {q.ANY_LIST}) % {q.ANY_SQUARE}) <= step)""",
    )
    whole = f"""whole AS MATERIALIZED (
  SELECT pretoken, row_number() OVER (ORDER BY freq DESC, pretoken) - 1 AS k FROM pre
  WHERE length(pretoken) > 2 ORDER BY freq DESC, pretoken LIMIT {q.WHOLE_WORDS}
)"""
    in_order = "SELECT list(m ORDER BY rank) FROM listed"
    sql["encode_whole_words"] = folded(
        listed(q.ANY_LIST, 0), in_order, [whole], f"256 + {q.ANY_LIST} + k", "true", "whole"
    )
    ascii_pair = "ord(substr(pair, 1, 1)) < 128 AND ord(substr(pair, 2, 1)) < 128"
    sql["encode_drop"] = folded(
        listed(q.ANY_LIST, 0, ascii_pair),
        in_order,
        [whole],
        "256 + (SELECT count(*) FROM listed) + k",
        "ord(c) < 128",
        "whole",
    )
    sql["encode_conversations"] = with_(BPE, turns("", "conv_id, turn")) + (
        "SELECT conv_id, turn, len(ids)::INT AS n_tokens, coalesce(array_to_string(ids, ','), '') AS tokens FROM turn_ids"
    )
    sql["encode_ascii_only"] = (
        r"SELECT doc_id, length(regexp_replace(text, '[^\x00-\x7F]', '', 'g'))::INT AS n_tokens FROM documents"
    )
    sql["encode_file_codec"] = sql["encode_conversations"].replace("conversations", "benchmark").replace(
        "conv_id, turn", "item_id"
    )
    sql["decode_roundtrip"] = "SELECT doc_id, text AS decoded FROM documents"
    sql["roundtrip_check"] = "SELECT count(*) AS n_rows, 0::BIGINT AS n_changed FROM documents"
    sql["token_counts"] = with_(BPE, ENC) + (
        "SELECT id::INT AS token_id, sum(freq)::BIGINT AS n FROM (SELECT freq, unnest(ids) AS id FROM enc) GROUP BY 1"
    )
    sql["stream_token_counts"] = sql["token_counts"]
    sql["delimiter_check"] = f"""SELECT count(*)::BIGINT AS n_ids, sum((strlen(t) - strlen(replace(t, '{DELIMITER}', '')))
  // {len(DELIMITER)})::BIGINT AS n_texts, true AS ok FROM (SELECT text || '{DELIMITER}' AS t FROM documents)"""
    sql["compression_stats"] = ENCODED + """SELECT lang, sum(strlen(text))::BIGINT AS n_bytes, sum(len(ids))::BIGINT AS n_tokens,
  round(sum(strlen(text)) / sum(len(ids)), 6) AS bytes_per_token,
  round(sum(strlen(text)) / (2 * sum(len(ids))), 6) AS uint16_ratio
FROM doc JOIN documents USING (doc_id, lang) GROUP BY lang"""
    sql["word_compression"] = with_(BPE, ENC) + f"""SELECT source, sum(strlen(pretoken))::BIGINT AS n_bytes,
  sum(len(ids))::BIGINT AS n_tokens
FROM (SELECT source, unnest({words_of('text')}) AS pretoken FROM documents) JOIN enc USING (pretoken) GROUP BY source"""
    line_chain = turns("", "conv_id, turn")
    lines = f"""lines AS MATERIALIZED (
  SELECT doc_id, unnest({words_of('line')}) AS pretoken FROM (
    SELECT doc_id, line || CASE WHEN i < n THEN chr(10) ELSE '' END AS line FROM (
      SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i, len(l) AS n
      FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)))
)"""
    line_words = line_chain.replace(
        f"(SELECT unnest({words_of('text')}) AS pretoken FROM conversations)", "lines"
    )
    line_words = line_words[: line_words.index(",\nturn_ids")]
    sql["tokenize_dataset"] = with_(BPE, lines, line_words) + f"""SELECT split, sum(b)::BIGINT AS n_bytes, sum(t)::BIGINT AS n_tokens,
  round(sum(b) / sum(t), 6) AS bytes_per_token FROM (
  SELECT doc_id, {SPLIT} AS split, strlen(text) AS b, coalesce(t, 0) + 1 AS t FROM documents LEFT JOIN (
    SELECT doc_id, sum(len(ids)) AS t FROM lines JOIN cenc USING (pretoken) GROUP BY doc_id) USING (doc_id))
GROUP BY split"""
    sql["tokenize_dataset_skip"] = sql["tokenize_dataset"]
    sql["token_offsets_by_name"] = ENCODED + """SELECT md5(doc_id::VARCHAR) AS name, len(ids)::INT AS n_tokens,
  coalesce(sum(len(ids)) OVER (ORDER BY md5(doc_id::VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offset
FROM doc"""
    sql["token_offsets"] = STREAM + """SELECT doc_id, len(ids)::INT AS n_tokens,
  coalesce(sum(len(ids)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offset
FROM str"""
    nxt = "(SELECT gp, id, lead(id) OVER (ORDER BY gp) AS nxt FROM tok)"
    sql["pack_sequences"] = STREAM + f"""SELECT gp // {q.WINDOW} AS window_id, min(gp) AS start,
  string_agg(id, ',' ORDER BY gp) AS input, string_agg(nxt, ',' ORDER BY gp) AS target
FROM {nxt} GROUP BY 1 HAVING count(nxt) = {q.WINDOW}"""
    sql["next_token_labels"] = STREAM + f"""SELECT id::INT AS token_id, nxt::INT AS label, count(*) AS n FROM {nxt}
WHERE gp < (SELECT (n - 1) // {q.WINDOW} * {q.WINDOW} FROM tot) GROUP BY 1, 2"""
    sql["sample_windows_random"] = samples("random")
    sql["sample_windows_indexed"] = samples("random")
    sql["token_block_manifest"] = STREAM + f"""SELECT gp // {BLOCK_TOKENS} AS block_id, count(*)::INT AS n_tokens,
  md5(string_agg(id::VARCHAR, ',' ORDER BY gp)) AS md5 FROM tok GROUP BY 1"""
    sql["sample_windows_aligned"] = samples("aligned")
    sql["window_start_histogram"] = STREAM + f"""SELECT start, count(*) AS n, round({q.HISTOGRAM_DRAWS}.0::DOUBLE / any_value(k), 6) AS expected,
  abs(count(*) - {q.HISTOGRAM_DRAWS}.0::DOUBLE / any_value(k))
    <= 5 * sqrt({q.HISTOGRAM_DRAWS}.0::DOUBLE / any_value(k) * (1 - 1.0::DOUBLE / any_value(k))) AS within
FROM (SELECT k, ({drawn('i')} % k) * {q.WINDOW} AS start FROM range({q.HISTOGRAM_DRAWS}) r(i),
  (SELECT (n - {q.WINDOW} + {q.WINDOW - 1}) // {q.WINDOW} AS k FROM tot)) GROUP BY start"""
    per_step = q.PLAN["batch"] * q.PLAN["length"]
    max_iters = q.PLAN["total_tokens"] // per_step
    sql["epoch_plan"] = STREAM + f"""SELECT n AS n_tokens, n // {per_step} AS iters_per_epoch, {max_iters}::BIGINT AS max_iters,
  round({max_iters}::DOUBLE / (n // {per_step}), 6) AS epochs, (n // {per_step}) * {q.PLAN['schedule_epochs']} AS cycle_iters FROM tot"""
    top, bottom = q.RATES
    sql["lr_schedule"] = STREAM + f"""SELECT it, round(CASE WHEN it < {q.WARMUP} THEN it * {top}::DOUBLE / {q.WARMUP}
  WHEN it > c THEN {bottom}::DOUBLE
  ELSE {bottom} + 0.5 * ({top} - {bottom}) * (1 + cos(pi() * (it - {q.WARMUP}) / (c - {q.WARMUP}))) END, 9) AS lr
FROM range({max_iters + 1}) r(it), (SELECT (n // {per_step}) * {q.PLAN['schedule_epochs']} AS c FROM tot)"""
    sql["softmax_temperature"] = with_(LOGITS) + """SELECT vec_id, dim, round(e / sum(e) OVER (PARTITION BY vec_id), 6) AS prob
FROM (SELECT vec_id, dim, exp(x / 0.5 - max(x / 0.5) OVER (PARTITION BY vec_id)) AS e FROM z)"""
    sql["softmax_long"] = sql["softmax_temperature"]
    loss = "count(nll) AS n, round(avg(nll), 6) AS loss, round(exp(avg(nll)), 4) AS perplexity FROM nll"
    sql["cross_entropy"] = with_(NLL) + f"SELECT label, {loss} GROUP BY label"
    sql["cross_entropy_long"] = with_(NLL) + f"SELECT {loss}"
    sql["rms_normalize"] = with_(LOGITS) + """SELECT vec_id, dim,
  round(x / sqrt(avg(x * x) OVER (PARTITION BY vec_id) + 1e-5::DOUBLE), 6) AS x FROM z"""

    def votes_of(length: int) -> str:
        return f"""WITH s AS MATERIALIZED (
  SELECT vec_id, label, embedding::DOUBLE[] AS v, row_number() OVER (ORDER BY vec_id) - 1 AS p FROM embeddings
), w AS MATERIALIZED (
  SELECT a.vec_id, a.label, b.label AS y, list_dot_product(a.v, b.v) / sqrt(len(a.v)) AS z
  FROM s a JOIN s b ON a.p // {length} = b.p // {length} AND b.p < a.p
), e AS MATERIALIZED (
  SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM w
), votes AS MATERIALIZED (
  SELECT vec_id, y, round(sum(e) / any_value(total), 9) AS weight
  FROM (SELECT *, sum(e) OVER (PARTITION BY vec_id) AS total FROM e) GROUP BY vec_id, y
), best AS (
  SELECT vec_id, y, weight FROM votes QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY weight DESC, y) = 1
) SELECT s.vec_id, s.label, y AS predicted, round(weight, 6) AS weight FROM s LEFT JOIN best USING (vec_id)"""

    sql["soft_knn"] = votes_of(q.KNN_LENGTH)
    sql["soft_knn_long"] = votes_of(q.LONG_KNN)
    model = with_(BPE, ENC, OCC, DOC, TOK, BIGRAMS)
    sql["ngram_model"] = model + (
        "SELECT prev::INT AS prev, next::INT AS next, n, ctx_n, round(prob, 9) AS prob FROM ng"
    )
    scored = with_(BPE, ENC, OCC, DOC, TOK, BIGRAMS, SCORES)
    sql["score_documents"] = scored + """SELECT doc_id, split, n_pairs, round(loss, 6) AS loss,
  round(exp(loss), 4) AS perplexity FROM scores"""
    def discounted(table: str) -> str:
        return f"""(SELECT CASE WHEN count_if(n = 1) > 0 AND count_if(n = 2) > 0
      THEN count_if(n = 1)::DOUBLE / (count_if(n = 1) + 2 * count_if(n = 2)) ELSE 0.5 END FROM {table})"""

    backoff = with_(BPE, ENC, OCC, DOC, TOK) + f""", every AS MATERIALIZED (
  SELECT doc_id, split, c2, c1, next, count(*) AS n FROM (
    SELECT doc_id, {SPLIT} AS split, coalesce(ids[i - 2], -1) AS c2, coalesce(ids[i - 1], -1) AS c1, ids[i] AS next
    FROM (SELECT doc_id, list_concat([-1, -1], ids) AS ids, unnest(range(3, len(ids) + 3)) AS i FROM str))
  GROUP BY ALL),
g3 AS MATERIALIZED (SELECT c2, c1, next, sum(n)::BIGINT AS n FROM every WHERE split = 'train' GROUP BY ALL),
g2 AS MATERIALIZED (SELECT c1, next, count(*) AS n FROM g3 GROUP BY ALL),
g1 AS MATERIALIZED (SELECT next, count(*) AS n FROM g2 GROUP BY ALL),
d AS MATERIALIZED (SELECT {discounted('g1')} AS d1, {discounted('g2')} AS d2, {discounted('g3')} AS d3),
u AS (SELECT d1 * (SELECT count(*) FROM g1) / (SELECT sum(n) FROM g1) / {q.VOCAB_SIZE} AS unseen FROM d),
p1 AS (SELECT next, (n - d1) / (SELECT sum(n) FROM g1) + unseen AS prob FROM g1, d, u),
s2 AS MATERIALIZED (SELECT c1, sum(n) AS total, d2 * count(*) / sum(n) AS share FROM g2, d GROUP BY c1, d2),
p2 AS MATERIALIZED (SELECT c1, next, (n - d2) / total + share * prob AS prob
  FROM g2 JOIN s2 USING (c1) JOIN p1 USING (next), d),
s3 AS MATERIALIZED (SELECT c2, c1, sum(n)::BIGINT AS total, d3 * count(*) / sum(n) AS share FROM g3, d GROUP BY c2, c1, d3),
p3 AS MATERIALIZED (SELECT c2, c1, next, n, (n - d3) / total + share * prob AS prob
  FROM g3 JOIN s3 USING (c2, c1) JOIN p2 USING (c1, next), d)
"""
    sql["kneser_ney_table"] = backoff + "SELECT c2, c1, next, n, round(prob, 9) AS prob FROM p3"
    sql["kneser_ney_contexts"] = backoff + "SELECT c2, c1, total AS weight, round(share, 9) AS share FROM s3"
    sql["kneser_ney_losses"] = backoff + """SELECT doc_id, split, n_pairs, round(loss, 6) AS loss, round(exp(loss), 4) AS perplexity FROM (
  SELECT doc_id, split, sum(e.n)::BIGINT AS n_pairs, sum(e.n * -ln(coalesce(p3.prob,
    coalesce(s3.share, 1) * coalesce(p2.prob, coalesce(s2.share, 1) * coalesce(p1.prob, unseen))))) / sum(e.n) AS loss
  FROM every e LEFT JOIN p3 USING (c2, c1, next) LEFT JOIN s3 USING (c2, c1) LEFT JOIN p2 USING (c1, next)
  LEFT JOIN s2 USING (c1) LEFT JOIN p1 USING (next), u GROUP BY doc_id, split)"""
    sql["split_losses"] = scored + """SELECT split, sum(n_pairs)::BIGINT AS n_pairs,
  round(sum(loss * n_pairs) / sum(n_pairs), 6) AS loss, round(exp(sum(loss * n_pairs) / sum(n_pairs)), 4) AS perplexity
FROM scores GROUP BY split"""
    sql["sampled_losses"] = with_(BPE, ENC, OCC, DOC, TOK, BIGRAMS, PARTS) + f"""SELECT split, count(*) AS n_pairs, round(avg(nll), 6) AS loss, round(exp(avg(nll)), 4) AS perplexity FROM (
  SELECT s.split, -ln(coalesce(g.prob, 1.0::DOUBLE / (coalesce(c.ctx_n, 0) + {q.VOCAB_SIZE}))) AS nll
  FROM (SELECT split, ({drawn('i')} % ((n - {q.WINDOW} + {q.WINDOW - 1}) // {q.WINDOW})) * {q.WINDOW} AS start
        FROM range({q.BATCH}) r(i), (SELECT split, count(*) AS n FROM parts GROUP BY split)) s
  JOIN (SELECT split, gp, id, lead(id) OVER (PARTITION BY split ORDER BY gp) AS nxt FROM parts) p
    ON p.split = s.split AND p.gp >= s.start AND p.gp < s.start + {q.WINDOW}
  LEFT JOIN ng g ON g.prev = p.id AND g.next = p.nxt
  LEFT JOIN (SELECT prev, max(ctx_n) AS ctx_n FROM ng GROUP BY prev) c ON c.prev = p.id) GROUP BY split"""
    sql["next_token_probs"] = with_(BPE, ENC, OCC, DOC, TOK, BIGRAMS, PROBS) + (
        "SELECT prev::INT AS prev, next::INT AS next, round(prob, 9) AS prob FROM probs"
    )
    sql["nucleus_table"] = with_(BPE, ENC, OCC, DOC, TOK, BIGRAMS, PROBS, NUCLEUS) + (
        "SELECT prev::INT AS prev, next::INT AS next, rank::INT AS rank, round(prob, 6) AS prob, "
        "round(upper, 6) AS upper FROM nucleus"
    )
    users = turns("WHERE role = 'user'", "conv_id || ':' || turn AS prompt_id")
    length = q.PROMPT_LENGTH
    sql["prepare_prompts"] = with_(BPE, users) + f"""SELECT prompt_id, len(ids) > {length} AS truncated,
  array_to_string(list_concat(list_transform(range(greatest({length} - len(ids), 0)), lambda i: {q.END_ID}),
    ids[greatest(len(ids) - {length}, 0) + 1:]), ',') AS model_input FROM turn_ids"""
    choice = f"""choice AS MATERIALIZED (
  SELECT prev, next, coalesce(lag(upper) OVER o, 0) AS lower,
    CASE WHEN lead(upper) OVER o IS NULL THEN 2 ELSE upper END AS upper
  FROM nucleus WINDOW o AS (PARTITION BY prev ORDER BY rank)
), g0 AS (
  SELECT prompt_id, coalesce(ids[-1], {q.END_ID}) AS prev, false AS done, []::INT[] AS generated FROM turn_ids
)"""
    sql["generate"] = with_(
        BPE, ENC, OCC, DOC, TOK, BIGRAMS, PROBS, NUCLEUS, users, choice, *GEN_STEPS
    ) + f"""SELECT prompt_id, len(generated)::INT AS n_new, array_to_string(generated, ',') AS generated
FROM g{q.NEW_TOKENS}"""
    sql["generate_shuffled"] = sql["generate"]
    drawn_steps = []
    for step in range(q.FEW_TOKENS):
        u = {k: uniform("prompt_id", f"'{step}'", f"'{k}'") for k in range(4)}
        drawn_steps.append(f"""b{step + 1} AS MATERIALIZED (
  SELECT prompt_id, c1 AS c2, pick AS c1, done OR pick = {q.END_ID} AS done,
    CASE WHEN done THEN generated ELSE list_append(generated, pick) END AS generated
  FROM (SELECT b.*, coalesce(t3.next, t2.next, t1.next, floor({u[0]} * {q.VOCAB_SIZE})::INT) AS pick FROM b{step} b
    LEFT JOIN cum3 t3 ON t3.c2 = b.c2 AND t3.c1 = b.c1 AND {u[3]} >= t3.lower AND {u[3]} < t3.upper
    LEFT JOIN cum2 t2 ON t2.c1 = b.c1 AND {u[2]} >= t2.lower AND {u[2]} < t2.upper
    LEFT JOIN cum1 t1 ON {u[1]} >= t1.lower AND {u[1]} < t1.upper))""")

    def running(k: int, context: str) -> str:
        part = f"PARTITION BY {context} " if context else ""
        return f"""cum{k} AS MATERIALIZED (
  SELECT *, coalesce(lag(upper) OVER ({part}ORDER BY n DESC, next), 0) AS lower FROM (
    SELECT *, round(sum(part) OVER ({part}ORDER BY n DESC, next ROWS UNBOUNDED PRECEDING), 9) AS upper FROM (
      SELECT g{k}.*, (n - d{k}) / sum(n) OVER ({part}) AS part FROM g{k}, d)))"""

    sql["generate_from_contexts"] = backoff.rstrip() + ",\n" + ",\n".join(
        [users, running(3, "c2, c1"), running(2, "c1"), running(1, ""),
         """b0 AS (SELECT prompt_id, coalesce(ids[-2], -1)::INT AS c2, coalesce(ids[-1], -1)::INT AS c1,
  false AS done, []::INT[] AS generated FROM turn_ids)""", *drawn_steps]
    ) + f"""
SELECT prompt_id, len(generated)::INT AS n_new, array_to_string(generated, ',') AS generated FROM b{q.FEW_TOKENS}"""
    first = descent(VECTORS, 10, 64, [q.RATES[0]])
    sql["grad_norm"] = first + "SELECT round(norm, 9) AS grad_norm FROM norm1"
    sql["classifier_step"] = first + (
        "SELECT class, dim, round(value, 8) AS value, round(m, 8) AS m FROM p1"
    )
    sql["sgd_step"] = first + (
        "SELECT class, dim, round(-g * 0.5 / sqrt(4), 8) AS value FROM grad1"
    )
    trained = descent(VECTORS, 10, 64, THREE_STEPS)
    sql["classifier_scores"] = trained + predictions(3, "vec_id", "label")
    sql["classifier_resumed"] = sql["classifier_scores"]
    sql["training_metrics"] = trained + " UNION ALL ".join(
        f"SELECT {t} AS iteration, 'grad_norm' AS metric, round(norm, 6) AS value FROM norm{t} "
        f"UNION ALL SELECT {t}, 'learning_rate', round({rate!r}::DOUBLE, 6)"
        for t, rate in enumerate(THREE_STEPS, start=1)
    )
    batches = descent(
        VECTORS.replace("x AS MATERIALIZED", "every AS MATERIALIZED", 1)
        + f""", x AS MATERIALIZED (
  SELECT * FROM every WHERE {uniform('id')} >= {q.VALID_SHARE}
)""",
        10,
        64,
        cosine_rates(0.05, 0.01, q.BATCH_STEPS),
        q.BATCH_SHARE,
    )
    sql["training_losses"] = batches + " UNION ALL ".join(
        f"""SELECT {t} AS iteration, CASE WHEN {uniform('id')} < {q.VALID_SHARE} THEN 'valid' ELSE 'train' END AS split,
  round(avg(-ln(e / total)), 5) AS loss FROM (
    SELECT id, y, class, e, sum(e) OVER (PARTITION BY id) AS total FROM (
      SELECT id, y, class, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM (
        SELECT r.id, r.y, class, sum(r.x * value) AS z FROM every r JOIN p{t} USING (dim) GROUP BY ALL)))
WHERE class = y GROUP BY 2"""
        for t in range(q.EVALUATE_EVERY, q.BATCH_STEPS + 1, q.EVALUATE_EVERY)
    )
    sql["classifier_loss"] = trained + """SELECT y AS label, count(*) AS n, round(avg(-ln(prob)), 6) AS loss,
  round(exp(avg(-ln(prob))), 4) AS perplexity FROM q3 WHERE class = y GROUP BY y"""
    sql["quality_classifier"] = (
        descent(QUALITY, 2, q.FEATURES, THREE_STEPS)
        + f"""SELECT id AS doc_id, quality, arg_max(class, round(prob, 9) * 1000 - class * 1e-9)::INT AS predicted,
  round(max(prob), 4) AS prob FROM (
    SELECT id, class, e / sum(e) OVER (PARTITION BY id) AS prob FROM (
      SELECT id, class, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM (
        SELECT x.id, class, sum(x.x * value) AS z FROM all_x x JOIN p3 USING (dim) GROUP BY ALL)))
LEFT JOIN labels ON labels.doc_id = id GROUP BY id, quality"""
    )
    sparse = sparse_descent(cosine_rates(0.05, 0.01, q.SPARSE_STEPS))
    sql["quality_classifier_sparse"] = sparse + """SELECT doc_id, quality,
  CASE WHEN round(1 - p1, 9) >= round(p1, 9) THEN 0 ELSE 1 END AS predicted, round(greatest(p1, 1 - p1), 4) AS prob FROM scored"""
    sql["quality_loss_sparse"] = sparse + """SELECT quality, count(*) AS n, round(avg(nll), 6) AS loss,
  round(exp(avg(nll)), 4) AS perplexity FROM (
    SELECT quality, -ln(CASE WHEN quality = 1 THEN p1 ELSE 1 - p1 END) AS nll FROM scored WHERE quality IS NOT NULL)
GROUP BY quality"""
    sql["stream_offsets"] = f"""SELECT doc_id, (doc_id % 6)::INT AS batch_id, size,
  (coalesce(sum(size) OVER (ORDER BY doc_id % 6, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS "offset"
FROM (SELECT doc_id, coalesce(len({words_of('text')}), 0)::BIGINT AS size FROM documents)"""
    sql["stream_counts"] = sql["pretoken_counts"]
    return sql
