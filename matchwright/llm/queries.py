"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.llm import bpe, extract, katz, langid, licences, packing, pii, quality, repair, simhash, topk, trie, warc
from matchwright.llm.texts import table


def tokenizer_path() -> str:
    """Where the public tokenizer file lies on the driver."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0))


ORACLES["op6_exact_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), r AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@register
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents")).drop("n_lines")


ORACLES["op5_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
    SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
    FROM (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)
), counts AS (SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY rid),
tri AS (
    SELECT rid, pos, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS win
    FROM w WINDOW o AS (PARTITION BY rid ORDER BY pos)
), again AS (
    SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, win) AS n FROM tri WHERE win IS NOT NULL) WHERE n > 1
), covered AS (
    SELECT rid, count(DISTINCT pos + k) AS n_repeat FROM again, (VALUES (0), (1), (2)) AS s(k) GROUP BY rid
), l AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (
    SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
    FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), m AS (
    SELECT doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
    FROM d LEFT JOIN counts USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN lines USING (rid)
), b AS (
    SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
           + 8 * (100 * n_dup_lines > 60 * n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT
           + 32 * (word_chars > 20 * n_words)::INT + 64 * (100 * n_dup_lines > 30 * n_lines)::INT
           + 128 * (100 * n_repeat_words > 20 * n_words)::INT AS BIGINT) AS fail_bits
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits,
       fail_bits & 3 <> 0 AS base_failed, fail_bits & 63 = 0 AS kept
FROM b
"""


@register
def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def _licence_sql(probes: int = 12, slack: int = 2, least: float = 0.6) -> str:
    """The scan as joins over one row per word; the tables of templates and phrases are written out as values."""
    rows = lambda xs: ", ".join(xs)
    words = rows(f"('{w}')" for w in licences.vocabulary())
    posts = rows(f"('{t}', '{w}', {p})" for t, (text, _) in licences.TEMPLATES.items() for p, w in enumerate(text.split()))
    keys = rows(
        f"('{t}', '{' '.join(key.split())}', {len((' ' + text + ' ').split(' ' + key + ' ')[0].split())})"
        for t, (text, key) in licences.TEMPLATES.items()
    )
    base = rows(f"('{phrase}', '{label}')" for phrase, label in licences.BASE.items())
    return rf"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), s AS (SELECT rid, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM d),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM s),
vocab(word) AS (VALUES {words}), posting(label, word, p) AS (VALUES {posts}),
keyed(label, phrase, site) AS (VALUES {keys}), based(phrase, label) AS (VALUES {base}),
df AS (SELECT v.word, count(DISTINCT rid) AS n FROM vocab v LEFT JOIN w USING (word) GROUP BY v.word),
probe AS (
    SELECT label, word FROM (
        SELECT label, word, row_number() OVER (PARTITION BY label ORDER BY n, word) AS k FROM (SELECT DISTINCT label, word FROM posting) JOIN df USING (word)
    ) WHERE k <= {probes}
), indexed AS (SELECT label, word, p FROM posting JOIN probe USING (label, word)),
phrases AS (SELECT DISTINCT phrase FROM (SELECT phrase FROM keyed UNION ALL SELECT phrase FROM based)),
part AS (SELECT phrase, unnest(string_split(phrase, ' ')) AS word, generate_subscripts(string_split(phrase, ' '), 1) - 1 AS k FROM phrases),
place AS (
    SELECT rid, phrase, pos - k AS start FROM w JOIN part USING (word)
    GROUP BY rid, phrase, pos - k HAVING count(*) = len(string_split(phrase, ' '))
), standing AS (SELECT rid, label, start, site FROM place JOIN keyed USING (phrase)),
aligned AS (
    SELECT rid, label, pos - p AS shift, count(*) AS agree FROM w JOIN indexed USING (word)
    SEMI JOIN standing USING (rid, label) GROUP BY rid, label, pos - p
), able AS (SELECT label, count(*) AS able FROM indexed GROUP BY label),
verified AS (
    SELECT rid, label, max(agree / able) AS share FROM aligned JOIN able USING (label) JOIN standing USING (rid, label)
    WHERE agree >= {least} * able AND abs(start - shift - site) <= {slack} GROUP BY rid, label
), own AS (SELECT rid, label, start FROM place JOIN based USING (phrase)),
o AS (
    SELECT rid, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
           array_to_string(list_sort(list_distinct(list(label))), ',') AS base_labels
    FROM own GROUP BY rid
), e AS (
    SELECT rid, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels
    FROM (SELECT rid, label FROM own UNION ALL SELECT rid, label FROM verified) GROUP BY rid
), v AS (SELECT rid, max(share) AS share FROM verified GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       greatest(coalesce(share, 0.0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0.0 END)::DOUBLE AS score
FROM s LEFT JOIN o USING (rid) LEFT JOIN e USING (rid) LEFT JOIN v USING (rid)
"""


ORACLES["op4_license_scans"] = _licence_sql()


@register
def op10_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.read_tokenizer(tokenizer_path()))


@register
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), bpe.read_tokenizer(tokenizer_path()))


@register
def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


@register
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_texts(table(spark, sf_dir, "pages"))


@register
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@register
def op9_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"))


@register
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of an ASCII text, bit by bit."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(a, x) >> 1, CASE WHEN xor(a, x) & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {bits}), lambda a, x: {step}), 4294967295)"


@register
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.reports(repair.damaged(table(spark, sf_dir, "conversations")))


ORACLES["op12_conversation_repair"] = rf"""
WITH RECURSIVE c AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS draw
    FROM conversations
), d AS (
    SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
           CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
    FROM c, (VALUES (0), (1)) AS k(copy) WHERE draw <> 0 AND (copy = 0 OR draw = 3)
), f AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
    FROM d
), r AS (
    SELECT conv_id, n, turn, role, text, left(role, 1) AS i, body = '' AS blank, body <> '' AND nth > 1 AS again,
           body <> '' AND nth = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS cut,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) AS pair
    FROM f
), moves(q, i, t, given) AS (
    VALUES ('0', 's', 'S', CAST(NULL AS VARCHAR)), ('0', 'u', 'U', 'user'), ('S', 'u', 'U', 'user'), ('U', 'a', 'A', 'assistant'), ('A', 'u', 'U', 'user')
), more(q, t, k, rows) AS (
    VALUES ('0', '0', 0, ''), ('0', 'U', 1, chr(10) || 'user:'), ('0', 'A', 2, chr(10) || 'user:' || chr(10) || 'assistant:'),
           ('S', 'S', 0, ''), ('S', 'U', 1, chr(10) || 'user:'), ('S', 'A', 2, chr(10) || 'user:' || chr(10) || 'assistant:'),
           ('U', 'U', 0, ''), ('U', 'A', 1, chr(10) || 'assistant:'), ('A', 'A', 0, ''), ('A', 'U', 1, chr(10) || 'user:')
), edits(kind, q, i, t, given) AS (
    SELECT 'D', q, CAST(NULL AS VARCHAR), q, CAST(NULL AS VARCHAR) FROM (VALUES ('0'), ('S'), ('U'), ('A')) AS x(q)
    UNION ALL SELECT 'K', q, i, t, CAST(NULL AS VARCHAR) FROM moves
    UNION ALL SELECT 'R', q, CAST(NULL AS VARCHAR), t, given FROM moves WHERE given IS NOT NULL
), best AS (
    SELECT conv_id, 0::BIGINT AS n, m.t AS q, CAST(2 * m.k AS BIGINT) AS cost, repeat('I', m.k) AS audit, m.rows AS text
    FROM (SELECT DISTINCT conv_id FROM conversations) JOIN more m ON m.q = '0'
    UNION ALL
    SELECT conv_id, n, q, cost, audit, text FROM (
        SELECT *, row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) AS place FROM (
            SELECT b.conv_id, r.n, m.t AS q,
                   b.cost + 2 * m.k + CASE e.kind WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END + CASE WHEN e.kind <> 'D' AND r.cut THEN 1 ELSE 0 END AS cost,
                   b.audit || e.kind || repeat('I', m.k) AS audit,
                   b.text || CASE WHEN e.kind = 'D' THEN '' ELSE chr(10) || coalesce(e.given, r.role) || ':' || r.text END || m.rows AS text
            FROM best b JOIN r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.n = b.n + 1
            JOIN edits e ON e.q = b.q AND (e.i IS NULL OR e.i = r.i) AND (e.kind = 'D' OR NOT (r.blank OR r.again))
            JOIN more m ON m.q = e.t
        )
    ) WHERE place = 1
), last AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, cost, audit) AS place FROM best WHERE q IN ('0', 'A')
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
           count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM r GROUP BY conv_id
)
SELECT l.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, sha256(substr(l.text, 2)) AS repaired_sha256
FROM last l LEFT JOIN counts ON l.conv_id IS NOT DISTINCT FROM counts.conv_id WHERE place = 1
"""


@register
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(trie.rebuilt(trie.turns(table(spark, sf_dir, "conversations"))))


ORACLES["op13_conversation_trie"] = rf"""
WITH own AS (
    SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS rows,
           {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), built AS (
    SELECT o.conv_id, list_concat(coalesce(list_slice(b.rows, 1, o.h), []), list_slice(o.rows, o.h + 1, len(o.rows))) AS rows
    FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
), prefix AS (
    SELECT conv_id, len(rows) = d AS ends, d, list_slice(rows, 1, d) AS path
    FROM (SELECT conv_id, rows, unnest(range(len(rows) + 1)) AS d FROM built)
), node AS (
    SELECT path, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ends,
           CASE WHEN any_value(d) = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(path[-1].text, '[^\x20\x09-\x0D]+')) END AS saved
    FROM prefix GROUP BY path
), family AS (
    SELECT n.path, count(c.path) AS n_children, min(p.conv_id) AS parent
    FROM node n LEFT JOIN node c ON c.d = n.d + 1 AND list_slice(c.path, 1, n.d) = n.path
    LEFT JOIN node p ON n.d > 0 AND p.d = n.d - 1 AND p.path = list_slice(n.path, 1, n.d - 1)
    GROUP BY n.path
), below AS (
    SELECT a.path, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(x.saved) AS saved_tokens
    FROM node a JOIN node x ON x.d >= a.d AND list_slice(x.path, 1, a.d) = a.path JOIN family f ON f.path = x.path
    GROUP BY a.path
)
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM node JOIN family USING (path) JOIN below USING (path)
"""
