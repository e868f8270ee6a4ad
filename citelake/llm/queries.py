"""The queries of this subpackage over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from citelake.llm.decontaminate import overlaps
from citelake.llm.divergence import quality_rules
from citelake.llm.licenses import scan_licenses
from citelake.llm.mixing import mix
from citelake.llm.near_dups import near_duplicates
from citelake.llm.pages import extract_text
from citelake.llm.quality import score_quality
from citelake.llm.repair import repair_conversations
from citelake.llm.source_audit import source_audit
from citelake.llm.token_files import token_index, write_tokens
from citelake.llm.top_k import exact_top_k
from citelake.llm.toxicity import score_toxicity
from citelake.llm.urls import filter_urls
from citelake.session import stage_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op6_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), width=2).drop("f")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "tokens")
    write_tokens(_table(spark, sf_dir, "documents"), path)
    return token_index(spark, path)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit(_table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The two divergences are sums of logarithms: left out, so that the rows are exact.
    return quality_rules(_table(spark, sf_dir, "documents")).drop("word_js", "class_js")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_decontaminate": op2_decontaminate,
    "op3_url_filter": op3_url_filter,
    "op4_quality": op4_quality,
    "op5_page_text": op5_page_text,
    "op6_near_dups": op6_near_dups,
    "op7_token_files": op7_token_files,
    "op8_toxicity": op8_toxicity,
    "op9_mix_sources": op9_mix_sources,
    "op10_top_k": op10_top_k,
    "op11_source_audit": op11_source_audit,
    "op12_quality_rules": op12_quality_rules,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE = {
    # The given pages hold their article in one element, with headings and paragraphs only.
    "op5_page_text": r"""
WITH inside AS (
    SELECT page_id, url, regexp_replace(
        regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'), '\s+', ' ', 'g') AS a
    FROM pages
), lines AS (
    SELECT page_id, url, string_split(regexp_replace(regexp_replace(
        replace(a, '<br>', ' '), '</?(p|h1)>', chr(10), 'g'), '<[^>]*>', '', 'g'), chr(10)) AS l
    FROM inside
), decoded AS (
    SELECT page_id, url, list_filter(list_transform(l, lambda x: trim(regexp_replace(
        replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)),
            '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') AS l
    FROM lines
)
SELECT page_id, url, array_to_string(l, chr(10)) AS text,
       CAST(length(array_to_string(l, chr(10))) AS BIGINT) AS n_chars
FROM decoded
""",
    "op10_top_k": """
WITH sound AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM sound q JOIN sound c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op11_source_audit": r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, coalesce(lang, '') AS l, coalesce(source, '') AS s,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), terms AS (
    SELECT rid, l, s, term, count(*) AS n
    FROM (SELECT rid, l, s, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d) GROUP BY ALL
), kept AS (
    SELECT l, term, CAST(sum(n) AS HUGEINT) AS n FROM terms GROUP BY l, term HAVING count(*) >= 3
), langs AS (
    SELECT l, count(*) AS v, sum(n) AS n FROM kept GROUP BY l
), cells AS (
    SELECT l, s, term, CAST(sum(terms.n) AS HUGEINT) AS n FROM terms JOIN kept USING (l, term) GROUP BY ALL
), sources AS (
    SELECT l, s, CAST(coalesce(sum(n), 0) AS HUGEINT) AS n FROM (SELECT DISTINCT l, s FROM d) LEFT JOIN cells USING (l, s) GROUP BY l, s
), weights AS (
    SELECT sources.l, sources.s, kept.term, coalesce(cells.n, 0) AS n,
           1 + (1000000000 * (coalesce(cells.n, 0) + 1)) // (sources.n + v) AS p,
           1 + (1000000000 * (kept.n + 1)) // (langs.n + v) AS q
    FROM sources JOIN kept ON kept.l = sources.l JOIN langs ON langs.l = sources.l
    LEFT JOIN cells ON cells.l = sources.l AND cells.s = sources.s AND cells.term = kept.term
), sums AS (
    SELECT a.l, a.s, b.s AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM weights a JOIN weights b ON a.l = b.l AND a.term = b.term AND a.s <> b.s GROUP BY ALL
), parts AS (
    SELECT a.l, a.s, 'pair' AS part, b.s AS item, coalesce(value, 0) AS value
    FROM sources a JOIN sources b ON a.l = b.l AND a.s <> b.s
    LEFT JOIN sums ON sums.l = a.l AND sums.s = a.s AND sums.item = b.s
    UNION ALL
    SELECT l, s, 'term', term, ((p - q) * (p - q)) // q FROM weights WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY l, s, part ORDER BY value DESC, item) AS r FROM parts
)
SELECT l AS lang, s AS source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= 200
""",
    "op12_quality_rules": r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce('+' || lang, '-') AS l FROM documents
), w AS (
    SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d
), windows AS (
    SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM w, unnest(range(1, len(w) - 1)) AS u(i)
), again AS (
    SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1
), repeated AS (
    SELECT rid, count(DISTINCT i + s) AS n FROM again, range(3) AS k(s) GROUP BY rid
), lines AS (
    SELECT rid, count(*) - count(DISTINCT line) AS n FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), classes AS (
    SELECT rid, doc_id, l, t, strlen(t) AS size, length(t) - length(regexp_replace(t, '[a-z]', '', 'g')) AS c0,
           length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS c1,
           length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS c2,
           length(t) - length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS c3,
           length(t) - length(regexp_replace(t, '[.,;:!?''"()-]', '', 'g')) AS c4,
           length(regexp_replace(t, '[^\x00-\x7F]', '', 'g')) AS ascii
    FROM d
), base AS (
    SELECT rid, doc_id, l, size, [c0, c1, c2, c3, c4, ascii - c0 - c1 - c2 - c3 - c4, size - ascii] AS c,
           CAST(len(w) AS BIGINT) AS n_words, CAST(length(t) - c3 AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words
    FROM classes JOIN w USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN repeated USING (rid)
), terms AS (
    SELECT rid, l, term, count(*) AS n
    FROM (SELECT rid, l, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d) GROUP BY ALL
), doc AS (
    SELECT rid, l, sum(n) AS n, substr(md5(max(term)), 1, 1) AS shard FROM terms GROUP BY ALL
), lang AS (
    SELECT l, sum(n) AS n FROM doc GROUP BY l HAVING sum(n) >= 10000
), common AS (
    SELECT l, term FROM terms JOIN lang USING (l) GROUP BY l, term HAVING sum(terms.n) * 2000 >= any_value(lang.n)
), shards AS (
    SELECT l, shard, sum(doc.n) AS n, sum(size) AS size, [sum(c[1]), sum(c[2]), sum(c[3]), sum(c[4]), sum(c[5]), sum(c[6]), sum(c[7])] AS c
    FROM doc JOIN (SELECT rid, c, size FROM base) USING (rid) JOIN (SELECT l FROM lang) USING (l) GROUP BY ALL
), held AS (
    SELECT terms.l, shard, terms.term, sum(terms.n) AS n FROM terms JOIN doc USING (rid) JOIN common ON common.l = terms.l AND common.term = terms.term
    GROUP BY ALL
), shares AS (
    SELECT common.l, common.term, quantile_disc((coalesce(held.n, 0) * 1000000000) // shards.n, 0.5) AS r
    FROM common JOIN shards ON shards.l = common.l
    LEFT JOIN held ON held.l = common.l AND held.term = common.term AND held.shard = shards.shard GROUP BY ALL
), word_sizes AS (
    SELECT l, sum(r) AS held, greatest(1000000000 - sum(r), 0) AS other FROM shares GROUP BY l
), q AS (
    SELECT l, term, r / (held + other) AS q, other / (held + other) AS qo FROM shares JOIN word_sizes USING (l)
), class_shares AS (
    SELECT l, k, quantile_disc((c[k] * 1000000000) // size, 0.5) AS r FROM shards, range(1, 8) AS u(k) GROUP BY ALL
), p AS (
    SELECT terms.rid, sum(terms.n) AS known, sum(q) AS there, any_value(qo) AS qo,
           sum((terms.n / doc.n * log2(2 * (terms.n / doc.n) / (terms.n / doc.n + q))
              + CASE WHEN q > 0 THEN q * log2(2 * q / (terms.n / doc.n + q)) ELSE 0 END) / 2) AS js
    FROM terms JOIN doc USING (rid) JOIN q ON q.l = terms.l AND q.term = terms.term GROUP BY terms.rid
), word_js AS (
    SELECT doc.rid, doc.n, coalesce(js, 0) + greatest(1 - o - coalesce(there, 0), 0) / 2
        + (CASE WHEN doc.n > coalesce(known, 0) THEN (1 - coalesce(known, 0) / doc.n)
               * log2(2 * (1 - coalesce(known, 0) / doc.n) / (1 - coalesce(known, 0) / doc.n + o)) ELSE 0 END
           + CASE WHEN o > 0 THEN o * log2(2 * o / (1 - coalesce(known, 0) / doc.n + o)) ELSE 0 END) / 2 AS js
    FROM doc JOIN (SELECT l, other / (held + other) AS o FROM word_sizes) USING (l) LEFT JOIN p USING (rid)
    WHERE doc.n >= 50
), class_js AS (
    SELECT rid, size, sum(((CASE WHEN c[k] > 0 THEN c[k] / size * log2(2 * (c[k] / size) / (c[k] / size + cq)) ELSE 0 END)
        + (CASE WHEN cq > 0 THEN cq * log2(2 * cq / (c[k] / size + cq)) ELSE 0 END)) / 2) AS js
    FROM base JOIN (SELECT l, k, r / sum(r) OVER (PARTITION BY l) AS cq FROM class_shares) USING (l)
    WHERE size >= 200 GROUP BY rid, size
), verdict AS (
    SELECT base.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           coalesce(word_js.js > 0.1 + 30.0 / word_js.n, false) OR coalesce(class_js.js > 0.05 + 25.0 / class_js.size, false) AS far
    FROM base LEFT JOIN word_js USING (rid) LEFT JOIN class_js USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT far AS kept
FROM verdict
""",
    "op13_conversation_repair": r"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations
), hashed AS (
    -- CRC-32 bit by bit, over the key's ASCII codes.
    SELECT *, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT)),
        lambda c, b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
        CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind
    FROM keyed
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM hashed, range(2) AS copies(c) WHERE kind <> 0 AND (c = 0 OR kind = 3)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
        sha256(length(role) || ':' || role || text)) AS i
    FROM damaged
), seen AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS time,
           rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
    FROM placed
), r AS (
    SELECT conv_id, i, turn, role, text, substr(role, 1, 1) AS s,
           CASE WHEN body = '' THEN 3 WHEN time > 1 THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault
    FROM seen
), sizes AS (
    SELECT conv_id, count(*) AS n FROM r GROUP BY conv_id
), inserts(a, b, cost, letters, lines) AS (
    VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
           (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (3, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']),
           (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:'])
), moves(a, b, letter, role, cost) AS (
    VALUES (0, 0, 'D', '', 2), (1, 1, 'D', '', 2), (2, 2, 'D', '', 2), (3, 3, 'D', '', 2),
           (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0), (3, 2, 'K', 'u', 0), (2, 3, 'K', 'a', 0),
           (0, 2, 'R', 'user', 1), (1, 2, 'R', 'user', 1), (3, 2, 'R', 'user', 1), (2, 3, 'R', 'assistant', 1)
), paths AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM sizes
    UNION ALL
    SELECT conv_id, i, state, cost, audit, lines FROM (
        SELECT p.conv_id, r.i, m.b AS state,
               CAST(p.cost + t.cost + m.cost + CASE WHEN letter <> 'D' AND fault = 1 THEN 5 ELSE 0 END AS BIGINT) AS cost,
               audit || letters || letter AS audit,
               list_concat(list_concat(p.lines, t.lines), CASE letter WHEN 'D' THEN CAST([] AS VARCHAR[])
                   WHEN 'K' THEN [r.role || ':' || text] ELSE [m.role || ':' || text] END) AS lines,
               row_number() OVER (PARTITION BY p.conv_id, m.b ORDER BY p.cost + t.cost + m.cost
                   + CASE WHEN letter <> 'D' AND fault = 1 THEN 5 ELSE 0 END, audit || letters || letter) AS best
        FROM paths p JOIN inserts t ON t.a = p.state JOIN moves m ON m.a = t.b
        JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
        WHERE letter = 'D' OR fault < 2 AND (letter = 'R' OR m.role = r.s)
    ) WHERE best = 1
), ends AS (
    SELECT p.conv_id, p.cost + t.cost AS cost, audit || letters AS audit, list_concat(p.lines, t.lines) AS lines,
           row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + t.cost, audit || letters) AS best
    FROM paths p JOIN sizes ON sizes.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = n JOIN inserts t ON t.a = p.state WHERE t.b IN (0, 3)
), pairs AS (
    SELECT *, lag(s) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM r
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 3) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
           count(*) FILTER (i > 1 AND before || s NOT IN ('su', 'ua', 'au')) AS illegal
    FROM pairs GROUP BY conv_id
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM o.conv_id AND best = 1
""",
}
