"""The same results in SQL over the given tables."""

from __future__ import annotations

from citelake.operators.flatten import REFERENCE_ID_TYPES

# The derivation of catalog.citations, one relation per level.
_ORDERS = """
o AS (
  SELECT *, 'order_' || o_orderkey AS doc_id,
         substr(md5('order_' || o_orderkey || chr(31) || 'orders'), 1, 3) AS bucket,
         CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
         CAST(day(o_orderdate) AS INTEGER) AS d, CAST(o_orderkey AS INTEGER) AS pmid
  FROM orders)"""
_AUTHORS = """
author AS (
  SELECT o.*, CAST(i AS INTEGER) AS i, row_number() OVER (ORDER BY bucket, doc_id, i) AS author_no
  FROM o, unnest(range(0, o_orderkey % 5)) AS t(i))"""
_AFFILIATIONS = """
affiliation AS (
  SELECT author.*, CAST(j AS INTEGER) AS j, o_custkey % 13 = 0 AND j = 1 AS known,
    CASE WHEN NOT (o_custkey % 13 = 0 AND j = 1) THEN
      'Dept ' || o_orderpriority || ', Supplier#'
      || lpad(CAST((o_custkey * (i + 1) * 3 + j) % 400 AS VARCHAR), 9, '0') || ', '
      || CASE WHEN (o_orderkey + j) % 11 = 0 THEN 'Elsewhere'
              ELSE 'NATION_' || ((o_orderkey + i + j) % 40) END
    END AS affiliation
  FROM author, unnest(range(0, (o_custkey + i) % 3)) AS u(j))"""
_ORGANISATIONS = """
plain AS (
  SELECT s_suppkey, s_name AS name, 'C' || s_nationkey AS country_code, n_name AS country_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
org AS (
  SELECT name, country_code, country_name FROM plain
  UNION ALL
  SELECT name || ', NATION_1', '', '' FROM plain WHERE s_suppkey % 10 = 0),
place AS (
  SELECT n_name AS name, 'C' || n_nationkey AS country_code FROM nation)"""
_MATCHES = """
texts AS (SELECT DISTINCT affiliation FROM affiliation WHERE affiliation IS NOT NULL),
best_org AS (
  SELECT * FROM (
    SELECT affiliation, name, country_code, country_name,
           row_number() OVER (PARTITION BY affiliation ORDER BY length(name) DESC, name) AS r
    FROM texts JOIN org ON contains(affiliation, name)) WHERE r = 1),
best_place AS (
  SELECT * FROM (
    SELECT affiliation, name, country_code,
           row_number() OVER (PARTITION BY affiliation ORDER BY length(name) DESC, name) AS r
    FROM texts JOIN place ON contains(affiliation, name)) WHERE r = 1)"""


def _enriched(mode: str) -> str:
    if mode == "fallback":
        code = "CASE WHEN g.name IS NOT NULL THEN g.country_code ELSE p.country_code END"
        name = "CASE WHEN g.name IS NOT NULL THEN g.country_name ELSE p.name END"
    else:
        code, name = "p.country_code", "p.name"
    return f"""
enriched AS (
  SELECT a.*, g.name AS org_hit, p.name AS place_hit,
         CASE WHEN known THEN 'Known' ELSE g.name END AS institution_name,
         CASE WHEN known THEN 'KN' ELSE {code} END AS country_code,
         CASE WHEN known THEN 'Knownland' ELSE {name} END AS country_name
  FROM affiliation a
  LEFT JOIN best_org g ON a.affiliation = g.affiliation
  LEFT JOIN best_place p ON a.affiliation = p.affiliation)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_BASE = (_ORDERS, _AUTHORS, _AFFILIATIONS)
_FALLBACK = (*_BASE, _ORGANISATIONS, _MATCHES, _enriched("fallback"))
_INDEPENDENT = (*_BASE, _ORGANISATIONS, _MATCHES, _enriched("independent"))
_FIELDS = """doc_id, i AS author_pos, j AS affiliation_pos, affiliation, institution_name,
  country_code, country_name"""

_ORG_HITS = _with(*_BASE, _ORGANISATIONS, _MATCHES) + """
SELECT doc_id, i AS author_pos, j AS affiliation_pos, name, country_code, country_name
FROM affiliation JOIN best_org USING (affiliation)"""

_GATE = """
SELECT doc_id FROM enriched {where} GROUP BY doc_id
HAVING bool_or(coalesce(trim(country_code), '') <> '')
   AND bool_or(coalesce(trim(institution_name), '') <> '')"""

# First dates of status `pubmed`, as (ordinal, year, month, day).
_DATES = """
dated AS (
  SELECT doc_id, pmid, 1 AS n, y AS year, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE m END AS month,
         d AS day
  FROM o WHERE o_orderstatus <> 'F'
  UNION ALL
  SELECT doc_id, pmid, 2, y + 1, m, 31 FROM o)"""

_KEYWORDS = """
keyword AS (
  SELECT o.*, pos, w FROM (
    SELECT o.*, unnest(string_split(o_orderpriority, '-')) AS w,
           generate_subscripts(string_split(o_orderpriority, '-'), 1) AS pos FROM o) o)"""

_STATUS = """
SELECT 'doc_' || doc_id || '.gz' AS name,
  CASE doc_id % 6
    WHEN 0 THEN 'ok' WHEN 1 THEN 'ok'
    WHEN 2 THEN CASE WHEN reverse(md5(text)) = md5(text) THEN 'ok' ELSE 'mismatch' END
    WHEN 3 THEN 'bad_format' WHEN 4 THEN 'bad_format' ELSE 'no_sidecar' END AS status
FROM documents"""

_LAST_PART = """
SELECT p_name AS name, arg_max(p_brand, p_partkey) AS country_code,
       arg_max(p_type, p_partkey) AS country_name
FROM part GROUP BY p_name"""


def _references() -> str:
    kinds = {
        "pubmed": "CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END",
        "doi": "CASE WHEN k = 1 THEN '10.2/' || o_orderkey ELSE '10.1/' || o_orderkey END",
        "pmcid": "CASE WHEN o_custkey % 2 <> 0 THEN CAST(o_custkey AS VARCHAR) END",
        "pii": "CAST(NULL AS VARCHAR)",
    }
    columns = ", ".join(f"{kinds[kind]} AS ref_article_id_{kind}" for kind in REFERENCE_ID_TYPES)
    return _with(_ORDERS) + f"""
SELECT pmid, row_number() OVER (ORDER BY bucket, doc_id, k) AS ref_no,
       'Ref ' || o_orderkey || '.' || k AS citation, {columns}
FROM o, unnest(range(0, o_orderkey % 3)) AS t(k)"""


_HEADINGS = """
heading AS (
  SELECT o.*, k, row_number() OVER (ORDER BY bucket, doc_id, k) AS descriptor_index
  FROM o, unnest(range(0, o_custkey % 3)) AS t(k)),
qualifier AS (
  SELECT doc_id, k, q FROM heading, unnest(range(0, (o_orderkey + k) % 3)) AS u(q))"""

_BANKS = """
bank AS (
  SELECT o.*, b FROM o, unnest(range(0, o_custkey % 3)) AS t(b)),
accession AS (
  SELECT bank.*, n FROM bank, unnest(range(0, (o_orderkey + b) % 3)) AS u(n))"""

# Three files are no gzip; their orders reach nothing.
_DAMAGED = """
SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'parse' ELSE 'stored' END AS outcome, count(*) AS n
FROM orders WHERE o_orderkey % 4 <> 3 GROUP BY ALL
UNION ALL SELECT 'gunzip', 3"""

ORACLE: dict[str, str] = {
    "org_match": """
SELECT c_custkey, name FROM (
  SELECT c_custkey, n_name AS name, row_number() OVER (
           PARTITION BY c_custkey ORDER BY length(n_name) DESC, n_name) AS r
  FROM customer JOIN nation ON contains(c_name || ', NATION_' || c_nationkey, n_name))
WHERE r = 1""",
    "org_match_indexed": _ORG_HITS,
    "org_match_shuffled": _ORG_HITS,
    "passage_match": """
SELECT doc_id, item_id
FROM documents d JOIN (SELECT text, min(item_id) AS item_id FROM benchmark
                       WHERE text <> '' GROUP BY text) b
  ON contains(d.text, b.text)""",
    "enrich_fallback": _with(*_FALLBACK) + f"SELECT {_FIELDS} FROM enriched",
    "enrich_fallback_indexed": _with(*_FALLBACK) + f"SELECT {_FIELDS} FROM enriched",
    "enrich_independent": _with(*_INDEPENDENT) + f"""
SELECT {_FIELDS} FROM enriched WHERE doc_id IN (
  SELECT doc_id FROM enriched GROUP BY doc_id
  HAVING count(org_hit) > 0 AND count(place_hit) > 0)""",
    "enrich_independent_shuffled": _with(*_INDEPENDENT) + f"""
SELECT {_FIELDS} FROM enriched WHERE doc_id IN (
  SELECT doc_id FROM enriched GROUP BY doc_id
  HAVING count(org_hit) > 0 AND count(place_hit) > 0)""",
    "dictionary_last_wins": _LAST_PART,
    "country_last_wins": """
SELECT p_type AS country_name, arg_max(p_brand, p_partkey) AS country_code
FROM part GROUP BY p_type""",
    "dictionary_curate": """
SELECT s_suppkey, s_name || ' ' AS name FROM supplier s WHERE NOT EXISTS (
  SELECT 1 FROM supplier t WHERE t.s_suppkey % 3 = 0 AND t.s_suppkey % 2 = 0
    AND lower(t.s_name) = lower(trim(s.s_name || ' ')))""",
    "registry_roundtrip": _LAST_PART,
    "gate_any": _with(*_FALLBACK) + _GATE.format(where=""),
    "gate_with_affiliation": _with(*_FALLBACK)
    + _GATE.format(where="WHERE affiliation IS NOT NULL"),
    "gate_year": _with(_ORDERS, _DATES) + "SELECT DISTINCT doc_id FROM dated WHERE year >= 2000",
    "pmids": _with(_ORDERS) + "SELECT pmid FROM o",
    "pubdate_first": _with(_ORDERS, _DATES) + """
SELECT pmid, year, month, day FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS r FROM dated) WHERE r = 1""",
    "pubdate_recent": _with(_ORDERS, _DATES)
    + "SELECT pmid, year, month, day FROM dated WHERE year >= 2000",
    "titles": _with(_ORDERS) + """
SELECT pmid, CASE WHEN o_orderkey % 9 <> 0 THEN 'Order ' || o_orderkey || ' ' || o_orderpriority
                  ELSE '' END AS article_title FROM o""",
    "journals": _with(_ORDERS) + """
SELECT pmid, o_orderpriority AS title,
  CASE WHEN o_custkey % 3 <> 0 THEN o_orderstatus ELSE '' END AS iso_abbreviation,
  CAST(y AS VARCHAR) AS volume, CAST(m AS VARCHAR) AS issue, y AS pub_year,
  lpad(CAST(m AS VARCHAR), 2, '0') AS pub_month,
  CASE WHEN o_orderkey % 4 <> 0 THEN d ELSE 0 END AS pub_day FROM o""",
    "authors": _with(_ORDERS, _AUTHORS) + """
SELECT pmid, author_no, CASE WHEN (o_custkey + i) % 7 <> 0 THEN 'Y' ELSE 'N' END AS valid_yn,
  'Customer#' || (o_custkey + i) AS lastname,
  CASE WHEN i <> 1 THEN o_orderpriority ELSE '' END AS forename,
  CAST(NULL AS VARCHAR) AS collectivename, o_orderstatus AS initials,
  CASE WHEN i = 3 THEN 'Jr' ELSE '' END AS suffix,
  CASE WHEN o_custkey % 2 = 0 THEN 'ORCID' ELSE '' END AS identifier_source,
  CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS identifier
FROM author""",
    "affiliations": _with(*_BASE) + """
SELECT pmid, row_number() OVER (ORDER BY bucket, doc_id, i, j) AS affiliation_no, affiliation,
  '' AS affiliation_country, '' AS affiliation_organization,
  CASE WHEN o_custkey % 2 = 0 THEN 'ORCID' ELSE '' END AS affiliation_identifier_source,
  CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS affiliation_identifier
FROM affiliation WHERE affiliation IS NOT NULL""",
    "author_affiliations": _with(*_BASE) + """
SELECT pmid, author_no, row_number() OVER (ORDER BY bucket, doc_id, i, j) AS affiliation_no
FROM affiliation WHERE affiliation IS NOT NULL""",
    "affiliation_links": _with(*_FALLBACK) + f"""
SELECT pmid, 'Customer#' || (o_custkey + i) AS lastname, affiliation,
  coalesce(country_code, '') AS affiliation_country,
  coalesce(institution_name, '') AS affiliation_organization
FROM enriched WHERE affiliation IS NOT NULL AND doc_id IN ({_GATE.format(where="")})""",
    "mesh_headings": _with(_ORDERS, _HEADINGS) + """
SELECT pmid, descriptor_index, 'Heading ' || ((o_custkey + k) % 50) AS descriptor_name,
  CASE WHEN k = 0 THEN 'Y' ELSE 'N' END AS descriptor_major_topic_yn,
  CAST(NULL AS VARCHAR) AS descriptor_type, 'D' || ((o_custkey + k) % 50) AS descriptor_ui,
  'Qualifier ' || q AS qualifier_name,
  CASE WHEN q = 1 THEN 'Y' WHEN q IS NOT NULL THEN 'N' END AS qualifer_major_topic_yn,
  'Q' || q AS qualifier_ui
FROM heading LEFT JOIN qualifier USING (doc_id, k)""",
    "references_pivot": _references(),
    "databanks": _with(_ORDERS, _BANKS) + """
SELECT pmid, CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END AS databank_list_complete_yn,
  'Bank ' || b AS databank_name, o_orderkey || '.' || b || '.' || n AS accession_number
FROM accession""",
    "keywords": _with(_ORDERS, _KEYWORDS) + """
SELECT row_number() OVER (ORDER BY bucket, doc_id, pos) AS keyword_index, pmid, w AS keyword,
  CASE WHEN w = 'LOW' THEN 'Y' ELSE 'N' END AS keyword_major_topic_yn FROM keyword""",
    "batch_number": """
SELECT o_orderkey, CAST((n - 1) // 1000 + 1 AS BIGINT) AS batch FROM (
  SELECT o_orderkey, row_number() OVER (
    ORDER BY substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 3), o_orderkey) AS n FROM orders)""",
    "two_loaders": _with(*_BASE, _KEYWORDS, """
counts AS (
  SELECT 'author' AS kind, count(*) AS n FROM author
  UNION ALL SELECT 'affiliation', count(*) FROM affiliation WHERE affiliation IS NOT NULL
  UNION ALL SELECT 'reference', CAST(sum(o_orderkey % 3) AS BIGINT) FROM o
  UNION ALL SELECT 'keyword', count(*) FROM keyword)""") + """
SELECT kind, n, n AS numbers, CAST(1 AS BIGINT) AS first, n AS last FROM counts""",
    "load_totals": _with(*_INDEPENDENT, _DATES, """
matched AS (
  SELECT doc_id, bool_or(coalesce(trim(country_code), '') <> '')
           AND bool_or(coalesce(trim(institution_name), '') <> '') AS passed
  FROM enriched GROUP BY doc_id HAVING bool_or(org_hit IS NOT NULL) AND bool_or(place_hit IS NOT NULL)),
recent AS (SELECT DISTINCT doc_id FROM dated WHERE year >= 1995),
outcomes AS (
  SELECT CASE WHEN m.doc_id IS NULL THEN 'unmatched' WHEN NOT passed THEN 'gate'
              WHEN r.doc_id IS NULL THEN 'year' ELSE 'stored' END AS outcome
  FROM o LEFT JOIN matched m USING (doc_id) LEFT JOIN recent r USING (doc_id)
  UNION ALL SELECT 'parse' FROM orders WHERE o_orderkey % 10 = 0)""") + """
SELECT 'run' AS run_id, outcome, count(*) AS n FROM outcomes GROUP BY outcome""",
    "file_checks": """
SELECT 'good' AS kind, 'ok' AS status, false AS damaged, count(*) AS lines FROM orders WHERE o_orderkey % 4 <> 3
UNION ALL SELECT 'large', 'ok', false, count(*) FROM lineitem
UNION ALL SELECT 'bad', 'mismatch', true, NULL
UNION ALL SELECT 'empty', 'no_sidecar', true, NULL""",
    "record_order": "SELECT count(*) AS records, count(*) AS in_order FROM lineitem",
    "enrich_documents": _with(*_BASE, _ORGANISATIONS.replace(
        "SELECT n_name AS name, 'C' || n_nationkey AS country_code FROM nation",
        "SELECT DISTINCT country_name AS name, country_code FROM plain"), _MATCHES) + """
SELECT a.doc_id, '{"more":[true,{}],"of":' || a.pmid || '}' AS extra, a.i AS author_pos,
       '["' || a.o_orderstatus || '",null]' AS marks,
       CASE (a.o_custkey + a.i) % 3 WHEN 1 THEN 'one' WHEN 2 THEN 'list'
            ELSE CASE WHEN a.o_orderkey % 5 > 1 THEN 'empty' ELSE 'none' END END AS shape,
       CASE WHEN f.j IS NOT NULL THEN f.j WHEN a.o_orderkey % 5 > 1 THEN 0 END AS pos,
       CASE WHEN f.j IS NOT NULL THEN coalesce(f.affiliation, '') END AS affiliation, 'note ' || f.j AS note,
       g.name AS institution_name,
       CASE WHEN g.name IS NOT NULL THEN g.country_code ELSE p.country_code END AS country_code,
       CASE WHEN g.name IS NOT NULL THEN g.country_name ELSE p.name END AS country_name
FROM author a LEFT JOIN affiliation f ON f.doc_id = a.doc_id AND f.i = a.i
LEFT JOIN best_org g ON f.affiliation = g.affiliation LEFT JOIN best_place p ON f.affiliation = p.affiliation""",
    "damaged_inputs": _DAMAGED,
    "stream_damaged": _DAMAGED,
    "table_store": _with(
        _ORDERS, _DATES,
        "\nkept AS (SELECT DISTINCT o.* FROM o JOIN dated USING (doc_id) WHERE year >= 2000)",
        _AUTHORS.replace("FROM o,", "FROM kept o,"), _AFFILIATIONS,
        _HEADINGS.replace("FROM o,", "FROM kept o,"), _BANKS.replace("FROM o,", "FROM kept o,"),
    ) + """
SELECT 'pub_pmid_list' AS name, count(*) AS n FROM kept
UNION ALL SELECT 'pub_pubdate', count(*) FROM dated WHERE year >= 2000
UNION ALL SELECT 'pub_article_title', count(*) FROM kept
UNION ALL SELECT 'pub_author', count(*) FROM author
UNION ALL SELECT 'pub_affiliation', count(*) FROM affiliation WHERE affiliation IS NOT NULL
UNION ALL SELECT 'pub_author_affiliation', count(*) FROM affiliation WHERE affiliation IS NOT NULL
UNION ALL SELECT 'pub_journal', count(*) FROM kept
UNION ALL SELECT 'pub_mesh_heading', count(*) FROM heading LEFT JOIN qualifier USING (doc_id, k)
UNION ALL SELECT 'pub_reference', CAST(sum(o_orderkey % 3) AS BIGINT) FROM kept
UNION ALL SELECT 'pub_databank_list', count(*) FROM accession
UNION ALL SELECT 'pub_keyword_list', CAST(sum(len(string_split(o_orderpriority, '-'))) AS BIGINT)
          FROM kept""",
    "mesh_terms": "SELECT 'D' || p_partkey AS descriptor_ui, p_name AS descriptor_name FROM part",
    "mesh_trees": """
SELECT 'D' || p_partkey AS descriptor_ui, t AS mesh_tree, substr(t, 1, 1) AS mesh_category
FROM part, unnest([p_type || '.' || p_partkey, p_brand || '.' || p_size]) AS u(t)
WHERE p_partkey % 5 <> 0""",
    "xml_articles": """
SELECT CAST(l_orderkey AS INTEGER) AS pmid,
  'Line <' || l_linenumber || '> of ' || l_returnflag AS title, 'S' || l_suppkey AS last_name,
  'Y' AS valid_yn, 'Part ' || l_partkey AS affiliation FROM lineitem""",
    "xml_trees": """
SELECT CAST(o_orderkey AS INTEGER) AS pmid, o_orderpriority AS first_keyword,
       o_orderstatus AS second_keyword FROM orders""",
    "record_positions": """
SELECT count(*) AS records, CAST(0 AS BIGINT) AS unsound_files FROM lineitem""",
    "json_paths": """
SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS INTEGER), 0) AS k,
  CASE WHEN json_extract_string(props, '$.k') IS NULL THEN 0 ELSE 1 END AS members, 0 AS missing
FROM events""",
    "json_roundtrip": _with(*_BASE) + """
SELECT doc_id, i AS author_pos, j AS affiliation_pos, affiliation,
  CASE WHEN known THEN 'Known' END AS institution_name, CASE WHEN known THEN 'KN' END AS country_code,
  CASE WHEN known THEN 'Knownland' END AS country_name FROM affiliation""",
    "quarantine": """
SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'malformed' ELSE 'stored' END AS status, count(*) AS n
FROM orders GROUP BY 1""",
    "stream_ingest": """
SELECT CAST(o_orderkey AS INTEGER) AS pmid, o_orderpriority AS keyword FROM orders
UNION ALL SELECT CAST(o_orderkey AS INTEGER), o_orderstatus FROM orders""",
    "md5_verify": _STATUS,
    "run_totals": f"SELECT status, count(*) AS n FROM ({_STATUS}) GROUP BY status",
    "gzip_verify": "SELECT CAST(doc_id AS VARCHAR) AS name, doc_id % 3 <> 0 AS ok FROM documents",
    "new_files": f"""
SELECT 'doc_' || doc_id || '.gz' AS name FROM documents
WHERE doc_id % 4 <> 3 AND 'doc_' || doc_id || '.gz' NOT IN (
  SELECT name FROM ({_STATUS}) WHERE status = 'ok')""",
}

ORACLE["review_sheet"] = ORACLE["dictionary_curate"]
ORACLE["batch_folders"] = f"""
SELECT batch, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high
FROM ({ORACLE["batch_number"]}) GROUP BY batch"""

# Registry countries only; affiliations without text bring nothing.
ORACLE["stream_enriched"] = _with(*_BASE, _ORGANISATIONS.replace(
    "SELECT n_name AS name, 'C' || n_nationkey AS country_code FROM nation",
    "SELECT DISTINCT country_name AS name, country_code FROM plain"), _MATCHES, _DATES, """
found AS (
  SELECT a.doc_id, a.pmid, a.affiliation, g.name AS institution,
         CASE WHEN g.name IS NOT NULL THEN g.country_code ELSE p.country_code END AS code
  FROM affiliation a LEFT JOIN best_org g ON a.affiliation = g.affiliation
  LEFT JOIN best_place p ON a.affiliation = p.affiliation),
kept AS (
  SELECT doc_id FROM found GROUP BY doc_id
  HAVING bool_or(coalesce(trim(code), '') <> '') AND bool_or(coalesce(trim(institution), '') <> '')
  INTERSECT SELECT doc_id FROM dated WHERE year >= 2000)""") + """
SELECT pmid, affiliation, coalesce(code, '') AS affiliation_country, coalesce(institution, '') AS affiliation_organization
FROM found SEMI JOIN kept USING (doc_id) WHERE affiliation IS NOT NULL"""
