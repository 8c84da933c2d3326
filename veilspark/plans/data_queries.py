"""Queries of the general data problems 1 and 2, with their SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.operators import failed_rows, flatten


def _loaded(spark: SparkSession, d: str) -> failed_rows.Loaded:
    return failed_rows.load(spark.read.parquet(f"{d}/intake_lines.parquet"), "line_no", "raw_record")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _loaded(spark, d).failed.select("line_no", "reason")


def p1_valid(spark: SparkSession, d: str) -> DataFrame:
    return _loaded(spark, d).valid


def p1_rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return _loaded(spark, d).errors.groupBy("column", "rule_name").agg(F.count("*").alias("n_errors"))


def _flat(spark: SparkSession, d: str) -> flatten.Flat:
    return flatten.flatten(spark.read.parquet(f"{d}/claim_docs.parquet"))


def p2_method(spark: SparkSession, d: str) -> DataFrame:
    """Every row of every child table: which array it is of, its key, its parent's key and its ordinal."""
    return _flat(spark, d).elements


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d).entries.select("claim_no", "case_id", "page_pos", "leaf_path")


def p2_cases(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d).cases.select("claim_no", "case_id", "is_valid")


def p2_pages(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d).pages.select("claim_no", "page_pos", "page_key", "has_data")


def p2_elements(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d).elements


def p2_schema(spark: SparkSession, d: str) -> DataFrame:
    return flatten.merged_schema(_flat(spark, d).entries)


QUERIES = {f.__name__: f for f in (p1_found, p1_valid, p1_rule_counts, p2_method, p2_found, p2_cases, p2_pages, p2_elements, p2_schema)}

_FIELD = '(?:"(?:[^"]|"")*"|[^",\\r\\n]*)'
_WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_SEVEN = "^" + ",".join([f"({_FIELD})"] * 7) + "$"
_EACH = ", ".join(f"regexp_extract(rec, '{_SEVEN}', {i})" for i in range(1, 8))
_RECORDS = rf"""
  recs AS (SELECT line_no, regexp_replace(raw_record, '[\r\n]+$', '') AS rec FROM intake_lines
           WHERE raw_record IS NOT NULL AND NOT regexp_full_match(raw_record, '{_WS}*')),
  seven AS (SELECT line_no, rec, regexp_full_match(rec, '{_FIELD}(?:,{_FIELD})*') AS ok,
                   regexp_full_match(rec, '{_FIELD}(?:,{_FIELD}){{6}}') AS is7,
                   [{_EACH}] AS raws
            FROM recs),
  vals AS (SELECT line_no, ok, is7, [CASE WHEN starts_with(x, '"') THEN replace(x[2:-2], '""', '"') ELSE x END FOR x IN raws] AS v FROM seven),
  judged AS (SELECT *, NOT regexp_full_match(v[1], '{_WS}*P[0-9]{{6,12}}{_WS}*') AS bad_id,
                    regexp_matches(v[7], '[\x{{FFFD}}\x{{0}}-\x{{8}}\x0B\x0C\x0E-\x1F\x{{7F}}-\x{{9F}}]') AS bad_note FROM vals)
"""
ORACLE = {
    "p1_found": f"WITH {_RECORDS} SELECT line_no, CASE WHEN NOT ok THEN 'quoting' WHEN NOT is7 THEN 'column_count' ELSE 'bad_value' END AS reason FROM judged WHERE NOT ok OR NOT is7 OR bad_id OR bad_note",
    "p1_valid": f"WITH {_RECORDS} SELECT line_no, " + ", ".join(f'v[{i + 1}] AS "{c}"' for i, c in enumerate(failed_rows.INTAKE_COLUMNS)) + " FROM judged WHERE ok AND is7 AND NOT bad_id AND NOT bad_note",
    "p1_rule_counts": f"""WITH {_RECORDS}, e AS (
        SELECT '#record' AS "column", 'quoting' AS rule_name FROM judged WHERE NOT ok
        UNION ALL SELECT '#record', 'column_count' FROM judged WHERE ok AND NOT is7
        UNION ALL SELECT 'PatientId', 'patient_id_form' FROM judged WHERE ok AND is7 AND bad_id
        UNION ALL SELECT 'Note', 'note_characters' FROM judged WHERE ok AND is7 AND bad_note)
      SELECT "column", rule_name, count(*) AS n_errors FROM e GROUP BY ALL""",
}
_DOCS = "docs AS (SELECT claim_no, CASE WHEN json_valid(doc_json) THEN doc_json::JSON END AS doc FROM claim_docs)"
_PAGES = f"""{_DOCS},
  cases AS (SELECT claim_no, doc, coalesce(doc->>'$.case_id', '') AS case_id FROM docs),
  lists AS (SELECT claim_no, case_id, CASE json_type(doc, '$.pages') WHEN 'ARRAY' THEN CAST(doc->'$.pages' AS JSON[]) WHEN 'OBJECT' THEN [doc->'$.pages'] END AS pages FROM cases),
  pages AS (SELECT claim_no, case_id, (unnest(range(len(pages))))::INTEGER AS page_pos, unnest(pages) AS page FROM lists WHERE pages IS NOT NULL),
  payload AS (SELECT claim_no, case_id, page_pos, CASE json_type(page, '$.extracted_data') WHEN 'OBJECT' THEN page->'$.extracted_data' WHEN 'ARRAY' THEN page->'$.extracted_data'
        WHEN 'VARCHAR' THEN CASE WHEN json_valid(page->>'$.extracted_data') AND json_type(page->>'$.extracted_data') = 'OBJECT' THEN (page->>'$.extracted_data')::JSON END END AS data FROM pages)"""
_ENTRIES = f"""WITH RECURSIVE {_PAGES},
  nodes AS (
    SELECT claim_no, case_id, page_pos, CAST(NULL AS VARCHAR) AS path, data AS v, '' AS up, '' AS inner_up, false AS is_element, CAST(NULL AS INTEGER) AS ordinal, '' AS of_array FROM payload WHERE data IS NOT NULL
    UNION ALL
    SELECT claim_no, case_id, page_pos, p, v, up, CASE WHEN obj THEN up ELSE p END, NOT obj, CASE WHEN NOT obj THEN CAST(key AS INTEGER) END, coalesce(path, '') FROM (
      SELECT claim_no, case_id, page_pos, path, CASE WHEN k.obj THEN CASE WHEN path IS NULL THEN k.key ELSE path || '.' || k.key END ELSE coalesce(path, '') || '[' || k.key || ']' END AS p, k.v AS v, inner_up AS up, k.obj AS obj, k.key AS key
      FROM (SELECT claim_no, case_id, page_pos, path, inner_up, unnest(CASE json_type(v)
            WHEN 'OBJECT' THEN list_transform(map_entries(CAST(v AS MAP(VARCHAR, JSON))), lambda e: {{'obj': true, 'key': e.key, 'v': e.value}})
            ELSE list_transform(CAST(v AS JSON[]), lambda x, i: {{'obj': false, 'key': CAST(i - 1 AS VARCHAR), 'v': x}}) END) AS k
          FROM nodes WHERE json_type(v) IN ('OBJECT', 'ARRAY'))))
  , leaves AS (SELECT * FROM nodes WHERE v IS NOT NULL AND json_type(v) NOT IN ('OBJECT', 'ARRAY', 'NULL'))"""
_ELEMENTS = rf"""{_ENTRIES} SELECT claim_no, claim_no || '/' || page_pos AS page_key, claim_no || '/' || page_pos || '#' || path AS element_key, claim_no || '/' || page_pos || '#' || up AS parent_key,
  ordinal, regexp_replace(of_array, '\[\d+\]', '[]', 'g') AS child_table FROM nodes WHERE is_element"""
ORACLE |= {
    "p2_found": f"{_ENTRIES} SELECT claim_no, case_id, page_pos, path AS leaf_path FROM leaves",
    "p2_cases": f"WITH {_DOCS} SELECT claim_no, coalesce(doc->>'$.case_id', '') AS case_id, doc IS NOT NULL AS is_valid FROM docs",
    "p2_pages": f"WITH {_PAGES} SELECT claim_no, page_pos, claim_no || '/' || page_pos AS page_key, data IS NOT NULL AS has_data FROM payload",
    "p2_method": _ELEMENTS,
    "p2_elements": _ELEMENTS,
    "p2_schema": rf"""{_ENTRIES}, kinds AS (SELECT claim_no, regexp_replace(path, '\[\d+\]', '[]', 'g') AS path, CASE json_type(v) WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'DOUBLE' THEN CASE WHEN regexp_matches(v::VARCHAR, '[eE]') THEN 'DOUBLE' ELSE 'DECIMAL' END ELSE json_type(v) END AS kind FROM leaves)
      SELECT path, kind, count(*) AS entries, count(DISTINCT claim_no) AS documents FROM kinds GROUP BY ALL""",
}
