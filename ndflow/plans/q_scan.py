"""Registered queries for the scan family."""

from __future__ import annotations

from pyspark.sql import functions as F

from ndflow.plans import fixtures as FX
from ndflow.plans.registry import register, with_ctes
from ndflow.plans.seq import ID_BUCKET, grouped_running_sums
from ndflow.sources import ndjson as N

# DuckDB twin of ``ndjson.parse_lines``.
SQL_PARSED = """
parsed AS (
  SELECT file_name, line_no, value, doc_id,
    CASE WHEN length(value) = 0 THEN 'blank'
         WHEN NOT json_valid(value) THEN 'invalid_json'
         WHEN json_type(value) <> 'OBJECT' THEN 'not_object'
         WHEN json_type(value, '$.resourceType') IS NULL THEN 'missing_resource_type'
         WHEN json_type(value, '$.resourceType') <> 'VARCHAR' THEN 'bad_resource_type'
         WHEN json_type(value, '$.id') IS NOT NULL AND json_type(value, '$.id') <> 'VARCHAR' THEN 'bad_id'
         ELSE 'ok' END AS status,
    CASE WHEN json_valid(value) AND json_type(value) = 'OBJECT' AND json_type(value, '$.resourceType') = 'VARCHAR'
         THEN json_extract_string(value, '$.resourceType') END AS resource_type,
    CASE WHEN NOT json_valid(value) OR json_type(value) <> 'OBJECT' THEN NULL
         WHEN json_type(value, '$.id') IS NULL THEN ''
         WHEN json_type(value, '$.id') = 'VARCHAR' THEN json_extract_string(value, '$.id') END AS resource_id,
    trim(value, ' ' || chr(9) || chr(13) || chr(10)) = '' AS blank_trimmed
  FROM fx_lines),
parsed2 AS (
  SELECT *, status IN ('ok', 'missing_resource_type', 'bad_resource_type', 'bad_id') AS parsed FROM parsed)"""


def _parsed(spark, sf_dir, numbered=True):
    return N.parse_lines(FX.document_lines(spark, sf_dir, numbered))


@register("ndjson_scan", sql=with_ctes(FX.SQL_DOCUMENT_LINES, SQL_PARSED, select="""
SELECT file_name, line_no, status, resource_type, resource_id FROM parsed2"""))
def q_ndjson_scan(spark, sf_dir):
    return _parsed(spark, sf_dir).select("file_name", "line_no", "status", "resource_type", "resource_id")


@register("ndjson_line_numbers", sql=with_ctes(FX.SQL_DOCUMENT_LINES, SQL_PARSED, select="""
SELECT file_name, line_no,
       CAST(count(*) OVER (PARTITION BY file_name ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS resource_no
FROM parsed2 WHERE NOT blank_trimmed"""))
def q_ndjson_line_numbers(spark, sf_dir):
    p = _parsed(spark, sf_dir).filter(~F.col("blank_trimmed")).select(
        "file_name", "line_no", F.lit(1).cast("long").alias("_one"))
    out = grouped_running_sums(p, ["file_name"], ["line_no"], {"resource_no": "_one"},
                               bucket=F.floor(F.col("line_no") / F.lit(ID_BUCKET)))
    return out.select("file_name", "line_no", "resource_no")


_SQL_STATUS_MSG = """CASE status WHEN 'invalid_json' THEN 'failed to parse JSON'
  WHEN 'not_object' THEN 'failed to parse JSON: not an object'
  WHEN 'missing_resource_type' THEN 'missing resourceType field'
  WHEN 'bad_resource_type' THEN 'resourceType is not a string'
  WHEN 'bad_id' THEN 'id is not a string' END"""


@register("malformed_lines", sql=with_ctes(FX.SQL_DOCUMENT_LINES, SQL_PARSED, select=f"""
SELECT file_name, line_no, status AS error_kind, {_SQL_STATUS_MSG} AS error, value
FROM parsed2 WHERE status NOT IN ('ok', 'blank')"""))
def q_malformed_lines(spark, sf_dir):
    return N.quarantine(_parsed(spark, sf_dir))


@register("resource_header", sql=with_ctes(FX.SQL_DOCUMENT_LINES, SQL_PARSED, select=f"""
SELECT file_name, line_no, resource_type, resource_id,
       CASE WHEN status IN ('missing_resource_type', 'bad_resource_type', 'bad_id') THEN {_SQL_STATUS_MSG} END AS header_error
FROM parsed2 WHERE parsed"""))
def q_resource_header(spark, sf_dir):
    p = _parsed(spark, sf_dir).filter(F.col("parsed"))
    err = F.when(F.col("status").isin("missing_resource_type", "bad_resource_type", "bad_id"),
                 N.status_message(F.col("status")))
    return p.select("file_name", "line_no", "resource_type", "resource_id", err.alias("header_error"))


@register("valid_resources", sql=with_ctes(FX.SQL_DOCUMENT_LINES, SQL_PARSED, select="""
SELECT file_name, count(*) FILTER (WHERE resource_type IS NOT NULL) AS n_valid,
       count(*) FILTER (WHERE resource_type IS NULL) AS n_invalid
FROM parsed2 WHERE parsed GROUP BY file_name"""))
def q_valid_resources(spark, sf_dir):
    p = _parsed(spark, sf_dir, numbered=False).filter(F.col("parsed"))
    return p.groupBy("file_name").agg(F.count_if(F.col("resource_type").isNotNull()).alias("n_valid"),
                                      F.count_if(F.col("resource_type").isNull()).alias("n_invalid"))


@register("count_per_file", sql=with_ctes(FX.SQL_DOCUMENT_LINES, SQL_PARSED, select="""
SELECT g.*, (SELECT count(*) FROM parsed2 p WHERE p.file_name = g.file_name AND p.parsed
             AND (g.first_error_line IS NULL OR p.line_no < g.first_error_line)) AS n_parsed_before_error
FROM (SELECT file_name, count(*) AS n_lines, count(*) FILTER (WHERE NOT blank_trimmed) AS n_nonblank,
             count(*) FILTER (WHERE parsed) AS n_parsed,
             min(CASE WHEN NOT parsed AND status <> 'blank' THEN line_no END) AS first_error_line,
             count(*) FILTER (WHERE status = 'ok') AS n_valid
      FROM parsed2 GROUP BY file_name) g"""))
def q_count_per_file(spark, sf_dir):
    return N.file_counts(_parsed(spark, sf_dir))


@register("group_by_type", sql=with_ctes(FX.SQL_DOCUMENT_LINES, SQL_PARSED, select="""
SELECT resource_type, count(*) AS n_resources, CAST(sum(strlen(value)) AS BIGINT) AS bytes
FROM parsed2 WHERE status = 'ok' GROUP BY resource_type"""))
def q_group_by_type(spark, sf_dir):
    p = _parsed(spark, sf_dir, numbered=False).filter(F.col("status") == "ok")
    return p.groupBy("resource_type").agg(F.count(F.lit(1)).alias("n_resources"),
                                          F.sum(F.octet_length("value")).cast("long").alias("bytes"))


@register("import_totals", sql=with_ctes(FX.SQL_DOCUMENT_LINES, select="""
SELECT count(DISTINCT file_name) AS n_files, CAST(sum(strlen(value) + 1) AS BIGINT) AS total_bytes,
       count(*) AS n_lines FROM fx_lines"""))
def q_import_totals(spark, sf_dir):
    lines = FX.document_lines(spark, sf_dir, numbered=False)
    return lines.agg(F.count_distinct("file_name").alias("n_files"),
                     F.sum(F.octet_length("value") + 1).cast("long").alias("total_bytes"),
                     F.count(F.lit(1)).alias("n_lines"))


@register("import_manifest", sql=with_ctes(FX.SQL_DOCUMENT_LINES, SQL_PARSED, select="""
SELECT file_name, 'import/' || file_name AS file_path,
       coalesce(nullif(regexp_extract(regexp_replace(file_name, '\\.ndjson$', ''), '^[_.\\-]*([^_.\\-]+)', 1), ''), 'Unknown') AS resource_type,
       CAST(sum(strlen(value) + 1) AS BIGINT) AS file_size, 'local_import' AS source_step,
       CAST(count(*) FILTER (WHERE NOT blank_trimmed) AS INTEGER) AS line_count
FROM parsed2 GROUP BY file_name"""))
def q_import_manifest(spark, sf_dir):
    return N.manifest(_parsed(spark, sf_dir, numbered=False))
