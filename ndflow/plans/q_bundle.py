"""Registered queries for the bundle operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ndflow.functions.jsonfn import json_size, rfc3339_normalized
from ndflow.operators import bundle as B
from ndflow.plans import fixtures as FX
from ndflow.plans.registry import (register, sql_header, sql_json_size, sql_rfc3339, sql_splice,
                                   with_ctes)
from ndflow.sources.ndjson import parse_lines

T1 = FX.FX_BUNDLE_THRESHOLD
T2 = FX.FX_ORDERS_THRESHOLD
OH = B.BUNDLE_OVERHEAD


# ---------------------------------------------------------------------------
# Shared SQL: sizes, split decision and greedy packing by recursive CTE
# ---------------------------------------------------------------------------

def _sql_split(threshold: int) -> str:
    return f"""
entry_sz AS (
  SELECT bundle_id, pos, entry,
         CAST(row_number() OVER (PARTITION BY bundle_id ORDER BY pos, entry) - 1 AS INTEGER) AS idx,
         {sql_json_size('entry')} AS size
  FROM fx_entries),
bhead AS (
  SELECT bundle_id, bundle_type, timestamp,
         {sql_header('bundle_id', 'bundle_type', 'timestamp')} AS header
  FROM fx_bundles),
bsplit AS (
  SELECT h.bundle_id, h.bundle_type, h.timestamp,
         CAST({sql_json_size('h.header')} + coalesce(s.tot, 0) + greatest(coalesce(s.n, 0) - 1, 0) AS BIGINT) AS original_size,
         coalesce(s.n, 0) AS n, s.first_over
  FROM bhead h LEFT JOIN (
     SELECT bundle_id, sum(size) AS tot, count(*) AS n,
            min(CASE WHEN size + {OH} > {threshold} THEN idx END) AS first_over
     FROM entry_sz GROUP BY bundle_id) s ON h.bundle_id = s.bundle_id),
bstatus AS (
  SELECT *, original_size > {threshold} AS should_split,
         CASE WHEN original_size > {threshold} AND first_over IS NOT NULL THEN 'oversized' ELSE 'ok' END AS status
  FROM bsplit),
pk AS (
  SELECT e.bundle_id, e.idx, e.size AS cur, 0 AS chunk
  FROM entry_sz e JOIN bstatus b ON e.bundle_id = b.bundle_id
  WHERE e.idx = 0 AND b.status = 'ok'
  UNION ALL
  SELECT e.bundle_id, e.idx,
         CASE WHEN b.should_split AND p.cur + e.size + {OH} > {threshold} THEN e.size ELSE p.cur + e.size END,
         p.chunk + CASE WHEN b.should_split AND p.cur + e.size + {OH} > {threshold} THEN 1 ELSE 0 END
  FROM pk p JOIN entry_sz e ON e.bundle_id = p.bundle_id AND e.idx = p.idx + 1
  JOIN bstatus b ON b.bundle_id = e.bundle_id),
packed AS (
  SELECT p.bundle_id, p.idx, p.chunk, e.size, e.entry FROM pk p JOIN entry_sz e USING (bundle_id, idx)),
chunks AS (
  SELECT bundle_id, chunk AS chunk_index, CAST(count(*) AS INTEGER) AS n_entries,
         CAST(min(idx) AS INTEGER) AS first_index, sum(size) AS tot,
         string_agg(entry, ',' ORDER BY idx) AS joined
  FROM packed GROUP BY bundle_id, chunk
  UNION ALL SELECT bundle_id, 0, 0, 0, 0, '' FROM bstatus WHERE n = 0 AND status = 'ok'),
chunk_full AS (
  SELECT c.*, b.bundle_type, b.timestamp, b.original_size,
         CAST(max(c.chunk_index) OVER (PARTITION BY c.bundle_id) + 1 AS INTEGER) AS total_chunks,
         c.bundle_id || '-chunk-' || c.chunk_index AS chunk_id
  FROM chunks c JOIN bstatus b ON c.bundle_id = b.bundle_id),
chunk_est AS (
  SELECT *, {sql_header('chunk_id', 'bundle_type',
                        "coalesce(" + sql_rfc3339('timestamp') + ", '0001-01-01T00:00:00Z')",
                        'n_entries')} AS est_header
  FROM chunk_full)"""


def _sql_est() -> str:
    return f"CAST({sql_json_size('est_header')} + tot + greatest(n_entries - 1, 0) AS BIGINT)"


# ---------------------------------------------------------------------------

@register("json_size", sql=with_ctes(FX.SQL_CONVERSATION_ENTRIES, select=f"""
SELECT bundle_id, pos, {sql_json_size('entry')} AS size FROM fx_entries"""))
def q_json_size(spark, sf_dir):
    e = FX.conversation_entries(spark, sf_dir)
    return e.select("bundle_id", "pos", json_size(F.col("entry")).alias("size"))


@register("should_split", sql=with_ctes(FX.SQL_CONVERSATION_ENTRIES, _sql_split(T1), select="""
SELECT bundle_id, original_size, should_split FROM bstatus"""))
def q_should_split(spark, sf_dir):
    b = FX.conversation_bundles(spark, sf_dir)
    s = b.select("bundle_id", B.bundle_size().alias("original_size"))
    return s.withColumn("should_split", B.should_split(F.col("original_size"), T1))


@register("split_bundles", sql=with_ctes(FX.SQL_CONVERSATION_ENTRIES, _sql_split(T1), select="""
SELECT b.bundle_id, b.status, b.original_size,
       (b.status = 'ok' AND b.should_split) AS was_split,
       CAST(CASE WHEN b.status = 'ok' THEN coalesce(c.total_chunks, 0) ELSE 0 END AS INTEGER) AS total_chunks,
       CASE WHEN b.status = 'oversized' THEN coalesce(json_extract_string(e.entry, '$.resource.resourceType'), 'Unknown') END AS error_resource_type,
       CASE WHEN b.status = 'oversized' THEN coalesce(json_extract_string(e.entry, '$.resource.id'), 'unknown') END AS error_resource_id,
       CASE WHEN b.status = 'oversized' THEN e.size END AS error_size
FROM bstatus b
LEFT JOIN (SELECT DISTINCT bundle_id, total_chunks FROM chunk_full) c ON b.bundle_id = c.bundle_id
LEFT JOIN entry_sz e ON e.bundle_id = b.bundle_id AND e.idx = b.first_over AND b.status = 'oversized'"""))
def q_split_bundles(spark, sf_dir):
    s = B.split_bundles(FX.conversation_bundles(spark, sf_dir), T1)
    return s.select("bundle_id", "status", "original_size", "was_split", "total_chunks",
                    "error_resource_type", "error_resource_id", "error_size")


@register("pack_greedy", sql=with_ctes(FX.SQL_CONVERSATION_ENTRIES, _sql_split(T1), select="""
SELECT bundle_id, 'ok' AS status, idx AS entry_index, chunk AS chunk_index FROM packed
UNION ALL SELECT bundle_id, status, NULL, NULL FROM bstatus WHERE status <> 'ok'"""))
def q_pack_greedy(spark, sf_dir):
    ch = B.chunk_rows(B.split_bundles(FX.conversation_bundles(spark, sf_dir), T1), keep_failed=True)
    return ch.select("bundle_id", "status", "chunk_index",
                     F.explode_outer(F.sequence(F.col("first_index"), F.col("first_index") + F.col("n_entries") - 1))
                     .alias("entry_index"))


@register("chunk_rows", sql=with_ctes(FX.SQL_CONVERSATION_ENTRIES, _sql_split(T1), select=f"""
SELECT chunk_id, bundle_id, 'ok' AS status, chunk_index, total_chunks, n_entries, first_index, {_sql_est()} AS estimated_size
FROM chunk_est UNION ALL SELECT NULL, bundle_id, status, NULL, NULL, NULL, NULL, NULL FROM bstatus WHERE status <> 'ok'"""))
def q_chunk_rows(spark, sf_dir):
    ch = B.chunk_rows(B.split_bundles(FX.conversation_bundles(spark, sf_dir), T1), keep_failed=True)
    has = F.col("chunk_index").isNotNull()
    return ch.select("chunk_id", "bundle_id", "status", "chunk_index", F.when(has, F.col("total_chunks")).alias("total_chunks"), "n_entries",
                     "first_index", "estimated_size")


@register("chunk_stats", sql=with_ctes(FX.SQL_CONVERSATION_ENTRIES, _sql_split(T1), select=f"""
SELECT b.bundle_id, b.original_size, coalesce(original_entries, 0) AS original_entries, coalesce(chunks_created, 0) AS chunks_created,
       coalesce(smallest_chunk_size, 0) AS smallest_chunk_size, coalesce(largest_chunk_size, 0) AS largest_chunk_size,
       coalesce(average_chunk_size, 0) AS average_chunk_size
FROM bstatus b LEFT JOIN (
  SELECT bundle_id, CAST(sum(n_entries) AS BIGINT) AS original_entries,
         count(*) AS chunks_created, min(est) AS smallest_chunk_size, max(est) AS largest_chunk_size,
         CAST(sum(est) // count(*) AS BIGINT) AS average_chunk_size
  FROM (SELECT *, {_sql_est()} AS est FROM chunk_est) GROUP BY bundle_id) s ON s.bundle_id = b.bundle_id"""))
def q_chunk_stats(spark, sf_dir):
    return B.chunk_stats(B.chunk_rows(B.split_bundles(FX.conversation_bundles(spark, sf_dir), T1), keep_failed=True))


def _orders_chunks(spark, sf_dir):
    return B.chunk_rows(B.split_bundles(FX.order_bundles(spark, sf_dir), T2))


@register("chunk_documents", sql=with_ctes(FX.SQL_ORDER_ENTRIES, _sql_split(T2), select=f"""
SELECT chunk_id, {sql_splice(sql_header('chunk_id', 'bundle_type', sql_rfc3339('timestamp'),
                                        "CASE WHEN bundle_type IN ('searchset', 'history') THEN n_entries END"),
                             'joined')} AS document
FROM chunk_full"""))
def q_chunk_documents(spark, sf_dir):
    ch = _orders_chunks(spark, sf_dir)
    return ch.select("chunk_id", B.chunk_document(ch).alias("document"))


@register("reassemble", sql=with_ctes(FX.SQL_ORDER_ENTRIES, _sql_split(T2), select=f"""
SELECT r.bundle_id, r.entry_count, r.was_reassembled, r.document,
       r.document = {sql_splice(sql_header('f.bundle_id', 'f.bundle_type', 'f.timestamp'),
                                "array_to_string(f.entries, ',')")} AS roundtrip_equal
FROM (
  SELECT bundle_id, CAST(sum(n_entries) AS INTEGER) AS entry_count, count(*) > 1 AS was_reassembled,
         {sql_splice(sql_header('bundle_id', 'any_value(bundle_type)', sql_rfc3339('any_value(timestamp)'),
                                "CASE WHEN any_value(bundle_type) IN ('searchset', 'history') THEN sum(n_entries) END"),
                     "string_agg(joined, ',' ORDER BY chunk_index)")} AS document
  FROM chunk_full GROUP BY bundle_id) r
JOIN fx_bundles f ON f.bundle_id = r.bundle_id"""))
def q_reassemble(spark, sf_dir):
    # the original document travels as its md5 through split and reassembly
    b = FX.order_bundles(spark, sf_dir)
    b = b.select("*", F.md5(B.bundle_document(b)).alias("_orig_md5"))
    r = B.reassemble(B.chunk_rows(B.split_bundles(b, T2)), keep_columns=("_orig_md5",))
    return r.select("bundle_id", "entry_count", "was_reassembled", "document",
                    (F.md5("document") == F.col("_orig_md5")).alias("roundtrip_equal"))


@register("split_orders", sql=with_ctes(FX.SQL_ORDER_ENTRIES, _sql_split(T2), select="""
SELECT b.status, (b.status = 'ok' AND b.should_split) AS was_split,
       CAST(CASE WHEN b.status = 'ok' THEN coalesce(c.total_chunks, 0) ELSE 0 END AS INTEGER) AS total_chunks,
       count(*) AS n_bundles, CAST(sum(b.n) AS BIGINT) AS n_entries, CAST(sum(b.original_size) AS BIGINT) AS bytes
FROM bstatus b LEFT JOIN (SELECT DISTINCT bundle_id, total_chunks FROM chunk_full) c ON b.bundle_id = c.bundle_id
GROUP BY ALL"""))
def q_split_orders(spark, sf_dir):
    s = B.split_bundles(FX.order_bundles(spark, sf_dir), T2)
    return (s.groupBy("status", "was_split", "total_chunks")
            .agg(F.count(F.lit(1)).alias("n_bundles"), F.sum(F.size("entries")).cast("long").alias("n_entries"),
                 F.sum("original_size").cast("long").alias("bytes")))


@register("bundle_metadata", sql=with_ctes(FX.SQL_ORDER_ENTRIES, select=f"""
SELECT bundle_id, bundle_type, {sql_rfc3339('timestamp')} AS timestamp, CAST(len(entries) AS INTEGER) AS n_entries
FROM fx_bundles"""))
def q_bundle_metadata(spark, sf_dir):
    b = FX.order_bundles(spark, sf_dir)
    return b.select("bundle_id", "bundle_type", rfc3339_normalized(F.col("timestamp")).alias("timestamp"),
                    F.size("entries").alias("n_entries"))


def _bundle_doc_lines(spark, sf_dir):
    """Conversation bundles written as NDJSON documents, some damaged.

    Fixed values: by conv_id mod 20: 3 -> bundle id removed, 5 -> numeric
    type, 7 -> a string entry in front, 9 -> entry is an object.
    """
    b = FX.conversation_bundles(spark, sf_dir)
    doc = B.bundle_document(b)
    m = F.col("conv_id") % 20
    dmg = (F.when(m == 3, F.regexp_replace("doc", '"id":"[^"]*","resourceType":"Bundle"', '"resourceType":"Bundle"'))
           .when(m == 5, F.regexp_replace("doc", '"type":"collection"', '"type":7'))
           .when(m == 7, F.regexp_replace("doc", r'^\{"entry":\[', '{"entry":["x",'))
           .when(m == 9, F.regexp_replace("doc", r'^\{"entry":\[', '{"entry":{},"x":['))
           .otherwise(F.col("doc")))
    return (b.select("bundle_id", F.col("bundle_id").cast("long").alias("conv_id"), doc.alias("doc"))
            .select("bundle_id", dmg.alias("value")))


_SQL_BUNDLE_DOC_LINES = f"""
bdoc AS (
  SELECT bundle_id, CAST(bundle_id AS BIGINT) AS conv_id,
         {sql_splice(sql_header('bundle_id', 'bundle_type', 'timestamp'), "array_to_string(entries, ',')")} AS doc
  FROM fx_bundles),
blines AS (
  SELECT bundle_id, CASE conv_id % 20
     WHEN 3 THEN regexp_replace(doc, '"id":"[^"]*","resourceType":"Bundle"', '"resourceType":"Bundle"')
     WHEN 5 THEN regexp_replace(doc, '"type":"collection"', '"type":7')
     WHEN 7 THEN regexp_replace(doc, '^\\{{"entry":\\[', '{{"entry":["x",')
     WHEN 9 THEN regexp_replace(doc, '^\\{{"entry":\\[', '{{"entry":{{}},"x":[')
     ELSE doc END AS value
  FROM bdoc)"""


@register("bundle_structure", sql=with_ctes(FX.SQL_CONVERSATION_ENTRIES, _SQL_BUNDLE_DOC_LINES, select="""
SELECT bundle_id,
  CASE WHEN NOT json_valid(value) THEN 'invalid JSON'
       WHEN coalesce(json_type(value, '$.id'), '') <> 'VARCHAR' THEN 'bundle.id must be present and a string'
       WHEN coalesce(json_type(value, '$.type'), '') <> 'VARCHAR' THEN 'bundle.type must be present and a string'
       WHEN coalesce(json_type(value, '$.entry'), '') <> 'ARRAY' THEN 'bundle.entry must be an array'
       WHEN NOT list_bool_and(list_transform(CAST(json_extract(value, '$.entry') AS JSON[]), lambda x: json_type(x) = 'OBJECT'))
            THEN 'bundle.entry[i] must be an object'
  END AS structure_error
FROM blines"""))
def q_bundle_structure(spark, sf_dir):
    lines = _bundle_doc_lines(spark, sf_dir)
    return lines.select("bundle_id", B.bundle_structure(F.col("value")).alias("structure_error"))


@register("bundle_entries", sql=with_ctes(FX.SQL_CONVERSATION_ENTRIES, _SQL_BUNDLE_DOC_LINES, select="""
SELECT bundle_id, CAST(u.i - 1 AS INTEGER) AS entry_index, CAST(u.e AS VARCHAR) AS entry,
       json_extract_string(u.e, '$.resource.id') AS resource_id
FROM (SELECT bundle_id, CAST(json_extract(value, '$.entry') AS JSON[]) AS arr FROM blines
      WHERE CAST(bundle_id AS BIGINT) % 20 NOT IN (3, 5, 7, 9)) b,
     LATERAL (SELECT unnest(b.arr) AS e, unnest(generate_series(1, len(b.arr))) AS i) u"""))
def q_bundle_entries(spark, sf_dir):
    lines = _bundle_doc_lines(spark, sf_dir)
    ok = lines.filter(B.bundle_structure(F.col("value")).isNull())
    b = B.bundles_from_lines(ok.select(F.col("bundle_id").alias("_line_bundle"), "value"))
    x = b.select("bundle_id", F.posexplode("entries").alias("entry_index", "entry"))
    return x.select("bundle_id", F.col("entry_index").cast("int"), "entry",
                    F.get_json_object("entry", "$.resource.id").alias("resource_id"))


_CONTRACT_CASE = """
  CASE WHEN coalesce(json_extract_string(d, '$.resourceType'), '') <> 'Bundle' THEN 'resourceType must be Bundle'
       WHEN coalesce(json_extract_string(d, '$.type'), '') NOT IN ('document', 'collection') THEN 'type must be document or collection'
       WHEN NOT regexp_matches(coalesce(json_extract_string(d, '$.id'), ''), '^.+-chunk-[0-9]+$') THEN 'id must match <id>-chunk-<n>'
       WHEN coalesce(json_array_length(d, '$.entry'), 0) = 0 THEN 'entry must be non-empty'
       WHEN json_extract(d, '$.total') IS NOT NULL AND CAST(json_extract(d, '$.total') AS BIGINT) <> json_array_length(d, '$.entry') THEN 'total must equal entry count'
       WHEN json_extract(d, '$.timestamp') IS NOT NULL AND NOT regexp_matches(json_extract_string(d, '$.timestamp'), '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}(\\.\\d+)?(Z|[+-]\\d{2}:\\d{2})$') THEN 'timestamp must be RFC 3339'
       WHEN NOT list_bool_and(list_transform(CAST(json_extract(d, '$.entry') AS JSON[]),
              lambda x: coalesce(json_extract_string(x, '$.resource.resourceType'), '') <> '')) THEN 'entry resource needs a resourceType'
  END"""


@register("chunk_contract", sql=with_ctes(FX.SQL_ORDER_ENTRIES, _sql_split(T2), select=f"""
SELECT chunk_id, {_CONTRACT_CASE.replace('d,', 'document,').replace('(d)', '(document)')} AS contract_error
FROM (SELECT chunk_id, {sql_splice(sql_header('chunk_id', 'bundle_type', sql_rfc3339('timestamp'),
                                              "CASE WHEN bundle_type IN ('searchset', 'history') THEN n_entries END"),
                                   'joined')} AS document FROM chunk_full)"""))
def q_chunk_contract(spark, sf_dir):
    from ndflow.operators.quality import chunk_contract_error
    ch = _orders_chunks(spark, sf_dir)
    docs = ch.select("chunk_id", B.chunk_document(ch).alias("document"))
    return docs.select("chunk_id", chunk_contract_error(F.col("document")).alias("contract_error"))


OVERSIZE_T = 10_000


@register("oversized_resources", sql=with_ctes(FX.SQL_DOCUMENT_LINES, select=f"""
SELECT file_name, line_no, coalesce(json_extract_string(value, '$.resourceType'), 'Unknown') AS error_resource_type,
       coalesce(json_extract_string(value, '$.id'), 'unknown') AS error_resource_id,
       {sql_json_size('value')} AS size
FROM fx_lines
WHERE json_valid(value) AND json_type(value) = 'OBJECT' AND coalesce(json_type(value, '$.resourceType'), '') = 'VARCHAR'
  AND json_extract_string(value, '$.resourceType') <> 'Bundle' AND {sql_json_size('value')} > {OVERSIZE_T}"""))
def q_oversized_resources(spark, sf_dir):
    res = parse_lines(FX.document_lines(spark, sf_dir)).filter(F.col("status") == "ok")
    o = B.oversized_resources(res, OVERSIZE_T)
    return o.select("file_name", "line_no", "error_resource_type", "error_resource_id", "size")


@register("route_counts", sql=with_ctes(FX.SQL_CONVERSATION_ENTRIES, _sql_split(T1), FX.SQL_DOCUMENT_LINES, select=f"""
SELECT route, count(*) AS n FROM (
  SELECT CASE WHEN original_size > {T1} THEN 'bundle_split' ELSE 'bundle_direct' END AS route FROM bstatus
  UNION ALL
  SELECT CASE WHEN {sql_json_size('value')} > {T1} THEN 'single_oversized' ELSE 'single_resource' END
  FROM fx_lines
  WHERE json_valid(value) AND json_type(value) = 'OBJECT' AND coalesce(json_type(value, '$.resourceType'), '') = 'VARCHAR')
GROUP BY route"""))
def q_route_counts(spark, sf_dir):
    b = FX.conversation_bundles(spark, sf_dir)
    br = b.select(B.route(F.lit("Bundle"), B.bundle_size(), T1).alias("route"))
    res = parse_lines(FX.document_lines(spark, sf_dir, numbered=False)).filter(F.col("status") == "ok")
    size = json_size(F.col("value"))
    rr = res.select(F.when(size > T1, "single_oversized")
                    .otherwise(B.route(F.col("resource_type"), size, T1)).alias("route"))
    return br.unionByName(rr).groupBy("route").agg(F.count(F.lit(1)).alias("n"))
