"""Fixture mappings: the driver's tables seen as record files, bundles, jobs
and progress samples (``FIXTURES.md`` part 2).

Each mapping exists twice: as Spark DataFrame code (used by the registered
queries) and as DuckDB SQL (``SQL_*`` strings, used only by the oracle).  The
two are written to produce identical rows; the CASE values are fixed and
listed once under the "Fixed values" comments.

All mappings are narrow projections or key-grouped aggregations over whole
tables; no row is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's table as a DataFrame.  Handles are reused per session
    (a DataFrame is only a plan; the inputs are read-only), which saves the
    file listing and footer read on every call."""
    key = (id(spark), sf_dir.rstrip("/"), name)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        _TABLES[key] = df
    return df


# --------------------------------------------------------------------------
# FX-BUNDLE: conversation = Bundle, turns in order = entries
# --------------------------------------------------------------------------

FX_BUNDLE_THRESHOLD = 1500  # bytes; gives one-chunk, many-chunk and oversized bundles


def conversation_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per entry: (bundle_id, pos, entry) with canonical entry JSON."""
    c = table(spark, sf_dir, "conversations")
    cid = F.col("conv_id").cast("string")
    tid = F.col("turn").cast("string")
    entry = F.to_json(F.struct(
        F.concat(F.lit("urn:uuid:turn-"), cid, F.lit("-"), tid).alias("fullUrl"),
        F.struct(F.concat(cid, F.lit("-"), tid).alias("id"),
                 F.lit("Communication").alias("resourceType"),
                 F.col("role").alias("role"),
                 F.col("text").alias("text")).alias("resource")))
    return c.select(cid.alias("bundle_id"), F.col("turn").cast("long").alias("pos"), entry.alias("entry"))


def bundles_from_entries(entries: DataFrame, meta: DataFrame | None = None, lists: tuple[str, ...] = ()) -> DataFrame:
    """Group an entry table into one row per bundle with an ordered entry array.

    A bundle is one record of the input (one NDJSON line), so the group size
    here is bounded by what one input line already held.  ``meta`` may add
    ``bundle_type``/``timestamp`` per bundle (joined on ``bundle_id``).  Entry
    columns named in ``lists`` become one list per bundle, in no order.
    """
    from ndflow.functions.jsonfn import json_size
    from ndflow.plans.seq import by_key
    sized = entries.select("bundle_id", "pos", "entry", json_size(F.col("entry")).alias("size"),
                           F.lit("collection" if meta is None else None).cast("string").alias("bundle_type"), F.lit(None).cast("string").alias("timestamp"), *lists)
    if meta is not None:
        # metadata rows join the entry rows of their bundle in the one grouping:
        # bundles without entries and entries without metadata are both kept
        sized = sized.unionByName(meta.select("bundle_id", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("string").alias("entry"),
                                              F.lit(None).cast("long").alias("size"), "bundle_type", "timestamp"), allowMissingColumns=True)
    b = by_key(sized, "bundle_id").groupBy("bundle_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("entry").isNotNull(), F.struct("pos", "entry", "size")))).alias("_e"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("entry_bytes"), F.max("size").alias("max_entry"),
        F.max("bundle_type").alias("bundle_type"), F.max("timestamp").alias("timestamp"), *[F.collect_list(c).alias(c) for c in lists])
    return b.select("bundle_id", "bundle_type", "timestamp", F.col("_e.entry").alias("entries"), F.col("_e.size").alias("sizes"),
                    "entry_bytes", "max_entry", *lists)


def conversation_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles_from_entries(conversation_entries(spark, sf_dir))


SQL_CONVERSATION_ENTRIES = """
fx_entries AS (
  SELECT CAST(conv_id AS VARCHAR) AS bundle_id, CAST(turn AS BIGINT) AS pos,
         CAST(to_json(struct_pack(
            fullUrl := 'urn:uuid:turn-' || conv_id || '-' || turn,
            resource := struct_pack(id := conv_id || '-' || turn, resourceType := 'Communication',
                                    role := role, text := text))) AS VARCHAR) AS entry
  FROM conversations),
fx_bundles AS (
  SELECT bundle_id, 'collection' AS bundle_type, CAST(NULL AS VARCHAR) AS timestamp,
         list(entry ORDER BY pos, entry) AS entries
  FROM fx_entries GROUP BY bundle_id)"""


# --------------------------------------------------------------------------
# FX-ORDERS: order = Bundle, line items by l_linenumber = entries
# --------------------------------------------------------------------------

FX_ORDERS_THRESHOLD = 700



def order_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ok = F.col("l_orderkey").cast("string")
    ln = F.col("l_linenumber").cast("string")
    entry = F.to_json(F.struct(
        F.concat(F.lit("urn:uuid:li-"), ok, F.lit("-"), ln).alias("fullUrl"),
        F.struct(F.concat(ok, F.lit("-"), ln).alias("id"),
                 F.col("l_quantity").cast("long").alias("quantity"),
                 F.lit("Claim").alias("resourceType"),
                 F.col("l_linestatus").alias("status")).alias("resource")))
    return li.select(F.concat(F.lit("order-"), ok).alias("bundle_id"),
                     F.col("l_linenumber").cast("long").alias("pos"), entry.alias("entry"))


def order_bundle_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    t = F.col("o_orderstatus")
    btype = F.when(t == "F", "collection").when(t == "O", "searchset").when(t == "P", "history")
    return o.select(F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("bundle_id"),
                    btype.alias("bundle_type"),
                    F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"))


def order_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles_from_entries(order_entries(spark, sf_dir), order_bundle_meta(spark, sf_dir))


SQL_ORDER_ENTRIES = """
fx_entries AS (
  SELECT 'order-' || l_orderkey AS bundle_id, CAST(l_linenumber AS BIGINT) AS pos,
         CAST(to_json(struct_pack(
            fullUrl := 'urn:uuid:li-' || l_orderkey || '-' || l_linenumber,
            resource := struct_pack(id := l_orderkey || '-' || l_linenumber,
                                    quantity := CAST(l_quantity AS BIGINT),
                                    resourceType := 'Claim', status := l_linestatus))) AS VARCHAR) AS entry
  FROM lineitem),
fx_bundles AS (
  SELECT 'order-' || o.o_orderkey AS bundle_id,
         CASE o.o_orderstatus WHEN 'F' THEN 'collection' WHEN 'O' THEN 'searchset' WHEN 'P' THEN 'history' END AS bundle_type,
         strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
         coalesce(e.entries, []) AS entries
  FROM (SELECT bundle_id, list(entry ORDER BY pos, entry) AS entries FROM fx_entries GROUP BY bundle_id) e
  RIGHT JOIN orders o ON e.bundle_id = 'order-' || o.o_orderkey)"""


# --------------------------------------------------------------------------
# FX-DOC: document = resource line; source = file; lang = resource type
# --------------------------------------------------------------------------

# Which document lines are written damaged, by doc_id mod 50.
#   7 -> empty line, 17 -> JSON cut short by one byte, 27 -> no resourceType,
#   37 -> numeric resourceType, 47 -> three spaces, 45 -> a JSON array.
def _doc_resource(include_type=True, numeric_type=False) -> F.Column:
    fields = [F.col("doc_id").cast("string").alias("id")]
    if include_type:
        fields.append((F.lit(5) if numeric_type else F.col("lang")).alias("resourceType"))
    fields.append(F.col("source").alias("source"))
    fields.append(F.col("text").alias("text"))
    return F.to_json(F.struct(*fields))


def document_lines(spark: SparkSession, sf_dir: str, numbered: bool = True) -> DataFrame:
    """(file_name, line_no, value, doc_id): one NDJSON line per document; the
    file is the document's source and lines follow doc_id.  Queries that do
    not use line numbers pass ``numbered=False`` (``line_no`` is then NULL)
    and skip the numbering shuffles."""
    from ndflow.plans.seq import grouped_row_number

    d = table(spark, sf_dir, "documents")
    m = F.col("doc_id") % 50
    good = _doc_resource()
    value = (F.when(m == 7, F.lit(""))
             .when(m == 17, F.expr("substring(_good, 1, length(_good) - 1)"))
             .when(m == 27, _doc_resource(include_type=False))
             .when(m == 37, _doc_resource(numeric_type=True))
             .when(m == 47, F.lit("   "))
             .when(m == 45, F.to_json(F.array(F.col("doc_id").cast("string"))))
             .otherwise(F.col("_good")))
    lines = (d.select("doc_id", F.concat("source", F.lit(".ndjson")).alias("file_name"), good.alias("_good"),
                      "lang", "source", "text")
             .select("doc_id", "file_name", value.alias("value")))
    if not numbered:
        return lines.withColumn("line_no", F.lit(None).cast("long"))
    return grouped_row_number(lines, ["file_name"], "doc_id", "line_no")


SQL_DOCUMENT_LINES = """
fx_doc AS (
  SELECT doc_id, source || '.ndjson' AS file_name,
         CAST(to_json(struct_pack(id := CAST(doc_id AS VARCHAR), resourceType := lang, source := source, text := text)) AS VARCHAR) AS good,
         CAST(to_json(struct_pack(id := CAST(doc_id AS VARCHAR), source := source, text := text)) AS VARCHAR) AS no_type,
         CAST(to_json(struct_pack(id := CAST(doc_id AS VARCHAR), resourceType := 5, source := source, text := text)) AS VARCHAR) AS num_type,
         CAST(to_json([CAST(doc_id AS VARCHAR)]) AS VARCHAR) AS arr
  FROM documents),
fx_lines AS (
  SELECT doc_id, file_name,
         CAST(row_number() OVER (PARTITION BY file_name ORDER BY doc_id) AS BIGINT) AS line_no,
         CASE doc_id % 50 WHEN 7 THEN '' WHEN 17 THEN substring(good, 1, length(good) - 1)
              WHEN 27 THEN no_type WHEN 37 THEN num_type WHEN 47 THEN '   ' WHEN 45 THEN arr
              ELSE good END AS value
  FROM fx_doc)"""


# --------------------------------------------------------------------------
# FX-PATIENT: customer -> Patient, order -> Encounter referencing its patient
# --------------------------------------------------------------------------

def patient_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value) Patient resources as canonical JSON lines."""
    from ndflow.plans.seq import spread
    c = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name"))
    n = table(spark, sf_dir, "nation")
    k = F.col("c_custkey")
    birth = F.format_string("%04d-%02d-%02d", (1940 + k % 60).cast("int"), (1 + k % 12).cast("int"),
                            (1 + k % 28).cast("int"))
    res = F.to_json(F.struct(
        F.array(F.struct(F.col("n_name").alias("country"),
                         F.format_string("%05d", F.col("c_nationkey") * 1000 + (k % 1000).cast("int")).alias("postalCode")
                         )).alias("address"),
        birth.alias("birthDate"),
        F.when(k % 2 == 0, "female").otherwise("male").alias("gender"),
        k.cast("string").alias("id"),
        F.array(F.struct(F.lit("urn:mrn").alias("system"),
                         F.concat(F.lit("MRN-"), k.cast("string")).alias("value"))).alias("identifier"),
        F.array(F.struct(F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("family"),
                         F.array(F.split_part(F.col("c_name"), F.lit("#"), F.lit(2))).alias("given"))).alias("name"),
        F.lit("Patient").alias("resourceType"),
        F.array(F.struct(F.lit("phone").alias("system"),
                         F.format_string("+49-%09d", k.cast("long")).alias("value"))).alias("telecom")))
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(k.alias("src_key"), res.alias("value"))


def encounter_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters referencing their patient.  Fixed values: orders with
    o_orderkey mod 97 = 5 reference a patient id shifted by 1,000,000 (a
    dangling reference)."""
    from ndflow.plans.seq import spread
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"))
    subj = F.when(F.col("o_orderkey") % 97 == 5, F.col("o_custkey") + 1000000).otherwise(F.col("o_custkey"))
    res = F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("period"),
        F.lit("Encounter").alias("resourceType"),
        F.col("o_orderstatus").alias("status"),
        F.struct(F.concat(F.lit("Patient/"), subj.cast("string")).alias("reference")).alias("subject")))
    return o.select(F.col("o_orderkey").alias("src_key"), res.alias("value"))


SQL_PATIENT_LINES = """
fx_patient AS (
  SELECT c_custkey AS src_key, CAST(to_json(struct_pack(
      address := [struct_pack(country := n_name, postalCode := printf('%05d', c_nationkey * 1000 + c_custkey % 1000))],
      birthDate := printf('%04d-%02d-%02d', 1940 + c_custkey % 60, 1 + c_custkey % 12, 1 + c_custkey % 28),
      gender := CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END,
      id := CAST(c_custkey AS VARCHAR),
      identifier := [struct_pack(system := 'urn:mrn', value := 'MRN-' || c_custkey)],
      name := [struct_pack(family := split_part(c_name, '#', 1), given := [split_part(c_name, '#', 2)])],
      resourceType := 'Patient',
      telecom := [struct_pack(system := 'phone', value := printf('+49-%09d', c_custkey))])) AS VARCHAR) AS value
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
fx_encounter AS (
  SELECT o_orderkey AS src_key, CAST(to_json(struct_pack(
      id := CAST(o_orderkey AS VARCHAR), period := strftime(o_orderdate, '%Y-%m-%d'),
      resourceType := 'Encounter', status := o_orderstatus,
      subject := struct_pack(reference := 'Patient/' || CASE WHEN o_orderkey % 97 = 5 THEN o_custkey + 1000000 ELSE o_custkey END))) AS VARCHAR) AS value
  FROM orders)"""


# --------------------------------------------------------------------------
# FX-LEDGER: order = job, line item = step
# --------------------------------------------------------------------------

# Job status per order status; input kind per order priority;
# step name per position; step status from (linestatus, returnflag);
# error message per partkey mod 4; HTTP status per suppkey mod 5.
STEP_NAMES_AFTER_IMPORT = ["dimp", "validation", "csv_conversion", "parquet_conversion", "http_import", "archive"]
ERROR_MESSAGES = ["connection refused", "HTTP 503: service unavailable", "invalid resource: missing id",
                  "context deadline exceeded"]
ERROR_HTTP = [500, 503, 429, 404, 400]


def _uuid_from(k: F.Column) -> F.Column:
    """UUID-shaped job id from a non-negative 64-bit key."""
    k = k.cast("long")
    return F.concat(F.lit("00000000-0000-0000-"), F.lpad(F.lower(F.hex(F.shiftright(k, 48))), 4, "0"), F.lit("-"),
                    F.lpad(F.lower(F.hex(k.bitwiseAND(F.lit(0xFFFFFFFFFFFF)))), 12, "0"))


def ledger_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """steps(job_id, step_id, pos, name, status, started_at, completed_at, files_processed,
    bytes_processed, retry_count, error_type, error_message, http_status)"""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    pr = F.col("o_orderpriority")
    imp = (F.when(pr.isin("2-HIGH", "3-MEDIUM"), "torch").when(pr == "1-URGENT", "http_import")
           .otherwise("local_import"))
    pos = F.col("l_linenumber")
    name = F.when(pos == 1, imp)
    for i, n in enumerate(STEP_NAMES_AFTER_IMPORT, start=2):
        name = name.when(pos == i, n)
    ls, rf = F.col("l_linestatus"), F.col("l_returnflag")
    status = (F.when(ls == "F", "completed").when(rf == "R", "failed").when(rf == "A", "in_progress")
              .otherwise("pending"))
    started = F.when(status != "pending", F.col("l_shipdate"))
    completed = F.when((status == "completed") & (rf != "N"), F.col("l_shipdate") + F.expr("INTERVAL 1 DAY"))
    msg_i = F.col("l_partkey") % 4
    msg = F.when(msg_i == 0, ERROR_MESSAGES[0]).when(msg_i == 1, ERROR_MESSAGES[1]) \
        .when(msg_i == 2, ERROR_MESSAGES[2]).otherwise(ERROR_MESSAGES[3])
    hs_i = F.col("l_suppkey") % 5
    http = F.when(hs_i == 0, 500).when(hs_i == 1, 503).when(hs_i == 2, 429).when(hs_i == 3, 404).otherwise(400)
    failed = status == "failed"
    step_id = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey",
                                                                     "l_suppkey")],
                          F.col("l_quantity").cast("long").cast("string"),
                          F.round(F.col("l_extendedprice") * 100).cast("long").cast("string"))
    return j.select(
        _uuid_from(F.col("l_orderkey")).alias("job_id"),
        step_id.alias("step_id"),
        pos.cast("int").alias("pos"),
        name.alias("name"),
        status.alias("status"),
        started.alias("started_at"),
        completed.alias("completed_at"),
        F.col("l_quantity").cast("int").alias("files_processed"),
        (F.col("l_quantity") * 1000).cast("long").alias("bytes_processed"),
        (F.round(F.col("l_discount") * 100).cast("int") % 3).alias("retry_count"),
        F.when(failed, F.when(http.isin(500, 503, 429, 408), "transient").otherwise("non_transient")).alias("error_type"),
        F.when(failed, msg).alias("error_message"),
        F.when(failed, http).alias("http_status"),
    )


def ledger_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """jobs(job_id, created_at, input_source, input_type, status, current_step,
    total_files, total_bytes, error_message).  Fixed values: the current step is
    the import for o_orderkey mod 3 = 0, dimp for 1, validation for 2; jobs with
    fewer steps name one they do not have."""
    o = table(spark, sf_dir, "orders")
    pr = F.col("o_orderpriority")
    k = F.col("o_orderkey").cast("string")
    ck = F.col("o_custkey").cast("string")
    itype = (F.when(pr == "1-URGENT", "http_url").when(pr == "2-HIGH", "torch_result_url")
             .when(pr == "3-MEDIUM", "crtdl_file").otherwise("local_directory"))
    src = (F.when(pr == "1-URGENT", F.concat(F.lit("https://data.example.org/export/"), k, F.lit(".ndjson")))
           .when(pr == "2-HIGH", F.concat(F.lit("https://torch.example.org/fhir/extraction/"), k))
           .when(pr == "3-MEDIUM", F.concat(F.lit("queries/cohort-"), k, F.lit(".crtdl")))
           .when(pr == "4-NOT SPECIFIED", F.concat(F.lit("/data/import/"), ck))
           .otherwise(F.concat(F.lit("./input/"), ck)))
    st = F.col("o_orderstatus")
    status = F.when(st == "F", "completed").when(st == "O", "in_progress").when(st == "P", "failed")
    imp = F.when(pr.isin("2-HIGH", "3-MEDIUM"), "torch").when(pr == "1-URGENT", "http_import").otherwise("local_import")
    m3 = F.col("o_orderkey") % 3
    current = F.when(m3 == 0, imp).when(m3 == 1, STEP_NAMES_AFTER_IMPORT[0]).otherwise(STEP_NAMES_AFTER_IMPORT[1])
    return o.select(
        _uuid_from(F.col("o_orderkey")).alias("job_id"),
        F.col("o_orderdate").alias("created_at"),
        src.alias("input_source"), itype.alias("input_type"), status.alias("status"),
        current.alias("current_step"),
        (F.col("o_totalprice") / 10000).cast("int").alias("total_files"),
        (F.col("o_totalprice") * 100).cast("long").alias("total_bytes"),
        F.when(st == "P", F.lit("step failed")).alias("error_message"))


SQL_LEDGER = """
fx_steps AS (
  SELECT l_orderkey,
         l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS BIGINT)
           || '-' || CAST(round(l_extendedprice * 100) AS BIGINT) AS step_id,
         CAST(l_linenumber AS INTEGER) AS pos,
         CASE WHEN l_linenumber = 1 THEN
                CASE WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'torch'
                     WHEN o_orderpriority = '1-URGENT' THEN 'http_import' ELSE 'local_import' END
              WHEN l_linenumber = 2 THEN 'dimp' WHEN l_linenumber = 3 THEN 'validation'
              WHEN l_linenumber = 4 THEN 'csv_conversion' WHEN l_linenumber = 5 THEN 'parquet_conversion'
              WHEN l_linenumber = 6 THEN 'http_import' WHEN l_linenumber = 7 THEN 'archive' END AS name,
         CASE WHEN l_linestatus = 'F' THEN 'completed' WHEN l_returnflag = 'R' THEN 'failed'
              WHEN l_returnflag = 'A' THEN 'in_progress' ELSE 'pending' END AS status,
         l_shipdate, l_returnflag, l_quantity, l_discount, l_partkey, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ledger_steps AS (
  SELECT printf('00000000-0000-0000-%04x-%012x', l_orderkey >> 48, l_orderkey & 281474976710655) AS job_id,
         step_id, pos, name, status,
         CASE WHEN status <> 'pending' THEN l_shipdate END AS started_at,
         CASE WHEN status = 'completed' AND l_returnflag <> 'N' THEN l_shipdate + INTERVAL 1 DAY END AS completed_at,
         CAST(l_quantity AS INTEGER) AS files_processed,
         CAST(l_quantity * 1000 AS BIGINT) AS bytes_processed,
         CAST(CAST(round(l_discount * 100) AS INTEGER) % 3 AS INTEGER) AS retry_count,
         CASE WHEN status = 'failed' THEN
              CASE WHEN l_suppkey % 5 IN (0, 1, 2) THEN 'transient' ELSE 'non_transient' END END AS error_type,
         CASE WHEN status = 'failed' THEN
              CASE l_partkey % 4 WHEN 0 THEN 'connection refused' WHEN 1 THEN 'HTTP 503: service unavailable'
                   WHEN 2 THEN 'invalid resource: missing id' ELSE 'context deadline exceeded' END END AS error_message,
         CASE WHEN status = 'failed' THEN
              CASE l_suppkey % 5 WHEN 0 THEN 500 WHEN 1 THEN 503 WHEN 2 THEN 429 WHEN 3 THEN 404 ELSE 400 END END AS http_status
  FROM fx_steps),
fx_jobs AS (SELECT * FROM orders),
ledger_jobs AS (
  SELECT printf('00000000-0000-0000-%04x-%012x', o_orderkey >> 48, o_orderkey & 281474976710655) AS job_id,
         o_orderdate AS created_at,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'https://data.example.org/export/' || o_orderkey || '.ndjson'
              WHEN '2-HIGH' THEN 'https://torch.example.org/fhir/extraction/' || o_orderkey
              WHEN '3-MEDIUM' THEN 'queries/cohort-' || o_orderkey || '.crtdl'
              WHEN '4-NOT SPECIFIED' THEN '/data/import/' || o_custkey
              ELSE './input/' || o_custkey END AS input_source,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'http_url' WHEN '2-HIGH' THEN 'torch_result_url'
              WHEN '3-MEDIUM' THEN 'crtdl_file' ELSE 'local_directory' END AS input_type,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'in_progress' WHEN 'P' THEN 'failed' END AS status,
         CASE o_orderkey % 3 WHEN 0 THEN CASE WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'torch'
              WHEN o_orderpriority = '1-URGENT' THEN 'http_import' ELSE 'local_import' END
              WHEN 1 THEN 'dimp' ELSE 'validation' END AS current_step,
         CAST(trunc(o_totalprice / 10000) AS INTEGER) AS total_files,
         CAST(trunc(o_totalprice * 100) AS BIGINT) AS total_bytes,
         CASE WHEN o_orderstatus = 'P' THEN 'step failed' END AS error_message
  FROM fx_jobs)"""


# --------------------------------------------------------------------------
# FX-EVENTS: events as the append-only log of step transitions
# --------------------------------------------------------------------------

# Transition and resulting status per event type.
STEP_EVENTS = {"signup": ("init", "pending"), "view": ("start", "in_progress"), "click": ("retry", "in_progress"),
               "purchase": ("complete", "completed"), "error": ("fail", "failed")}


def step_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_id, step_id, seq, event, to_status, ts): the user is the job, a day
    of the user is a step; the log is as it comes, with forbidden transitions."""
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    ev, to = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, (name, status) in STEP_EVENTS.items():
        ev, to = F.when(t == k, name).otherwise(ev), F.when(t == k, status).otherwise(to)
    job = F.col("user_id").cast("string")
    return e.select(job.alias("job_id"), F.concat(job, F.lit(":"), F.date_format("ts", "yyyy-MM-dd")).alias("step_id"),
                    F.col("event_id").alias("seq"), ev.alias("event"), to.alias("to_status"), "ts")


SQL_STEP_EVENTS = """
events_l AS (
  SELECT CAST(user_id AS VARCHAR) AS job_id, CAST(user_id AS VARCHAR) || ':' || strftime(ts, '%Y-%m-%d') AS step_id, event_id AS seq, ts,
         CASE event_type WHEN 'signup' THEN 'init' WHEN 'view' THEN 'start' WHEN 'click' THEN 'retry' WHEN 'purchase' THEN 'complete'
              WHEN 'error' THEN 'fail' END AS event,
         CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'in_progress' WHEN 'click' THEN 'in_progress'
              WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' END AS to_status
  FROM events)"""


# --------------------------------------------------------------------------
# FX-PROGRESS: per user, events ordered by (ts, event_id) are progress samples
# --------------------------------------------------------------------------

def progress_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, ts, seq, items, bytes): items = running count, bytes = running
    sum of ``value`` (as integer cents), in (ts, event_id) order per run."""
    from ndflow.plans.seq import grouped_running_sums

    e = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), "ts", F.col("event_id").alias("seq"),
        F.lit(1).cast("long").alias("_one"), F.round(F.col("value") * 100).cast("long").alias("_cents"))
    out = grouped_running_sums(e, ["run_id"], ["ts", "seq"], {"items": "_one", "bytes": "_cents"},
                               bucket=F.date_trunc("day", F.col("ts")))
    return out.select("run_id", "ts", "seq", "items", "bytes")


SQL_PROGRESS = """
progress AS (
  SELECT user_id AS run_id, ts, event_id AS seq,
         CAST(count(*) OVER w AS BIGINT) AS items,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS bytes
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


# --------------------------------------------------------------------------
# FX-CALLS: events as a call log
# --------------------------------------------------------------------------

# HTTP status per event type; message for 'error' events by
# event_id mod 6 (status 0 = no HTTP answer).
CALL_ERROR_MESSAGES = ["dial tcp 10.0.0.7:443: connection refused", "read: connection reset by peer",
                       "unexpected EOF", "write /jobs/out.part: no space left on device",
                       "open /jobs/in.ndjson: permission denied", "geofence lookup failed"]


def call_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(call_id, ts, seq, http_status, message): one row per attempt."""
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    status = (F.when(t == "view", 200).when(t == "click", 503).when(t == "purchase", 429)
              .when(t == "signup", 400).otherwise(0))
    mi = F.col("event_id") % 6
    err = F.when(mi == 0, CALL_ERROR_MESSAGES[0])
    for i in range(1, 6):
        err = err.when(mi == i, CALL_ERROR_MESSAGES[i])
    msg = (F.when(t == "view", "ok").when(t == "click", "HTTP 503: service unavailable")
           .when(t == "purchase", "HTTP 429: too many requests").when(t == "signup", "HTTP 400: bad request")
           .otherwise(err))
    return e.select(F.concat(F.col("user_id").cast("string"), F.lit(":"), F.date_format("ts", "yyyy-MM-dd")).alias("call_id"),
                    "ts", F.col("event_id").alias("seq"), status.alias("http_status"), msg.alias("message"))


SQL_CALLS = """
calls AS (
  SELECT CAST(user_id AS VARCHAR) || ':' || strftime(ts, '%Y-%m-%d') AS call_id, ts, event_id AS seq,
         CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 503 WHEN 'purchase' THEN 429
              WHEN 'signup' THEN 400 ELSE 0 END AS http_status,
         CASE event_type WHEN 'view' THEN 'ok' WHEN 'click' THEN 'HTTP 503: service unavailable'
              WHEN 'purchase' THEN 'HTTP 429: too many requests' WHEN 'signup' THEN 'HTTP 400: bad request'
              ELSE CASE event_id % 6 WHEN 0 THEN 'dial tcp 10.0.0.7:443: connection refused'
                   WHEN 1 THEN 'read: connection reset by peer' WHEN 2 THEN 'unexpected EOF'
                   WHEN 3 THEN 'write /jobs/out.part: no space left on device'
                   WHEN 4 THEN 'open /jobs/in.ndjson: permission denied' ELSE 'geofence lookup failed' END
         END AS message
  FROM events)"""
