"""Registered queries over whole flows: reruns and repaired files (S9, K2, E1),
de-identification by path (D2, D3), chunk invariance (D8), links at any depth
(P12), all elements of any type (F1), criteria trees (J5)."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from ndflow.functions.jsonfn import STRICT_JSON
from ndflow.operators import bundle as B
from ndflow.operators.cohort import extract_groups
from ndflow.operators.deid_doc import deidentify_documents
from ndflow.operators.flatten import flatten_tables, infer_schemas, nested_rows
from ndflow.operators.links import dangling_links, extract_links
from ndflow.plans import fixtures as FX
from ndflow.plans.flow import WRITERS, read_output, run_directory
from ndflow.plans.registry import register, with_ctes
from ndflow.plans.seq import by_key, spread
from ndflow.session import scratch_path
from ndflow.sinks.files import stored, write_csv, write_parquet

SECRET = "ndflow-demo-key"  # example key handed in as a parameter, as a user would


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


# ---- E1: two files of one name, then a repaired and an unchanged one

FLOW_THRESHOLD = 10_000
_SQL_RUNS = f"""
f AS (
  SELECT doc_id, CASE WHEN CAST(regexp_extract(file_name, '([0-9]+)', 1) AS INTEGER) % 2 = 0 THEN 'a/x.ndjson' ELSE 'b/x.ndjson' END AS rel_path,
         CASE WHEN trim(value, ' ' || chr(9) || chr(13) || chr(10)) = '' THEN 'blank' WHEN NOT json_valid(value) OR json_type(value) <> 'OBJECT' THEN 'bad'
              WHEN json_type(value, '$.resourceType') IS NULL OR json_type(value, '$.resourceType') <> 'VARCHAR' THEN 'bad'
              WHEN json_type(value, '$.id') IS NOT NULL AND json_type(value, '$.id') <> 'VARCHAR' THEN 'bad'
              WHEN strlen(value) + 5 * (length(value) - length(translate(value, '<>&', ''))) > {FLOW_THRESHOLD} THEN 'over' ELSE 'ok' END AS st
  FROM fx_lines),
s AS (  -- a/x is repaired in the second run: its bad lines are gone
  SELECT rel_path, sink, n FROM (
    SELECT rel_path, 'ndjson' AS sink, count(*) FILTER (WHERE st = 'ok') AS n FROM f GROUP BY rel_path
    UNION ALL SELECT rel_path, 'parquet', count(*) FILTER (WHERE st = 'ok') FROM f GROUP BY rel_path
    UNION ALL SELECT rel_path, 'csv', count(*) FILTER (WHERE st = 'ok') FROM f GROUP BY rel_path
    UNION ALL SELECT rel_path, 'oversized', count(*) FILTER (WHERE st = 'over') FROM f GROUP BY rel_path
    UNION ALL SELECT rel_path, 'rejects', count(*) FILTER (WHERE st = 'bad') FROM f WHERE rel_path = 'b/x.ndjson' GROUP BY rel_path
    UNION ALL SELECT rel_path, 'ledger', 1 FROM f GROUP BY rel_path) WHERE n > 0)"""


@register("flow_reruns", sql=with_ctes(FX.SQL_DOCUMENT_LINES, _SQL_RUNS, select="""
SELECT rel_path, sink, CAST(n AS BIGINT) AS n, CAST(n AS BIGINT) AS n_files_view, CASE rel_path WHEN 'a/x.ndjson' THEN 2 ELSE 3 END AS generation FROM s"""))
def q_flow_reruns(spark, sf_dir):
    """Run 1 takes ``a/x.ndjson``; before run 2 it is repaired (its bad
    lines are gone); before run 3 ``b/x.ndjson`` comes along; run 4 has nothing
    to do.  Rows of every sink by source file: as plain readers see them, and as
    ``read_output`` does; and the generation that holds them."""
    lines = FX.document_lines(spark, sf_dir, numbered=False)
    src, out = _scratch(spark, "flow-src"), _scratch(spark, "flow-out")
    even = F.regexp_extract("file_name", "([0-9]+)", 1).cast("int") % 2 == 0

    def land(df, rel):
        df.select("value", F.lit(rel).alias("source_file")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_file").text(src)

    def run():
        return run_directory(spark, src, SECRET, FLOW_THRESHOLD, out, glob="*.txt", rules={"*": {"source": "keep"}}, flat_types=("en",))

    from ndflow.sources.ndjson import parse_lines
    land(lines.filter(even), "a/x.ndjson")
    run()
    good = parse_lines(lines.withColumn("line_no", F.lit(None).cast("long"))).filter(F.col("status").isin("ok", "blank") | F.col("blank_trimmed"))
    land(good.filter(even), "a/x.ndjson")
    run()
    land(lines.filter(~even), "b/x.ndjson")
    run()
    paths = run()

    def plain(sink):
        if sink == "ndjson":
            x = spark.read.text(paths[sink]).select(F.regexp_replace(F.url_decode("output_file"), "dimped_", "").alias("rel_path"), "generation")
        elif sink == "csv":
            x = spark.read.option("header", True).csv(paths[sink])
        else:
            x = spark.read.parquet(paths[sink])
        return x.select("rel_path", F.lit(sink).alias("sink"), F.col("generation").cast("int").alias("generation"))

    def view(sink):
        x = plain(sink) if sink == "ndjson" else read_output(spark, out, sink)
        return x.select("rel_path", F.lit(sink).alias("sink"))

    sinks = ("ndjson", "parquet", "csv", "oversized", "rejects", "ledger")
    a = b = None
    for s in sinks:
        a = plain(s) if a is None else a.unionAll(plain(s))
        b = view(s) if b is None else b.unionAll(view(s))
    a = a.groupBy("rel_path", "sink").agg(F.count(F.lit(1)).alias("n"), F.max("generation").alias("generation"))
    return a.join(b.groupBy("rel_path", "sink").agg(F.count(F.lit(1)).alias("n_files_view")), ["rel_path", "sink"])


# ---- D2, D3: nothing of a person gets out

def _person_bundles(spark, sf_dir):
    """One bundle per customer with the person's name, phone, address and ids in
    every kind of place: request and search URLs, locations, extensions,
    primitive extensions, contained resources, attachments, notes, displays,
    social security numbers, free text values."""
    c = spread(FX.table(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    k = F.col("c_custkey").cast("string")
    pid, mrn, org = F.concat(F.lit("pat-"), k, F.lit("-p")), F.concat(F.lit("mrn-"), k, F.lit("-m")), F.concat(F.lit("org-"), k, F.lit("-o"))
    name, phone, street = F.col("c_name"), F.format_string("+49-%09d", "c_custkey"), F.concat(F.lit("12 Long street "), k)
    txt = F.concat_ws(" / ", name, phone, street)
    url = F.concat(F.lit("Patient/"), pid)
    ext = F.array(F.struct(F.lit("http://x/e").alias("url"), F.lit("1951-02-03").alias("valueDate"), txt.alias("valueString")))
    patient = F.struct(
        F.struct(ext.alias("extension")).alias("_birthDate"), F.array(F.struct(F.lit("DE").alias("country"), F.lit("12345").alias("postalCode"), F.array(street).alias("line"))).alias("address"),
        F.lit("1951-02-03").alias("birthDate"), F.array(F.struct(F.struct(name.alias("family")).alias("name"), F.lit("male").alias("gender"))).alias("contact"),
        F.array(F.struct(org.alias("id"), F.lit("Clinic").alias("name"), F.lit("Organization").alias("resourceType"))).alias("contained"), ext.alias("extension"),
        F.lit("female").alias("gender"), pid.alias("id"),
        F.array(F.struct(F.lit("http://hl7.org/fhir/sid/us-ssn").alias("system"), phone.alias("value"), F.struct(txt.alias("display")).alias("assigner")),
                F.struct(F.lit("urn:mrn").alias("system"), mrn.alias("value"), F.struct(txt.alias("display")).alias("assigner"))).alias("identifier"),
        F.struct(F.concat(F.lit("#"), org).alias("reference"), name.alias("display")).alias("managingOrganization"),
        F.array(F.struct(name.alias("family"), F.array(name).alias("given"))).alias("name"),
        F.array(F.struct(F.lit("image/png").alias("contentType"), F.base64(name.cast("binary")).alias("data"), txt.alias("title"),
                         F.concat(F.lit("http://h/"), url).alias("url"))).alias("photo"),
        F.lit("Patient").alias("resourceType"), F.array(F.struct(phone.alias("value"))).alias("telecom"), F.struct(txt.alias("div")).alias("text"))
    observation = F.struct(
        F.struct(F.lit("weight").alias("text"), F.array(F.struct(F.lit("29463-7").alias("code"), F.lit("Body weight").alias("display"))).alias("coding")).alias("code"),
        F.concat(F.lit("obs-"), k, F.lit("-b")).alias("id"), F.array(F.struct(txt.alias("text"))).alias("note"), F.array(F.struct(name.alias("display"))).alias("performer"),
        F.lit("Observation").alias("resourceType"), F.struct(F.concat(F.lit("http://h/"), url).alias("reference"), name.alias("display")).alias("subject"),
        F.struct(F.lit("kg").alias("unit"), F.col("c_custkey").alias("value")).alias("valueQuantity"), txt.alias("valueString"))
    entry = F.array(
        F.to_json(F.struct(F.concat(F.lit("http://h/"), url).alias("fullUrl"), F.struct(F.lit("PUT").alias("method"), url.alias("url"),
                           F.concat(F.lit("Patient?identifier=urn:mrn|"), mrn, F.lit("&name="), F.replace(name, F.lit(" "), F.lit("+"))).alias("ifNoneExist")).alias("request"),
                           patient.alias("resource"), F.struct(F.concat(url, F.lit("/_history/1")).alias("location"), F.lit("201").alias("status")).alias("response"))),
        F.to_json(F.struct(observation.alias("resource"))))
    link = F.to_json(F.array(F.struct(F.lit("self").alias("relation"), F.concat(F.lit("https://h/fhir/"), url, F.lit("/$everything?_count=5&patient="), pid).alias("url"))))
    doc = F.concat(F.lit('{"entry":['), F.array_join(entry, ","), F.lit('],"id":"b-'), k, F.lit('-b","link":'), link, F.lit(',"resourceType":"Bundle","type":"transaction"}'))
    planted = F.array(name, phone, street, txt, pid, mrn, org, F.base64(name.cast("binary")), F.lit("1951-02"), F.concat(F.lit("b-"), k, F.lit("-b")),
                      F.concat(F.lit("obs-"), k, F.lit("-b")), F.replace(name, F.lit(" "), F.lit("+")))
    return c.select("c_custkey", doc.alias("value"), planted.alias("planted"))


@register("deid_by_path", sql="""
SELECT c_custkey, true AS planted_in, CAST(0 AS BIGINT) AS leaks, 'DE' AS country, '123**' AS postal_code, '1951' AS birth, 'Body weight' AS display, 'Clinic' AS organization,
  'weight' AS code_text, CAST(c_custkey AS VARCHAR) AS quantity, true AS links_agree, CAST(1 AS BIGINT) AS identifiers FROM customer""")
def q_deid_by_path(spark, sf_dir):
    """Of the values planted in every kind of place none is left
    (``leaks``), while codes, units, years and regions are, and all links to the
    patient and the contained organization still meet."""
    b = _person_bundles(spark, sf_dir)
    seen = F.forall("planted", lambda p: F.contains(F.col("value"), p))
    x = deidentify_documents(b.select("c_custkey", "value", "planted", seen.alias("planted_in")), SECRET)
    v = F.col("value")
    g = lambda path: F.get_json_object(v, path)
    pid, org = g("$.entry[0].resource.id"), g("$.entry[0].resource.contained[0].id")
    links = ((g("$.entry[0].fullUrl") == F.concat(F.lit("http://h/Patient/"), pid)) & (g("$.entry[0].request.url") == F.concat(F.lit("Patient/"), pid))
             & (g("$.entry[0].response.location") == F.concat(F.lit("Patient/"), pid, F.lit("/_history/1"))) & (g("$.entry[1].resource.subject.reference") == g("$.entry[0].fullUrl"))
             & F.contains(g("$.link[0].url"), F.concat(F.lit("/Patient/"), pid, F.lit("/$everything?_count=5&patient=")))
             & (g("$.entry[0].resource.managingOrganization.reference") == F.concat(F.lit("#"), org)))
    return x.select("c_custkey", "planted_in", F.size(F.filter("planted", lambda p: F.contains(v, p))).cast("long").alias("leaks"),
                    g("$.entry[0].resource.address[0].country").alias("country"), g("$.entry[0].resource.address[0].postalCode").alias("postal_code"),
                    g("$.entry[0].resource.birthDate").alias("birth"), g("$.entry[1].resource.code.coding[0].display").alias("display"),
                    g("$.entry[0].resource.contained[0].name").alias("organization"), g("$.entry[1].resource.code.text").alias("code_text"),
                    g("$.entry[1].resource.valueQuantity.value").alias("quantity"), links.alias("links_agree"),
                    F.json_array_length(g("$.entry[0].resource.identifier")).cast("long").alias("identifiers"))


# ---- D8: chunks and whole bundles, two separate paths

from ndflow.plans.q_bundle import _sql_split  # noqa: E402


def metamorphic(bundles, threshold: int, secret: str, chunk_rules=None, whole_rules=None):
    """Every splittable bundle de-identified twice, as the chunk documents
    that a service would get and as one document, compared entry by entry, byte
    for byte; ``leaks``: original entry ids left in the chunks' text."""
    chunks = B.chunk_rows(B.split_bundles(bundles, threshold)).filter("bundle_id is not null")
    # the whole document and the original ids travel with the first chunk, and the
    # documents of a bundle meet before they are de-identified: they are several
    # times as long afterwards, and then no longer known to lie by bundle
    whole = F.struct(B.bundle_document(chunks).alias("value"), F.col("total_chunks").cast("int").alias("total_chunks"),
                     F.transform("entries", lambda e: F.get_json_object(e, "$.resource.id")).alias("ids"))
    docs = chunks.select("bundle_id", F.struct("chunk_index", B.chunk_document(chunks).alias("value")).alias("c"), F.when(F.col("chunk_index") == 0, whole).alias("w"))
    met = by_key(docs, "bundle_id").groupBy("bundle_id").agg(F.collect_list("c").alias("c"), F.collect_list("w").alias("w"))
    x = met.select("bundle_id", F.col("c.chunk_index").alias("places"), F.col("c.value").alias("parts"), F.col("w.value").alias("wholes"), "w.total_chunks", "w.ids")
    by_chunk = deidentify_documents(x, secret, "parts", rules=chunk_rules)
    both = deidentify_documents(by_chunk, secret, "wholes", rules=whole_rules)
    entries = lambda c: F.from_json(c, "entry array<string>", STRICT_JSON)["entry"]
    j = both.select("bundle_id", F.sort_array(F.arrays_zip("places", "parts")).alias("_c"), F.explode(F.arrays_zip("wholes", "total_chunks", "ids")).alias("_w"))
    j = j.select("bundle_id", F.size("_c").alias("chunks"), "_w.total_chunks", "_w.ids", entries(F.col("_w.wholes")).alias("_e"),
                 F.transform("_c.parts", entries).alias("_parts"), F.array_join("_c.parts", "").cast("binary").alias("_text"))
    # a quote is on every few bytes, an id's first character is not: most searches end with the bare id
    found = lambda i: F.contains("_text", i.cast("binary")) & F.contains(F.col("_text"), F.concat(F.lit('"'), i, F.lit('"')).cast("binary"))
    return j.select("bundle_id", F.size("_e").alias("entry_count"), "chunks", (F.flatten("_parts") == F.col("_e")).alias("equal"),
                    (F.col("chunks") == F.col("total_chunks")).alias("all_chunks"), F.exists("ids", found).alias("leaks"))


@register("split_metamorphic", sql=with_ctes(FX.SQL_ORDER_ENTRIES, _sql_split(FX.FX_ORDERS_THRESHOLD), select="""
SELECT b.bundle_id, CAST(b.n AS INTEGER) AS entry_count, CAST(coalesce(c.k, 1) AS INTEGER) AS chunks, true AS equal, true AS all_chunks, false AS leaks
FROM bstatus b LEFT JOIN (SELECT bundle_id, max(total_chunks) AS k FROM chunk_full GROUP BY bundle_id) c ON c.bundle_id = b.bundle_id WHERE b.status = 'ok'"""))
def q_split_metamorphic(spark, sf_dir):
    return metamorphic(FX.order_bundles(spark, sf_dir), FX.FX_ORDERS_THRESHOLD, SECRET)


# ---- P12: links at any depth

def _linked_bundles(spark, sf_dir):
    """One bundle per order: the order with nested links to its customer, a
    contained place, another entry by URN, and its items; fixed values: orders
    with o_orderkey mod 97 = 5 name a customer that is not there, mod 89 = 3 a
    contained place that is not there, mod 83 = 2 a URN that no entry has."""
    o = spread(FX.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    k = F.col("o_orderkey")
    ks = k.cast("string")
    cust = F.when(k % 97 == 5, F.col("o_custkey") + 1000000).otherwise(F.col("o_custkey")).cast("string")
    place = F.when(k % 89 == 3, "gone").otherwise("place")
    urn = F.concat(F.when(k % 83 == 2, "urn:uuid:no-").otherwise("urn:uuid:item-"), ks)
    enc = F.struct(
        F.array(F.struct(F.lit("place").alias("id"), F.lit("Location").alias("resourceType"))).alias("contained"), ks.alias("id"),
        F.array(F.struct(F.struct(F.concat(F.lit("#"), place).alias("reference")).alias("location"))).alias("location"),
        F.array(F.struct(F.array(F.struct(F.struct(F.concat(F.lit("Patient/"), cust).alias("reference")).alias("actor"))).alias("members"))).alias("participant"),
        F.lit("Encounter").alias("resourceType"), F.array(F.struct(urn.alias("reference"))).alias("reasonReference"))
    item = F.struct(F.struct(F.concat(F.lit("Encounter/"), ks).alias("reference")).alias("encounter"), F.concat(F.lit("i-"), ks).alias("id"), F.lit("Condition").alias("resourceType"))
    doc = F.concat(F.lit('{"entry":[{"resource":'), F.to_json(enc), F.lit('},{"fullUrl":"urn:uuid:item-'), ks, F.lit('","resource":'), F.to_json(item),
                   F.lit('}],"id":"b'), ks, F.lit('","resourceType":"Bundle"}'))
    return o.select(k.alias("src_key"), doc.alias("value"))


@register("dangling_links", sql="""
WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer)
SELECT o_orderkey AS src_key, 'Bundle.entry.resource/Encounter.participant.members.actor' AS path, 'Patient/' || (o_custkey + 1000000) AS target, 'Patient' AS ref_type,
  CAST(o_custkey + 1000000 AS VARCHAR) AS ref_id FROM orders WHERE o_orderkey % 97 = 5 AND CAST(o_custkey + 1000000 AS VARCHAR) NOT IN (SELECT id FROM c)
UNION ALL SELECT o_orderkey, 'Bundle.entry.resource/Encounter.participant.members.actor', 'Patient/' || o_custkey, 'Patient', CAST(o_custkey AS VARCHAR) FROM orders
  WHERE o_orderkey % 97 <> 5 AND CAST(o_custkey AS VARCHAR) NOT IN (SELECT id FROM c)
UNION ALL SELECT o_orderkey, 'Bundle.entry.resource/Encounter.location.location', '#gone', NULL, NULL FROM orders WHERE o_orderkey % 89 = 3
UNION ALL SELECT o_orderkey, 'Bundle.entry.resource/Encounter.reasonReference', 'urn:uuid:no-' || o_orderkey, NULL, NULL FROM orders WHERE o_orderkey % 83 = 2""")
def q_dangling_links(spark, sf_dir):
    """Links of any type and depth that lead nowhere: typed ones against the
    patients and encounters of all documents, local and URN ones inside their
    own document."""
    docs = _linked_bundles(spark, sf_dir).unionAll(FX.patient_lines(spark, sf_dir).select("src_key", "value"))
    return dangling_links(stored(extract_links(docs, keep=("src_key",)), "links"), ("src_key",))


# ---- F1: all elements of any type

@register("flatten_elements", sql="""
WITH p AS (
  SELECT c_custkey AS src_key, unnest([0, 1, 2]) AS no, unnest(['urn:mrn', 'urn:card', 'urn:phone']) AS system,
         unnest(['M' || c_custkey, 'C' || c_custkey, '+49-' || c_custkey]) AS value FROM customer),
a AS (
  SELECT c_custkey AS src_key, n, unnest(generate_series(0, n - 1)) AS no, c_name FROM (SELECT *, 1 + c_custkey % 3 AS n FROM customer)),
l AS (SELECT src_key, no, unnest([0, 1]) AS line_no, unnest([c_name, 'floor ' || no]) AS value FROM a)
SELECT fmt, tab, src_key, a_no, b_no, x, y FROM (
  SELECT 'Patient_identifier' AS tab, src_key, CAST(no AS INTEGER) AS a_no, CAST(NULL AS INTEGER) AS b_no, system AS x, value AS y FROM p
  UNION ALL SELECT 'Patient_address', src_key, CAST(no AS INTEGER), NULL, 'C' || no, NULL FROM a
  UNION ALL SELECT 'Patient_address_line', src_key, CAST(no AS INTEGER), CAST(line_no AS INTEGER), value, NULL FROM l
  UNION ALL SELECT 'Patient', c_custkey, NULL, NULL, 'P' || c_custkey, CAST(c_acctbal AS VARCHAR) FROM customer
  UNION ALL SELECT 'Account', c_custkey, NULL, NULL, 'A' || c_custkey, c_mktsegment FROM customer) CROSS JOIN (SELECT unnest(['csv', 'parquet']) AS fmt)""")
def q_flatten_elements(spark, sf_dir):
    """two types, inferred; identifiers, addresses and address lines beyond
    the first, written as CSV and Parquet and read back."""
    c = spread(FX.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))
    k = F.col("c_custkey").cast("string")
    ident = lambda s, v: F.struct(F.lit(s).alias("system"), v.alias("value"))
    address = F.transform(F.sequence(F.lit(0), (F.col("c_custkey") % 3).cast("int")), lambda i: F.struct(
        F.concat(F.lit("C"), i.cast("string")).alias("country"), F.array(F.col("c_name"), F.concat(F.lit("floor "), i.cast("string"))).alias("line")))
    patient = F.to_json(F.struct(address.alias("address"), F.col("c_acctbal").cast("string").alias("balance"), F.concat(F.lit("P"), k).alias("id"), F.array(
        ident("urn:mrn", F.concat(F.lit("M"), k)), ident("urn:card", F.concat(F.lit("C"), k)), ident("urn:phone", F.concat(F.lit("+49-"), k))).alias("identifier"),
        F.lit("Patient").alias("resourceType")))
    account = F.to_json(F.struct(F.concat(F.lit("A"), k).alias("id"), F.lit("Account").alias("resourceType"), F.struct(F.col("c_mktsegment").alias("code")).alias("type")))
    lines = c.select(F.col("c_custkey").alias("src_key"), F.explode(F.array(
        F.struct(F.lit("Patient").alias("resource_type"), patient.alias("value")), F.struct(F.lit("Account").alias("resource_type"), account.alias("value")))).alias("r"))
    lines = stored(lines.select("src_key", "r.*"), "lines")
    pick = {"Patient_identifier": ("identifier_no", None, "system", "value"), "Patient_address": ("address_no", None, "country", None),
            "Patient_address_line": ("address_no", "line_no", "value", None), "Patient": (None, None, "id", "balance"), "Account": (None, None, "id", "type_code")}
    tables, paths, out = {}, {}, None
    for kind, schema in infer_schemas(lines).items():
        tables |= flatten_tables(stored(nested_rows(lines, kind, schema, ("src_key",)), f"nested-{kind}"), kind, ("src_key",))
    with ThreadPoolExecutor(WRITERS) as pool:
        jobs = []
        for name, t in tables.items():
            for fmt in ("csv", "parquet"):
                paths[name, fmt] = _scratch(spark, f"{fmt}-{name}")
                jobs.append(pool.submit(write_csv if fmt == "csv" else write_parquet, t, paths[name, fmt]))
        for j in jobs:
            j.result()
    for name, t in tables.items():
        for fmt in ("csv", "parquet"):
            path = paths[name, fmt]
            back = spark.read.option("header", True).schema(t.schema).csv(path) if fmt == "csv" else spark.read.parquet(path)
            cols = [F.col(x).cast(d) if x else F.lit(None).cast(d) for x, d in zip(pick[name], ("int", "int", "string", "string"), strict=True)]
            x = back.select(F.lit(fmt).alias("fmt"), F.lit(name).alias("tab"), "src_key", *[v.alias(n) for v, n in zip(cols, ("a_no", "b_no", "x", "y"), strict=True)])
            out = x if out is None else out.unionAll(x)
    return out


# ---- J5: criteria trees

COHORT_TREE = {
    "cohortDefinition": {
        "version": "1.0", "display": "adults, women or from two nations, with a finished order or an urgent one, not only cheap ones",
        "inclusionCriteria": [
            {"name": "birth_date", "type": "age", "min": 18, "max": 65, "on": "2020-01-01"},
            [{"name": "gender", "type": "code", "value": "female"}, {"name": "country", "type": "code", "value": ["FRANCE", "GERMANY"]}],
            [{"name": "status", "type": "code", "value": "F", "resourceType": "Encounter"},
             {"name": "price", "type": "range", "min": 300000, "resourceType": "Condition"}]],
        "exclusionCriteria": [{"name": "segment", "type": "code", "value": "BUILDING", "resourceType": "Coverage"}]},
    "dataExtraction": {"attributeGroups": [
        {"name": "people", "resourceType": "Patient", "attributes": ["gender", "birth_date"]},
        {"name": "visits", "resourceType": "Encounter", "attributes": ["status", "period"], "filter": [{"name": "status", "type": "code", "value": ["F", "O"]}]},
        {"name": "findings", "resourceType": "Condition", "attributes": ["price"]}]},
}


@register("cohort_groups", sql="""
WITH p AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender, n_name AS country, c_mktsegment,
         make_date(CAST(1940 + c_custkey % 60 AS INTEGER), CAST(1 + c_custkey % 12 AS INTEGER), CAST(1 + c_custkey % 28 AS INTEGER)) AS born
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
e AS (SELECT o_orderkey, o_orderstatus AS status, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS period, o_totalprice AS price,
             CAST(CASE WHEN o_orderkey % 97 = 5 THEN o_custkey + 1000000 ELSE o_custkey END AS VARCHAR) AS patient, CAST(o_custkey AS VARCHAR) AS owner FROM orders),
m AS (
  SELECT * FROM p WHERE date_sub('year', born, DATE '2020-01-01') BETWEEN 18 AND 65 AND (gender = 'female' OR country IN ('FRANCE', 'GERMANY'))
    AND (id IN (SELECT patient FROM e WHERE status = 'F') OR id IN (SELECT owner FROM e WHERE price >= 300000)) AND c_mktsegment <> 'BUILDING')
SELECT 'people' AS grp, id, CAST(NULL AS VARCHAR) AS patient, gender AS x, CAST(born AS VARCHAR) AS y FROM m
UNION ALL SELECT 'visits', CAST(o_orderkey AS VARCHAR), patient, status, period FROM e WHERE status IN ('F', 'O') AND patient IN (SELECT id FROM m)
UNION ALL SELECT 'findings', 'c' || o_orderkey, owner, CAST(CAST(price AS DECIMAL(18, 2)) AS VARCHAR), NULL FROM e WHERE owner IN (SELECT id FROM m)""")
def q_cohort_groups(spark, sf_dir):
    """AND of ORs over four types' frames, an exclusion, and one frame per
    attribute group."""
    from ndflow.plans.q_more import _encounters, _patients
    e = stored(_encounters(spark, sf_dir).withColumn("patient", F.regexp_extract("subject", r"^Patient/(.+)$", 1)), "encounters")
    o = FX.table(spark, sf_dir, "orders")
    c = FX.table(spark, sf_dir, "customer")
    frames = {"Patient": stored(_patients(spark, sf_dir), "patients"), "Encounter": e,
              "Condition": o.select(F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_custkey").cast("string").alias("patient"),
                                    F.col("o_totalprice").cast("decimal(18,2)").alias("price")),
              "Coverage": c.select(F.lit("v").alias("id"), F.col("c_custkey").cast("string").alias("patient"), F.col("c_mktsegment").alias("segment"))}
    g = extract_groups(frames, COHORT_TREE)
    none = F.lit(None).cast("string")
    people = g["people"].select(F.lit("people").alias("grp"), "id", none.alias("patient"), F.col("gender").alias("x"), F.col("birth_date").alias("y"))
    visits = g["visits"].select(F.lit("visits").alias("grp"), "id", "patient", F.col("status").alias("x"), F.col("period").alias("y"))
    findings = g["findings"].select(F.lit("findings").alias("grp"), "id", "patient", F.col("price").cast("string").alias("x"), none.alias("y"))
    return people.unionAll(visits).unionAll(findings)


# ---- T2: the ETA window by event time

@register("eta_events", sql=with_ctes(FX.SQL_PROGRESS, select=f"""
SELECT run_id, items AS n, CAST(len(w) AS INTEGER) AS window_samples,
       CASE WHEN len(w) >= 2 AND items - w[1].items > 0 AND (epoch_us(ts) - epoch_us(w[1].ts)) / 1e6 > 0
            THEN ((epoch_us(ts) - epoch_us(w[1].ts)) / 1e6) / (items - w[1].items) END AS avg_sec_per_item
FROM (
  SELECT run_id, ts, items,
         list_filter(list(struct_pack(ts := ts, items := items)) OVER (PARTITION BY run_id ORDER BY ts, seq
                     ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
                     lambda s: epoch_us(s.ts) > epoch_us(ts) - {12 * 3600 * 1_000_000}) AS w
  FROM progress)"""))
def q_eta_events(spark, sf_dir):
    """Samples arrive in files of random rows, a few files at a time, so
    every run's samples come in any order; the state store holds them until the
    watermark has passed.  A closing row ends the feed."""
    from ndflow.streaming.event_time import closing_sample, eta_events, event_samples, use_rocksdb
    from ndflow.streaming.progress import run_available
    s = FX.progress_samples(spark, sf_dir).select("run_id", "ts", "seq", "items", "bytes")
    src, sink, ckpt = _scratch(spark, "events-src"), _scratch(spark, "events-sink"), _scratch(spark, "events-ckpt")
    s.repartition(12, F.xxhash64("run_id", "seq")).write.mode("append").parquet(src)
    store = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    use_rocksdb(spark)
    try:
        run_available(eta_events(event_samples(spark, src, 6), "400 days", window_seconds=12 * 3600), sink, ckpt)
        closing_sample(spark, "2100-01-01 00:00:00").write.mode("append").parquet(src)
        run_available(eta_events(event_samples(spark, src, 6), "400 days", window_seconds=12 * 3600), sink, ckpt)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", store)
    return spark.read.parquet(sink).select("run_id", F.col("items").alias("n"), "window_samples", "avg_sec_per_item")
