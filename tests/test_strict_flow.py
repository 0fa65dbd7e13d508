"""Strict parsing, whole documents through the flow, large values, file
identity and pseudonyms beyond the fixtures."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from ndflow.functions.jsonfn import parse_status
from ndflow.operators import bundle as B
from ndflow.operators import deid as D
from ndflow.operators import quality as Q
from ndflow.operators.deid_doc import Deidentifier, deidentify_documents
from ndflow.plans.flow import import_directory, run_flow
from ndflow.sources import ndjson as N

# value -> status, written down by hand from the JSON grammar
STATUS = {
    '{"a":1}': "ok", ' {"a":[1,2]} ': "ok", "{}": "ok", '{"a":"x\\ty"}': "ok", '{"a":1e5,"b":-0.5}': "ok", '{"end":2,"v":3}': "ok",
    "[]": "not_object", '"s"': "not_object", "1": "not_object", "null": "not_object", "": "blank",
    "   ": "invalid_json", '{"a":1}]': "invalid_json", '{"a":1}] junk [': "invalid_json", "{'a':1}": "invalid_json", '{"a":"x\ty"}': "invalid_json",
    '{"a":1} trailing': "invalid_json", '{"a":1}{"b":2}': "invalid_json", '{"a":1},{"b":2}': "invalid_json", '{"a":1},"k":{}': "invalid_json",
    '{"a":1},"end":1': "invalid_json", '1,"end":1} [': "invalid_json", '{"a":01}': "invalid_json", '{"a":NaN}': "invalid_json", '{"a":1,}': "invalid_json",
    "{a:1}": "invalid_json", '{"a":1': "invalid_json", '{"a"}': "invalid_json", '{"a":1}//c': "invalid_json", '{"a":"\\x"}': "invalid_json",
}


def test_strict_status(spark):
    df = spark.createDataFrame([(k,) for k in STATUS], "value string")
    assert {r.value: r.s for r in df.select("value", parse_status(F.col("value")).alias("s")).collect()} == STATUS
    lines = df.select(F.lit("f").alias("file_name"), F.lit(1).cast("long").alias("line_no"), "value")
    got = {r.value: r.status for r in N.parse_lines(lines).collect()}
    for v, s in STATUS.items():
        assert got[v] == ("missing_resource_type" if s == "ok" else s)


def test_document_checks_are_strict(spark):
    bundle = '{"resourceType":"Bundle","id":"b-chunk-0","type":"collection","entry":[{"resource":{"resourceType":"X"}}]}'
    query = '{"cohortDefinition":{"inclusionCriteria":[]},"dataExtraction":{"attributeGroups":[]}}'
    cases = {t: None for t in ("", " ")} | {t: "bad" for t in (" trailing", "]", "] junk [", '{}')}
    for tail, bad in cases.items():
        r = spark.createDataFrame([(bundle + tail, query + tail)], "b string, q string").select(
            B.bundle_structure(F.col("b")).alias("p7"), Q.chunk_contract_error(F.col("b")).alias("p8"), Q.query_doc_error(F.col("q")).alias("p9")).first()
        assert [x is not None for x in r] == [bad is not None] * 3, tail


@pytest.mark.parametrize("path,ok", [("a/b.ndjson", True), ("import/../x", True), ("import/../../etc/x.ndjson", False), ("a/./../../x", False), ("/abs", False),
                                     ("../x", False), ("./x", True), ("a//b/../c", True), ("a/..b", True), ("..b/x", False), ("a/b/../../..", False), ("", True)])
def test_safe_path(spark, path, ok):
    assert spark.createDataFrame([(path,)], "p string").select(Q.safe_path(F.col("p"))).first()[0] is ok


def test_sequential_pseudonyms_stay_apart(spark):
    d = spark.range(120_000).select(F.lit("Patient").alias("resource_type"), F.format_string("patient-%06d", "id").alias("resource_id"))
    m = D.pseudonym_map(d, "k")
    assert m.select("sequential").distinct().count() == m.select("pseudonym").distinct().count() == 120_000
    assert m.filter("resource_id = 'patient-000000'").first().sequential == "PA_00001"
    assert m.filter("resource_id = 'patient-119999'").first().sequential == "PA_120000"


def test_references(spark):
    refs = ["Patient/1", "http://h/fhir/Patient/1", "Patient/1/_history/2", "https://h/fhir/Patient/1/_history/3", "urn:uuid:1", "#frag", "text", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(refs)], "i int, r string")
    got = [r[1] for r in df.select("i", D.pseudonymize_reference(F.col("r"), "k")).orderBy("i").collect()]
    p = spark.range(1).select(D.pseudonym(F.lit("Patient"), F.lit("1"), "k")).first()[0]
    assert got[:4] == [f"Patient/{p}", f"http://h/fhir/Patient/{p}", f"Patient/{p}/_history/2", f"https://h/fhir/Patient/{p}/_history/3"]
    assert got[4].startswith("urn:uuid:") and got[4] != "urn:uuid:1" and len(p) == 32 and got[5:] == refs[5:]
    own = Deidentifier("k")
    assert [own.link(r) if r else None for r in refs] == got


def test_key_is_not_in_the_plan(spark):
    df = spark.createDataFrame([("1",)], "id string").select(D.pseudonym(F.lit("Patient"), F.col("id"), "s3cr3t-key").alias("p"))
    plan = df._jdf.queryExecution().toString()
    df.collect()
    assert "s3cr3t-key" not in plan + df._jdf.queryExecution().toString()


def test_nested_documents_keep_fields(spark):
    patient = {"resourceType": "Patient", "id": "7", "gender": "female", "birthDate": "1950-02-03", "name": [{"family": "Doe"}], "multipleBirth": [1, 2.5],
               "address": [{"country": "DE", "postalCode": "12345", "line": ["x"]}, {"country": "FR"}], "identifier": [{"system": "s", "value": "M1"}, {"value": "M2"}],
               "meta": {"profile": ["p"]}, "managingOrganization": {"reference": "Organization/9", "display": "Doe clinic"}}
    bundle = {"resourceType": "Bundle", "id": "b", "type": "batch", "identifier": {"system": "x", "value": "B7"}, "link": [{"relation": "self"}],
              "entry": [{"fullUrl": "urn:uuid:7", "resource": patient}, {"resource": {"resourceType": "Observation", "id": "o", "subject": {"reference": "Patient/7"},
                                                                                    "valueQuantity": {"value": 1.5, "unit": "kg"}}}]}
    df = spark.createDataFrame([(json.dumps(bundle),), (json.dumps(patient),)], "value string")
    b, p = (json.loads(r.value) for r in deidentify_documents(df, "k").collect())
    own = Deidentifier("k")
    assert p["id"] == own.pseudonym("Patient", "7") and p["gender"] == "female" and p["birthDate"] == "1950" and p["multipleBirth"] == [1, 2.5]
    assert "name" not in p and [a.get("postalCode") for a in p["address"]] == ["123**", None] and len(p["identifier"]) == 2
    assert p["meta"]["profile"] == ["p"] and p["meta"]["security"][0]["code"] == "REDACTED" and "display" not in p["managingOrganization"]
    assert b["entry"][0]["resource"] == p and b["entry"][1]["resource"]["subject"]["reference"] == f"Patient/{p['id']}"
    assert b["entry"][1]["resource"]["valueQuantity"] == {"value": 1.5, "unit": "kg"} and b["link"] == [{"relation": "self"}] and b["type"] == "batch"
    text = json.dumps(b)
    assert "Doe" not in text and "M1" not in text and "B7" not in text and '"7"' not in text and "urn:uuid:7" not in text


@pytest.mark.parametrize("mib", [20, 30, 100])
def test_large_values_lose_nothing(tmp_dir, mib):
    """In a session of its own, with a stated heap (``large_values.py``)."""
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "large_values.py")
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--driver-memory 6g pyspark-shell"}
    r = subprocess.run([sys.executable, script, str(mib), tmp_dir], env=env, capture_output=True, text=True, timeout=900, check=False)
    assert r.returncode == 0 and r.stdout.strip().endswith("fine"), r.stdout[-2000:] + r.stderr[-2000:]


def test_equal_names_empty_files_and_landing(spark, tmp_dir):
    for d, n in (("a", 3), ("b", 2), ("c d", 0)):
        os.makedirs(f"{tmp_dir}/in/{d}")
        with open(f"{tmp_dir}/in/{d}/Patient x.ndjson", "w", newline="") as f:
            f.write("".join(f'{{"resourceType":"Patient","id":"{d}{i}"}}\r\n' for i in range(n))[:-2 if n == 2 else None])
    m = {r.file_path: r for r in import_directory(spark, tmp_dir + "/in", tmp_dir + "/land").collect()}
    assert {k: r.line_count for k, r in m.items()} == {"local_import/a/Patient x.ndjson": 3, "local_import/b/Patient x.ndjson": 2, "local_import/c d/Patient x.ndjson": 0}
    assert all(r.created_at is not None and r.file_name == "Patient x.ndjson" for r in m.values())
    for k, r in m.items():
        assert r.file_size == os.path.getsize(f"{tmp_dir}/in/{k[13:]}")
    back = N.read_ndjson(spark, tmp_dir + "/land", glob="*.txt")
    c = {r.rel_path: r for r in N.file_counts(N.parse_lines(back), ("rel_path",)).collect()}
    assert {k: r.n_lines for k, r in c.items()} == {"a/Patient x.ndjson": 3, "b/Patient x.ndjson": 2}
    assert {r.file_name for r in back.select("file_name").distinct().collect()} == {"Patient x.ndjson"}


def test_scan_prunes_files_and_numbers_on_demand(spark, tmp_dir):
    for n in ("a", "b"):
        with open(f"{tmp_dir}/{n}.ndjson", "w") as f:
            f.write("".join(f'{{"n":{i}}}\n' if i % 5 else "bad\n" for i in range(50)))
    one = N.read_ndjson(spark, tmp_dir, line_numbers=False, files=F.col("_metadata.file_name") == "a.ndjson")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 50 and "Exchange" not in plan and plan.count("FileScan text") == 1
    scan = N.scan_splits(spark, tmp_dir)
    bad = N.add_line_numbers(scan.filter("value = 'bad'"), scan)
    assert sorted((r.file_name, r.line_no) for r in bad.collect()) == [(f"{n}.ndjson", i + 1) for n in "ab" for i in range(0, 50, 5)]


def test_counts_stop_at_the_first_error_of_any_slice(spark):
    rows = [(f"f{k}", i, i == k or (k == 300 and i > 300 and i % 7 == 0)) for k in (1, 62, 63, 124, 300, 999) for i in range(1, 401)]
    df = spark.createDataFrame(rows, "file_name string, line_no long, bad boolean")
    df = df.select("file_name", "line_no", F.when(F.col("bad"), "x").otherwise('{"resourceType":"P"}').alias("value"))
    got = {r.file_name: (r.n_parsed_before_error, r.first_error_line, r.n_lines) for r in N.file_counts(N.parse_lines(df)).collect()}
    assert got == {f"f{k}": ((k - 1, k, 400) if k <= 400 else (400, None, 400)) for k in (1, 62, 63, 124, 300, 999)}


def test_flow_mixes_types_and_resumes(spark, tmp_dir):
    entry = lambda i, n: {"fullUrl": f"urn:uuid:e{i}", "resource": {"resourceType": "X", "id": f"e{i}", "p": "x" * n}}
    docs = [{"resourceType": "Patient", "id": "1", "gender": "male", "name": [{"family": "Doe"}]},
            {"resourceType": "Bundle", "id": "small", "type": "t", "entry": [entry(1, 10)]}, {"resourceType": "Bundle", "type": "t", "entry": []},
            {"resourceType": "Bundle", "id": "large", "type": "t", "meta": {"tag": [1]}, "entry": [entry(i, 300) for i in range(9)]},
            {"resourceType": "Bundle", "id": "over", "type": "t", "entry": [entry(1, 10), entry(2, 2000)]}, {"resourceType": "Y", "id": "y", "p": "x" * 2000}]
    rows = [("a.ndjson", i + 1, json.dumps(d)) for i, d in enumerate(docs)] + [("a.ndjson", 90, "   "), ("a.ndjson", 91, "{bad")]
    lines = spark.createDataFrame(rows, "file_name string, line_no long, value string")
    out = tmp_dir + "/out"
    paths = run_flow(lines, "k", 1000, out)
    got = {d.get("type", "") + str(len(d.get("entry", []))): d for d in (json.loads(r.value) for r in spark.read.text(paths["ndjson"]).collect())}
    assert len(got) == 4 and len(got["t9"]["entry"]) == 9 and got["t9"]["meta"]["tag"] == [1] and len(got["t1"]["entry"]) == 1 and "id" not in got["t0"]
    assert got["0"]["gender"] == "male" and "Doe" not in json.dumps(got)
    over = {(r.over_type, r.over_id) for r in spark.read.parquet(paths["oversized"]).collect()}
    assert over == {("X", "e2"), ("Y", "y")}
    assert spark.read.parquet(paths["rejects"]).count() == 1
    led = spark.read.parquet(paths["ledger"]).first()
    assert (led.lines, led.blank, led.rejected, led.oversized, led.accepted, led.bundle_split, led.bundle_direct) == (8, 1, 1, 2, 4, 1, 2)
    assert led.chunks > 4 and led.status == "completed_with_rejects"
    assert spark.read.parquet(paths["parquet_Patient"]).select("gender").first().gender == "male"
    # a second run sees the first file again and a new one: only the new one is processed, nothing is lost
    more = lines.unionAll(spark.createDataFrame([("b.ndjson", 1, '{"resourceType":"Patient","id":"2","gender":"female"}')], lines.schema))
    before = {r.f for r in spark.read.text(paths["ndjson"]).select(F.input_file_name().alias("f")).collect()}
    run_flow(more, "k", 1000, out)
    after = {r.f for r in spark.read.text(paths["ndjson"]).select(F.input_file_name().alias("f")).collect()}
    assert before < after and spark.read.parquet(paths["parquet"]).count() == 5 and spark.read.parquet(paths["ledger"]).count() == 2
    assert spark.read.option("header", True).csv(paths["csv"]).count() == 5 and spark.read.parquet(paths["rejects"]).count() == 1


def test_eta_stream_over_many_files_in_any_order(spark, tmp_dir):
    from ndflow.operators.progress import eta_window
    from ndflow.streaming.progress import eta_stream, run_available, samples_from
    rows = [(1 + i % 2, f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", i, i // 2 + 1, 0) for i in range(110)]
    df = spark.createDataFrame(rows, "run_id long, t string, seq long, items long, bytes long").select(
        "run_id", F.col("t").cast("timestamp_ntz").alias("ts"), "seq", "items", "bytes")
    for part in (df.filter("seq >= 55"), df.filter("seq < 55")):  # the later half arrives first
        part.repartition(55).write.mode("append").parquet(tmp_dir + "/src")
    run_available(eta_stream(samples_from(spark, tmp_dir + "/src")), tmp_dir + "/sink", tmp_dir + "/ck")
    got = {(r.run_id, r.items): (r.window_samples, r.avg_sec_per_item) for r in spark.read.parquet(tmp_dir + "/sink").collect()}
    want = {(r.run_id, r.items): (r.window_samples, r.avg_sec_per_item) for r in eta_window(df.withColumn("n", F.col("items"))).collect()}
    assert got == want and len(got) == 110
