"""E1 over runs: file versions, replaced output, one pass, failures, validation."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from ndflow.operators.deid import Retry
from ndflow.plans import flow
from ndflow.plans.flow import read_output, run_directory
from ndflow.sources import ndjson as N


def put(folder, rel, docs, mtime=None):
    path = f"{folder}/{rel}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("".join((d if isinstance(d, str) else json.dumps(d)) + "\n" for d in docs))
    if mtime:
        os.utime(path, (mtime, mtime))


def patient(i, **more):
    return {"resourceType": "Patient", "id": str(i), "gender": "male", "identifier": [{"system": "a", "value": f"x{i}"}, {"system": "b", "value": f"y{i}"}], **more}


def rows(spark, paths, sink):
    if sink == "ndjson":
        return sorted(spark.read.text(paths[sink]).select(F.url_decode("output_file")).toPandas().iloc[:, 0])
    df = spark.read.option("header", True).csv(paths[sink]) if sink.startswith("csv") else spark.read.parquet(paths[sink])
    return sorted(r.rel_path for r in df.select("rel_path").collect())


def test_equal_names_stay_apart(spark, tmp_dir):
    src, out = tmp_dir + "/in", tmp_dir + "/out"
    put(src, "a/x.ndjson", [patient(1), patient(2)])
    run_directory(spark, src, "k", 1000, out)
    put(src, "b/x.ndjson", [patient(3)])
    paths = run_directory(spark, src, "k", 1000, out)
    assert rows(spark, paths, "ndjson") == ["a/dimped_x.ndjson"] * 2 + ["b/dimped_x.ndjson"]
    for sink in ("parquet", "csv", "parquet_Patient", "csv_Patient"):
        assert rows(spark, paths, sink) == ["a/x.ndjson"] * 2 + ["b/x.ndjson"], sink
    assert rows(spark, paths, "csv_Patient_identifier") == ["a/x.ndjson"] * 4 + ["b/x.ndjson"] * 2
    assert rows(spark, paths, "ledger") == ["a/x.ndjson", "b/x.ndjson"]
    assert sorted((r.rel_path, r.line_no) for r in spark.read.parquet(paths["parquet"]).collect()) == [("a/x.ndjson", 1), ("a/x.ndjson", 2), ("b/x.ndjson", 1)]


def test_repaired_files_leave_nothing_old(spark, tmp_dir):
    src, out = tmp_dir + "/in", tmp_dir + "/out"
    put(src, "a.ndjson", [patient(1), "{bad", patient(2)], 1000)
    put(src, "b.ndjson", [patient(3), "[1]"], 1000)
    run_directory(spark, src, "k", 1000, out)
    put(src, "a.ndjson", [{"resourceType": "Encounter", "id": "9"}, {"resourceType": "Encounter", "id": "8"}], 2000)
    paths = run_directory(spark, src, "k", 1000, out)
    for read in (lambda s: rows(spark, paths, s), lambda s: sorted(r.rel_path for r in read_output(spark, out, s).collect())):
        assert read("rejects") == ["b.ndjson"] and read("parquet_Patient") == ["b.ndjson"] and read("csv_Patient") == ["b.ndjson"]
        assert read("parquet_Encounter") == ["a.ndjson"] * 2 and read("parquet") == ["a.ndjson", "a.ndjson", "b.ndjson"] and read("ledger") == ["a.ndjson", "b.ndjson"]
    assert rows(spark, paths, "ndjson") == ["dimped_a.ndjson", "dimped_a.ndjson", "dimped_b.ndjson"]
    assert {r.rel_path: (r.generation, r.rejected, r.status) for r in spark.read.parquet(paths["ledger"]).collect()} == {
        "a.ndjson": (2, 0, "completed"), "b.ndjson": (1, 1, "completed_with_rejects")}
    # nothing to do: nothing changes, and an emptied file is known as empty
    before = {f for f in os.listdir(out + "/records")}
    run_directory(spark, src, "k", 1000, out)
    assert {f for f in os.listdir(out + "/records")} == before
    put(src, "b.ndjson", [], 3000)
    paths = run_directory(spark, src, "k", 1000, out)
    assert rows(spark, paths, "parquet") == ["a.ndjson"] * 2 and {r.rel_path: r.status for r in spark.read.parquet(paths["ledger"]).collect()} == {
        "a.ndjson": "completed", "b.ndjson": "empty"}
    run_directory(spark, src, "k", 1000, out)
    assert len(os.listdir(out + "/records")) == len(before) + 0


def test_one_scan_and_one_rewrite(spark, tmp_dir, monkeypatch):
    """The source is gone once ``records`` is written, and every document met
    the de-identifier exactly once."""
    src, out = tmp_dir + "/in", tmp_dir + "/out"
    put(src, "a.ndjson", [patient(i) for i in range(50)] + ["{bad", ""])
    calls = spark.sparkContext.accumulator(0)

    def deid(doc):
        calls.add(1)
        return {k: v for k, v in doc.items() if k != "name"}

    write = flow._write_sinks

    def after_scan(*args, **more):
        shutil.rmtree(src)
        return write(*args, **more)

    monkeypatch.setattr(flow, "_write_sinks", after_scan)
    paths = run_directory(spark, src, "k", 1000, out, external=deid)
    assert calls.value == 50 and spark.read.text(paths["ndjson"]).count() == 50 and spark.read.parquet(paths["rejects"]).first().line_no == 51


def test_failures_are_rows(spark, tmp_dir):
    """D5/D6 in the flow: a document that fails is a reject without text, a
    passing error is tried again, and the others go on."""
    src, out = tmp_dir + "/in", tmp_dir + "/out"
    put(src, "a.ndjson", [patient(1), patient(2), patient(3), patient(4)])
    seen = {}

    def deid(doc):
        if doc["id"] == "2":
            raise ValueError("no")
        if doc["id"] == "3":
            raise TimeoutError("busy")
        if doc["id"] == "4" and not seen.setdefault("4", 0):
            seen["4"] = 1
            raise ConnectionError("once")
        return doc

    paths = run_directory(spark, src, "k", 1000, out, external=deid, retry=Retry(3, 1, 2))
    got = {(r.line_no, r.error_kind, r.value) for r in spark.read.parquet(paths["rejects"]).collect()}
    assert got == {(2, "deidentify_non_transient", None), (3, "deidentify_transient", None)}
    led = spark.read.parquet(paths["ledger"]).first()
    assert (led.lines, led.failed, led.accepted, led.status) == (4, 2, 2, "completed_with_rejects")
    rec = {r.resource_id: r.deid_attempts for r in spark.read.parquet(paths["records"]).collect()}
    assert rec == {"1": 1, "2": 1, "3": 3, "4": 2}


def test_a_broken_run_is_cleared(spark, tmp_dir, monkeypatch):
    src, out = tmp_dir + "/in", tmp_dir + "/out"
    put(src, "a.ndjson", [patient(1)])
    run_directory(spark, src, "k", 1000, out)
    put(src, "b.ndjson", [patient(2), "{bad", {"resourceType": "Odd", "id": "o"}])
    with monkeypatch.context() as m:
        m.setattr(flow, "_validate", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run_directory(spark, src, "k", 1000, out)
    assert spark.read.parquet(out + "/rejects").count() == 1  # left behind, but not shown
    assert read_output(spark, out, "rejects").count() == 0 and read_output(spark, out, "parquet").count() == 1
    put(src, "b.ndjson", [patient(2)], 5000)
    paths = run_directory(spark, src, "k", 1000, out)
    assert spark.read.parquet(paths["rejects"]).count() == 0 and rows(spark, paths, "ndjson") == ["dimped_a.ndjson", "dimped_b.ndjson"]
    assert not [f for f in os.listdir(out + "/nested_Odd") if f.startswith("generation")]


def test_validation_covers_all_current_files(spark, tmp_dir):
    src, out = tmp_dir + "/in", tmp_dir + "/out"
    put(src, "enc.ndjson", [{"resourceType": "Encounter", "id": "e1", "subject": {"reference": "Patient/1"}},
                            {"resourceType": "Encounter", "participant": [{"actor": {"reference": "Patient/2"}}, {"actor": {"reference": "#c"}}],
                             "contained": [{"resourceType": "X", "id": "c"}]}], 1000)
    paths = run_directory(spark, src, "k", 1000, out)
    assert {r.path for r in spark.read.parquet(paths["dangling"]).collect()} == {"Encounter.subject", "Encounter.participant.actor"}
    assert [tuple(r) for r in spark.read.parquet(paths["missing"]).select("resource_type", "field", "n_missing", "n_rows").collect()] == [("Encounter", "id", 1, 2)]
    put(src, "pat.ndjson", [patient(1)], 1000)
    paths = run_directory(spark, src, "k", 1000, out, required={"Patient": ["birthDate", "identifier.value"], "*": []})
    assert {r.path for r in spark.read.parquet(paths["dangling"]).collect()} == {"Encounter.participant.actor"}
    assert {(r.resource_type, r.field) for r in spark.read.parquet(paths["missing"]).collect()} == {("Encounter", "id"), ("Patient", "birthDate")}


def test_odd_file_names_and_many_splits(spark, tmp_dir):
    """Line numbers through several splits; names with glob characters and blanks."""
    src, out = tmp_dir + "/in", tmp_dir + "/out"
    put(src, "sub [1]/x {a}%20.ndjson", [patient(i) if i % 100 else "{bad" for i in range(4000)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        paths = run_directory(spark, src, "k", 1000, out, flat_types=())
        assert sorted(r.line_no for r in spark.read.parquet(paths["rejects"]).collect()) == list(range(1, 4001, 100))
        assert rows(spark, paths, "ledger") == ["sub [1]/x {a}%20.ndjson"]
        # a split table over the limit: files in groups, no shuffle of text, same numbers
        for i in range(5):
            put(tmp_dir + "/many", f"f{i}.ndjson", [f'{{"n":{j}}}' for j in range(300 + i)])
        some = N.read_ndjson(spark, tmp_dir + "/many", broadcast_limit_bytes=4096)
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") > 1
        whole = N.read_ndjson(spark, tmp_dir + "/many")
        key = lambda df: sorted((r.file_name, r.line_no, r.value) for r in df.collect())
        assert key(some) == key(whole) and len(key(some)) == 1510
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_metamorphic_check_fails_when_a_path_differs(spark):
    from ndflow.plans import fixtures as FX
    from ndflow.plans.q_flow import metamorphic
    b = FX.order_bundles(spark, "/root/testdata/sf0.001")
    same = metamorphic(b, FX.FX_ORDERS_THRESHOLD, "k")
    assert same.filter("not equal or not all_chunks or leaks").count() == 0 and same.filter("chunks > 1").count() > 10
    for change in ({"chunk_rules": {"Claim": {"status": "drop"}}}, {"whole_rules": {"Claim": {"quantity": "keep"}}}):
        x = metamorphic(b, FX.FX_ORDERS_THRESHOLD, "k", **change)
        assert x.filter("equal and entry_count > 0").count() == 0
    kept = metamorphic(b, FX.FX_ORDERS_THRESHOLD, "k", chunk_rules={"*": {"id": "keep"}})
    assert kept.filter("not leaks and entry_count > 0").count() == 0
