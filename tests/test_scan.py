"""NDJSON scan: discovery, line numbers across splits, malformed lines."""

import json
import os

from pyspark.sql import functions as F

from ndflow.sources import ndjson as N


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_recursive_case_insensitive_discovery(spark, tmp_dir):
    write(f"{tmp_dir}/a/Patient_1.ndjson", ['{"resourceType":"Patient","id":"1"}'])
    write(f"{tmp_dir}/b/c/Obs #2.NDJSON", ['{"resourceType":"Observation","id":"2"}'])
    write(f"{tmp_dir}/notes.txt", ["ignored"])
    df = N.read_ndjson(spark, tmp_dir)
    assert sorted(r.file_name for r in df.collect()) == ["Obs #2.NDJSON", "Patient_1.ndjson"]


def test_check_source(spark, tmp_dir):
    assert N.check_source(spark, tmp_dir) == "directory holds no .ndjson files"
    assert N.check_source(spark, tmp_dir + "/missing").startswith("source does not exist")
    write(f"{tmp_dir}/x/a.NDJSON", ["{}"])
    assert N.check_source(spark, tmp_dir) is None
    assert "single file" in N.check_source(spark, f"{tmp_dir}/x/a.NDJSON")


def test_line_numbers_across_many_splits(spark, tmp_dir):
    lines = [json.dumps({"resourceType": "Patient", "id": str(i), "pad": "p" * (i % 50)}) for i in range(5000)]
    write(f"{tmp_dir}/big.ndjson", lines)
    write(f"{tmp_dir}/small.ndjson", lines[:10])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")  # force many splits of one file
    try:
        df = N.read_ndjson(spark, tmp_dir)
        assert df.rdd.getNumPartitions() > 5
        got = {(r.file_name, r.line_no): r.value for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for i, line in enumerate(lines, start=1):
        assert got[("big.ndjson", i)] == line
    assert len([k for k in got if k[0] == "small.ndjson"]) == 10


def test_parse_statuses(spark):
    vals = ['{"resourceType":"Patient","id":"1"}', "", "   ", '{"resourceType":"Patient"', "[1,2]",
            '{"id":"x"}', '{"resourceType":5}', '{"resourceType":"P","id":7}', '{"resourceType":"P"} trailing',
            '{"a":1}{"b":2}', '{"resourceType":"P","id":"a","resourceType":"Q"}']
    df = spark.createDataFrame([("f.ndjson", i + 1, v) for i, v in enumerate(vals)], "file_name string, line_no long, value string")
    p = {r.line_no: r for r in N.parse_lines(df).collect()}
    st = [p[i + 1].status for i in range(len(vals))]
    assert st[:10] == ["ok", "blank", "invalid_json", "invalid_json", "not_object", "missing_resource_type",
                       "bad_resource_type", "bad_id", "invalid_json", "invalid_json"]
    assert p[1].resource_id == "1" and p[6].resource_id == "x"
    assert st[10] == "ok" and p[11].resource_type == "Q"  # duplicate key: last one wins
    assert p[3].blank_trimmed and not p[3].parsed
    q = N.quarantine(N.parse_lines(df))
    assert q.filter(F.col("error_kind") == "blank").count() == 0 and q.count() == 8


def test_file_counts_failfast_point(spark):
    vals = ['{"resourceType":"A"}', "", '{"resourceType":"A"}', "{bad", '{"resourceType":"A"}']
    df = spark.createDataFrame([("f.ndjson", i + 1, v) for i, v in enumerate(vals)], "file_name string, line_no long, value string")
    r = N.file_counts(N.parse_lines(df)).collect()[0]
    assert (r.n_lines, r.n_nonblank, r.n_parsed, r.first_error_line, r.n_parsed_before_error) == (5, 4, 3, 4, 2)


def test_name_to_type(spark):
    names = ["Patient_001.ndjson", "Observation-x.ndjson", "__.ndjson", "Encounter.part.ndjson", ".ndjson"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(N.name_to_type(F.col("n"))).collect()]
    assert got == ["Patient", "Observation", "Unknown", "Encounter", "Unknown"]


def test_line_numbers_without_broadcast_match(spark, tmp_dir):
    lines = [json.dumps({"resourceType": "P", "id": str(i)}) for i in range(3000)]
    write(f"{tmp_dir}/a.ndjson", lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        a = {(r.line_no, r.value) for r in N.read_ndjson(spark, tmp_dir).collect()}
        b = {(r.line_no, r.value) for r in N.read_ndjson(spark, tmp_dir, broadcast_limit_bytes=0).collect()}
        plan = N.read_ndjson(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert a == b and len(a) == 3000 and "Broadcast" in plan


def test_empty_input_and_failfast(spark, tmp_dir):
    os.makedirs(tmp_dir + "/sub")
    write(f"{tmp_dir}/notes.txt", ["x"])
    df = N.read_ndjson(spark, tmp_dir)
    assert df.count() == 0 and "line_no" in df.columns
    lines = spark.createDataFrame([("f.ndjson", 1, '{"resourceType":"A"}'), ("f.ndjson", 2, "{bad")],
                                  "file_name string, line_no long, value string")
    try:
        N.parse_lines(lines, mode="failfast").collect()
        assert False, "failfast should stop on the bad line"
    except Exception as e:  # noqa: BLE001
        assert "file f.ndjson line 2: failed to parse JSON" in str(e)
    assert N.parse_lines(lines).count() == 2


def test_line_beyond_variant_limit_is_classified(spark, tmp_dir):
    big = json.dumps({"resourceType": "Bundle", "id": "huge", "type": "collection",
                      "entry": [{"resource": {"resourceType": "X", "id": str(i), "pad": "p" * 2000}} for i in range(10_000)]})
    assert len(big) > 17 * 1024 * 1024
    write(f"{tmp_dir}/big.ndjson", [big, '{"resourceType":"A"}'])
    p = {r.line_no: r for r in N.parse_lines(N.read_ndjson(spark, tmp_dir)).collect()}
    assert p[1].status == "ok" and p[1].resource_type == "Bundle" and p[1].resource_id == "huge"
    from ndflow.operators import bundle as B
    b = B.bundles_from_lines(N.read_ndjson(spark, tmp_dir).filter("line_no = 1")).collect()[0]
    assert len(b.entries) == 10_000


def test_streaming_status_agrees_with_variant_parse(spark):
    from ndflow.functions.jsonfn import parse_status, strict_parse
    vals = ['{"a":1}', " {\"a\":1} ", "", "  ", "[1]", '"s"', "5", "null", '{"a":1} x', '{"a":1},{"b":2}',
            '{"a":[1,{"b":null}]}', '{"a":', "{}", '{"a":1}{"a":2}', '\t{"k":"v"}\n']
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    rows = df.select(parse_status(F.col("v")).alias("a"), strict_parse(F.col("v"))[1].alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]
