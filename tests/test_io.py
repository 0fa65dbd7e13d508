"""Sinks, streaming resume, extraction parsing and downloads."""

import json
import os
import urllib.error

from pyspark.sql import functions as F

from ndflow.sinks.files import write_ndjson
from ndflow.sources.fetch import extraction_urls, fetch
from ndflow.sources.ndjson import read_ndjson
from ndflow.streaming.ingest import ingest_available


def test_ndjson_write_read_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("a.ndjson", '{"b":1, "a":"x"}'), ("b.ndjson", '{"id":"2"}')], "f string, value string")
    write_ndjson(df, tmp_dir + "/out", partition_col="f")
    back = read_ndjson(spark, tmp_dir + "/out", glob="*.txt").collect()
    assert sorted(r.value for r in back) == ['{"a":"x","b":1}', '{"id":"2"}']
    assert {"f=a.ndjson", "f=b.ndjson"} <= set(os.listdir(tmp_dir + "/out"))
    assert not [n for n in os.listdir(tmp_dir + "/out") if n.startswith("_temporary")]


def test_stream_rerun_adds_nothing(spark, tmp_dir):
    src, sink, ck = tmp_dir + "/src", tmp_dir + "/sink", tmp_dir + "/ck"
    os.makedirs(src)
    for i in range(2):
        with open(f"{src}/f{i}.ndjson", "w") as f:
            f.write('{"resourceType":"A"}\n{"resourceType":"B"}\n')
    assert ingest_available(spark, src, sink, ck) == 4
    assert ingest_available(spark, src, sink, ck) == 0
    with open(f"{src}/f9.NDJSON", "w") as f:
        f.write('{"resourceType":"C"}\n')
    assert ingest_available(spark, src, sink, ck) == 1
    assert spark.read.parquet(sink).count() == 5


def test_extraction_dialects(spark):
    docs = [
        (1, json.dumps({"resourceType": "Parameters", "parameter": [
            {"name": "output", "part": [{"name": "type", "valueCode": "Patient"}, {"name": "url", "valueUrl": "/r/1.ndjson"}]},
            {"name": "other", "part": [{"name": "url", "valueUrl": "/x"}]}]})),
        (2, json.dumps({"output": [{"type": "A", "url": "http://torch:8080/r/2.ndjson"}, {"type": "B", "url": ""}], "error": []})),
        (3, json.dumps({"output": [], "error": [{"code": "x"}]})),
        (4, json.dumps({"resourceType": "Parameters", "parameter": []})),
        (5, json.dumps({"something": 1})),
        (6, "{not json"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, doc string")
    out = {}
    for r in extraction_urls(df, "https://base.org").collect():
        out.setdefault(r.doc_id, []).append((r.url, r.status))
    assert out[1] == [("https://base.org/r/1.ndjson", "ok")]
    assert out[2] == [("https://base.org/r/2.ndjson", "ok")]
    assert out[3] == [(None, "empty_with_errors")] and out[4] == [(None, "empty")]
    assert out[5] == [(None, "unknown_format")] and out[6] == [(None, "invalid_json")]


def test_fetch_retries_transient_then_fails_fast(spark, tmp_dir):
    calls = {}

    def fetcher(url):
        calls[url] = calls.get(url, 0) + 1
        if url == "ok":
            return b'{"a":1}\n\n{"b":2}\n'
        if url == "flaky" and calls[url] < 2:
            raise OSError("connection reset by peer")
        if url == "flaky":
            return b"{}\n"
        raise urllib.error.HTTPError(url, 404, "not found", None, None)

    urls = spark.createDataFrame([("ok", "a.ndjson"), ("flaky", "b.ndjson"), ("missing", "c.ndjson")],
                                 "url string, file_name string")
    got = {r.url: r for r in fetch(urls, tmp_dir + "/dl", fetcher, initial_ms=1).collect()}
    assert (got["ok"].status, got["ok"].line_count) == ("ok", 2)
    assert (got["flaky"].status, got["flaky"].attempts) == ("ok", 2)
    assert (got["missing"].status, got["missing"].attempts, got["missing"].http_status) == ("failed", 1, 404)
    assert sorted(r.value for r in spark.read.text(got["ok"].file_path).collect()) == ["", '{"a":1}', '{"b":2}']
    # a later failure, and another URL with a taken name, leave earlier files alone
    again = spark.createDataFrame([("missing", "a.ndjson"), ("flaky", "b.ndjson"), ("ok", "b.ndjson")], "url string, file_name string")
    fetch(again, tmp_dir + "/dl", fetcher, initial_ms=1).collect()
    assert spark.read.text(got["ok"].file_path).count() == 3
    assert spark.read.text(tmp_dir + "/dl/file_name=b.ndjson").count() == 4
    assert not os.path.exists(tmp_dir + "/dl/file_name=c.ndjson")


def test_a_url_listed_twice_lands_once(spark, tmp_dir):
    from ndflow.sources.fetch import fetch
    urls = spark.createDataFrame([("u", "f"), ("u", "f"), ("u", "g"), ("v", "f")], "url string, file_name string")
    got = {(r.url, r.file_name): r.line_count for r in fetch(urls, tmp_dir + "/dl", lambda u: b"1\n2\n3\n").collect()}
    assert got == {("u", "f"): 3, ("u", "g"): 3, ("v", "f"): 3} and spark.read.text(tmp_dir + "/dl").count() == 9


def test_lines_of_a_broken_attempt_do_not_count(spark, tmp_dir):
    from ndflow.sources.fetch import fetch
    tries = {}

    def breaks_once(url):
        tries[url] = tries.get(url, 0) + 1
        yield b'{"a":1}\n'
        if tries[url] == 1:
            raise OSError("connection reset by peer")
        yield b'{"a":2}'

    r = fetch(spark.createDataFrame([("u", "f")], "url string, file_name string"), tmp_dir + "/dl", breaks_once, initial_ms=1).first()
    assert (r.status, r.attempts, r.line_count, r.file_size) == ("ok", 2, 2, 15)
    assert spark.read.text(tmp_dir + "/dl").count() == 2


def test_run_flow_writes_every_sink(spark, tmp_dir):
    from ndflow.plans.flow import run_flow
    vals = ['{"id":"1","resourceType":"Note","source":"s","text":"hello"}', "", "{bad",
            '{"id":"2","resourceType":"Note","source":"s","text":"' + "x" * 500 + '"}']
    lines = spark.createDataFrame([("f.ndjson", i + 1, v) for i, v in enumerate(vals)],
                                  "file_name string, line_no long, value string")
    paths = run_flow(lines, "k", 300, tmp_dir + "/out")
    docs = [json.loads(r.value) for r in spark.read.text(paths["ndjson"]).collect()]
    assert len(docs) == 1 and docs[0]["id"] != "1" and docs[0]["meta"]["security"][0]["code"] == "REDACTED"
    assert spark.read.parquet(paths["rejects"]).count() == 1
    assert spark.read.parquet(paths["oversized"]).count() == 1
    assert spark.read.option("header", True).csv(paths["csv"]).count() == 1
    assert spark.read.parquet(paths["parquet"]).select("resource_type").collect()[0][0] == "Note"
    assert os.listdir(paths["ndjson"]) and any(n.startswith("output_file=dimped_f.ndjson") for n in os.listdir(paths["ndjson"]))


def test_import_directory(spark, tmp_dir):
    from ndflow.plans.flow import import_directory
    os.makedirs(tmp_dir + "/in/sub")
    with open(tmp_dir + "/in/Patient_a.ndjson", "w") as f:
        f.write('{"resourceType":"Patient"}\n\n{"resourceType":"Patient"}\n')
    with open(tmp_dir + "/in/sub/Observation.NDJSON", "w") as f:
        f.write('{"resourceType":"Observation"}\n')
    m = {r.file_name: r for r in import_directory(spark, tmp_dir + "/in", tmp_dir + "/out").collect()}
    assert m["Patient_a.ndjson"].line_count == 2 and m["Patient_a.ndjson"].resource_type == "Patient"
    assert m["Patient_a.ndjson"].file_size == os.path.getsize(tmp_dir + "/in/Patient_a.ndjson")
    assert m["Observation.NDJSON"].line_count == 1
    assert spark.read.text(tmp_dir + "/out").count() == 4
    try:
        import_directory(spark, tmp_dir + "/out", tmp_dir + "/out2")
        assert False
    except ValueError as e:
        assert "no .ndjson" in str(e)


def test_readme_walkthrough(spark, tmp_dir):
    """The README usage example, end to end on a small directory."""
    from pyspark.sql import functions as F

    from ndflow.operators import bundle as B
    from ndflow.plans.flow import import_directory, run_flow
    from ndflow.sources.ndjson import file_counts, parse_lines, quarantine

    os.makedirs(tmp_dir + "/export")
    with open(tmp_dir + "/export/Bundle_1.ndjson", "w") as f:
        f.write(json.dumps({"resourceType": "Bundle", "id": "b1", "type": "collection",
                            "entry": [{"resource": {"resourceType": "X", "id": str(i), "p": "x" * 300}}
                                      for i in range(20)]}) + "\n")
        f.write('{"resourceType":"Note","id":"n1","source":"s","text":"hi"}\n{bad\n')
    assert import_directory(spark, tmp_dir + "/export", tmp_dir + "/import").count() == 1
    lines = read_ndjson(spark, tmp_dir + "/import", glob="*.txt")
    parsed = parse_lines(lines)
    assert quarantine(parsed).count() == 1 and file_counts(parsed).count() == 1
    bundles = B.bundles_from_lines(parsed.filter(F.col("resource_type") == "Bundle"))
    chunks = B.chunk_rows(B.split_bundles(bundles, threshold=2000))
    assert chunks.count() > 1
    whole = B.reassemble(chunks).collect()[0]
    assert whole.entry_count == 20 and json.loads(whole.document)["id"] == "b1"
    paths = run_flow(lines, secret="k", threshold=1 << 20, out_dir=tmp_dir + "/out")
    assert spark.read.text(paths["ndjson"]).count() == 2
