"""Bundle split / pack / reassemble: boundary cases of the reference tests."""

import json

from pyspark.sql import functions as F

from ndflow.operators import bundle as B

SCHEMA = "bundle_id string, bundle_type string, timestamp string, entries array<string>"


def entry(i, pad=0):
    return json.dumps({"fullUrl": f"urn:uuid:c-{i}",
                       "resource": {"id": f"c-{i}", "padding": "x" * pad, "resourceType": "Condition"}},
                      separators=(",", ":"), sort_keys=True)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def greedy(sizes, threshold, overhead=200):
    """Brute-force reference of the packing rule (plain Python)."""
    chunks, cur, size = [], [], 0
    for i, s in enumerate(sizes):
        if s + overhead > threshold:
            return "oversized"
        if cur and size + s + overhead > threshold:
            chunks.append(cur)
            cur, size = [], 0
        cur.append(i)
        size += s
    if cur:
        chunks.append(cur)
    return chunks


def test_small_bundle_is_one_chunk(spark):
    df = frame(spark, [("b1", "collection", None, [entry(1), entry(2)])])
    s = B.split_bundles(df, 10_000).collect()[0]
    assert s.status == "ok" and not s.was_split and s.total_chunks == 1


def test_size_exactly_at_threshold_is_not_split(spark):
    df = frame(spark, [("b1", "collection", None, [entry(i, pad=100) for i in range(5)])])
    size = B.split_bundles(df, 10_000).collect()[0].original_size
    assert not B.split_bundles(df, size).collect()[0].was_split
    assert B.split_bundles(df, size - 1).collect()[0].was_split


def test_packing_matches_brute_force_and_keeps_order(spark):
    entries = [entry(i, pad=(i * 37) % 300) for i in range(60)]
    df = frame(spark, [("b1", "collection", None, entries)])
    t = 900
    ch = B.chunk_rows(B.split_bundles(df, t)).orderBy("chunk_index").collect()
    sizes = [len(e.encode()) for e in entries]
    want = greedy(sizes, t)
    got = [list(range(r.first_index, r.first_index + r.n_entries)) for r in ch]
    assert got == want
    flat = [e for r in ch for e in r.chunk_entries]
    assert flat == entries
    for r in ch:  # every chunk within budget by the packing formula
        assert sum(sizes[i] for i in range(r.first_index, r.first_index + r.n_entries)) + 200 <= t or r.n_entries == 1


def test_one_oversized_entry_fails_bundle(spark):
    df = frame(spark, [("b1", "collection", None, [entry(1), entry(2, pad=2000), entry(3)])])
    s = B.split_bundles(df, 1000).collect()[0]
    assert s.status == "oversized"
    assert s.error_resource_type == "Condition" and s.error_resource_id == "c-2"
    assert B.chunk_rows(B.split_bundles(df, 1000)).count() == 0


def test_empty_and_missing_id(spark):
    rows = [("b1", "collection", None, []), (None, "collection", None, [entry(1)])]
    df = frame(spark, rows)
    st = {r.bundle_id: (r.status, r.total_chunks) for r in B.split_bundles(df, 1000).collect()}
    assert st == {"b1": ("ok", 1), None: ("ok", 1)}  # within the budget: as they are
    st = {r.bundle_id: r.status for r in B.split_bundles(df, 10).collect()}
    assert st == {"b1": "empty", None: "invalid"}
    stats = {r.bundle_id: tuple(r)[2:] for r in B.chunk_stats(B.chunk_rows(B.split_bundles(df, 10), keep_failed=True)).collect()}
    assert stats == {"b1": (0, 0, 0, 0, 0), None: (0, 0, 0, 0, 0)}


def test_other_fields_count_and_survive(spark):
    doc = {"resourceType": "Bundle", "id": "b", "type": "batch", "meta": {"tag": ["<x>"]}, "identifier": {"value": "B7"}, "link": [{"u": 1}],
           "entry": [json.loads(entry(i, pad=100)) for i in range(6)]}
    small = {"resourceType": "Bundle", "type": "batch", "entry": []}
    lines = spark.createDataFrame([("f", 1, json.dumps(doc, indent=1).replace("\n", " ")), ("f", 2, json.dumps(small))], "file_name string, line_no long, value string")
    b = B.bundles_from_lines(lines)
    split = B.split_bundles(b, 600)
    size = {r.bundle_id: r.original_size for r in split.collect()}
    canon = lambda d: json.dumps(d, sort_keys=True, separators=(",", ":"))
    assert size == {"b": len(canon(doc)) + 10, "f:2": len(canon(small))}
    back = {r.bundle_id: r for r in B.reassemble(B.chunk_rows(split)).collect()}
    assert back["b"].was_reassembled and json.loads(back["b"].document) == doc and json.loads(back["f:2"].document) == small
    ch = B.chunk_rows(split).filter("bundle_id = 'b'")
    assert all(json.loads(r.d)["meta"] == doc["meta"] for r in ch.select(B.chunk_document(ch).alias("d")).collect())


def test_html_escapes_count_in_size(spark):
    df = spark.createDataFrame([("<x>&é",)], "v string")
    from ndflow.functions.jsonfn import json_size
    from pyspark.sql import functions as F
    j = df.select(F.to_json(F.struct("v")).alias("j"))
    assert j.select(json_size(F.col("j"))).collect()[0][0] == len('{"v":"<x>&é"}'.encode()) + 15


def test_reassemble_round_trip_and_totals(spark):
    entries = [entry(i, pad=150) for i in range(12)]
    rows = [("s1", "searchset", "2024-01-02T03:04:05.123+00:00", entries),
            ("c1", "collection", "not a time", entries)]
    df = frame(spark, rows)
    r = {x.bundle_id: x for x in B.reassemble(B.chunk_rows(B.split_bundles(df, 1200))).collect()}
    s = json.loads(r["s1"].document)
    assert s["total"] == 12 and s["timestamp"] == "2024-01-02T03:04:05Z" and s["id"] == "s1"
    assert [e["fullUrl"] for e in s["entry"]] == [json.loads(e)["fullUrl"] for e in entries]
    c = json.loads(r["c1"].document)
    assert "total" not in c and "timestamp" not in c and r["c1"].was_reassembled


def test_chunk_documents_pass_contract(spark):
    from ndflow.operators.quality import chunk_contract_error
    df = frame(spark, [("b1", "collection", "2024-01-02T03:04:05Z", [entry(i, 200) for i in range(10)])])
    ch = B.chunk_rows(B.split_bundles(df, 1000))
    errs = ch.select(chunk_contract_error(B.chunk_document(ch))).collect()
    assert len(errs) > 1 and all(e[0] is None for e in errs)


def test_bundle_structure_rules(spark):
    docs = ['{"id":"a","type":"collection","entry":[{"x":1}]}', '{"type":"collection","entry":[]}',
            '{"id":"a","type":5,"entry":[]}', '{"id":"a","type":"t","entry":{}}', '{"id":"a","type":"t","entry":[1]}']
    df = spark.createDataFrame([(d,) for d in docs], "v string")
    got = [r[0] for r in df.select(B.bundle_structure(F.col("v"))).collect()]
    assert got[0] is None
    assert got[1].startswith("bundle.id") and got[2].startswith("bundle.type")
    assert got[3] == "bundle.entry must be an array" and got[4] == "bundle.entry[i] must be an object"


def test_large_bundle_packs_linearly(spark):
    import time
    entries = [entry(i, pad=(i * 13) % 90) for i in range(50_000)]
    df = frame(spark, [("big", "collection", None, entries)])
    t0 = time.time()
    ch = B.chunk_rows(B.split_bundles(df, 1500)).select("chunk_index", "first_index", "n_entries").collect()
    assert time.time() - t0 < 120
    want = greedy([len(e.encode()) for e in entries], 1500)
    got = sorted((r.chunk_index, r.first_index, r.n_entries) for r in ch)
    assert [(i, c[0], len(c)) for i, c in enumerate(want)] == got


def test_bundle_lines_are_canonicalised(spark):
    line = '{"resourceType":"Bundle","id":"b","type":"collection","entry":[{ "resource": {"resourceType":"X", "id":"1"}, "fullUrl":"u"}]}'
    df = spark.createDataFrame([(line,)], "value string")
    b = B.bundles_from_lines(df).collect()[0]
    assert b.entries == ['{"fullUrl":"u","resource":{"id":"1","resourceType":"X"}}']
