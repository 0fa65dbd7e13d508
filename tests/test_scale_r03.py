"""Steps that must stay spread out and small on the driver whatever the tables'
files look like."""

import json

from pyspark.sql import functions as F


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def order_table(spark, n=40):
    """A bundle frame of its own: one to six entries, some over the budget."""
    entry = lambda b, i: json.dumps({"fullUrl": f"urn:uuid:li-{b}-{i}", "resource": {"id": f"{b}-{i}", "quantity": i, "resourceType": "Claim", "status": "F"}},
                                    separators=(",", ":"), sort_keys=True)
    return spark.createDataFrame([(f"order-{b}", "collection", None, [entry(b, i) for i in range(1 + b % 6)]) for b in range(n)],
                                 "bundle_id string, bundle_type string, timestamp string, entries array<string>")


def test_metamorphic_check_meets_in_one_grouping_without_a_join(spark):
    from ndflow.plans.q_flow import metamorphic
    x = metamorphic(order_table(spark), 500, "k")
    assert "Join" not in optimized(x)  # a join may be planned as a broadcast of all documents
    rows = {r.bundle_id: r for r in x.collect()}
    assert len(rows) == 40 and all(r.equal and r.all_chunks and not r.leaks for r in rows.values())
    assert {r.entry_count for r in rows.values()} == {1, 2, 3, 4, 5, 6} and max(r.chunks for r in rows.values()) > 1


def tables(spark, tmp_dir):
    """Small tables, each one file with one row group."""
    put = lambda name, ddl, rows: spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp_dir}/{name}.parquet")
    put("nation", "n_nationkey int, n_name string", [(0, "FRANCE"), (1, "PERU")])
    put("customer", "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        [(k, f"Customer#{k}", k % 2, 1.5, "AUTOMOBILE") for k in range(60)])
    x = spark.range(120).select(F.col("id").alias("o_orderkey"), (F.col("id") % 60).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit(400000.0).alias("o_totalprice"),
                                F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("o_orderdate"))
    x.coalesce(1).write.parquet(f"{tmp_dir}/orders.parquet")
    x.select(F.col("o_orderkey").alias("l_orderkey"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("l_linenumber"), F.lit(2.0).alias("l_quantity"),
             F.lit("F").alias("l_linestatus")).coalesce(1).write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.range(200).select(F.col("id").alias("event_id"), (F.col("id") % 4).alias("user_id"), F.lit(1.0).alias("value"), F.timestamp_seconds(
        F.lit(1704067200) + F.col("id") * 60).cast("timestamp_ntz").alias("ts")).coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    return tmp_dir


def test_documents_of_a_one_file_table_are_made_in_many_tasks(spark, tmp_dir):
    from ndflow.plans.q_flow import q_deid_by_path
    from ndflow.plans.q_more import _encounters, _patients
    d = tables(spark, tmp_dir)
    rows = q_deid_by_path(spark, d)
    assert rows.rdd.getNumPartitions() >= 8 and rows.filter("planted_in and links_agree and leaks = 0").count() == 60
    assert _patients(spark, d).rdd.getNumPartitions() >= 8 and _encounters(spark, d).rdd.getNumPartitions() >= 8


def test_split_invariance_has_no_join(spark, tmp_dir):
    from ndflow.plans.q_more import q_split_invariance
    x = q_split_invariance(spark, tables(spark, tmp_dir))
    assert "Join" not in optimized(x)
    assert x.filter("equal and not leaks and entry_count = 5").count() == 120


def test_links_are_extracted_once(spark, tmp_dir):
    from ndflow.plans.q_flow import q_dangling_links
    x = q_dangling_links(spark, tables(spark, tmp_dir))
    assert "MapInArrow" not in optimized(x)
    assert x.filter("target like 'Patient/%'").count() == 2  # orders 5 and 102


def test_cohorts_parse_every_resource_once(spark, tmp_dir):
    from ndflow.operators.flatten import ENCOUNTER_PATHS, flatten
    from ndflow.plans import q_flow as Q
    d = tables(spark, tmp_dir)
    assert "resourceType" not in optimized(Q.q_cohort_groups(spark, d))  # the flat frames are read, not made again
    lines = spark.createDataFrame([('{"resourceType":"Encounter","id":"1","status":"F"}',), ("junk",), (None,)], "value string")
    x = flatten(lines, ENCOUNTER_PATHS, "Encounter")
    plan = optimized(x)
    assert plan.index("Filter") < plan.index("Generate") and [r.status for r in x.collect()] == ["F"]


def test_flat_tables_come_from_stored_rows(spark, tmp_dir, monkeypatch):
    from ndflow.plans import q_flow as Q
    seen, real = [], Q.stored
    monkeypatch.setattr(Q, "stored", lambda df, name: seen.append(name) or real(df, name))
    x = Q.q_flatten_elements(spark, tables(spark, tmp_dir))
    assert sorted(seen) == ["lines", "nested-Account", "nested-Patient"]
    assert x.filter("tab = 'Patient_identifier' and fmt = 'csv'").count() == 180


def test_contract_parses_a_document_once_per_step(spark):
    from ndflow.operators.quality import chunk_contract_error
    good = '{"entry":[{"resource":{"resourceType":"Claim"}}],"id":"b-chunk-0","resourceType":"Bundle","total":1,"type":"collection"}'
    df = spark.createDataFrame([(good,), (good.replace(":1,", ":2,"),), (good + "x",), (None,), (good.replace("Claim", ""),)], "d string")
    x = df.select(chunk_contract_error(F.col("d")).alias("e"))
    assert optimized(x).count("from_json") <= 3
    assert [r.e for r in x.collect()] == [None, "total must equal entry count", "resourceType must be Bundle", "resourceType must be Bundle", "entry resource needs a resourceType"]


def test_samples_are_made_once_for_both_halves(spark, tmp_dir, monkeypatch):
    from ndflow.plans import q_more as Q
    seen, real = [], Q.stored
    monkeypatch.setattr(Q, "stored", lambda df, name: seen.append(name) or real(df, name))
    assert Q.q_eta_stream(spark, tables(spark, tmp_dir)).count() == 200 and seen == ["eta-samples"]


def test_waiting_samples_are_not_read_before_a_watermark():
    import pandas as pd
    from ndflow.streaming.event_time import EtaProcessor

    class Handle:
        calls = []

        def __getattr__(self, name):
            return lambda *a: self.calls.append((name, a)) or self

        def getCurrentWatermarkInMs(self):
            return 0

    h = Handle()
    p = EtaProcessor(10, 60)
    p.init(h)
    rows = [pd.DataFrame({"ts": pd.to_datetime([t], unit="s"), "seq": [t], "items": [t]}) for t in (7, 3)]
    assert list(p.handleInputRows((1,), iter(rows), h)) == []
    assert [c for c in h.calls if c[0] in ("get", "appendList", "registerTimer")] == [
        ("appendList", ([(7000000, 7, 7), (3000000, 3, 3)],)), ("registerTimer", (7001,))]


def test_a_filter_on_the_status_parses_every_line_once(spark):
    from ndflow.functions import jsonfn as J
    from ndflow.sources.ndjson import parse_lines
    texts = ['{"id":"1","resourceType":"A"}', "", " \t\r\n", '{"id":"1"', "[1]", "1", '{"id":1,"resourceType":"A"}', '{"resourceType":5}', ' {"resourceType":"B"} ', "\u00a0", None]
    lines = spark.createDataFrame([(t,) for t in texts], "t string").select(F.concat("t", F.lit("")).alias("value"))
    x = parse_lines(lines).filter(F.col("status").isin("ok", "blank") | F.col("blank_trimmed"))
    assert optimized(x).count(J._END + '"}]') == 1  # the header's parse
    assert [(r.value, r.status, r.resource_type, r.resource_id, r.blank_trimmed) for r in x.collect()] == [
        (texts[0], "ok", "A", "1", False), ("", "blank", None, None, True), (" \t\r\n", "invalid_json", None, None, True), (texts[8], "ok", "B", "", False)]


def test_sizes_need_no_regex(spark):
    from ndflow.functions.jsonfn import escape_growth, json_size
    df = spark.createDataFrame([("ab",), ("<a>&&",), ("\u2028x\u2029",), ("é<\u2028",), ("",), (None,)], "t string")
    x = df.select(json_size(F.col("t")).alias("n"), escape_growth(F.col("t")).alias("g"))
    assert "RLIKE" not in optimized(x) and "regexp" not in optimized(x)
    assert [tuple(r) for r in x.collect()] == [(2, 0), (25, 20), (13, 6), (14, 8), (0, 0), (None, 0)]


def test_metamorphic_documents_meet_before_they_are_rewritten(spark, tmp_dir):
    from ndflow.plans.q_flow import q_split_metamorphic
    x = q_split_metamorphic(spark, tables(spark, tmp_dir))
    plan = x._jdf.queryExecution().executedPlan().toString()
    # one reading of each table, one dealing out by bundle, one pass through Python for both paths
    assert optimized(x).count("MapInArrow") == 1 and plan.count("Exchange hashpartitioning(bundle_id") == 1 and plan.count("Scan parquet") == 2
    assert x.filter("equal and all_chunks and not leaks and entry_count = 5").count() == 120


def test_metamorphic_check_of_odd_bundles(spark):
    from ndflow.plans.q_flow import metamorphic
    entry = lambda i, n=1: json.dumps({"fullUrl": f"urn:uuid:{i}", "resource": {"id": i, "resourceType": "Claim", "code": {"text": "x" * n}}}, separators=(",", ":"))
    rows = [("empty", "collection", []), ("none", "collection", None), ("two", "history", [entry("a", 300), entry("b", 300)]), ("over", "collection", [entry("c", 900)]),
            (None, "collection", [entry("d")]), ("bad", "collection", [entry("e", 300), '{"fullUrl":NaN}', entry("f", 300)]), ("untyped", None, [entry("g")]),
            ("no-id", "collection", ['{"resource":{"resourceType":"Claim"}}']), ("twice", "collection", [entry("h")]), ("twice", "collection", [entry("i")])]
    df = spark.createDataFrame([(i, t, None, e) for i, t, e in rows], "bundle_id string, bundle_type string, timestamp string, entries array<string>")
    got = sorted(map(tuple, metamorphic(df, 700, "k").collect()), key=str)
    assert got == sorted([("empty", 0, 1, True, True, False), ("none", 0, 1, True, True, False), ("two", 2, 2, True, True, False), ("bad", None, 2, None, True, None),
                          ("untyped", 1, 1, True, True, False), ("no-id", 1, 1, True, True, None), ("twice", 1, 2, False, False, False), ("twice", 1, 2, False, False, False)], key=str)
    kept = metamorphic(df, 700, "k", chunk_rules={"*": {"id": "keep"}}).filter("leaks").collect()
    assert {r.bundle_id for r in kept} == {"two", "bad", "untyped", "twice"}


def test_lists_of_documents_are_rewritten_like_single_ones(spark):
    from ndflow.operators.deid_doc import deidentify_documents
    good = [json.dumps({"resourceType": "Claim", "id": str(i), "status": "F", "quantity": i, "note": "x", "total": {"value": 1.50}}) for i in range(4)]
    rows = [(1, good[:2], good[2]), (2, [good[0], "{", None], None), (3, [], "["), (4, None, good[3])]
    df = spark.createDataFrame(rows, "k int, a array<string>, b string")
    both = deidentify_documents(deidentify_documents(df, "s", "a"), "s", "b", rules={"Claim": {"quantity": "keep"}})
    assert optimized(both).count("MapInArrow") == 1 and both.columns == df.columns
    one = lambda text, **kw: deidentify_documents(spark.createDataFrame([(text,)], "value string"), "s", **kw).first().value
    got = {r.k: (r.a, r.b) for r in both.collect()}
    rule = {"rules": {"Claim": {"quantity": "keep"}}}
    assert got == {1: ([one(good[0]), one(good[1])], one(good[2], **rule)), 2: ([one(good[0]), None, None], None), 3: ([], None), 4: (None, one(good[3], **rule))}
    assert '"value":1.5}' in got[1][0][0] and '"quantity"' not in got[1][0][0] and '"quantity":2' in got[1][1] and got[1][0][0].count("REDACTED") == 1
    # on a column that is already done, the second pass works on its result
    again = deidentify_documents(deidentify_documents(df, "s", "b"), "s", "b")
    assert {r.k: r.b for r in again.collect()}[4] == one(one(good[3]))


def test_a_rewritten_text_equals_the_rewritten_document():
    from ndflow.operators import deid_doc as D
    own, seven = D.Deidentifier("k", {"*": {"kept": "tree"}}), "7" * 450
    texts = ['{"resourceType":"Patient","id":"\\ud83d","birthDate":"1950-02-03","meta":{"profile":["p"],"security":["old"]},"contained":[{"resourceType":"Device","id":"d"}],'
             '"link":[{"other":{"reference":"#d"}},{"other":{"reference":"Patient/1"}},{}],"name":"n"}', f'{{"total":{seven},"count":1.50,"value":-0,"kept":{{"a":[1e400]}}}}',
             '{"kept":' + "9" * 5000 + '}', '[{"resourceType":"A","resourceType":"B","id":"1"},3,null]', '"x"', "{}", "[]", "5"]
    for t in texts:
        assert own.text(t) == D.text_of(own.document(D.parse(t)))
    assert own.text(texts[1]) == f'{{"count":1.50,"kept":{{"a":[1e400]}},"total":{seven},"value":0}}' and own.text(texts[2]) == texts[2]
    assert own.document(D.parse(texts[0]))["meta"] == {"profile": ["p"], "security": [{"code": c, "display": d, "system": D.SECURITY_SYSTEM} for c, d in D.SECURITY_TAGS]}
    for t in (None, "", "{", '{"a":NaN}', "\ufeff{}"):
        try:
            D.parse(t)
            raise AssertionError(t)
        except (ValueError, TypeError) as e:
            assert "JSON" in str(e) or "Expecting" in str(e) or "BOM" in str(e)
