"""De-identification, run ledger, retry outcomes."""

import datetime as dt
import json

from pyspark.sql import functions as F

from ndflow.operators import deid as D
from ndflow.operators import ledger as L
from ndflow.operators.retry import retry_outcomes


def test_pseudonyms_consistent_and_references_join(spark):
    pats = spark.createDataFrame([("1",), ("2",)], "id string")
    encs = spark.createDataFrame([("e1", "Patient/1"), ("e2", "Patient/2"), ("e3", "Patient/9")], "id string, subject string")
    p = pats.select(D.pseudonym(F.lit("Patient"), F.col("id"), "k").alias("pid"))
    e = encs.select(D.pseudonymize_reference(F.col("subject"), "k").alias("s"))
    joined = e.join(p, F.regexp_extract("s", "^Patient/(.+)$", 1) == F.col("pid"))
    assert joined.count() == 2
    other_key = pats.select(D.pseudonym(F.lit("Patient"), F.col("id"), "k2").alias("pid"))
    assert p.intersect(other_key).count() == 0


def test_rule_table_drops_unlisted_and_unknown_action(spark):
    df = spark.createDataFrame([("1", "Doe", "1950-02-03", "12345")], "id string, family string, birth string, zip string")
    out = D.apply_rules(df, {"id": "pseudonym", "family": "drop", "birth": "year", "zip": "prefix3"}, "Patient", "k")
    r = out.collect()[0]
    assert out.columns == ["id", "birth", "zip"] and r.birth == "1950" and r.zip == "123**" and len(r.id) == 32
    try:
        D.apply_rules(df, {"id": "shuffle"}, "Patient", "k")
        assert False
    except ValueError:
        pass


def test_external_errors_become_rows(spark):
    df = spark.createDataFrame([(1, '{"id":"a"}'), (2, "{bad")], "src_key long, value string")
    out = {r.src_key: r for r in D.external(df, lambda d: {"id": d["id"] + "x"}).collect()}
    assert out[1].ok and json.loads(out[1].value) == {"id": "ax"} and out[1].attempts == 1
    assert not out[2].ok and out[2].error_type == "non_transient" and out[2].attempts == 1


def test_external_retries_transient_failures(spark):
    df = spark.createDataFrame([(1, '{"id":"a"}')], "src_key long, value string")

    def always_down(doc):
        raise ConnectionError("connection refused")

    r = D.external(df, always_down, max_attempts=3, initial_ms=1).collect()[0]
    assert not r.ok and r.error_type == "transient" and r.attempts == 3


def steps_frame(spark, rows):
    schema = ("job_id string, step_id string, pos int, name string, status string, started_at timestamp_ntz, "
              "completed_at timestamp_ntz, files_processed int, bytes_processed long, retry_count int, "
              "error_type string, error_message string, http_status int")
    return spark.createDataFrame(rows, schema)


def test_ledger_summary_resume_and_audit(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("j1", "a", 1, "local_import", "completed", t, t, 1, 10, 0, None, None, None),
            ("j1", "b", 2, "dimp", "failed", t, None, 0, 0, 2, "transient", "HTTP 503", 503),
            ("j1", "c", 3, "validation", "pending", None, None, 0, 0, 0, None, None, None),
            ("j2", "d", 1, "local_import", "completed", t, t, 1, 10, 0, None, None, None),
            ("j2", "e", 2, "dimp", "completed", t, None, 1, 10, 0, None, None, None),
            ("j3", "f", 1, "torch", "failed", t, None, 0, 0, 0, "non_transient", "bad", 400),
            ("j3", "g", 2, "validation", "pending", None, None, 0, 0, 0, None, None, None)]
    steps = steps_frame(spark, rows)
    jobs = spark.createDataFrame([("j1", "failed", "dimp"), ("j2", "in_progress", "validation"), ("j3", "failed", None), ("j4", "pending", "")],
                                 "job_id string, status string, current_step string")
    assert {r.job_id: r.current_retries for r in L.current_steps(jobs, steps).collect()} == {"j1": 2, "j2": None, "j3": None, "j4": None}
    full = jobs.select("*", *[F.lit(v).alias(k) for k, v in {"input_source": "x", "input_type": "local_directory", "total_files": 1, "total_bytes": 1}.items()])
    full = full.withColumn("job_id", F.concat(F.lit("00000000-0000-0000-0000-00000000000"), F.substring("job_id", 2, 1)))
    own = steps.withColumn("job_id", F.concat(F.lit("00000000-0000-0000-0000-00000000000"), F.substring("job_id", 2, 1)))
    errs = {r.job_id[-1]: r.job_error for r in L.job_error(full, own).collect()}
    assert errs == {"1": None, "2": "current_step not found in job steps", "3": None, "4": None}
    finished = jobs.withColumn("status", F.lit("completed"))
    assert {(r.resume_step, r.action) for r in L.resume_point(finished, steps).collect()} == {(None, "done")}
    rp = {r.job_id: (r.resume_step, r.action) for r in L.resume_point(jobs, steps).collect()}
    assert rp == {"j1": ("dimp", "retry"), "j2": (None, "done"), "j3": ("torch", "retry"), "j4": (None, "done")}
    done = {r.job_id: r.complete for r in L.jobs_complete(jobs, steps).collect()}
    assert done == {"j1": False, "j2": True, "j3": False, "j4": False}
    blocked = {(r.job_id, r.name) for r in L.blocked_steps(steps).collect()}
    assert blocked == {("j3", "validation")}
    log = [("b", "init", "pending"), ("b", "start", "in_progress"), ("b", "fail", "failed"), ("b", "retry", "in_progress"), ("b", "fail", "failed"),
           ("c", "init", "pending"), ("e", "start", "in_progress"), ("e", "complete", "completed"), ("e", "start", "in_progress")]
    ev = spark.createDataFrame([("j", s, i, e, to, t) for i, (s, e, to) in enumerate(log)],
                               "job_id string, step_id string, seq int, event string, to_status string, ts timestamp_ntz")
    state = {r.step_id: (r.status, r.retries) for r in L.ledger_state(ev).collect()}
    assert state == {"b": ("failed", 1), "c": ("pending", 0), "e": ("in_progress", 0)}
    bad = {(r.step_id, r.seq) for r in L.bad_transitions(ev).collect()}
    assert bad == {("e", 8)}  # completed steps do not start again
    errs = {r.step_id: r.e for r in steps.select("step_id", L.step_error(steps).alias("e")).collect()}
    assert errs["e"].startswith("completed_at must be set") and errs["a"] is None


def test_retry_outcomes(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("c1", t, 1, 503, "HTTP 503"), ("c1", t + dt.timedelta(seconds=1), 2, 200, "ok"),
            ("c2", t, 3, 400, "bad request"),
            ("c3", t, 4, 0, "connection reset by peer"), ("c3", t, 5, 429, "slow down"),
            ("c4", t, 6, 0, "disk full")] + [("c5", t, 10 + i, 500, "oops") for i in range(7)]
    log = spark.createDataFrame(rows, "call_id string, ts timestamp_ntz, seq long, http_status int, message string")
    out = {r.call_id: r for r in retry_outcomes(log).collect()}
    assert (out["c1"].outcome, out["c1"].attempts) == ("succeeded", 2)
    assert out["c2"].outcome == "failed_non_transient"
    assert (out["c3"].outcome, out["c3"].attempts, out["c3"].next_delay_ms) == ("retry_pending", 2, 2000)
    assert out["c4"].outcome == "failed_non_transient"
    assert (out["c5"].outcome, out["c5"].attempts) == ("exhausted", 5)
