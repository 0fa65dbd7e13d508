"""Run ledger: questions asked of ``jobs`` and ``steps`` tables (J2, J3,
O1-O3, L1-L5, A5, X15, X17, X18).

``jobs(job_id, created_at, input_source, input_type, status, current_step,
total_files, total_bytes, error_message)`` and ``steps(job_id, step_id, pos, name, status,
started_at, completed_at, files_processed, bytes_processed, retry_count,
error_type, error_message, http_status)``.  Step order inside a job is
``(pos, step_id)``.

Per-job facts are aggregates over steps joined to jobs on ``job_id``: one
shuffle per side, no window over a whole job table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ndflow.functions.scalars import format_age, format_bytes, status_symbol
from ndflow.operators.quality import STEP_NAMES
from ndflow.plans.seq import by_key

# Ledger enums - the import steps, the steps that need a
# completed import first (any of the three), job/step statuses, input kinds.
IMPORT_STEPS = ("torch", "local_import", "http_import")
NEEDS_IMPORT = ("dimp", "validation", "csv_conversion", "parquet_conversion")
JOB_STATUSES = ("pending", "in_progress", "completed", "failed")
INPUT_TYPES = ("local_directory", "http_url", "crtdl_file", "torch_result_url")
# Allowed status transitions (same table for jobs and steps).
ALLOWED_TRANSITIONS = (("pending", "in_progress"), ("in_progress", "completed"), ("in_progress", "failed"),
                       ("failed", "in_progress"))
UUID_RE = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
# Job and step validity messages, in the order they are checked.
JOB_RULES = {
    "id": "job_id is required",
    "uuid": "invalid job_id: must be a valid UUID",
    "input": "input_source is required",
    "http": "input_source must be a valid HTTP(S) URL when input_type is http_url",
    "input_type": "invalid input_type: ",
    "status": "invalid status: ",
    "current": "current_step not found in job steps",
    "files": "total_files cannot be negative",
    "bytes": "total_bytes cannot be negative",
}
STEP_RULES = {
    "name": "invalid step name: ",
    "status": "invalid step status: ",
    "retries": "retry_count cannot be negative",
    "files": "files_processed cannot be negative",
    "bytes": "bytes_processed cannot be negative",
    "started": "started_at must be set when step is in_progress or completed",
    "completed": "completed_at must be set when step is completed",
}


def _step_struct() -> Column:
    return F.struct("pos", "step_id", "name", "status", "retry_count")


def step_summary(steps: DataFrame) -> DataFrame:
    """Per job: current step (last step that left ``pending``, else the
    first), first pending step (O2), completion (A5), import done (J3)."""
    s = _step_struct()
    # min/max over structs aggregate by sorting; partitioning by job first
    # means one sort after one shuffle instead of a sort on each side of it
    g = by_key(steps, "job_id").groupBy("job_id").agg(
        F.max(F.when(F.col("status") != "pending", s)).alias("_cur_started"),
        F.min(s).alias("_first"),
        F.min(F.when(F.col("status") == "pending", s)).alias("_next_pending"),
        F.count(F.lit(1)).alias("n_steps"),
        F.bool_and(F.col("status") == "completed").alias("_all_done"),
        F.bool_or(F.col("name").isin(*IMPORT_STEPS) & (F.col("status") == "completed")).alias("import_done"))
    cur = F.coalesce(F.col("_cur_started"), F.col("_first"))
    return g.select("job_id", "n_steps", "import_done",
                    cur["pos"].alias("current_pos"), cur["step_id"].alias("current_step_id"),
                    cur["name"].alias("current_step"), cur["status"].alias("current_status"),
                    cur["retry_count"].alias("current_retries"),
                    F.col("_next_pending")["name"].alias("next_pending_step"),
                    F.col("_all_done").alias("all_completed"))


def current_steps(jobs: DataFrame, steps: DataFrame) -> DataFrame:
    """The step row each job names as its current one: an equi join on
    (job_id, name); of several steps of that name the first by position.

    Position and retries travel in one long, so the minimum is a hash
    aggregate, combined before the shuffle."""
    at = F.min(F.col("pos").cast("long") * F.lit(1 << 32) + F.col("retry_count"))
    s = steps.groupBy("job_id", F.col("name").alias("current_step")).agg(at.alias("_at"))
    return jobs.join(s, ["job_id", "current_step"], "left").select(
        *jobs.columns, F.shiftright("_at", 32).cast("int").alias("current_pos"),
        F.col("_at").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("current_retries"))


def job_list(jobs: DataFrame, steps: DataFrame, as_of: Column) -> DataFrame:
    """Every job with status symbol, current step, files,
    retries of the current step and age at ``as_of`` (sorted newest first by
    the caller's ``orderBy``; no collect)."""
    j = current_steps(jobs, steps)
    age_us = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("created_at").cast("timestamp"))
    return j.select("job_id", "status", status_symbol(F.col("status")).alias("symbol"),
                    F.coalesce("current_step", F.lit("")).alias("current_step"),
                    F.col("total_files").alias("files"),
                    F.coalesce("current_retries", F.lit(0)).alias("retries"),
                    format_age(age_us).alias("age"),
                    F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


def jobs_complete(jobs: DataFrame, steps: DataFrame) -> DataFrame:
    """A5: every step completed; a job without steps is not complete."""
    s = step_summary(steps)
    return jobs.join(s, "job_id", "left").select(
        "job_id", F.coalesce(F.col("all_completed") & (F.col("n_steps") > 0), F.lit(False)).alias("complete"))


def step_line(steps: DataFrame) -> Column:
    """One status-report line per step (L2)."""
    files = F.when(F.col("status").isin("completed", "in_progress"), F.concat(
        F.lit(" ("), F.col("files_processed").cast("string"), F.lit(" files"),
        F.when(F.col("bytes_processed") > 0, F.concat(F.lit(", "), format_bytes(F.col("bytes_processed"), with_tb=False)))
        .otherwise(F.lit("")), F.lit(")"))).otherwise(F.lit(""))
    retries = F.when(F.col("retry_count") > 0, F.concat(F.lit(" ["), F.col("retry_count").cast("string"),
                                                         F.lit(" retries]"))).otherwise(F.lit(""))
    err = F.when(F.col("error_message").isNotNull(), F.concat(F.lit(" | Error: "), F.col("error_message"))) \
        .otherwise(F.lit(""))
    return F.concat(status_symbol(F.col("status"), for_job=False), F.lit(" "), F.col("name"), F.lit(" - "),
                    F.col("status"), files, retries, err)


def job_status(jobs: DataFrame, steps: DataFrame) -> DataFrame:
    """L2: summary and ordered step lines per job.  Steps of one job are at
    most the number of step kinds, so the ordered list is small."""
    lines = steps.select("job_id", "pos", "step_id", step_line(steps).alias("line"))
    g = by_key(lines, "job_id").groupBy("job_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "step_id", "line"))).alias("_l"))
    g = g.select("job_id", F.array_join(F.col("_l.line"), "\n").alias("steps_text"))
    return (jobs.join(g, "job_id", "left")
            .select("job_id", F.concat(
                F.lit("Status: "), F.col("status"), F.lit(" | Current Step: "), F.coalesce("current_step", F.lit("")),
                F.lit(" | Files: "), F.col("total_files").cast("string"),
                F.when(F.col("error_message").isNotNull(), F.concat(F.lit(" | Error: "), F.col("error_message")))
                .otherwise(F.lit(""))).alias("summary"),
                F.coalesce("steps_text", F.lit("")).alias("steps_text")))


def next_steps(steps: DataFrame) -> DataFrame:
    """O3: the next step after each step, in job order.  The window holds one
    job's steps (bounded by the number of step kinds)."""
    w = Window.partitionBy("job_id").orderBy("pos", "step_id")
    return steps.select("job_id", "step_id", "name", F.lead("name").over(w).alias("next_step"))


def blocked_steps(steps: DataFrame) -> DataFrame:
    """Steps that need an import while no import step of the job is
    completed; anti join against jobs with a completed import."""
    done = (steps.filter(F.col("name").isin(*IMPORT_STEPS) & (F.col("status") == "completed"))
            .select("job_id").distinct())
    need = steps.filter(F.col("name").isin(*NEEDS_IMPORT))
    return need.join(done, "job_id", "left_anti").select("job_id", "step_id", "name",
                                                         F.lit("import").alias("blocked_by"))


def resume_point(jobs: DataFrame, steps: DataFrame) -> DataFrame:
    """Where ``continue`` resumes: nowhere (``done``) when the job is
    completed, else the current step unless completed (``retry`` when failed,
    ``run`` otherwise), else the next step after it (``blocked`` if it needs an
    import that is not done), else ``done``."""
    if "status" not in jobs.columns:
        jobs = jobs.withColumn("status", F.lit(None).cast("string"))
    s = step_summary(steps)
    nx = next_steps(steps).select("job_id", F.col("step_id").alias("current_step_id"),
                                  F.col("next_step").alias("_after"))
    j = jobs.select("job_id", "status").join(s, "job_id", "left").join(nx, ["job_id", "current_step_id"], "left")
    over = F.col("current_step").isNull() | F.coalesce(F.col("status") == "completed", F.lit(False))
    step = (F.when(over, F.lit(None))
            .when(F.col("current_status") != "completed", F.col("current_step"))
            .otherwise(F.col("_after")))
    action = (F.when(over, "done")
              .when(F.col("current_status") == "failed", "retry")
              .when(F.col("current_status") != "completed", "run")
              .when(F.col("_after").isNull(), "done")
              .when(F.col("_after").isin(*NEEDS_IMPORT) & ~F.coalesce("import_done", F.lit(False)), "blocked")
              .otherwise("run"))
    return j.select("job_id", step.alias("resume_step"), action.alias("action"))


def ledger_state(events: DataFrame) -> DataFrame:
    """L4: latest state per step from its events (``max_by`` on time, a
    partial aggregate) and the retry count."""
    return events.groupBy("job_id", "step_id").agg(
        F.max_by("to_status", F.struct("ts", "seq")).alias("status"),
        F.count_if(F.col("event") == "retry").alias("retries"),
        F.count(F.lit(1)).alias("n_events"))


def bad_transitions(events: DataFrame) -> DataFrame:
    """Consecutive events of a step whose status change is not allowed
    (repeating a status is not a change)."""
    w = Window.partitionBy("job_id", "step_id").orderBy("ts", "seq")
    x = events.select("job_id", "step_id", "seq", F.lag("to_status").over(w).alias("from_status"),
                      F.col("to_status"))
    ok = F.lit(False)
    for a, b in ALLOWED_TRANSITIONS:
        ok = ok | ((F.col("from_status") == a) & (F.col("to_status") == b))
    return x.filter(F.col("from_status").isNotNull() & (F.col("from_status") != F.col("to_status")) & ~ok)


def job_error(jobs: DataFrame, steps: DataFrame) -> DataFrame:
    """First failing job rule, NULL when valid.  A job's current step must
    be one of its steps (semi-join flag on job and name)."""
    known = steps.select("job_id", F.col("name").alias("current_step"), F.lit(True).alias("_known")).distinct()
    j = jobs.join(known, ["job_id", "current_step"], "left")
    src, it = F.col("input_source"), F.col("input_type")
    err = (F.when(F.coalesce(F.col("job_id"), F.lit("")) == "", JOB_RULES["id"])
           .when(~F.col("job_id").rlike(UUID_RE), JOB_RULES["uuid"])
           .when(F.coalesce(src, F.lit("")) == "", JOB_RULES["input"])
           .when((it == "http_url") & ~(src.startswith("http://") | src.startswith("https://")),
                 JOB_RULES["http"])
           .when(~it.isin(*INPUT_TYPES), F.concat(F.lit(JOB_RULES["input_type"]), it))
           .when(~F.col("status").isin(*JOB_STATUSES), F.concat(F.lit(JOB_RULES["status"]), F.col("status")))
           .when((F.coalesce("current_step", F.lit("")) != "") & F.col("_known").isNull(), JOB_RULES["current"])
           .when(F.col("total_files") < 0, JOB_RULES["files"])
           .when(F.col("total_bytes") < 0, JOB_RULES["bytes"]))
    return j.select("job_id", err.alias("job_error"))


def step_error(steps: DataFrame) -> Column:
    """First failing step rule, NULL when valid."""
    st = F.col("status")
    return (F.when(~F.col("name").isin(*STEP_NAMES), F.concat(F.lit(STEP_RULES["name"]), F.col("name")))
            .when(~st.isin(*JOB_STATUSES), F.concat(F.lit(STEP_RULES["status"]), st))
            .when(F.col("retry_count") < 0, STEP_RULES["retries"])
            .when(F.col("files_processed") < 0, STEP_RULES["files"])
            .when(F.col("bytes_processed") < 0, STEP_RULES["bytes"])
            .when(st.isin("in_progress", "completed") & F.col("started_at").isNull(),
                  STEP_RULES["started"])
            .when((st == "completed") & F.col("completed_at").isNull(),
                  STEP_RULES["completed"]))
