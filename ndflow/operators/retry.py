"""Row-level retry over a call log.

A call log has one row per attempt: ``(call_id, ts, seq, http_status,
message)``; status 200 is success, 0 means no HTTP answer (the message says
why).  The outcome per call follows the reference's retry loop: attempts in
time order, stop at the first success or non-transient error, or after
``max_attempts``; a call whose attempts are all transient and fewer than the
limit is still pending, with the next backoff delay.

Attempt numbers come from the two-level row number (``seq.grouped_row_number``
with hour buckets), per-call facts from one partial aggregate, and the
deciding attempt from an equi-join on ``(call_id, attempt)``: a unique key, so
no call, however hot, lands in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ndflow.functions.scalars import backoff_ms, classify_error, should_retry, step_error_type
from ndflow.plans.seq import grouped_running_sums, join_null_safe

# Default retry configuration (attempts, first and largest backoff).
MAX_ATTEMPTS = 5
INITIAL_BACKOFF_MS = 1000
MAX_BACKOFF_MS = 30000


def classify_attempts(log: DataFrame) -> DataFrame:
    ok = F.col("http_status") == 200
    et = F.when(ok, F.lit(None)).otherwise(step_error_type(F.col("http_status"), F.col("message")))
    c = classify_error(F.col("message"))
    return log.select("*", ok.alias("success"), et.alias("error_type"),
                      F.when(~ok, c["category"]).alias("error_category"),
                      F.when(~ok, c["message"]).alias("error_text"))


def retry_outcomes(log: DataFrame, max_attempts: int = MAX_ATTEMPTS, initial_ms: int = INITIAL_BACKOFF_MS,
                   max_ms: int = MAX_BACKOFF_MS) -> DataFrame:
    c = classify_attempts(log).withColumn("_one", F.lit(1).cast("long"))
    ranked = grouped_running_sums(c, ["call_id"], ["ts", "seq"], {"attempt": "_one"},
                                  bucket=F.date_trunc("hour", F.col("ts"))).drop("_one")
    terminal = F.col("success") | (F.col("error_type") == "non_transient")
    per = ranked.groupBy("call_id").agg(F.count(F.lit(1)).alias("n_attempts"),
                                        F.min(F.when(terminal, F.col("attempt"))).alias("_first_terminal"))
    decided = F.least(F.coalesce("_first_terminal", "n_attempts"), F.lit(max_attempts))
    per = per.select("call_id", "n_attempts", decided.cast("long").alias("attempt"))
    j = join_null_safe(per, ranked, ["call_id", "attempt"])
    outcome = (F.when(F.col("success"), "succeeded")
               .when(F.col("error_type") == "non_transient", "failed_non_transient")
               .when(~should_retry(F.col("error_type"), F.col("attempt"), max_attempts), "exhausted")
               .otherwise("retry_pending"))
    return j.select("call_id", F.col("attempt").alias("attempts"), outcome.alias("outcome"),
                    F.when(~F.col("success"), F.col("message")).alias("last_error"),
                    F.col("error_type").alias("last_error_type"),
                    F.when(outcome == "retry_pending", backoff_ms(F.col("attempt") - 1, initial_ms, max_ms))
                    .alias("next_delay_ms"))
