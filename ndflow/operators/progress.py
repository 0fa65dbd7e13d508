"""Progress analytics over sample tables.

A progress table holds ``(run_id, ts, seq, items, bytes)`` samples with a
per-run sample number ``n`` (1, 2, ... in ``(ts, seq)`` order, from the
two-level row number).  Rolling windows look back a fixed number of samples,
so instead of a window over a whole run (one task per run) the window runs
inside ranges of sample numbers, each with the last samples of the range
before it: one shuffle, no row copies but those, exact results, and a run
holding a third of all samples still spreads over every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ndflow.functions.scalars import format_bytes, format_bytes_rate, format_duration, format_items_rate
from ndflow.plans.seq import grouped_running_sums, join_null_safe

# ETA window (last samples kept, and their maximum age in seconds).
WINDOW_SAMPLES = 10
WINDOW_SECONDS = 30


def number_samples(samples: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Add ``n`` (1-based sample number per run in ``(ts, seq)`` order)."""
    b = bucket if bucket is not None else F.date_trunc("day", F.col("ts"))
    one = samples.withColumn("_one", F.lit(1).cast("long"))
    return grouped_running_sums(one, ["run_id"], ["ts", "seq"], {"n": "_one"}, bucket=b).drop("_one")


# Samples of one run handled by one window task.
LOOKBACK_BUCKET = 1 << 14


def lookback(samples: DataFrame, k: int, cols: list[str], bucket: int = LOOKBACK_BUCKET) -> DataFrame:
    """For every sample, the array ``prev`` of the previous ``k-1`` samples
    and itself (oldest first) as ``struct(n, cols...)``.

    A bounded window inside (run, range of sample numbers); the last ``k-1``
    samples of a range are also given to the next one as its start."""
    own = F.floor((F.col("n") - 1) / F.lit(bucket))
    tail = (F.col("n") - 1) % bucket >= bucket - (k - 1)
    x = samples.select("run_id", "n", F.struct("n", *cols).alias("_s"), own.alias("_own"),
                       F.explode(F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))).alias("_bk"))
    w = Window.partitionBy("run_id", "_bk").orderBy("n").rowsBetween(-(k - 1), 0)
    x = x.select("run_id", "n", "_own", "_bk", F.collect_list("_s").over(w).alias("prev"))
    return x.filter(F.col("_bk") == F.col("_own")).select("run_id", "n", "prev")


def lags(samples: DataFrame, k: int, cols: list[str], bucket: int = LOOKBACK_BUCKET) -> DataFrame:
    """For every sample its columns and those of the ``k`` samples before it,
    ``<col>_1`` (the one just before) to ``<col>_k``; NULL where the run has none.
    Ranges of sample numbers as in ``lookback``, plain columns instead of arrays."""
    own = F.floor((F.col("n") - 1) / F.lit(bucket))
    tail = (F.col("n") - 1) % bucket >= bucket - k
    x = samples.select("run_id", "n", *cols, own.alias("_own"), F.explode(F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))).alias("_bk"))
    w = Window.partitionBy("run_id", "_bk").orderBy("n")
    x = x.select("*", *[F.lag(c, i).over(w).alias(f"{c}_{i}") for c in cols for i in range(1, k + 1)])
    return x.filter(F.col("_bk") == F.col("_own")).drop("_bk", "_own")


def eta_window(samples: DataFrame, window_samples: int = WINDOW_SAMPLES,
               window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """W1-W3 per sample: samples in the window (last ``window_samples``, newer
    than ``window_seconds`` strictly), average seconds per item, throughput,
    and ETA to the run's final item count (W2; 0 when done)."""
    k = window_samples - 1
    s = samples.select("run_id", "n", now_us_of(F.col("ts")).alias("us"), "items")
    x = lags(s, k, ["us", "items"])
    # samples are in time order, so those inside the window are the last ones
    inside = [F.coalesce(F.col(f"us_{i}") > F.col("us") - window_seconds * 1_000_000, F.lit(False)) for i in range(1, k + 1)]
    cnt = F.lit(1)
    for c in inside:
        cnt = cnt + c.cast("int")
    first_us, first_items = F.col("us"), F.col("items")
    for i, c in enumerate(inside, 1):  # the oldest one inside wins
        first_us, first_items = F.when(c, F.col(f"us_{i}")).otherwise(first_us), F.when(c, F.col(f"items_{i}")).otherwise(first_items)
    x = x.select("run_id", "n", "items", cnt.alias("_cnt"), ((F.col("us") - first_us) / 1e6).alias("_dt"), (F.col("items") - first_items).alias("_di"))
    dt, di, cnt = F.col("_dt"), F.col("_di"), F.col("_cnt")
    valid = (cnt >= 2) & (di > 0) & (dt > 0)
    avg = F.when(valid, dt / di)
    total = samples.groupBy("run_id").agg(F.max("items").alias("total_items"))
    y = x.select("run_id", "n", "items", cnt.alias("window_samples"), avg.alias("avg_sec_per_item"))
    y = join_null_safe(y, total, ["run_id"])
    remaining = F.col("total_items") - F.col("items")
    eta_valid = (F.col("window_samples") >= 2) & ((remaining <= 0) | F.col("avg_sec_per_item").isNotNull())
    eta = F.when(F.col("window_samples") < 2, F.lit(None)).when(remaining <= 0, F.lit(0.0)) \
        .otherwise(remaining * F.col("avg_sec_per_item"))
    # raw doubles: the same IEEE operations as any other engine, no rounding
    return y.select("run_id", "n", "items", "window_samples", "avg_sec_per_item",
                    (1.0 / F.col("avg_sec_per_item")).alias("items_per_sec"),
                    eta.alias("eta_sec"), eta_valid.alias("eta_valid"))


def now_us_of(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def instant_rate(samples: DataFrame) -> DataFrame:
    """Item and byte rate since the previous sample; a zero time gap keeps
    the previous rate; the first sample of a run has rate 0.

    The carried rate is a forward fill: the rate of the latest sample with a
    positive gap.  Computed two-level like the running sums: the last such
    sample per (run, day) bucket, carried across buckets on the small bucket
    table, then inside buckets with a bounded window."""
    lb = lookback(samples, 2, ["ts", "items", "bytes"])
    cur, prev = F.element_at("prev", -1), F.element_at("prev", 1)
    dt = (now_us_of(cur["ts"]) - now_us_of(prev["ts"])) / 1e6
    has = (F.size("prev") == 2) & (dt > 0)
    x = lb.select("run_id", "n", cur["ts"].alias("ts"),
                  F.when(has, (cur["items"] - prev["items"]) / dt).alias("_ir"),
                  F.when(has, (cur["bytes"] - prev["bytes"]) / dt).alias("_br"))
    from ndflow.plans.seq import grouped_forward_fill
    f = grouped_forward_fill(x, ["run_id"], "n", ["_ir", "_br"], bucket=F.date_trunc("day", F.col("ts")))
    return f.select("run_id", "n", F.coalesce("_ir", F.lit(0.0)).alias("items_per_sec"),
                    F.coalesce("_br", F.lit(0.0)).alias("bytes_per_sec"))


def average_rate(samples: DataFrame) -> DataFrame:
    """W5 + W7: rates since the run's first sample, and percent of the run's
    final item count (0 when that total is 0)."""
    per = samples.groupBy("run_id").agg(F.min("ts").alias("_t0"), F.max("items").alias("_total"))
    x = join_null_safe(samples, per, ["run_id"])
    el = (now_us_of(F.col("ts")) - now_us_of(F.col("_t0"))) / 1e6
    return x.select("run_id", "n",
                    F.when(el > 0, F.col("items") / el).otherwise(0.0).alias("avg_items_per_sec"),
                    F.when(el > 0, F.col("bytes") / el).otherwise(0.0).alias("avg_bytes_per_sec"),
                    F.when(F.col("_total") == 0, 0.0).otherwise(F.col("items") / F.col("_total") * 100)
                    .alias("percent"))


def throughput_summary(samples: DataFrame) -> DataFrame:
    """One summary line per run, from per-run aggregates
    (``max_by`` for the last sample, combined map-side)."""
    g = samples.groupBy("run_id").agg(
        F.min("ts").alias("t0"), F.max("ts").alias("t1"),
        F.max_by("items", F.struct("ts", "seq")).alias("items"),
        F.max_by("bytes", F.struct("ts", "seq")).alias("bytes"))
    el_us = now_us_of(F.col("t1")) - now_us_of(F.col("t0"))
    el = el_us / 1e6
    ir = F.when(el > 0, F.col("items") / el).otherwise(0.0)
    br = F.when(el > 0, F.col("bytes") / el).otherwise(0.0)
    return g.select("run_id", F.concat(
        F.col("items").cast("string"), F.lit(" items ("), format_bytes(F.col("bytes")), F.lit(") in "),
        format_duration(el_us), F.lit(" | Avg: "), format_items_rate(ir), F.lit(", "), format_bytes_rate(br))
        .alias("summary"))
