"""Two-level running sums and progress windows against brute force, with a
hot key spread over many buckets."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ndflow.operators import progress as W
from ndflow.plans.seq import grouped_forward_fill, grouped_running_sums


def samples(spark, n_hot=3000, seed=7):
    rnd = random.Random(seed)
    rows, t0 = [], dt.datetime(2024, 1, 1)
    for run, n in ((1, n_hot), (2, 40), (3, 1)):
        t = t0
        items = byts = 0
        for i in range(n):
            t = t + dt.timedelta(seconds=rnd.choice([0, 0, 1, 5, 20, 3600]))
            items += 1
            byts += rnd.randint(0, 500)
            rows.append((run, t, run * 100000 + i, items, byts))
    return spark.createDataFrame(rows, "run_id long, ts timestamp_ntz, seq long, items long, bytes long")


def test_running_sums_match_window(spark):
    s = samples(spark)
    got = grouped_running_sums(s.select("run_id", "ts", "seq", "bytes"), ["run_id"], ["ts", "seq"],
                               {"cum": "bytes"}, bucket=F.date_trunc("hour", F.col("ts")))
    w = Window.partitionBy("run_id").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = s.select("seq", F.sum("bytes").over(w).alias("cum"))
    assert got.select("seq", "cum").exceptAll(want).count() == 0 and got.count() == s.count()


def test_forward_fill_matches_window(spark):
    s = samples(spark).withColumn("x", F.when(F.col("seq") % 7 == 0, F.col("bytes")))
    got = grouped_forward_fill(s.select("run_id", "ts", "seq", "x"), ["run_id"], "seq", ["x"],
                               bucket=F.date_trunc("hour", F.col("ts")))
    w = Window.partitionBy("run_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = s.select("seq", F.last("x", ignorenulls=True).over(w).alias("x"))
    assert got.select("seq", "x").exceptAll(want).count() == 0


def brute_eta(rows, k=10, window_s=30):
    out = {}
    by_run = {}
    for r in rows:
        by_run.setdefault(r.run_id, []).append(r)
    for run, rs in by_run.items():
        rs.sort(key=lambda r: (r.ts, r.seq))
        total = rs[-1].items
        for i, r in enumerate(rs):
            win = [x for x in rs[max(0, i - k + 1): i + 1] if (r.ts - x.ts).total_seconds() < window_s]
            avg = None
            if len(win) >= 2:
                dtt = (win[-1].ts - win[0].ts).total_seconds()
                di = win[-1].items - win[0].items
                if di > 0 and dtt > 0:
                    avg = dtt / di
            out[(run, r.items)] = (len(win), avg)
    return out


def test_eta_window_matches_brute_force(spark):
    s = samples(spark).withColumn("n", F.col("items"))
    want = brute_eta(s.collect(), window_s=600)
    got = W.eta_window(s, window_seconds=600).collect()
    assert len(got) == len(want)
    for r in got:
        n, avg = want[(r.run_id, r.n)]
        assert r.window_samples == n
        assert (r.avg_sec_per_item is None and avg is None) or abs(r.avg_sec_per_item - avg) < 1e-9


def test_instant_rate_zero_gap_keeps_previous(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, t, 1, 1, 10), (1, t + dt.timedelta(seconds=2), 2, 5, 30), (1, t + dt.timedelta(seconds=2), 3, 9, 90)]
    s = spark.createDataFrame(rows, "run_id long, ts timestamp_ntz, seq long, items long, bytes long") \
        .withColumn("n", F.col("seq"))
    got = {r.n: r for r in W.instant_rate(s).collect()}
    assert got[1].items_per_sec == 0.0 and got[2].items_per_sec == 2.0 and got[3].items_per_sec == 2.0


def test_running_sums_keep_null_keys(spark):
    rows = [(None, 1, 5), (None, 2, 7), ("a", 1, 1)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = {(r.k, r.o): r.cum for r in grouped_running_sums(df, ["k"], ["o"], {"cum": "v"}, F.col("o")).collect()}
    assert got == {(None, 1): 5, (None, 2): 12, ("a", 1): 1}
