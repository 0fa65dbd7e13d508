"""The ETA stream by event time equals the batch window."""

import random

from pyspark.sql import functions as F

from ndflow.operators.progress import eta_window
from ndflow.streaming import event_time as T
from ndflow.streaming.progress import run_available


def test_many_files_in_any_order_under_a_file_limit(spark, tmp_dir):
    rows = [(1 + i % 3, f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", i, i // 3 + 1, 0) for i in range(240)]
    rows += [(9, "2024-01-01 00:00:30", 5, 7, 0), (9, "2024-01-01 00:00:30", 4, 3, 0)]  # equal times: by seq
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "run_id long, t string, seq long, items long, bytes long").select(
        "run_id", F.col("t").cast("timestamp_ntz").alias("ts"), "seq", "items", "bytes")
    df.repartition(110, F.rand(3)).write.mode("append").parquet(tmp_dir + "/src")
    T.use_rocksdb(spark)

    def run():
        run_available(T.eta_events(T.event_samples(spark, tmp_dir + "/src", 30), "10 minutes"), tmp_dir + "/sink", tmp_dir + "/ck")

    run()
    held = spark.read.parquet(tmp_dir + "/sink").count()
    T.closing_sample(spark, "2024-01-02 00:00:00").write.mode("append").parquet(tmp_dir + "/src")
    run()
    got = {(r.run_id, r.seq): (r.ts, r.items, r.window_samples, r.avg_sec_per_item) for r in spark.read.parquet(tmp_dir + "/sink").collect()}
    want = {(r.run_id, r.items): (r.window_samples, r.avg_sec_per_item) for r in eta_window(
        df.withColumn("n", F.row_number().over(__import__("pyspark").sql.Window.partitionBy("run_id").orderBy("ts", "seq")).cast("long"))).collect()}
    assert held < 242 and len(got) == 242 and spark.read.parquet(tmp_dir + "/sink").count() == 242
    assert {(r, v[1]): v[2:] for (r, _), v in got.items()} == want
