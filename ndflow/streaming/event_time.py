"""Progress ETA window by event time (T2): samples may come late and in any
order inside a stated delay.

Each run buffers the samples the watermark has not passed, in the stream's
state store, and hands them out in ``(ts, seq)`` order once it has.  A sample
is thus emitted once, with the window of the samples truly before it, whatever
files it came in and in which order.  The buffer holds the samples of the
delay, the window the last few emitted ones; both are bounded by the delay and
the window, not by the run.  Samples later than the delay are dropped by Spark's
watermark; choose the delay by how late files may come.

The samples of the last ``delay`` stay buffered until newer ones move the
watermark on; ``closing_sample`` is a row that does it at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ndflow.operators.progress import WINDOW_SAMPLES, WINDOW_SECONDS

SAMPLE_SCHEMA = "run_id long, ts timestamp, seq long, items long"
OUTPUT_SCHEMA = "run_id long, ts timestamp_ntz, seq long, items long, window_samples int, avg_sec_per_item double"
#: The run of ``closing_sample``; never emitted.
NO_RUN = -(1 << 63)


class EtaProcessor(StatefulProcessor):
    """Keyed state of one run: waiting samples and the last emitted ones."""

    def __init__(self, window_samples: int, window_seconds: int):
        self.most, self.window_us = window_samples, window_seconds * 1_000_000

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "ts long, seq long, items long")
        self.last = handle.getValueState("last", "ts array<long>, items array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] == NO_RUN:
            return
        new = []
        for x in rows:
            new += zip(x["ts"].to_numpy("datetime64[us]").astype("int64").tolist(), x["seq"].tolist(), x["items"].tolist(), strict=True)
        if new:
            self.waiting.appendList(new)
            self.handle.registerTimer(max(new)[0] // 1000 + 1)
        yield from self._emit(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._emit(key, timerValues.getCurrentWatermarkInMs())

    def _emit(self, key, watermark_ms: int) -> Iterator[pd.DataFrame]:
        """The waiting samples that the watermark has passed, in order."""
        limit = watermark_ms * 1000
        if limit <= 0:  # before the first watermark nothing is ready
            return
        samples = [tuple(r) for r in self.waiting.get()]
        ready = sorted(r for r in samples if r[0] <= limit)
        if not ready:
            return
        rest = [r for r in samples if r[0] > limit]
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        ts, items = (list(x) for x in self.last.get()) if self.last.exists() else ([], [])
        out = []
        for t, seq, it in ready:
            ts, items = [*ts, t][-self.most:], [*items, it][-self.most:]
            first = next(i for i, x in enumerate(ts) if x > t - self.window_us)
            ts, items = ts[first:], items[first:]
            seconds, done = (t - ts[0]) / 1e6, it - items[0]
            out.append((key[0], t, seq, it, len(ts), seconds / done if len(ts) >= 2 and done > 0 and seconds > 0 else None))
        self.last.update((ts, items))
        runs, us, seqs, counts, sizes, avgs = zip(*out, strict=True)
        yield pd.DataFrame({"run_id": np.array(runs), "ts": np.array(us, "int64").view("datetime64[us]"), "seq": np.array(seqs), "items": np.array(counts),
                            "window_samples": np.array(sizes, "int32"), "avg_sec_per_item": np.array(avgs, "float64")}, copy=False)

    def close(self) -> None:
        pass


def eta_events(samples: DataFrame, delay: str = "1 hour", window_samples: int = WINDOW_SAMPLES, window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """``samples``: a streaming frame ``(run_id, ts, seq, items)``; rows as in
    ``operators.progress.eta_window``.  Needs the RocksDB state store
    (``use_rocksdb``)."""
    x = samples.select("run_id", F.col("ts").cast("timestamp").alias("ts"), "seq", "items").withWatermark("ts", delay)
    return x.groupBy("run_id").transformWithStateInPandas(EtaProcessor(window_samples, window_seconds), OUTPUT_SCHEMA, "Append", "EventTime")


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that keyed timers need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def closing_sample(spark: SparkSession, ts: str) -> DataFrame:
    """One row that moves the watermark to ``ts`` less the delay."""
    return spark.createDataFrame([(NO_RUN, 0, 0)], "run_id long, seq long, items long").select(
        "run_id", F.lit(ts).cast("timestamp_ntz").alias("ts"), "seq", "items", F.lit(0).cast("long").alias("bytes"))


def event_samples(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A file stream of progress samples; ``max_files`` bounds a micro-batch."""
    r = spark.readStream.schema("run_id long, ts timestamp_ntz, seq long, items long, bytes long")
    return (r.option("maxFilesPerTrigger", max_files) if max_files else r).parquet(path)
