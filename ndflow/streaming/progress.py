"""Progress ETA window on a live feed (T2): the W1 window as keyed streaming
state.

Each run keeps only its last ``window_samples`` samples as state (bounded,
whatever the run's length); every new sample updates the state and emits
the window size and average seconds per item, exactly like the batch
``operators.progress.eta_window``.  Samples of a run are expected in
``(ts, seq)`` order across micro-batches (inside a micro-batch they are
sorted).  The state lives in the stream's checkpoint (shared storage), so a
restarted query continues where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ndflow.operators.progress import WINDOW_SAMPLES, WINDOW_SECONDS

OUTPUT_SCHEMA = ("run_id long, ts timestamp_ntz, seq long, items long, window_samples int, "
                 "avg_sec_per_item double")
STATE_SCHEMA = "ts_us array<long>, items array<long>"


def eta_stream(samples: DataFrame, window_samples: int = WINDOW_SAMPLES,
               window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """``samples``: a (streaming) frame ``(run_id, ts, seq, items)``."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    window_us = window_seconds * 1_000_000

    def update(key, batches, state):
        import numpy as np
        import pandas as pd

        # plain arrays: a run has few samples in a micro-batch, and frame operations cost more than they
        parts = [(x["ts"].to_numpy("datetime64[us]").astype("int64"), x["seq"].to_numpy(), x["items"].to_numpy()) for x in batches]
        stamps, seqs, counts = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((seqs, stamps))
        stamps, seqs, counts = stamps[order], seqs[order], counts[order]
        ts_us, items = (list(state.get[0]), list(state.get[1])) if state.exists else ([], [])
        old = len(ts_us)
        ts_us += stamps.tolist()
        items += counts.tolist()
        first, sizes, avgs = 0, [], []
        for i in range(old, len(ts_us)):
            t = ts_us[i]
            first = max(first, i + 1 - window_samples)
            while ts_us[first] <= t - window_us:
                first += 1
            seconds, done = (t - ts_us[first]) / 1e6, items[i] - items[first]
            sizes.append(i + 1 - first)
            avgs.append(seconds / done if i > first and done > 0 and seconds > 0 else None)
        state.update((ts_us[first:], items[first:]))
        yield pd.DataFrame({"run_id": np.full(len(stamps), key[0]), "ts": stamps.view("datetime64[us]"), "seq": seqs, "items": counts,
                            "window_samples": np.array(sizes, "int32"), "avg_sec_per_item": np.array(avgs, "float64")}, copy=False)

    return (samples.select("run_id", "ts", "seq", "items")
            .groupBy("run_id")
            .applyInPandasWithState(update, OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout))


def run_available(stream_df: DataFrame, sink_dir: str, checkpoint: str) -> None:
    """Process everything available now into ``sink_dir`` (Parquet)."""
    q = (stream_df.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def samples_from(spark, path: str) -> DataFrame:
    """A file stream of progress samples written as Parquet under ``path``.
    All files that are there make one micro-batch (no file limit), so their
    order does not matter."""
    schema = "run_id long, ts timestamp_ntz, seq long, items long, bytes long"
    return spark.readStream.schema(schema).parquet(path).select(
        "run_id", "ts", "seq", "items", F.col("bytes"))
