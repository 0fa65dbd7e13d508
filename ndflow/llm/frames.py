"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import inspect
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ndflow.llm.textcore import slices
from ndflow.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _give_back() -> None:
    """Hand freed memory of this worker back to the system: Arrow's pool, and
    the C library's where it has the call."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def lean(fn):
    """A function over Arrow batches (``mapInArrow``) or groups
    (``applyInArrow``) whose worker keeps no freed memory afterwards: workers
    are reused by later stages and sit next to each other in an executor."""
    def call(*args):
        try:
            out = fn(*args)
            if isinstance(out, pa.Table):
                return out
        finally:
            _give_back()
        return _streamed(out)

    # Spark counts the arguments
    return (lambda a: call(a)) if len(inspect.signature(fn).parameters) == 1 or fn.__defaults__ else (lambda a, b: call(a, b))


def _streamed(batches):
    try:
        yield from batches
    finally:
        _give_back()


def pick(df: DataFrame, **cols: tuple[str, str]) -> DataFrame:
    """Only the named inputs, as ``new name=(column, type)``: whatever else the
    table holds cannot clash with the columns an operator makes."""
    return df.select(*[df[f"`{c}`"].cast(t).alias(new) for new, (c, t) in cols.items()])


def id_remainder(col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (the held-out split)."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(mod)


def stored(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts the lineage
    and survives a lost executor."""
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pinned(df: DataFrame, spark: SparkSession, name: str, limit: int = 10_000) -> DataFrame:
    """A computed table made fixed: up to ``limit`` rows are held as they are (a
    few hundred KB), more are ``stored``.  For per-source and per-range tables,
    which are small as a rule: saves writing many near-empty files."""
    rows = df.limit(limit + 1).collect()
    return spark.createDataFrame(rows, df.schema) if len(rows) <= limit else stored(df, spark, name)


def bounded_sample(df: DataFrame, key: Column, bound: int) -> DataFrame:
    """About ``bound`` rows when there are more (all when not), chosen by a
    hash of ``key``: the same rows on every run."""
    n = df.count()
    if n <= bound:
        return df
    return df.filter(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < F.lit(int((1 << 30) * (bound / n))))


def per_value_sample(df: DataFrame, value: Column, key: Column, counts: dict, bound: int) -> DataFrame:
    """About ``bound`` rows of every value that has more (all of one that has
    not), chosen by a hash of ``key``: the same rows on every run."""
    many = {v: n for v, n in counts.items() if n > bound}
    if not many:
        return df
    share = F.lit(1 << 30)
    for v, n in many.items():
        share = F.when(value == v, F.lit(int((1 << 30) * (bound / n)))).otherwise(share)
    return df.filter(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < share)


def text_bytes(df: DataFrame, col: str) -> int:
    """Total UTF-8 bytes of a text column."""
    return df.agg(F.coalesce(F.sum(F.octet_length(col).cast("long")), F.lit(0))).first()[0]


def filter_docs(docs: DataFrame, text_col: str, verdict) -> DataFrame:
    """Rows whose text ``verdict(slice) -> bool array`` accepts, all columns
    kept; one pass without a join, each row judged by itself."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            if b.num_rows:
                keep = np.concatenate([verdict(s) for s in slices(b.column(at))])
                yield b.filter(pa.array(keep))

    return docs.mapInArrow(lean(run), docs.schema)


def order_key(*cols: Column) -> Column:
    """A non-negative shuffle key: rows sorted by it are in random order, the
    same on every run."""
    return F.xxhash64(*cols, F.lit("order")).bitwiseAND(F.lit((1 << 63) - 1))


def key_block(key: Column, bits: int) -> Column:
    """Top ``bits`` bits of an ``order_key``: blocks are monotone in the key,
    so a running sum can be cut into them."""
    return F.shiftright(key, 63 - bits)


def global_rank(df: DataFrame, spark: SparkSession, order: list[Column], name: str, label: str) -> DataFrame:
    """0-based rank in a global order without sorting all rows in one task:
    range partitions, their counts, and the row number inside each."""
    cols = df.columns
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    x = pinned(df.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id()), spark, label)
    n = x.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    n = n.select(F.col("_pid").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    r = F.row_number().over(Window.partitionBy("_pid").orderBy(*order)) - 1
    x = x.withColumn("_r", r).join(F.broadcast(n), F.col("_pid") == F.col("_p"))  # one row per partition
    return x.select(*cols, (F.col("_r") + F.col("_before")).cast("long").alias(name))
