"""Exact per-group running counts and sums that do not put a whole group in
one task.

A plain ``sum(...) OVER (PARTITION BY key ORDER BY ...)`` sends every row of a
key to one task; with one key holding a third of the data that task is the
job.  Here each key is cut into sub-buckets by a column that is monotone in
the order (a time bucket, an id range, a file split).  Three steps, all
distributed:

1. totals per (key, bucket): a partial aggregate, combined map-side;
2. offsets per (key, bucket): a prefix sum over the small bucket table;
3. running sums inside each (key, bucket) window plus the bucket's offset.

Every task holds at most one bucket of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one id range handled by one window task when the order key is an id.
ID_BUCKET = 1 << 20


def grouped_running_sums(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, str],
                         bucket: Column) -> DataFrame:
    """Add one running-sum column per ``sums`` item (out name -> source column)."""
    b = df.withColumn("_bk", bucket)
    totals = b.groupBy(*keys, "_bk").agg(*[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()])
    before = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_bk", *[
        F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).cast("long").alias(f"_o_{o}") for o in sums])
    upto = Window.partitionBy(*keys, "_bk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner = b.select("*", *[F.sum(c).over(upto).alias(f"_r_{o}") for o, c in sums.items()])
    out = join_null_safe(inner, offsets, [*keys, "_bk"])
    return out.select(*df.columns, *[(F.col(f"_r_{o}") + F.col(f"_o_{o}")).cast("long").alias(o) for o in sums])


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where NULL matches NULL, so rows with a NULL
    key are kept (a plain equi-join would drop them)."""
    r = right.select(*[F.col(k).alias(f"_j{i}") for i, k in enumerate(keys)],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for i, k in enumerate(keys):
        c = left[k].eqNullSafe(r[f"_j{i}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "inner").drop(*[f"_j{i}" for i in range(len(keys))])


def grouped_row_number(df: DataFrame, keys: list[str], order_col: str, name: str,
                       bucket: Column | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order_col)`` computed in
    two levels; ``order_col`` must be unique within a key.  Default buckets are
    id ranges of ``ID_BUCKET``."""
    if bucket is None:
        bucket = F.floor(F.col(order_col) / F.lit(ID_BUCKET))
    one = df.withColumn("_one", F.lit(1).cast("long"))
    out = grouped_running_sums(one, keys, [order_col], {name: "_one"}, bucket)
    return out.drop("_one")


def range_row_number(df: DataFrame, keys: list[str], order_col: str, name: str) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order_col)`` through
    sampled ranges of (keys, order_col): no bucket expression is needed, and a
    key of any size and any id pattern is cut into even parts.  The ranged rows
    are written once to the shared folder, so their part numbers are fixed."""
    import uuid

    from ndflow.session import scratch_path
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, f"ranges-{uuid.uuid4().hex}")
    df.repartitionByRange(parts, *keys, order_col).withColumn("_bk", F.spark_partition_id()).write.parquet(path)
    one = spark.read.parquet(path).withColumn("_one", F.lit(1).cast("long"))
    out = grouped_running_sums(one, keys, [order_col], {name: "_one"}, F.col("_bk"))
    return out.select(*df.columns, name)


def grouped_forward_fill(df: DataFrame, keys: list[str], order_col: str, cols: list[str],
                         bucket: Column) -> DataFrame:
    """``last(c, ignorenulls) OVER (PARTITION BY keys ORDER BY order_col)`` for
    each column, two-level: the last non-null per (key, bucket) is carried
    across buckets on the small bucket table, then filled inside buckets."""
    b = df.withColumn("_bk", bucket)
    lasts = b.groupBy(*keys, "_bk").agg(*[
        F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(order_col).alias("o"), F.col(c).alias("v"))))
        .alias(f"_l_{c}") for c in cols])
    before = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(*keys, "_bk", *[
        F.last(F.col(f"_l_{c}")["v"], ignorenulls=True).over(before).alias(f"_c_{c}") for c in cols])
    upto = Window.partitionBy(*keys, "_bk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    inner = b.select(*[x for x in b.columns if x not in cols], *[
        F.last(F.col(c), ignorenulls=True).over(upto).alias(f"_f_{c}") for c in cols])
    out = join_null_safe(inner, carried, [*keys, "_bk"])
    return out.select(*[x for x in df.columns if x not in cols],
                      *[F.coalesce(f"_f_{c}", f"_c_{c}").alias(c) for c in cols])


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over all cores.  A table's file can be a few MB, so
    one task or a handful, while what is made of each of its rows is costly: deal
    the columns that are needed before that work."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism))


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition on the grouping key before a list-building aggregate
    (``collect_list``).  Such aggregates do not shrink data map-side, so
    shuffling the raw rows and aggregating once is cheaper than shuffling
    serialized partial lists; the shuffle volume is the same."""
    return df.repartition(*keys)
