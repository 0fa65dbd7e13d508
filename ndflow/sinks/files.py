"""Sinks: NDJSON, CSV and Parquet through Spark's file committer (K1-K5).

Writes are atomic per job (temporary attempt folders, ``_SUCCESS`` on
commit), so a failed or retried task never leaves a partial file visible:
the reference's ``.part`` + rename rule (K3) is the committer's job here.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ndflow.functions.jsonfn import one_line
from ndflow.session import scratch_path

# Prefix of a de-identified output file name.
OUTPUT_PREFIX = "dimped_"


def output_name(file_name: Column, prefix: str = OUTPUT_PREFIX) -> Column:
    """K2: one output per input, named ``<prefix><input name>``."""
    return F.concat(F.lit(prefix), file_name)


def output_path(rel_path: Column, prefix: str = OUTPUT_PREFIX) -> Column:
    """K2 for a file below a source: its folder, and the output name, so that
    files of one name in two folders stay apart."""
    name = F.regexp_extract(rel_path, "([^/]+)$", 1)
    return F.concat(F.regexp_replace(rel_path, "[^/]+$", ""), output_name(name, prefix))


def to_ndjson_line(value: Column) -> Column:
    """K1: one JSON object per line, compact with sorted keys; a value beyond
    the VARIANT limit keeps its own text on one line."""
    return one_line(value)


def write_ndjson(df: DataFrame, path: str, value_col: str = "value", partition_col: str | tuple[str, ...] | None = None,
                 mode: str = "overwrite") -> None:
    """K1/K2: text lines; with ``partition_col`` (or several) one folder per
    source file.
    ``overwrite`` with dynamic partition overwrite replaces only the
    partitions written (resume-safe)."""
    cols = [to_ndjson_line(F.col(value_col)).alias("value")]
    parts = (partition_col,) if isinstance(partition_col, str) else partition_col or ()
    cols += [F.col(c) for c in parts]
    w = df.select(*cols).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if parts:
        w = w.partitionBy(*parts)
    w.text(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder: what several branches of a plan
    read is then made once."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """K4: flat frame to CSV with a header; partitioned output replaces only the
    folders it writes."""
    w = df.write.mode(mode).option("header", True).option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*partition_by) if partition_by else w).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """K5: Parquet, optionally partitioned (e.g. by resource type); partitioned
    output replaces only the folders it writes."""
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
