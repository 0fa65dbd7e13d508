"""Mixing sources to target weights (operator 4).

Method: weighted fair queueing.  Documents of a source stand in a fixed random
order; a document's virtual finish time is the source's cumulative words up to
and including it, divided by the source's target.  All copies (first and
second pass over a source) are put in one global order of finish times by a
range sort, and the order is cut where the total budget is spent.  A source's
words thus come near its target: the cut lies near time 1 for all of them.

Targets: sources in code point order (null last) weigh 3, 1, 2, repeating, and
share ``budget`` x all words; a target stops at ``max_passes`` x its source's
words and the excess is shared again by weight until none is above.

A hot source is no single task: its running sums go through key blocks, and
the sort is by ranges.  Only slim rows (id, source, size) are shuffled; the
driver sees one cut row.

Defined results: size is the number of words (null or empty: 0, never taken,
``taken`` 0); a null source is a source of its own; equal rows are taken alike;
texts of any length count by their words, in the JVM; empty input gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ndflow.llm.frames import global_rank, key_block, order_key, pinned, stored
from ndflow.plans.seq import grouped_running_sums, join_null_safe

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_PASSES = 2
BLOCK_BITS = 10
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of the per-source table below which it is broadcast.
BROADCAST_SOURCES = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(slim: DataFrame, spark: SparkSession, weights=WEIGHTS, budget: float = BUDGET, max_passes: int = MAX_PASSES) -> DataFrame:
    """``source, source_size, rank, weight, target`` of every source."""
    per = slim.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked = global_rank(per, spark, [F.col("source").asc_nulls_last()], "rank", "sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    t = pinned(ranked.withColumn("weight", w).withColumn("cap", (F.col("source_size") * max_passes).cast("double")), spark, "targets")
    total = t.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("s")).first()["s"]
    level, stopped = 0.0, -1
    while True:  # each round raises the level; it ends when no more targets stop
        full = F.col("cap") <= F.col("weight") * level
        r = t.agg(F.count_if(full).alias("n"), F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)).alias("c"),
                  F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("w")).first()
        if r["n"] == stopped or not r["w"]:
            break
        stopped, level = r["n"], (budget * total - r["c"]) / r["w"]
    return t.select("source", "source_size", "rank", "weight", F.least("cap", F.col("weight") * level).alias("target"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = docs[f"`{text_col}`"].cast("string")
    d = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{source_col}`"].cast("string").alias("source"),
                    n_words(text).alias("size"), F.crc32(text.cast("binary")).alias("crc"))
    return d.withColumn("key", order_key(F.col("doc_id"), F.col("crc")))


_TIE = ["rank", "key", "doc_id", "crc", "size"]


def _finish(x: DataFrame) -> DataFrame:
    """Finish times of the first and second pass of each row."""
    t = F.col("target")
    return x.select("*", *[(F.when(t > 0, (F.col("cum") + F.col("source_size") * p) / t)).alias(f"finish{p}") for p in range(MAX_PASSES)])


def _before(p: int, cut) -> Column:
    """Whether a row's copy of pass ``p`` stands at or before the cut."""
    mine = F.struct(F.col(f"finish{p}").alias("f"), F.lit(p).alias("pass"), *[F.col(c) for c in _TIE])
    at = F.struct(F.lit(cut["f"]).alias("f"), F.lit(cut["pass"]).alias("pass"),
                  *[F.lit(cut[c]).cast(t).alias(c) for c, t in zip(_TIE, ("long",) * 5, strict=True)])
    return (F.col("size") > 0) & F.col(f"finish{p}").isNotNull() & (mine <= at)


def mix(docs: DataFrame, spark: SparkSession, weights=WEIGHTS, budget: float = BUDGET, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """``doc_id, source, size, crc, source_size, target, copies, taken`` of
    every row: how often it is taken (0 to 2) and its words times that."""
    slim = stored(_sized(docs, id_col, text_col, source_col), spark, "mix")
    targets = source_targets(slim, spark, weights, budget)
    total = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("s"), F.count(F.lit(1)).alias("n")).first()
    t = F.broadcast(targets) if total["n"] <= BROADCAST_SOURCES else targets
    x = join_null_safe(slim, t, ["source"])
    x = grouped_running_sums(x, ["rank"], ["key", "doc_id", "crc", "size"], {"cum": "size"}, key_block(F.col("key"), BLOCK_BITS))
    x = stored(_finish(x), spark, "finish")
    cut = _cut(x, spark, budget * total["s"])
    copies = F.lit(0)
    if cut is not None:
        for p in range(MAX_PASSES):
            copies = copies + _before(p, cut).cast("int")
    return x.withColumn("copies", copies).select("doc_id", "source", "size", "crc", "source_size", "target", "copies",
                                                 (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def _cut(x: DataFrame, spark: SparkSession, budget: float):
    """The last copy of the global order that the budget pays for."""
    order = ["f", "pass", *_TIE]
    copies = x.filter("size > 0 and finish0 is not null").select(
        F.explode(F.array(*[F.struct(F.col(f"finish{p}").alias("f"), F.lit(p).alias("pass")) for p in range(MAX_PASSES)])).alias("c"), *_TIE)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = stored(copies.select("c.f", "c.pass", *_TIE).repartitionByRange(parts, *order).withColumn("pid", F.spark_partition_id()), spark, "queue")
    sums = s.groupBy("pid").agg(F.sum("size").alias("n"), F.max(F.struct(*order)).alias("last"))
    upto = sums.withColumn("upto", F.sum("n").over(Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, 0)))  # one row per range
    upto = pinned(upto, spark, "queuesums")
    whole = upto.filter(F.col("upto") <= budget).agg(F.max(F.struct("pid", "upto", "last")).alias("m")).first()["m"]
    crossing = upto.filter(F.col("upto") > budget).agg(F.min("pid").alias("p")).first()["p"]
    cut = whole["last"] if whole else None
    if crossing is not None:
        run = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) + (whole["upto"] if whole else 0)
        last = (s.filter(F.col("pid") == crossing).withColumn("run", run).filter(F.col("run") <= budget)
                .agg(F.max(F.struct(*order)).alias("m")).first()["m"])
        cut = last or cut
    return cut


def mixed_documents(docs: DataFrame, spark: SparkSession, weights=WEIGHTS, budget: float = BUDGET, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every document as often as it is taken, all its columns
    kept; rows equal in id, source and text are taken alike.

    Finish times follow the order inside a source, so what is taken of a
    source in a pass ends at one order key: texts are compared with the keys
    of their source and not shuffled."""
    m = mix(docs, spark, weights, budget, id_col, text_col, source_col)
    m = m.withColumn("at", F.struct(order_key(F.col("doc_id"), F.col("crc")).alias("key"), "doc_id", "crc"))
    ends = m.groupBy("source").agg(*[F.max(F.when((F.col("copies") > p) & (F.col("size") > 0), F.col("at"))).alias(f"end{p}")
                                     for p in range(MAX_PASSES)])
    ends = pinned(ends, spark, "ends").withColumnRenamed("source", "_src")
    if ends.count() <= BROADCAST_SOURCES:
        ends = F.broadcast(ends)
    text, ident = docs[f"`{text_col}`"].cast("string"), docs[f"`{id_col}`"].cast("long")
    crc = F.crc32(text.cast("binary"))
    at = F.struct(order_key(ident, crc).alias("key"), ident.alias("doc_id"), crc.alias("crc"))
    x = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{source_col}`"].cast("string").alias("_s"),
                    at.alias("_at")).filter(F.coalesce(text.rlike(WORD), F.lit(False)))
    x = x.join(ends, x["_s"].eqNullSafe(ends["_src"]))
    copies = sum((F.coalesce(F.col("_at") <= F.col(f"end{p}"), F.lit(False)).cast("int") for p in range(MAX_PASSES)), F.lit(0))
    return x.select("row", F.explode(F.array_repeat(F.lit(1), copies)).alias("_copy")).select("row.*")


def digest(mixed: DataFrame) -> DataFrame:
    """The contract's columns of ``mix``."""
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")
