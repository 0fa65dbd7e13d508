"""Minimum-cost-flow resharding (operator 1).

Method: the old shards' sizes and the new shards' capacities are the two sides
of a flow network; a byte that stays in its shard costs nothing, a byte that
moves costs one.  The cheapest flow says how many bytes go from each old shard
to each new one.  Each old shard is a line of documents in a fixed random
order; the flow cuts the line into consecutive blocks, one per target, and a
document goes where its midpoint lies.  Only shards that gain or lose a block
are written again (``rewrite_affected``).

Only sizes per shard and one order key per cut (at most old + new - 1 of them)
reach the driver; documents are placed by comparing their key with the cuts,
so placing needs no shuffle of texts.  Running sums inside a shard go through
key blocks, so no task holds a whole shard.

Defined results: size is the UTF-8 bytes of the text (null: none) plus one;
capacities are equal to within one byte; a null old shard counts as shard 0;
equal rows (same id and text) share a place; texts of any length only add their
size; empty input gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ndflow.llm.frames import key_block, order_key, pick, stored
from ndflow.plans.seq import grouped_running_sums

SHARDS = 16
BLOCK_BITS = 10


def equal_capacities(total: int, n: int) -> list[int]:
    return [total // n + (i < total % n) for i in range(n)]


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Cheapest amounts (i, j) that ship every supply into the capacities, by
    successive cheapest augmenting paths (Bellman-Ford on the residual
    network).  Nodes are shards, so the network is small."""
    if sum(supply) > sum(capacity):
        raise ValueError("capacities are smaller than the shards")
    n, m = len(supply), len(capacity)
    flow = {(i, j): 0 for i in range(n) for j in range(m)}
    left, room = list(supply), list(capacity)
    while any(left):
        inf = float("inf")
        dist_i = [0 if left[i] else inf for i in range(n)]
        dist_j, via_j, via_i = [inf] * m, [-1] * m, [-1] * n
        changed = True
        while changed:
            changed = False
            for (i, j), f in flow.items():
                if dist_i[i] + cost(i, j) < dist_j[j]:
                    dist_j[j], via_j[j], changed = dist_i[i] + cost(i, j), i, True
                if f and dist_j[j] - cost(i, j) < dist_i[i]:
                    dist_i[i], via_i[i], changed = dist_j[j] - cost(i, j), j, True
        end = min((j for j in range(m) if room[j]), key=lambda j: dist_j[j])
        path, j = [], end
        while True:
            i = via_j[j]
            path.append((i, j, 1))
            if via_i[i] < 0:
                break
            j = via_i[i]
            path.append((i, j, -1))
        amount = min([left[i], room[end], *(flow[a, b] for a, b, sign in path if sign < 0)])
        for a, b, sign in path:
            flow[a, b] += sign * amount
        left[i] -= amount
        room[end] -= amount
    return {k: f for k, f in flow.items() if f}


def block_transfers(old_sizes: dict[int, int], capacities: list[int]) -> list[tuple[int, int, int, int]]:
    """``(old, first byte, end byte, new)`` blocks of every old shard's line:
    what stays comes first, then what leaves, by target."""
    old = sorted(old_sizes)
    flow = min_cost_flow([old_sizes[o] for o in old], capacities, lambda i, j: 0 if old[i] == j else 1)
    out = []
    for i, o in enumerate(old):
        at = 0
        for j in sorted((j for a, j in flow if a == i), key=lambda j: (j != o, j)):
            out.append((o, at, at + flow[i, j], j))
            at += flow[i, j]
    return out


def _order(p: str = "") -> Column:
    return F.struct(F.col(f"{p}key"), F.col(f"{p}doc_id"), F.col(f"{p}text_crc32"))


def sized(docs: DataFrame, old_shard: Column, id_col: str, text_col: str) -> DataFrame:
    """Slim rows: id, size, checksum, old shard and order key."""
    d = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].cast("string").alias("text"), old_shard.alias("old"))
    d = d.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                 F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.coalesce(F.col("old"), F.lit(0)).cast("int").alias("old"))
    return d.withColumn("key", order_key(F.col("doc_id"), F.col("text_crc32")))


def plan(slim: DataFrame, n_shards: int) -> Column:
    """The new shard as an expression over ``sized`` rows."""
    sizes = {r["old"]: r["s"] for r in slim.groupBy("old").agg(F.sum("size").alias("s")).collect()}  # one row per old shard
    blocks = block_transfers(sizes, equal_capacities(sum(sizes.values()), n_shards))
    cuts = [b for b in blocks if b[1] > 0]
    firsts = {}
    if cuts:
        x = grouped_running_sums(slim.filter(F.col("old").isin([b[0] for b in cuts])), ["old"], ["key", "doc_id", "text_crc32"],
                                 {"end": "size"}, key_block(F.col("key"), BLOCK_BITS))
        mid = 2 * F.col("end") - F.col("size")
        row = x.agg(*[F.min(F.when((F.col("old") == o) & (mid >= 2 * lo), _order())).alias(f"c{i}")
                      for i, (o, lo, _, _) in enumerate(cuts)]).first()
        firsts = {(o, lo): row[f"c{i}"] for i, (o, lo, _, _) in enumerate(cuts)}
    out = F.lit(0)
    for o, lo, _, new in blocks:  # later blocks are tested first
        here = F.col("old") == o
        if lo:
            c = firsts[o, lo]
            if c is None:  # no document's midpoint lies in or after the block
                continue
            cut = F.struct(F.lit(c["key"]).alias("key"), F.lit(c["doc_id"]).cast("long").alias("doc_id"), F.lit(c["text_crc32"]).cast("long").alias("text_crc32"))
            here = here & (_order() >= cut)
        out = F.when(here, F.lit(new)).otherwise(out)
    return out.cast("int")


def reshard(docs: DataFrame, spark: SparkSession, old_shard: Column, n_shards: int = SHARDS, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, old_shard, shard, slot`` of every row; slots
    count from 0 without gaps in each shard."""
    slim = stored(sized(docs, old_shard, id_col, text_col), spark, "shards")
    x = slim.withColumn("shard", plan(slim, n_shards)).withColumn("_one", F.lit(1).cast("long"))
    x = grouped_running_sums(x, ["shard"], ["key", "doc_id", "text_crc32", "old"], {"_slot": "_one"}, key_block(F.col("key"), BLOCK_BITS))
    return x.select("doc_id", "size", "text_crc32", F.col("old").alias("old_shard"), "shard", (F.col("_slot") - 1).alias("slot"))


def place(docs: DataFrame, spark: SparkSession, old_shard: Column, n_shards: int = SHARDS, id_col: str = "doc_id",
          text_col: str = "text", out_col: str = "shard") -> DataFrame:
    """``docs`` with the new shard as a column (replaced when it exists): texts
    are neither shuffled nor stored, only their slim rows."""
    slim = stored(sized(docs, old_shard, id_col, text_col), spark, "place")
    expr = plan(slim, n_shards)
    cols = [c for c in docs.columns if c != out_col]
    crc = F.crc32(docs[f"`{text_col}`"].cast("string").cast("binary"))
    ident = docs[f"`{id_col}`"].cast("long")
    tagged = docs.select(F.struct(*[docs[f"`{c}`"] for c in cols]).alias("row"), ident.alias("doc_id"), crc.alias("text_crc32"),
                         F.coalesce(old_shard, F.lit(0)).cast("int").alias("old"), order_key(ident, crc).alias("key"))
    return tagged.select("row.*", expr.alias(out_col))


def rewrite_affected(docs: DataFrame, spark: SparkSession, old_shard: Column, path: str, n_shards: int = SHARDS, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Write the shards that gain or lose documents as Parquet, one folder
    ``shard=N`` each, under ``path``; the files of the others stay as they
    are.  Returns ``shard, n_docs, moved_in, rewritten``."""
    x = place(docs.withColumn("_old", F.coalesce(old_shard, F.lit(0)).cast("int")), spark, F.col("_old"), n_shards, id_col, text_col, "_shard")
    x = stored(x, spark, "rewrite")
    moved = x.filter(F.col("_old") != F.col("_shard")).groupBy("_old", "_shard").agg(F.count(F.lit(1)).alias("n")).collect()  # shard pairs
    touched = sorted({r["_old"] for r in moved} | {r["_shard"] for r in moved})
    keep = [c for c in x.columns if c not in ("_old", "_shard")]
    out = x.filter(F.col("_shard").isin(touched)).select(*keep, F.col("_shard").alias("shard"))
    out.repartition("shard", F.pmod(F.xxhash64(F.col(id_col)), F.lit(64))).write.mode("append").partitionBy("shard").parquet(path)
    return x.groupBy(F.col("_shard").alias("shard")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("_old") != F.col("_shard")).alias("moved_in"),
        F.max(F.col("_shard").isin(touched)).alias("rewritten"))


def digest(placed: DataFrame) -> DataFrame:
    """The contract's columns of ``reshard``."""
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "old_shard", (F.col("shard") != F.col("old_shard")).alias("moved"))
