"""Exact top-k search by inner product over a bit-sliced index (operator 12).

Method: components are quantised to integers.  The index holds blocks of
``BLOCK_ROWS`` vectors; for every attribute (dimension) and every bit of its
value one bitmap over the block's rows, and its complement for negative
weights.  A query's weighted sum of the attributes is bitmap arithmetic: each
set bit ``j`` of a weight adds the attribute's slices at weight ``2^(bit + j)``,
and carry-save adders (three bitmaps in, a sum and a carry out) reduce the stack
of every weight to one bitmap, which gives the slices of all the block's scores
at once.  The top rows are then selected from the most significant slice
downward; the rows that are still equal after the last slice are the boundary,
and the smallest ids among them fill what is left.  Scores are read back from
the slices, so they are exact integers.

The queries are dealt into groups of ``GROUP_QUERIES``; a task works on one
block and one group, and both are bounded, whatever the table's size.  Every
task returns at most ``k`` rows a query, and the final rank sees ``k`` rows a
query and block.

Defined results: vectors that are null, hold a null or non-finite component, or
one of ``COMPONENT_LIMIT`` or more in magnitude (whose sums would not fit a
long) take no part; vectors of different lengths have no score, empty vectors
score 0 with each other; rows with a query's id are its own and no candidates; a
candidate row that stands there twice is listed twice; rows that repeat a
query's id and vector are one query, a repeated id with another vector is a
query of its own; a null id is no query, as a candidate it comes after all ids
of its score; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ndflow.llm.frames import stored
from ndflow.llm.textcore import U64

TOP = 5
SCALE = 256
BLOCK_ROWS = 8192
GROUP_QUERIES = 4096
COMPONENT_LIMIT = float(1 << 16)
NO_ID = np.iinfo(np.int64).max


def _usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < COMPONENT_LIMIT, F.lit(False)))
    return v.isNotNull() & F.coalesce(fine, F.lit(False))


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: usable vectors as integers, ``floor(scale * x)``."""
    v = vectors[f"`{vec_col}`"].cast("array<double>")
    x = vectors.select(vectors[f"`{id_col}`"].cast("long").alias("vec_id"), v.alias("v")).filter(_usable(F.col("v")))
    return x.select("vec_id", F.transform("v", lambda e: F.floor(e * F.lit(scale)).cast("int")).alias("v"))


INDEX_SCHEMA = "block int, dim int, n int, low long, bits int, ids binary, slices binary"
GROUP_SCHEMA = "grp int, dim int, n int, ids binary, ints binary"


def _by_dim(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids (``NO_ID`` for null) and vectors of up to ``most`` rows of one length."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    count: dict[int, int] = {}

    def out(d):
        ids, v = zip(*held.pop(d), strict=True)
        count.pop(d)
        ids, v = np.concatenate(ids), np.concatenate(v)
        for a in range(0, len(ids), most):
            yield ids[a:a + most], v[a:a + most]

    for b in batches:
        ids = b.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
        lists = b.column(1)
        sizes = np.diff(lists.offsets.to_numpy())
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        start = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        for d in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == d)
            v = values[start[rows][:, None] + np.arange(d)] if d else np.zeros((len(rows), 0), np.int32)
            held.setdefault(d, []).append((ids[rows], v))
            count[d] = count.get(d, 0) + len(rows)
            if count[d] >= 4 * most:
                yield from out(d)
    for d in list(held):
        yield from out(d)


def slice_block(ids: np.ndarray, v: np.ndarray) -> dict:
    """The bitmaps of a block, rows in order of id: ``slices[dim, bit]`` over the
    rows, values counted from the block's smallest."""
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], v[order]
    n, dim = v.shape
    low = int(v.min()) if v.size else 0
    bits = max(1, int(v.max() - low).bit_length()) if v.size else 1
    u = np.zeros((dim, -(-n // 64) * 64), np.int64)
    u[:, :n] = v.T.astype(np.int64) - low
    out = np.empty((dim, bits, u.shape[1] // 64), U64)
    for b in range(bits):
        out[:, b] = np.packbits(((u >> b) & 1).astype(np.uint8), axis=1, bitorder="little").view(U64)
    return {"dim": dim, "n": n, "low": low, "bits": bits, "ids": ids.astype(np.int64).tobytes(), "slices": out.tobytes()}


def _index(batches):
    for ids, v in _by_dim(batches, BLOCK_ROWS):
        yield pa.RecordBatch.from_pylist([{"block": TaskContext.get().partitionId(), **slice_block(ids, v)}], schema=_INDEX)


def _groups(batches):
    for ids, v in _by_dim(batches, GROUP_QUERIES):
        yield pa.RecordBatch.from_pylist([{"grp": TaskContext.get().partitionId(), "dim": v.shape[1], "n": len(ids), "ids": ids.astype(np.int64).tobytes(),
                                           "ints": v.astype(np.int32).tobytes()}], schema=_GROUP)


_INDEX = pa.schema([("block", pa.int32()), ("dim", pa.int32()), ("n", pa.int32()), ("low", pa.int64()), ("bits", pa.int32()),
                    ("ids", pa.binary()), ("slices", pa.binary())])
_GROUP = pa.schema([("grp", pa.int32()), ("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("ints", pa.binary())])


class Block:
    """A block with its bitmaps and their complements, ready for queries."""

    def __init__(self, n: int, dim: int, low: int, bits: int, ids: bytes, slices: bytes):
        self.n, self.low, self.bits = n, low, bits
        self.ids = np.frombuffer(ids, np.int64)
        self.words = -(-n // 64)
        s = np.frombuffer(slices, U64).reshape(dim * bits, self.words)
        self.stack = np.concatenate([s, ~s])  # row (sign * dim + d) * bits + bit
        self.rows = np.zeros(self.words, U64)
        full, rest = divmod(n, 64)
        self.rows[:full] = ~U64(0)
        if rest:
            self.rows[full] = U64((1 << rest) - 1)

    def scores(self, q: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of ``score - constant`` for all rows (lowest first) and the
        constant.

        A negative weight takes the complement: ``-m * u = m * (top - u) - m *
        top`` with ``top = 2^bits - 1``, so that everything added is positive."""
        w = np.abs(q.astype(np.int64))
        negative = q < 0
        top = (1 << self.bits) - 1
        constant = self.low * int(q.sum(dtype=np.int64)) - top * int(w[negative].sum())
        base = (np.where(negative, len(q), 0) + np.arange(len(q))) * self.bits
        levels: list[list[np.ndarray]] = []
        for j in range(int(w.max()).bit_length() if len(w) else 0):
            at = base[(w >> j) & 1 == 1]
            for b in range(self.bits if len(at) else 0):
                while len(levels) <= j + b:
                    levels.append([])
                levels[j + b].append(at + b)
        out, carry = [], np.zeros((0, self.words), U64)
        level = 0
        while level < len(levels) or len(carry):
            own = levels[level] if level < len(levels) else []
            x = np.concatenate([self.stack[np.concatenate(own)], carry]) if own else carry
            one, carry = _add(x)
            out.append(one if one is not None else np.zeros(self.words, U64))
            level += 1
        return out, constant

    def top(self, q: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The block's ``k`` best rows as (position, score)."""
        alive = self.rows.copy()
        a, b = np.searchsorted(self.ids, [own, own], side="left")[0], np.searchsorted(self.ids, own, side="right")
        for i in range(int(a), int(b)):
            alive[i >> 6] &= ~(U64(1) << U64(i & 63))
        slices, constant = self.scores(q)
        sure = np.zeros(self.words, U64)
        n_sure = 0
        for s in reversed(slices):
            hit = alive & s
            n = int(np.bitwise_count(hit).sum())
            if n_sure + n > k:
                alive = hit
            else:  # all of them are among the best; the rest goes on without
                sure |= hit
                n_sure += n
                alive &= ~s
                if n_sure == k:
                    break
        best = _positions(sure, k) + (_positions(alive, k - n_sure) if n_sure < k else [])  # boundary: equal scores, smallest ids
        out = []
        for i in best:
            v = sum(((int(s[i >> 6]) >> (i & 63)) & 1) << e for e, s in enumerate(slices))
            out.append((i, v + constant))
        return out


def _add(x: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
    """Carry-save reduction of the bitmaps of one weight: the bitmap that stays,
    and the carries for the next weight."""
    carries = []
    while len(x) > 2:
        m = len(x) // 3
        a, b, c = x[:m], x[m:2 * m], x[2 * m:3 * m]
        t = a ^ b
        carries.append((a & b) | (t & c))
        x = np.concatenate([t ^ c, x[3 * m:]]) if len(x) > 3 * m else t ^ c
    if len(x) == 2:
        carries.append((x[:1] & x[1:]))
        x = x[:1] ^ x[1:]
    carry = np.concatenate(carries) if carries else np.zeros((0, x.shape[1]), U64)
    return (x[0] if len(x) else None), carry


def _positions(bitmap: np.ndarray, most: int) -> list[int]:
    """Positions of the first ``most`` set bits."""
    out: list[int] = []
    for w in np.flatnonzero(bitmap).tolist():
        v = int(bitmap[w])
        while v and len(out) < most:
            low = v & -v
            out.append((w << 6) + low.bit_length() - 1)
            v ^= low
        if len(out) >= most:
            break
    return out


HITS_SCHEMA = "query_id long, q binary, vec_id long, score long"


def _tile(k: int):
    def run(index: pa.Table, groups: pa.Table) -> pa.Table:
        """Each query of a group against each block of its length."""
        out: list[tuple] = []
        for blk in index.to_pylist():
            block = None
            for g in groups.to_pylist():
                if g["dim"] != blk["dim"]:
                    continue
                block = block or Block(blk["n"], blk["dim"], blk["low"], blk["bits"], blk["ids"], blk["slices"])
                ids, ints = np.frombuffer(g["ids"], np.int64), np.frombuffer(g["ints"], np.int32).reshape(g["n"], g["dim"])
                for own, q in zip(ids.tolist(), ints, strict=True):
                    out += [(own, q.tobytes(), None if block.ids[i] == NO_ID else int(block.ids[i]), s) for i, s in block.top(q, own, k)]
        cols = list(zip(*out, strict=True)) if out else [(), (), (), ()]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                        names=["query_id", "q", "vec_id", "score"])

    return run


def build_index(x: DataFrame, spark: SparkSession) -> tuple[DataFrame, int]:
    """All rows of ``quantised`` vectors in blocks, written once; rows are dealt
    evenly, so a hot id or vector is in all blocks."""
    n = max(1, -(-x.count() // BLOCK_ROWS))
    return stored(x.repartition(n).mapInArrow(_index, INDEX_SCHEMA), spark, "slices"), n


def search(x: DataFrame, queries: DataFrame, spark: SparkSession, k: int = TOP) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best rows of ``x``;
    both frames as made by ``quantised``."""
    index, n_blocks = build_index(x, spark)
    q = queries.filter(F.col("vec_id").isNotNull()).distinct()
    n_groups = max(1, -(-q.count() // GROUP_QUERIES))
    groups = stored(q.repartition(n_groups).mapInArrow(_groups, GROUP_SCHEMA), spark, "queries")
    # a tile is one block and one group: the query set against all rows, in blocks
    left = index.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    right = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    hits = left.groupBy("block", "grp").cogroup(right.groupBy("block", "grp")).applyInArrow(_tile(k), HITS_SCHEMA)
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last()))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_similar(vectors: DataFrame, spark: SparkSession, every: int = 50, k: int = TOP, **columns) -> DataFrame:
    """Search with the rows whose id ``every`` divides as queries."""
    x = quantised(vectors, **columns)
    return search(x, x.filter(F.col("vec_id") % every == 0), spark, k)
