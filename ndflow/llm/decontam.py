"""Benchmark decontamination (operator 2).

Method: a broadcast hash set of the benchmark's normalised n-grams; one scan
of the documents hashes every token window, looks it up, verifies each hit
word by word, and marks the words inside verified windows.  The marked spans
can be cut out (``remove_spans``) or the documents dropped
(``clean_documents``).

The set is broadcast only while the benchmark's text is below
``broadcast_bytes``; a larger benchmark is scanned in parts of that size, each
part one pass over the documents, and the parts' spans are merged per row.

Defined results: a null or wordless document has no words, no hits and
``items`` empty; a null or wordless item matches nothing; an item without an id
hits words and is not listed; an id is listed once, whether its item is repeated
or has several texts; every input row gives one output row, repeated rows
included; texts of any length are read whole; empty documents give no rows, an
empty benchmark hits nothing; other columns of the inputs are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ndflow.llm.frames import filter_docs, lean, pick, text_bytes
from ndflow.llm.textcore import ALNUM, LOWER, U64, Words, cover, doc_sums, member, slices, window_hashes, window_starts

NGRAM = 10
BROADCAST_BYTES = 32 << 20


class NgramIndex:
    """Windows of a set of items: for each length the sorted hashes, and for
    each hash the exact windows with the items that hold them."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        self.windows: dict[int, dict[int, dict[bytes, list[int]]]] = {}
        self.items: list[str] = []
        if items:
            self.items = [i for i, _ in items]
            for no, (_, text) in enumerate(items):
                col = pa.array([text], pa.string())
                for s in slices(col):
                    self._add(no, s, n)
        self.sorted = {k: np.array(sorted(d), dtype=U64) for k, d in self.windows.items()}

    def _add(self, no: int, s, n: int) -> None:
        w = Words(s, ALNUM, lower=True)
        if not len(w):
            return
        k = min(n, len(w))
        low = LOWER[s.data].tobytes()
        words = [low[a:b] for a, b in zip(w.start.tolist(), w.end.tolist(), strict=True)]
        by_hash = self.windows.setdefault(k, {})
        for i, h in enumerate(window_hashes(w.hash, k).tolist()):
            owners = by_hash.setdefault(h, {}).setdefault(b" ".join(words[i:i + k]), [])
            if not owners or owners[-1] != no:
                owners.append(no)


def _scan_slice(s, index: NgramIndex) -> tuple[Words, np.ndarray, list[set[int]]]:
    """Words of a slice, which of them are hit, and the items of each
    document."""
    w = Words(s, ALNUM, lower=True)
    hit = np.zeros(len(w), bool)
    items: list[set[int]] = [set() for _ in range(s.n_docs)]
    low = None
    for k, keys in index.sorted.items():
        at = window_starts(w.first, k)
        if not len(at):
            continue
        found, _ = member(keys, hashes := window_hashes(w.hash, k)[at])
        at, hashes = at[found], hashes[found]
        if not len(at):
            continue
        if low is None:
            low = LOWER[s.data].tobytes()
        docs = np.searchsorted(w.first, at, side="right") - 1
        kept = []
        for i, h, d in zip(at.tolist(), hashes.tolist(), docs.tolist(), strict=True):
            window = b" ".join([low[w.start[j]:w.end[j]] for j in range(i, i + k)])
            owners = index.windows[k][h].get(window)  # verify: same words, not only the same hash
            if owners is not None:
                kept.append(i)
                items[d].update(owners)
        hit |= cover(len(w), np.array(kept, np.int64), k)
    return w, hit, items


SCAN_SCHEMA = "doc_id long, n_words long, n_hit long, spans array<struct<start: int, stop: int>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def _spans(hit: np.ndarray, lo: int, hi: int) -> list[tuple[int, int]]:
    """Runs of hit words of one document, as word indexes."""
    h = np.concatenate([[0], hit[lo:hi].astype(np.int8), [0]])
    step = np.diff(h)
    return [{"start": int(a), "stop": int(b)} for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True)]


def _scan(batches: Iterator[pa.RecordBatch], index) -> Iterator[pa.RecordBatch]:
    idx: NgramIndex = index.value
    for batch in batches:
        ids = batch.column(0)
        for s in slices(batch.column(1)):
            w, hit, items = _scan_slice(s, idx)
            n_hit = doc_sums(hit, w.first)
            spans = [_spans(hit, w.first[d], w.first[d + 1]) if n_hit[d] else [] for d in range(s.n_docs)]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(s.lo, s.n_docs), pa.array(w.counts(), pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(spans, _SPANS), pa.array([sorted({idx.items[i] for i in x} - {None}) for x in items], pa.list_(pa.string()))],
                names=["doc_id", "n_words", "n_hit", "spans", "items"])


def _item_parts(items: DataFrame, limit: int) -> list[DataFrame]:
    """The benchmark itself, or hash parts of it of about ``limit`` bytes."""
    parts = -(-text_bytes(items, "text") // limit)
    if parts <= 1:
        return [items]
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p) for p in range(parts)]


def scan_documents(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document row: ``doc_id, n_words, n_hit, spans`` (hit word
    ranges) and ``items`` (ids of the items with windows in it, sorted)."""
    spark = docs.sparkSession
    d = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    b = _items(benchmark, item_col, item_text)
    parts = _item_parts(b, broadcast_bytes)
    if len(parts) == 1:
        index = spark.sparkContext.broadcast(_index(parts[0], n))
        return d.mapInArrow(lean(lambda it: _scan(it, index)), SCAN_SCHEMA)
    return _marked_by_parts(d, parts, n).drop("_k")


def _items(benchmark: DataFrame, item_col: str, item_text: str) -> DataFrame:
    return pick(benchmark, item_id=(item_col, "string"), text=(item_text, "string")).dropna(subset=["text"]).distinct()


def _marked_by_parts(d: DataFrame, parts: list[DataFrame], n: int) -> DataFrame:
    """``scan_documents`` over the parts of a large benchmark: one pass each,
    spans and items merged per text (``_k``)."""
    u = None
    for part in parts:
        index = d.sparkSession.sparkContext.broadcast(_index(part, n))
        x = _keyed(d).mapInArrow(lean(lambda it, index=index: _keyed_scan(it, index)), "_k string, " + SCAN_SCHEMA)
        u = x if u is None else u.unionAll(x)
    span = "array<struct<start:int,stop:int>>"

    def join(a, x):  # a: merged runs so far, x: the next one by start
        last = F.get(a, F.size(a) - 1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))
        return F.when((F.size(a) > 0) & (x["start"] <= last["stop"]), F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(longer))).otherwise(
            F.concat(a, F.array(x)))

    g = u.groupBy("_k", "doc_id").agg(F.first("n_words").alias("n_words"), F.count(F.lit(1)).alias("_n"),
                                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("_s"),
                                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    g = g.withColumn("spans", F.aggregate("_s", F.array().cast(span), join))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    copies = F.explode(F.sequence(F.lit(1), (F.col("_n") / F.lit(len(parts))).cast("int")))
    return g.select("_k", "doc_id", "n_words", n_hit.alias("n_hit"), "spans", "items", copies.alias("_c")).drop("_c")


def _keyed(d: DataFrame) -> DataFrame:
    return d.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("_k"))


def _keyed_scan(batches, index):
    for batch in batches:
        at = 0
        for out in _scan(iter([batch]), index):
            yield pa.RecordBatch.from_arrays([batch.column(2).slice(at, out.num_rows), *out.columns], names=["_k", *out.schema.names])
            at += out.num_rows


def clean_documents(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM, text_col: str = "text",
                    item_col: str = "item_id", item_text: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The documents without any benchmark window, all their columns kept; one
    pass per part of the benchmark."""
    sc = docs.sparkSession.sparkContext
    b = _items(benchmark, item_col, item_text)
    for part in _item_parts(b, broadcast_bytes):
        index = sc.broadcast(_index(part, n))
        docs = filter_docs(docs, text_col, lambda s, index=index: _clean(s, index.value))
    return docs


def _clean(s, index: NgramIndex) -> np.ndarray:
    w, hit, _ = _scan_slice(s, index)
    return doc_sums(hit, w.first) == 0


def _index(items: DataFrame, n: int) -> NgramIndex:
    """Index of a benchmark part of checked size."""
    return NgramIndex([(r.item_id, r.text) for r in items.orderBy("item_id", "text").toLocalIterator()], n)


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM, id_col: str = "doc_id", text_col: str = "text",
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, text, n_removed``: texts with the hit spans cut out (from the
    first byte of a span's first word to the last byte of its last word)."""
    spark: SparkSession = docs.sparkSession
    d = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    b = _items(benchmark, "item_id", "text")
    parts = _item_parts(b, broadcast_bytes)
    if len(parts) > 1:
        return _cut_marked(d, _marked_by_parts(d, parts, n))
    index = spark.sparkContext.broadcast(_index(b, n))

    def cut(batches):
        for batch in batches:
            for s in slices(batch.column(1)):
                w, hit, _ = _scan_slice(s, index.value)
                n_hit = doc_sums(hit, w.first)
                out = [_without(s, w, i, _spans(hit, w.first[i], w.first[i + 1])) for i in range(s.n_docs)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.lo, s.n_docs), pa.array(out, pa.string()), pa.array(n_hit, pa.int64())],
                                                 names=["doc_id", "text", "n_removed"])

    return d.mapInArrow(cut, "doc_id long, text string, n_removed long")


def _without(s, w: Words, i: int, spans: list[dict]) -> str:
    """Document ``i`` of a slice without some of its words."""
    lo, hi = int(s.offsets[i]), int(s.offsets[i + 1])
    keep, at = [], lo
    for x in spans:
        keep.append(s.data[at:w.start[w.first[i] + x["start"]]].tobytes())
        at = int(w.end[w.first[i] + x["stop"] - 1])
    return b"".join([*keep, s.data[at:hi].tobytes()]).decode()


def _cut_marked(d: DataFrame, marked: DataFrame) -> DataFrame:
    """Cut the merged spans of a benchmark in parts: texts meet their spans by
    fingerprint, only those that have any."""
    spans = marked.filter("n_hit > 0").groupBy("_k").agg(F.first("spans").alias("spans"), F.first("n_hit").alias("n_removed"))
    x = _keyed(d).join(spans, "_k", "left").select("doc_id", "text", "spans", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"))

    def cut(batches):
        for batch in batches:
            marks = batch.column(2).to_pylist()
            for s in slices(batch.column(1)):
                w = Words(s, ALNUM, lower=True)
                out = [_without(s, w, i, marks[s.lo + i] or []) for i in range(s.n_docs)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.lo, s.n_docs), pa.array(out, pa.string()), batch.column(3).slice(s.lo, s.n_docs)],
                                                 names=["doc_id", "text", "n_removed"])

    return x.mapInArrow(lean(cut), "doc_id long, text string, n_removed long")


def digest(scan: DataFrame) -> DataFrame:
    """The contract's columns of ``scan_documents``."""
    return scan.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


def items_digest(items: list[str]) -> str:
    """Reference form of ``items_sha256`` (used by tests)."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
