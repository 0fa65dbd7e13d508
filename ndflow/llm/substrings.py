"""Substring deduplication (operator 3).

Method: fixed-block anchors.  Every document's non-overlapping 7-word blocks
(words 0-6, 7-13, ...) are the index; every rolling 7-word window probes it.
A 13-word window holds a whole block of the document it repeats, so each
repeat is anchored by a hit.  Hits are extended: the 13-word windows around an
anchor are looked up by a 96-bit fingerprint, and those that start in an
earlier document are covered.  Consecutive windows join to the maximal exact
repeat; its words are removed.

Chunks are ranges of ``doc_id`` (see ``chunks``), so "in a smaller document"
is "in a lower chunk" or decided inside the chunk.  Three passes read one
exchange of the texts: announce blocks and probes, announce anchored windows,
remove.  A passage in a third of all documents costs one entry per chunk.

Defined results: a null or empty text has no words (kept_sha256 of the empty
string); documents with a null ``doc_id`` are left whole and never make others
lose words; rows with equal ``doc_id`` do not remove from each other; one output
row per input row; texts of any length are read whole, a very long one as a slice
of its own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ndflow.llm.chunks import Plan, bucket_runs, run_ends, run_starts, short_keys, text_arrays, unpack
from ndflow.llm.frames import lean, pick
from ndflow.llm.textcore import CHECK_BASE, NON_SPACE, U64, Slice, Words, cover, doc_sums, member, slices, window_hashes, window_starts

WINDOW = 13
BLOCK = 7  # the largest block of which every 13-word window holds a whole one

_INDEX = "bucket int, chunk int, blocks binary, probes binary"
_ANCHORS = "chunk int, bucket int, keys binary"
_WINDOWS = "bucket int, chunk int, prints binary, checks binary"
_EARLIER = "chunk int, prints binary, checks binary"
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _batch(rows: dict[str, list], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    return pa.table({n: pa.array(rows[n], kinds[k]) for n, k in (c.split() for c in schema.split(", "))})


def _announce(table: pa.Table, bits: int) -> pa.Table:
    """A chunk's distinct block and probe keys, packed by bucket."""
    chunk = table.column("chunk")[0].as_py()
    blocks, probes = [], []
    for s in slices(text_arrays(table, "text")):
        w = Words(s, NON_SPACE)
        at = window_starts(w.first, BLOCK)
        keys = short_keys(window_hashes(w.hash, BLOCK)[at], bits)
        aligned = (at - np.repeat(w.first[:-1], np.diff(w.first))[at]) % BLOCK == 0
        blocks.append(keys[aligned])
        probes.append(keys)
    b = np.unique(np.concatenate(blocks))
    p = np.unique(np.concatenate(probes))
    p = p[~member(b, p)[0]]
    out: dict[str, list] = {"bucket": [], "chunk": [], "blocks": [], "probes": []}
    packed = {"blocks": {}, "probes": {}}
    for name, keys in (("blocks", b), ("probes", p)):
        for bucket, lo, hi in bucket_runs(keys, 32):
            packed[name][bucket] = keys[lo:hi].astype(np.uint32).tobytes()
    for bucket in sorted(set(packed["blocks"]) | set(packed["probes"])):
        out["bucket"].append(bucket)
        out["chunk"].append(chunk)
        out["blocks"].append(packed["blocks"].get(bucket, b""))
        out["probes"].append(packed["probes"].get(bucket, b""))
    return _batch(out, _INDEX)


def _anchors(table: pa.Table) -> pa.Table:
    """Of one bucket: keys that are a block in one chunk and occur in a later
    one, sent to each chunk that has to extend them."""
    chunk_of = table.column("chunk").to_numpy()
    bk, br = unpack(table.column("blocks"), np.uint32)
    pk, pr = unpack(table.column("probes"), np.uint32)
    key, chunk = np.concatenate([bk, pk]), chunk_of[np.concatenate([br, pr])]
    block = np.arange(len(key)) < len(bk)
    order = np.argsort(key, kind="stable")
    key, chunk, block = key[order], chunk[order], block[order]
    out: dict[str, list] = {"chunk": [], "bucket": [], "keys": []}
    same = key[1:] == key[:-1]
    shared = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(key) else np.zeros(0, bool)
    key, chunk, block = key[shared], chunk[shared], block[shared]
    if len(key):
        st = run_starts(key)
        n = np.diff(np.concatenate([st, [len(key)]]))
        none = np.iinfo(np.int32).max
        first_block = np.repeat(np.minimum.reduceat(np.where(block, chunk, none), st), n)
        last = np.repeat(np.maximum.reduceat(chunk, st), n)
        send = (chunk > first_block) | (block & (last > chunk))
        key, chunk = key[send], chunk[send]
        order = np.argsort(chunk, kind="stable")
        key, chunk = key[order], chunk[order]
        st = run_starts(chunk)
        for lo, hi in zip(st, run_ends(st, len(chunk)), strict=True):
            out["chunk"].append(int(chunk[lo]))
            out["bucket"].append(table.column("bucket")[0].as_py())
            out["keys"].append(np.sort(key[lo:hi]).tobytes())
    return _batch(out, _ANCHORS)


def _prints(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """64-bit and 32-bit fingerprint of every run of 13 words."""
    return window_hashes(w.hash, WINDOW), (window_hashes(w.hash, WINDOW, CHECK_BASE) >> U64(32)).astype(np.uint32)


def _extend(docs: pa.Table, anchors: pa.Table, bits: int) -> pa.Table:
    """A chunk's distinct 13-word windows that hold an anchor."""
    out: dict[str, list] = {"bucket": [], "chunk": [], "prints": [], "checks": []}
    if not docs.num_rows or not anchors.num_rows:
        return _batch(out, _WINDOWS)
    chunk = docs.column("chunk")[0].as_py()
    k, r = unpack(anchors.column("keys"), np.uint32)
    keys = np.sort((anchors.column("bucket").to_numpy()[r].astype(U64) << U64(32)) | k.astype(U64))
    prints, checks = [], []
    for s in slices(text_arrays(docs, "text")):
        w = Words(s, NON_SPACE)
        at = window_starts(w.first, WINDOW)
        if not len(at):
            continue
        hit = np.zeros(len(w) + 1, np.int32)
        rolling = short_keys(window_hashes(w.hash, BLOCK), bits)
        hit[1:len(rolling) + 1] = member(keys, rolling)[0]
        seen = np.cumsum(hit)
        at = at[seen[at + WINDOW - BLOCK + 1] > seen[at]]  # a block starts at one of its first 7 words
        h, c = _prints(w)
        prints.append(h[at])
        checks.append(c[at])
    h, first = np.unique(np.concatenate(prints), return_index=True) if prints else (np.zeros(0, U64), np.zeros(0, np.int64))
    c = np.concatenate(checks)[first] if prints else np.zeros(0, np.uint32)
    for bucket, lo, hi in bucket_runs(h, 64 - bits):
        out["bucket"].append(bucket)
        out["chunk"].append(chunk)
        out["prints"].append(h[lo:hi].tobytes())
        out["checks"].append(c[lo:hi].tobytes())
    return _batch(out, _WINDOWS)


def _earlier(table: pa.Table) -> pa.Table:
    """Of one bucket: each chunk's windows that a lower chunk holds too."""
    h, r = unpack(table.column("prints"), U64)
    c, _ = unpack(table.column("checks"), np.uint32)
    chunk = table.column("chunk").to_numpy()[r]
    order = np.lexsort((chunk, c, h))
    h, c, chunk = h[order], c[order], chunk[order]
    later = np.concatenate([[False], (h[1:] == h[:-1]) & (c[1:] == c[:-1])]) if len(h) else np.zeros(0, bool)
    h, c, chunk = h[later], c[later], chunk[later]
    out: dict[str, list] = {"chunk": [], "prints": [], "checks": []}
    order = np.argsort(chunk, kind="stable")
    h, c, chunk = h[order], c[order], chunk[order]
    st = run_starts(chunk)
    for lo, hi in zip(st, run_ends(st, len(chunk)), strict=True):
        out["chunk"].append(int(chunk[lo]))
        out["prints"].append(h[lo:hi].tobytes())
        out["checks"].append(c[lo:hi].tobytes())
    return _batch(out, _EARLIER)


def _own_earlier(h: np.ndarray, c: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which windows also start in a smaller document of the same chunk."""
    order = np.lexsort((doc, c, h))
    sh, sc, sd = h[order], c[order], doc[order]
    new = np.concatenate([[True], (sh[1:] != sh[:-1]) | (sc[1:] != sc[:-1])]) if len(h) else np.zeros(0, bool)
    first = sd[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else sd
    out = np.zeros(len(h), bool)
    out[order] = sd > first
    return out


def kept_text(text: bytes, covered: np.ndarray) -> bytes:
    """Words that are not covered, joined by one space."""
    words = text.split()
    return b" ".join(words if not covered.any() else [w for w, x in zip(words, covered.tolist(), strict=True) if not x])


def _remove(docs: pa.Table, earlier: pa.Table, finish) -> pa.Table:
    """Covered words of every document of a chunk, given to ``finish``."""
    ids = docs.column("doc_id").to_numpy()
    k, _ = unpack(earlier.column("prints"), U64)
    v, _ = unpack(earlier.column("checks"), np.uint32)
    order = np.argsort(k, kind="stable")
    k, v = k[order], v[order]
    rank = np.unique(ids, return_inverse=True)[1]
    hs, cs, ds, ats, sl, base = [], [], [], [], [], 0
    firsts: list[tuple[Slice, np.ndarray, int]] = []
    for s in slices(text_arrays(docs, "text")):
        w = Words(s, NON_SPACE)
        at = window_starts(w.first, WINDOW)
        if len(at):
            h, c = _prints(w)
            hs.append(h[at])
            cs.append(c[at])
            ds.append(rank[s.lo + np.repeat(np.arange(s.n_docs), np.diff(w.first))[at]])
            ats.append(at + base)
        firsts.append((s, w.first, base))
        base += len(w)
    if hs:
        h, c, d, at = (np.concatenate(x) for x in (hs, cs, ds, ats))
        found, i = member(k, h)
        found &= (v[i] == c) if len(v) else False
        covered = cover(base, at[found | _own_earlier(h, c, d)], WINDOW)
    else:
        covered = np.zeros(base, bool)
    parts = []
    for s, first, b in firsts:
        cov = covered[b:b + int(first[-1])]
        parts.append(finish(ids[s.lo:s.hi], s, first, cov))
    return pa.concat_tables(parts)


def _digest(ids, s: Slice, first: np.ndarray, covered: np.ndarray) -> pa.Table:
    sha = [hashlib.sha256(kept_text(s.doc(i), covered[first[i]:first[i + 1]])).hexdigest() for i in range(s.n_docs)]
    return _batch({"doc_id": ids, "n_words": np.diff(first), "n_removed": doc_sums(covered, first), "kept_sha256": sha}, _RESULT)


def _texts(ids, s: Slice, first: np.ndarray, covered: np.ndarray) -> pa.Table:
    text = [kept_text(s.doc(i), covered[first[i]:first[i + 1]]).decode() for i in range(s.n_docs)]
    return _batch({"doc_id": ids, "text": text, "n_removed": doc_sums(covered, first)}, "doc_id long, text string, n_removed long")


def _run(docs: DataFrame, id_col: str, text_col: str, finish, schema: str) -> DataFrame:
    spark = docs.sparkSession
    d = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    plan = Plan(d, "doc_id", "text")
    bits = plan.bits
    texts = d.filter(F.col("doc_id").isNotNull()).select("doc_id", "text", plan.chunk_of(F.col("doc_id"), spark).alias("chunk"))
    by_chunk = texts.groupBy("chunk")
    index = by_chunk.applyInArrow(lean(lambda t: _announce(t, bits)), _INDEX)
    anchors = index.groupBy("bucket").applyInArrow(lean(_anchors), _ANCHORS)
    windows = by_chunk.cogroup(anchors.groupBy("chunk")).applyInArrow(lean(lambda a, b: _extend(a, b, bits)), _WINDOWS)
    earlier = windows.groupBy("bucket").applyInArrow(lean(_earlier), _EARLIER)
    out = by_chunk.cogroup(earlier.groupBy("chunk")).applyInArrow(lean(lambda a, b: _remove(a, b, finish)), schema)

    def whole(batches):
        for b in batches:
            for s in slices(b.column(1)):
                w = Words(s, NON_SPACE)
                none = pa.nulls(s.n_docs, pa.int64())
                t = finish(np.zeros(s.n_docs, np.int64), s, w.first, np.zeros(len(w), bool))
                yield from t.set_column(0, "doc_id", none).to_batches()

    return out.unionAll(d.filter(F.col("doc_id").isNull()).mapInArrow(whole, schema))


def dedup_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` per document row."""
    return _run(docs, id_col, text_col, _digest, _RESULT)


def dedup_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_removed``: the texts without repeated passages."""
    return _run(docs, id_col, text_col, _texts, "doc_id long, text string, n_removed long")
