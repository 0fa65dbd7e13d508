"""N-gram Jaccard self-join (operator 8).

Method: a blocked sparse matrix product of the document by n-gram incidence.
Rows are classes of documents with equal n-gram sets; the product accumulates
overlap counts inside a block and drops pairs below the bounds that the two set
sizes give (overlap of ``t / (1 + t)`` of their sum, sizes within ``t``).

What enters the product is found first, for all documents:
1. Sets and 128-bit set fingerprints; equal sets form a class, whose smallest
   id stands for it.
2. Document frequency of every n-gram, by the packed exchange of ``chunks``.
   A set is ordered by (frequency, hash).  Two sets that link share an n-gram
   among the first ``n - ceil(t n) + 1`` of each; n-grams of one document only
   come first, so a document with that many own n-grams has no partner, and a
   passage that many documents share comes last.
3. Round one compares each candidate with one leader (the smallest candidate
   of its prefix lists), which settles most groups of copies at a cost linear
   in their size.  Lists whose members are all in one component are settled.
4. Round two takes the rest: candidates joined by unsettled lists form blocks,
   a block of more than ``TILE`` documents is cut into tiles, and every pair of
   tiles is one product; it returns links that join components, never all
   pairs.
Components of the verified links are found in Spark.

Shingles are compared by 64-bit hashes.  Defined results: a null or empty text
has an empty set and is its own component; fewer words than the shingle length
make one shingle of the whole; documents with a null ``doc_id`` stand for
nobody and take the component of an equal set, else null; repeated rows each
give a row; several texts under one id are documents of their own, with the
components of their sets; texts of any length are read whole, in slices; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ndflow.llm.chunks import Plan, bucket_runs, run_ends, run_starts, short_keys, text_arrays, unpack
from ndflow.llm.components import components
from ndflow.llm.frames import lean, pick, stored
from ndflow.llm.textcore import NON_SPACE, U64, Slice, Words, member, mix64, slices, window_hashes, window_starts

SHINGLE = 4
PERCENT = 85
TILE = 2048

_SETS = "doc_id long, n_shingles long, f1 long, f2 long"


def shingle_sets(s: Slice, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)``: the distinct shingles of every document of a slice,
    sorted, and where each document's begin."""
    w = Words(s, NON_SPACE, lower=True)
    n = w.counts()
    doc = w.doc_of()
    at = window_starts(w.first, k)
    h, d = window_hashes(w.hash, k)[at], doc[at]
    for m in range(1, k):  # short texts: the whole sequence
        short = np.flatnonzero(n == m)
        if len(short):
            h = np.concatenate([h, window_hashes(w.hash, m)[w.first[short]]])
            d = np.concatenate([d, short])
    order = np.argsort(h)
    order = order[np.argsort(d[order], kind="stable")]
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[new], d[new]
    return h, np.searchsorted(d, np.arange(s.n_docs + 1))


def fingerprints(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each document's set: equal for equal sets."""
    out = []
    for salt in (U64(0x1B873593CC9E2D51), U64(0xE6546B64A0761D65)):
        c = np.concatenate([np.zeros(1, U64), np.cumsum(mix64(h ^ salt), dtype=U64)])
        out.append((c[first[1:]] - c[first[:-1]]).view(np.int64))
    return out[0], out[1]


def _sets(batches, k: int):
    for b in batches:
        for s in slices(b.column(1)):
            h, first = shingle_sets(s, k)
            f1, f2 = fingerprints(h, first)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(s.lo, s.n_docs), pa.array(np.diff(first), pa.int64()), pa.array(f1), pa.array(f2)],
                                             names=["doc_id", "n_shingles", "f1", "f2"])


_FREQ = "bucket int, chunk int, keys binary, counts binary"
_SHARED = "chunk int, bucket int, keys binary, counts binary"


def _announce(table: pa.Table, bits: int, k: int) -> pa.Table:
    """A chunk's distinct shingle keys with the number of its (distinct) sets
    that hold them."""
    chunk = table.column("chunk")[0].as_py()
    seen: set[tuple[int, int]] = set()
    parts = []
    for s in slices(text_arrays(table, "text")):
        h, first = shingle_sets(s, k)
        f1, f2 = fingerprints(h, first)
        fresh = np.zeros(s.n_docs, bool)
        for i, f in enumerate(zip(f1.tolist(), f2.tolist(), strict=True)):
            if f not in seen:
                seen.add(f)
                fresh[i] = True
        parts.append(short_keys(h[np.repeat(fresh, np.diff(first))], bits))
    keys, counts = np.unique(np.concatenate(parts), return_counts=True)
    out: dict[str, list] = {"bucket": [], "chunk": [], "keys": [], "counts": []}
    for bucket, lo, hi in bucket_runs(keys, 32):
        many = np.flatnonzero(counts[lo:hi] > 1)  # counts of 1 are left out: (index, count) pairs
        out["bucket"].append(bucket)
        out["chunk"].append(chunk)
        out["keys"].append(keys[lo:hi].astype(np.uint32).tobytes())
        out["counts"].append(np.stack([many, counts[lo:hi][many]], axis=1).astype(np.uint32).tobytes())
    return pa.table({"bucket": pa.array(out["bucket"], pa.int32()), "chunk": pa.array(out["chunk"], pa.int32()),
                     "keys": pa.array(out["keys"], pa.binary()), "counts": pa.array(out["counts"], pa.binary())})


def _frequencies(table: pa.Table) -> pa.Table:
    """Of one bucket: each chunk's keys that two or more sets hold, with the
    number of sets (up to 65,535: it only orders)."""
    keys, counts, chunks = [], [], []
    for c, k, m in zip(table.column("chunk").to_pylist(), table.column("keys"), table.column("counts"), strict=True):
        k = np.frombuffer(k.as_py(), np.uint32)
        n = np.ones(len(k), np.int64)
        m = np.frombuffer(m.as_py(), np.uint32).reshape(-1, 2)
        n[m[:, 0]] = m[:, 1]
        keys.append(k)
        counts.append(n)
        chunks.append(np.full(len(k), c, np.int32))
    key, n, chunk = np.concatenate(keys), np.concatenate(counts), np.concatenate(chunks)
    order = np.argsort(key, kind="stable")
    key, n, chunk = key[order], n[order], chunk[order]
    st = run_starts(key)
    df = np.repeat(np.add.reduceat(n, st), np.diff(np.concatenate([st, [len(key)]])))
    key, df, chunk = key[df > 1], np.minimum(df[df > 1], 65535), chunk[df > 1]
    order = np.argsort(chunk, kind="stable")  # keys stay sorted inside a chunk
    key, df, chunk = key[order], df[order], chunk[order]
    st = run_starts(chunk)
    end = run_ends(st, len(chunk))
    bucket = table.column("bucket")[0].as_py()
    return pa.table({"chunk": pa.array(chunk[st], pa.int32()), "bucket": pa.array([bucket] * len(st), pa.int32()),
                     "keys": pa.array([key[a:z].tobytes() for a, z in zip(st, end, strict=True)], pa.binary()),
                     "counts": pa.array([df[a:z].astype(np.uint16).tobytes() for a, z in zip(st, end, strict=True)], pa.binary())})


_CAND = "rep long, n long, shared binary, prefix array<long>"


def _candidates(docs: pa.Table, lists: pa.Table, bits: int, k: int, pct: int) -> pa.Table:
    """Class representatives of a chunk with a shared shingle in their prefix.
    ``lists`` holds the chunk's shared keys and, as bucket -1, its classes: the
    representative's id, the set's fingerprints, the class's node."""
    out: dict[str, list] = {"rep": [], "n": [], "shared": [], "prefix": []}
    if docs.num_rows and lists.num_rows:
        bucket = lists.column("bucket").to_numpy()
        own_classes = unpack(lists.filter(pa.array(bucket < 0)).column("keys"), np.dtype(">i8"))[0].astype(np.int64).reshape(-1, 4)
        node_of = {(a, b, c): node for a, b, c, node in own_classes.tolist()}
        reps = np.unique(own_classes[:, 0])
        freq = lists.filter(pa.array(bucket >= 0))
        key, row = unpack(freq.column("keys"), np.uint32)
        df, _ = unpack(freq.column("counts"), np.uint16)
        key = (freq.column("bucket").to_numpy()[row].astype(U64) << U64(32)) | key.astype(U64)
        order = np.argsort(key)
        key, df = key[order], df[order]
        ids = docs.column("doc_id").to_numpy()
        done: set[int] = set()
        for s in slices(text_arrays(docs, "text")):
            wanted = member(reps, ids[s.lo:s.hi])[0]
            if not wanted.any():
                continue
            h, first = shingle_sets(s, k)
            f1, f2 = fingerprints(h, first)
            found, at = member(key, short_keys(h, bits))
            own = np.concatenate([[0], np.cumsum(~found)])
            for i in np.flatnonzero(wanted).tolist():
                lo, hi = int(first[i]), int(first[i + 1])
                n = hi - lo
                rep = node_of.get((int(ids[s.lo + i]), int(f1[i]), int(f2[i])))  # None: the class has another representative
                room = n - (pct * n + 99) // 100 + 1 - int(own[hi] - own[lo])
                if rep is None or n == 0 or room <= 0 or rep in done:
                    continue
                done.add(rep)  # a repeated row stands once
                sh = h[lo:hi][found[lo:hi]]
                first_ones = np.lexsort((sh, df[at[lo:hi][found[lo:hi]]]))[:room]
                out["rep"].append(rep)
                out["n"].append(n)
                out["shared"].append(sh.tobytes())
                out["prefix"].append(sh[first_ones].view(np.int64))
    return pa.table({"rep": pa.array(out["rep"], pa.int64()), "n": pa.array(out["n"], pa.int64()),
                     "shared": pa.array(out["shared"], pa.binary()), "prefix": pa.array(out["prefix"], pa.list_(pa.int64()))})


def _links(n1, n2, overlap, pct: int):
    """100 * overlap >= pct * union, in integers."""
    return (100 + pct) * overlap >= pct * (n1 + n2)


def _with_leader(members: pa.Table, leaders: pa.Table, pct: int) -> pa.Table:
    """Candidates of one leader (or a salted part of them) that link with it."""
    a, b = [], []
    if members.num_rows and leaders.num_rows:
        lead = np.frombuffer(leaders.column("lead_shared")[0].as_py(), U64)
        ln, lid = leaders.column("lead_n")[0].as_py(), leaders.column("lead")[0].as_py()
        for rep, n, shared in zip(members.column("rep").to_pylist(), members.column("n").to_pylist(), members.column("shared"), strict=True):
            x = np.frombuffer(shared.as_py(), U64)
            if _links(ln, n, int(member(lead, x)[0].sum()), pct):
                a.append(lid)
                b.append(rep)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _product(t: pa.Table, pct: int) -> pa.Table:
    """One product of two tiles: overlap counts of their documents, accumulated
    n-gram by n-gram, and the links that join two components."""
    rep, n, comp, tile = (t.column(c).to_numpy() for c in ("rep", "n", "comp", "tile"))
    across = t.column("t1")[0].as_py() != t.column("t2")[0].as_py()
    order = np.lexsort((rep, n))  # by size: partners of a row are a range of columns
    sets = [np.frombuffer(t.column("shared")[int(i)].as_py(), U64) for i in order]
    rep, n, comp, tile = rep[order], n[order], comp[order], tile[order]
    a, b = [], []
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    vocab, col = np.unique(np.concatenate(sets), return_inverse=True)
    doc = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    by_gram = np.argsort(col, kind="stable")  # postings: documents of each n-gram, ascending
    post = doc[by_gram]
    start = np.concatenate([[0], np.cumsum(np.bincount(col, minlength=len(vocab)))])
    ends = np.cumsum([len(x) for x in sets])
    for i in range(len(sets)):
        grams = col[ends[i] - len(sets[i]):ends[i]]
        top = int(np.searchsorted(n, n[i] * 100 // pct, side="right"))  # larger sets are out of reach
        if top <= i + 1:
            continue
        # row i of the product: how many of its n-grams each document holds
        rows = np.concatenate([post[start[g]:start[g + 1]] for g in grams.tolist()]) if len(grams) else np.zeros(0, np.int64)
        overlap = np.bincount(rows, minlength=len(sets))[i + 1:top]
        near = _links(n[i], n[i + 1:top], overlap, pct)
        if across:  # pairs inside a tile belong to the tile's own product
            near &= tile[i + 1:top] != tile[i]
        for j in (np.flatnonzero(near) + i + 1).tolist():
            x, y = find(int(comp[i])), find(int(comp[j]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                a.append(int(rep[i]))
                b.append(int(rep[j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _verified_links(cand: DataFrame, spark: SparkSession, pct: int, tile: int) -> DataFrame:
    """Links between candidates (enough to connect all that are linked)."""
    post = stored(cand.select("rep", "n", F.explode("prefix").alias("gram")), spark, "postings")
    lists = post.groupBy("gram").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("m")).filter("m > 1").select("gram", "leader")
    one = stored(post.join(lists, "gram").groupBy("rep").agg(F.min("leader").alias("leader")).filter("leader < rep"), spark, "leaders")
    salt = F.pmod(F.xxhash64("rep"), F.lit(64)).cast("int")  # a hot leader's group is 64 tasks
    members = cand.select("rep", "n", "shared").join(one, "rep").withColumn("salt", salt)
    salts = one.select(F.col("leader").alias("to"), salt.alias("part")).distinct()
    leaders = salts.join(cand.select(F.col("rep").alias("lead"), F.col("n").alias("lead_n"), F.col("shared").alias("lead_shared")),
                         F.col("to") == F.col("lead"))
    star = (members.groupBy("leader", "salt").cogroup(leaders.groupBy("to", "part"))
            .applyInArrow(lean(lambda x, y: _with_leader(x, y, pct)), "a long, b long"))
    star = stored(star, spark, "star")
    comp = stored(components(star, spark, "starcc"), spark, "starcomp")
    # lists that still hold two components
    p = post.join(comp, post["rep"] == comp["node"], "left").select("gram", "rep", F.coalesce("component", "rep").alias("comp"))
    mixed = p.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("rep").alias("first")).filter("lo < hi")
    rest = stored(p.join(mixed.select("gram", "first"), "gram").select("rep", "comp", "first").distinct(), spark, "rest")
    if rest.isEmpty():
        return star
    block = stored(components(rest.select(F.col("first").alias("a"), F.col("rep").alias("b")), spark, "blockcc"), spark, "blocks")
    size = block.groupBy("component").agg(F.count(F.lit(1)).alias("size")).withColumnRenamed("component", "block")
    x = block.select(F.col("node").alias("rep"), F.col("component").alias("block")).join(size, "block")
    tiles = F.ceil(F.col("size") / F.lit(tile)).cast("int")
    mine = F.pmod(F.xxhash64("rep"), tiles).cast("int")
    x = x.select("rep", "block", tiles.alias("tiles"), mine.alias("tile")).join(rest.select("rep", "comp").distinct(), "rep")
    # a document goes to the product of its tile with every tile
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    x = x.select("rep", "block", "comp", "tile", other.alias("other")).select(
        "rep", "block", "comp", "tile", F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"))
    x = x.join(cand.select("rep", "n", "shared"), "rep")
    more = x.groupBy("block", "t1", "t2").applyInArrow(lean(lambda t: _product(t, pct)), "a long, b long")
    return star.unionAll(stored(more, spark, "product"))


def jaccard_components(docs: DataFrame, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                       pct: int = PERCENT, tile: int = TILE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document row."""
    return class_components(docs, spark, id_col, text_col, k, pct, tile).select("doc_id", "n_shingles", "component_id")


def class_components(docs: DataFrame, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, pct: int = PERCENT,
                     tile: int = TILE) -> DataFrame:
    """``jaccard_components`` with the fingerprints ``f1, f2`` of each row's set."""
    d = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    slim = stored(d.mapInArrow(lean(lambda it: _sets(it, k)), _SETS), spark, "sets")
    plan = Plan(d, "doc_id", "text")
    bits = plan.bits
    classes = slim.filter("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("rep"))
    # a class is a node; its name is the representative's id, and where several
    # texts under one id stand for classes, a hash of the set
    shared = classes.groupBy("rep").agg(F.count(F.lit(1)).alias("_m")).filter("_m > 1").select(F.col("rep").alias("_rep"), F.lit(True).alias("_shared"))
    classes = classes.join(shared, classes["rep"] == shared["_rep"], "left").drop("_rep")
    classes = classes.withColumn("node_id", F.when(F.col("_shared"), F.xxhash64("n_shingles", "f1", "f2", "rep")).otherwise(F.col("rep"))).drop("_shared")
    classes = stored(classes, spark, "classes")
    texts = d.filter(F.col("doc_id").isNotNull()).select("doc_id", "text", plan.chunk_of(F.col("doc_id"), spark).alias("chunk"))
    by_chunk = texts.groupBy("chunk")
    freq = by_chunk.applyInArrow(lean(lambda t: _announce(t, bits, k)), _FREQ).groupBy("bucket").applyInArrow(lean(_frequencies), _SHARED)
    reps = classes.select(plan.chunk_of(F.col("rep"), spark).alias("chunk"), F.lit(-1).alias("bucket"),
                          F.concat(*[_packed(F.col(c)) for c in ("rep", "f1", "f2", "node_id")]).alias("keys"),
                          F.lit(b"").alias("counts"))
    cand = by_chunk.cogroup(freq.unionAll(reps).groupBy("chunk")).applyInArrow(lean(lambda a, b: _candidates(a, b, bits, k, pct)), _CAND)
    cand = stored(cand, spark, "candidates")
    links = _verified_links(cand, spark, pct, tile)
    comp = stored(components(links, spark), spark, "components")
    c = classes.join(comp, classes["node_id"] == comp["node"], "left").select("n_shingles", "f1", "f2", "rep", F.coalesce("component", "node_id").alias("_c"))
    smallest = c.groupBy("_c").agg(F.min("rep").alias("component_id"))  # node names are not all ids
    c = c.join(smallest, "_c").select("n_shingles", "f1", "f2", "component_id")
    c = c.withColumnsRenamed({"n_shingles": "_n", "f1": "_f1", "f2": "_f2"})
    out = slim.join(c, (slim["n_shingles"] == c["_n"]) & (slim["f1"] == c["_f1"]) & (slim["f2"] == c["_f2"]), "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", "f1", "f2", own.alias("component_id"))


def _packed(col):
    """A long as 8 big-endian bytes."""
    return F.unhex(F.lpad(F.hex(col), 16, "0"))


def one_per_component(docs: DataFrame, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One document of each component (the smallest id), all columns kept.
    Documents without words or without an id stay; rows that repeat the staying
    document's id and set stay with it.  Of several texts under one id each is
    judged by itself."""
    c = stored(class_components(docs, spark, id_col, text_col, **kw), spark, "verdicts")
    gone = F.coalesce(F.col("component_id") != F.col("doc_id"), F.lit(False))
    by_id = c.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_lose")).agg(F.min(gone).alias("all"), F.max(gone).alias("any")).filter("any")
    own = docs[f"`{id_col}`"].cast("long")
    out = docs.join(by_id.filter("all").select("_lose"), own == F.col("_lose"), "left_anti")
    mixed = by_id.filter("not all").select("_lose")
    if mixed.isEmpty():
        return out
    # ids of which one text goes and another stays: their rows by set
    some = out.join(mixed, own == F.col("_lose"), "left_semi")
    k = kw.get("k", SHINGLE)
    lost = c.filter(gone).join(mixed, F.col("doc_id") == F.col("_lose"), "left_semi").select(F.col("doc_id").alias("_lose"), "f1", "f2").distinct()
    names = [f"_c{i}" for i in range(len(docs.columns))]
    x = some.toDF(*names)
    at_id, at_text = docs.columns.index(id_col), docs.columns.index(text_col)

    def fingerprint(batches):
        for b in batches:
            for s in slices(b.column(at_text)):
                f1, f2 = fingerprints(*shingle_sets(s, k))
                yield pa.RecordBatch.from_arrays([*[v.slice(s.lo, s.n_docs) for v in b.columns], pa.array(f1), pa.array(f2)], names=[*names, "f1", "f2"])

    types = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields, strict=True))
    x = x.withColumn(names[at_text], F.col(names[at_text]).cast("string")).mapInArrow(lean(fingerprint), f"{types}, f1 long, f2 long")
    kept = x.join(lost.withColumnsRenamed({"f1": "_f1", "f2": "_f2"}), (F.col(names[at_id]).cast("long") == F.col("_lose")) & (F.col("f1") == F.col("_f1")) & (
        F.col("f2") == F.col("_f2")), "left_anti").select(*names).toDF(*docs.columns)
    return out.join(mixed, own == F.col("_lose"), "left_anti").unionAll(kept)
