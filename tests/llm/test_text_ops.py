"""Operators on words of texts against their plain-Python forms."""

import hashlib

import brute
import numpy as np
import pyarrow as pa
from conftest import rows

from ndflow.llm import decontam, ngramjoin, substrings, textcore


def bench(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_hit string")


def some_items(docs):
    w = max((t for _, t in docs if t), key=len).split()
    return [(1, " ".join(w[20:40])), (2, " ".join(w[30:36])), (10, " ".join(w[20:40])), (3, None), (4, ""), (5, "zz yy"), (6, "one"), (7, "..."), (None, "two words")]


def test_words_do_not_cross_documents():
    s = next(textcore.slices(pa.array(["ab", "cd ef", "", None, "g"])))
    w = textcore.Words(s, textcore.NON_SPACE)
    assert w.counts().tolist() == [1, 2, 0, 0, 1]
    assert [bytes(s.data[a:b]) for a, b in zip(w.start, w.end)] == [b"ab", b"cd", b"ef", b"g"]


def test_slices_of_sliced_arrays_cover_all_rows():
    col = pa.array([("word%d " % i) * (i % 7) for i in range(100)])
    got = [s.doc(i).decode() for s in textcore.slices(col.slice(13, 50), 64) for i in range(s.n_docs)]
    assert got == col.slice(13, 50).to_pylist()


def test_hashes_agree_wherever_a_word_stands():
    a = textcore.Words(next(textcore.slices(pa.array(["x " * 1000 + "word"]))), textcore.NON_SPACE).hash
    b = textcore.Words(next(textcore.slices(pa.array(["word x"]))), textcore.NON_SPACE).hash
    assert a[-1] == b[0] and a[0] == b[1] and a[0] != b[0]
    s = next(textcore.slices(pa.array(["alpha beta " * 300])))
    w = textcore.Words(s, textcore.NON_SPACE)
    assert (textcore._span_hashes(s.data, w.start, w.end, piece=16) == w.hash).all()


def test_cover():
    assert textcore.cover(6, np.array([1, 3]), 2).tolist() == [False, True, True, True, True, False]


def test_decontamination(spark, odd_docs, odd_frame):
    items = some_items(odd_docs)
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = sorted(brute.decontam(odd_docs, items), key=str)
    b = bench(spark, items)
    assert rows(decontam.digest(decontam.scan_documents(odd_frame, b)), *cols) == want
    assert any(x[2] for x in want)
    # a benchmark over the broadcast limit is scanned in parts
    parts = decontam.scan_documents(odd_frame, b, broadcast_bytes=60)
    assert rows(decontam.digest(parts), *cols) == want
    one = {(r.doc_id, str(r.spans), r.n_words) for r in decontam.scan_documents(odd_frame, b).collect()}
    assert one == {(r.doc_id, str(r.spans), r.n_words) for r in parts.collect()}
    # dropping documents keeps the others whole, with all their columns
    clean = decontam.clean_documents(odd_frame, b)
    assert clean.columns == odd_frame.columns
    bad = {x[0] for x in want if x[5]}
    assert sorted(str(r.doc_id) for r in clean.select("doc_id").collect()) == sorted(str(d) for d, *_ in odd_docs if d not in bad and d is not None) + ["None"] * sum(
        1 for x in want if x[0] is None and not x[5])


def test_decontamination_lists_ids_once(spark, odd_docs, odd_frame):
    """Two texts under one id, a repeated item and an item without an id, in one
    part and in several; spans are cut alike."""
    w = max((t for _, t in odd_docs if t), key=len).split()
    items = [(7, " ".join(w[20:40])), (7, " ".join(w[60:75])), (7, " ".join(w[20:40])), (None, " ".join(w[100:115])), (None, "two words"), (8, "one")]
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = sorted(brute.decontam(odd_docs, items), key=str)
    b = bench(spark, items)
    for size in (1 << 20, 60):
        assert rows(decontam.digest(decontam.scan_documents(odd_frame, b, broadcast_bytes=size)), *cols) == want
    assert any(x[0] == 1004 and x[2] == 2 and x[3] == 0 for x in want)
    whole = rows(decontam.remove_spans(odd_frame, b), "doc_id", "text", "n_removed")
    assert rows(decontam.remove_spans(odd_frame, b, broadcast_bytes=60), "doc_id", "text", "n_removed") == whole
    assert sum(r[2] for r in whole) == sum(x[2] for x in want)


def test_decontamination_cuts_spans(spark):
    d = spark.createDataFrame([(1, "Keep this. One two three, four! And that."), (2, "clean")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "one TWO three four")], "item_id long, text string")
    assert rows(decontam.remove_spans(d, b), "doc_id", "text", "n_removed") == [(1, "Keep this. ! And that.", 4), (2, "clean", 0)]


def test_decontamination_of_nothing(spark, odd_frame, no_docs):
    b = bench(spark, some_items([(0, "a " * 60)]))
    assert decontam.scan_documents(no_docs, b).count() == 0
    none = decontam.digest(decontam.scan_documents(odd_frame, b.limit(0)))
    assert none.filter("contaminated or n_hit > 0 or n_items > 0").count() == 0
    assert {r[0] for r in none.select("items_sha256").distinct().collect()} == {hashlib.sha256(b"").hexdigest()}


def test_substring_dedup(odd_docs, odd_frame, no_docs):
    cols = ("doc_id", "n_words", "n_removed", "kept_sha256")
    want = sorted(brute.substring_dedup(odd_docs), key=str)
    assert rows(substrings.dedup_digest(odd_frame), *cols) == want
    assert sum(x[2] > 0 for x in want) > 3
    assert substrings.dedup_digest(no_docs).count() == 0


def test_substring_dedup_across_chunks(monkeypatch, odd_docs, odd_frame):
    """Many small chunks and buckets give the same result as one."""
    monkeypatch.setattr(substrings, "Plan", lambda d, i, t: __import__("ndflow.llm.chunks", fromlist=["Plan"]).Plan(d, i, t, chunk_bytes=3000))
    got = rows(substrings.dedup_digest(odd_frame), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.substring_dedup(odd_docs), key=str)


def test_substring_texts(spark):
    w = [f"w{i}" for i in range(40)]
    d = spark.createDataFrame([(2, " ".join(w[:30])), (1, " ".join(w[10:])), (3, "a  b")], "doc_id long, text string")
    assert rows(substrings.dedup_texts(d), "doc_id", "text", "n_removed") == [(1, " ".join(w[10:]), 0), (2, " ".join(w[:10]), 20), (3, "a b", 0)]


def test_jaccard_components(spark, odd_docs, odd_frame, no_docs):
    cols = ("doc_id", "n_shingles", "component_id")
    want = sorted(brute.jaccard_components(odd_docs), key=str)
    assert rows(ngramjoin.jaccard_components(odd_frame, spark), *cols) == want
    assert ngramjoin.jaccard_components(no_docs, spark).count() == 0
    kept = ngramjoin.one_per_component(odd_frame, spark)
    assert kept.columns == odd_frame.columns
    lose = {x[0] for x in want if x[2] != x[0] and x[0] is not None}
    assert lose and sorted(map(str, (r.doc_id for r in kept.select("doc_id").collect()))) == sorted(str(d) for d, _ in odd_docs if d not in lose)


def drifting(n, words, step):
    """A chain: each text changes ``step`` words of the one before, so that far
    members do not link with each other."""
    w = [f"x{i}" for i in range(words)]
    out = []
    for d in range(n):
        out.append((d * 3 + 1, " ".join(w)))
        for j in range(step):
            w[(d * step + j) * 7 % words] = f"y{d}_{j}"
    return out


def test_jaccard_chains_and_tiles(spark, monkeypatch):
    """Chains of links, unsettled lists, several chunks and several tiles."""
    docs = drifting(40, 60, 1) + [(500 + i, " ".join(["common"] * 0 + [f"p{j}" for j in range(30)] + [f"q{i}_{j}" for j in range(4)])) for i in range(30)]
    docs += [(900 + i, " ".join([f"s{j}" for j in range(50)][: 50 - i])) for i in range(20)]
    f = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(brute.jaccard_components(docs), key=str)
    assert rows(ngramjoin.jaccard_components(f, spark, tile=7), "doc_id", "n_shingles", "component_id") == want
    monkeypatch.setattr(ngramjoin, "Plan", lambda d, i, t: __import__("ndflow.llm.chunks", fromlist=["Plan"]).Plan(d, i, t, chunk_bytes=2000))
    assert rows(ngramjoin.jaccard_components(f, spark, k=5, pct=80), "doc_id", "component_id") == sorted(
        ((d, c) for d, _, c in brute.jaccard_components(docs, 5, 80)), key=str)


def distinct_docs(n, lead=0):
    """Texts of their own words but for seven that all hold, ``lead`` words in."""
    return [(i, " ".join([f"a{i}_{j}" for j in range(lead)] + [f"c{j}" for j in range(7)] + [f"z{i}_{j}" for j in range(300)])) for i in range(n)]


def test_jaccard_without_shared_shingles(spark, monkeypatch):
    """One document, three distinct ones, several chunks without a repeat."""
    one, three, many = [(1, "only one short text here today")], [(i, f"a{i} b{i} c{i} d{i} e{i} f{i}") for i in range(3)], distinct_docs(12)
    cols = ("doc_id", "n_shingles", "component_id")
    for docs in (one, three):
        f = spark.createDataFrame(docs, "doc_id long, text string")
        assert rows(ngramjoin.jaccard_components(f, spark), *cols) == sorted(brute.jaccard_components(docs), key=str)
    assert ngramjoin.one_per_component(spark.createDataFrame(three, "doc_id long, text string"), spark, k=5, pct=80).count() == 3
    monkeypatch.setattr(ngramjoin, "Plan", lambda d, i, t: __import__("ndflow.llm.chunks", fromlist=["Plan"]).Plan(d, i, t, chunk_bytes=3000))
    f = spark.createDataFrame(many, "doc_id long, text string")
    assert rows(ngramjoin.jaccard_components(f, spark), *cols) == sorted(brute.jaccard_components(many), key=str)


def test_substring_dedup_without_repeats(spark, monkeypatch):
    """Chunks that share keys which are no block, blocks but no window, nothing."""
    monkeypatch.setattr(substrings, "Plan", lambda d, i, t: __import__("ndflow.llm.chunks", fromlist=["Plan"]).Plan(d, i, t, chunk_bytes=3000))
    for docs in (distinct_docs(1), distinct_docs(12), distinct_docs(12, lead=1), [(i, t.replace("c", f"c{i}")) for i, t in distinct_docs(12)]):
        f = spark.createDataFrame(docs, "doc_id long, text string")
        got = rows(substrings.dedup_digest(f), "doc_id", "n_words", "n_removed", "kept_sha256")
        assert got == sorted(brute.substring_dedup(docs), key=str)


def test_several_texts_under_one_id(spark, small_docs):
    """Each text keeps its links and is judged by itself."""
    w = [t.split() for _, t in sorted(small_docs, key=lambda x: -len(x[1]))[:6]]
    a, b, c = (" ".join(x[:150]) for x in w[:3])
    near = lambda t, i: " ".join(x if j != 75 else f"z{i}" for j, x in enumerate(t.split()))
    docs = [(5, a), (5, b), (5, c), (3, near(a, 1)), (7, near(b, 2)), (9, near(b, 3)), (5, a), (11, "one two three four five"), (12, c), (None, near(c, 4)), (5, None)]
    f = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(docs)], "doc_id long, text string, f1 int")
    assert rows(ngramjoin.jaccard_components(f, spark), "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard_components(docs), key=str)
    kept = ngramjoin.one_per_component(f, spark)
    # a under 5 goes with 3; b and c under 5 stay, and so do rows without id or text
    assert kept.columns == f.columns and sorted(r.f1 for r in kept.collect()) == [1, 2, 3, 7, 9, 10]
