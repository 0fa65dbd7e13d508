"""Collocations, exact top-k search and the filter audit against plain Python."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from brute import UPPER, words
from conftest import rows

from ndflow.llm import bitslice, collocations, filteraudit, textcore

# ---- operator 11


def plain_counts(docs, order=4):
    """docs: (lang, text).  Counts of all phrases of up to ``order`` words."""
    f = defaultdict(Counter)
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(w)):
                for k in range(1, order + 1):
                    if i + k <= len(w):
                        f["und" if lang is None else lang][tuple(w[i:i + k])] += 1
    return f


def plain_collocations(docs, least, pct=80, scale=2_000_000, keep=2000):
    out = []
    for lang, f in plain_counts(docs).items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        cand = {g: c for g, c in f.items() if len(g) > 1 and c >= least}

        def inside(g, cand=cand):
            return any(len(q) > len(g) and 100 * c >= pct * cand[g] and any(q[i:i + len(g)] == g for i in range(len(q) - len(g) + 1)) for q, c in cand.items())

        got = []
        for g, a in cand.items():
            if not inside(g):
                score, k = min((scale * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
                got.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(got)[:keep])]
    return sorted(out, key=str)


COLLOCATION = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize(("least", "keep", "range_rows"), [(3, 2000, 400_000), (2, 50, 60)])
def test_collocations(spark, odd_frame, least, keep, range_rows):
    docs = [(r.lang, r.text) for r in odd_frame.select("lang", "text").collect()]
    got = rows(collocations.collocations(odd_frame, spark, min_count=least, keep=keep, range_rows=range_rows), *COLLOCATION)
    want = plain_collocations(docs, least, keep=keep)
    assert got == want and len(want) > 20


def test_counts_hold_across_ranges_and_combined_runs(spark, monkeypatch, odd_frame):
    docs = [(r.lang, r.text) for r in odd_frame.select("lang", "text").collect()]
    want = sorted(((lang, " ".join(g), c) for lang, f in plain_counts(docs).items() for g, c in f.items() if c >= 4), key=str)
    got = collocations.phrase_counts(odd_frame.repartition(5), spark, 4, range_rows=25).filter("k > 0").collect()
    assert sorted(((r.lang, r.key.rstrip(" "), r.f) for r in got), key=str) == want


def test_long_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "PIECE_BYTES", 64)
    text = "Alpha beta gamma  delta epsilon zeta\teta theta iota kappa lambda mu nu xi. omicron pi rho sigma tau\nupsilon phi chi psi omega " * 5
    run = collocations.Run()
    s = next(textcore.slices(pa.array([text])))
    run.add(s, np.array([0], np.int32), spell=True)
    h, lang, follows, mine = run.arrays()
    vocabulary, spelled = run.words()
    w = np.array(spelled.to_pylist(), dtype=object)[np.searchsorted(vocabulary, h)]
    got = Counter()
    for i in np.flatnonzero(mine):
        for k in range(1, 5):
            if follows[i:i + k - 1].all():
                got[tuple(w[i:i + k])] += 1
    assert got == plain_counts([("x", text)])["x"]
    assert len(run.parts) > 5


def test_collocations_of_nothing(spark, no_docs, odd_frame):
    assert collocations.collocations(no_docs, spark).count() == 0
    assert collocations.collocations(odd_frame.filter("text is null or text = ''"), spark, min_count=2).count() == 0
    assert collocations.collocations(odd_frame, spark, min_count=10 ** 6).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    """Counts near 2^40: the product with the scale passes 64 bits."""
    big = 7 * 10 ** 14
    x = spark.createDataFrame([("x", "a ", 1, big), ("x", "b ", 1, big - 3), ("x", "a b ", 2, big - 7)], "lang string, key string, k int, f long")
    x = collocations.with_parts(x, x["key"], ["l1", "l2", "l3"], spark, 10)
    assert {(r.key, r.l1) for r in x.collect()} == {("a ", None), ("b ", None), ("a b ", big)}
    score = x.filter("k = 2").selectExpr(f"cast(2000000 as decimal(18,0)) * cast(f as decimal(19,0)) div (cast(l1 as decimal(19,0)) + {big - 3}) as s").first().s
    assert score == 2_000_000 * (big - 7) // (big + big - 3)


# ---- operator 12


def plain_top(vectors, every=50, k=5):
    """vectors: (id, list or None).  Integer inner products, ties to the smaller id."""
    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) and abs(x) < bitslice.COMPONENT_LIMIT for x in v)
    q = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors if usable(v)]
    out = []
    for i, v in {(i, tuple(v)) for i, v in q if i is not None and i % every == 0}:
        s = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j is None, j or 0, j) for j, w in q if j != i and len(w) == len(v))
        out += [(i, r + 1, j, -score) for r, (score, _, _, j) in enumerate(s[:k])]
    return sorted(out, key=str)


def vectors(spark, x):
    return spark.createDataFrame([(i, v, 7, "x", 1) for i, v in x], "vec_id long, embedding array<float>, score int, block string, n int")


SEARCH = ("query_id", "rank", "vec_id", "score")


def odd_vectors(n=300, dim=9):
    r = np.random.default_rng(5)
    x = [(i, [float(v) for v in np.float32(r.normal(0, 0.2, dim))]) for i in range(n)]
    same = x[3][1]
    x += [(n + i, same) for i in range(40)]  # a hot vector: ties at the boundary
    x += [(50, x[7][1]), (50, x[50][1]), (n, same), (None, same), (1000, None), (1050, [0.0] * dim), (1100, [0.1] * (dim - 1)), (1101, [0.2] * (dim - 1)),
          (1150, []), (1151, []), (1200, [None] * dim), (1201, [float("nan")] * dim), (1250, [float("inf")] + [0.0] * (dim - 1)), (-50, [-9.5] * dim),
          (1300, [300.0, -4000.25, *[0.0] * (dim - 2)]), (1350, [1e30] * dim)]
    return x


@pytest.mark.parametrize(("rows_a_block", "queries"), [(8192, 4096), (64, 4)])
def test_search(spark, monkeypatch, rows_a_block, queries):
    monkeypatch.setattr(bitslice, "BLOCK_ROWS", rows_a_block)
    monkeypatch.setattr(bitslice, "GROUP_QUERIES", queries)
    x = odd_vectors()
    assert rows(bitslice.top_similar(vectors(spark, x), spark), *SEARCH) == plain_top(x)


def test_search_of_few_and_none(spark):
    few = [(0, [0.5, 0.25]), (1, [0.5, -0.25]), (2, [-1.0, 0.0])]
    assert rows(bitslice.top_similar(vectors(spark, few), spark), *SEARCH) == plain_top(few)
    assert bitslice.top_similar(vectors(spark, few).limit(0), spark).count() == 0
    assert bitslice.top_similar(vectors(spark, few[1:]), spark).count() == 0  # no query
    assert bitslice.top_similar(vectors(spark, few[:1]), spark).count() == 0  # no candidate


def test_block_selects_from_the_top_slice_down():
    r = np.random.default_rng(2)
    for dim, n, spread in ((16, 700, 3), (5, 130, 900), (1, 64, 2)):
        v = r.integers(-spread, spread + 1, (n, dim)).astype(np.int32)
        b = bitslice.Block(**{k: x for k, x in bitslice.slice_block(np.arange(n) * 2, v).items()})
        for i in range(0, n, 37):
            s = v.astype(np.int64) @ v[i]
            want = sorted((-int(x), j) for j, x in enumerate(s) if j != i)[:5]
            assert sorted((-x, j) for j, x in b.top(v[i], i * 2, 5)) == want


# ---- operator 13


def plain_audit(docs, labels):
    """docs: (id, lang, text); labels: (id, quality, toxic)."""
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, _, t in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    parts = defaultdict(list)
    for i, lang, t in docs:
        t, w = t or "", words(t)
        bad = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
               "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and first[t] < i}
        parts[lang or ""].append(({k for k, v in bad.items() if v}, i in good, i in toxic))
    out = []
    for part, x in parts.items():
        got, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left = x
            for step, f in enumerate(order):
                removed = [y for y in left if f in y[0]]
                gone = [y for y in x if f in y[0] and y[0] & set(order[:step])]
                left = [y for y in left if f not in y[0]]
                shapley[f] += len(removed)
                got.append((part, "".join(order), step + 1, len(left), len(removed), len(gone), sum(y[0] == {f} for y in x), sum(y[1] for y in removed),
                            sum(y[2] for y in removed), f))
        out += [(*g[:-1], shapley[g[-1]]) for g in got]
    return sorted(out, key=str)


AUDIT = ("part", "filter_order", "step", *filteraudit.MEASURES, "shapley")


def test_audit(spark, odd_frame, odd_docs):
    frame = odd_frame.unionByName(odd_frame.limit(3)).unionByName(odd_frame.filter("doc_id = 1005").selectExpr("* except (lang)", "'' as lang").select(*odd_frame.columns))
    docs = [(r.doc_id, r.lang, r.text) for r in frame.select("doc_id", "lang", "text").collect()]
    labels = [(docs[i][0], i % 2, int(i % 3 == 0)) for i in range(0, len(docs), 2)] + [(docs[0][0], None, 1), (None, 1, 1), (10 ** 6, 1, 1)]
    lab = spark.createDataFrame([(*x, "clash") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = rows(filteraudit.audit(frame, lab, spark), *AUDIT)
    want = plain_audit(docs, labels)
    assert got == want and len(want) == 600 * 3
    none = rows(filteraudit.audit(frame, lab.limit(0), spark), *AUDIT)
    assert none == plain_audit(docs, [])


def test_audit_of_nothing(spark, no_docs):
    lab = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(no_docs, lab, spark).count() == 0


def test_long_texts_measure_as_short_ones(monkeypatch):
    text = ("Word word WORD #x été 你好 " * 3 + "\n\t a") * 20
    s = next(textcore.slices(pa.array([text])))
    want = [int(x[0]) for x in filteraudit._measure(s)]
    monkeypatch.setattr(filteraudit, "PIECE_BYTES", 50)
    assert [int(x[0]) for x in filteraudit._measure_long(s)] == want
    assert want == [len(words(text)), len(set(words(text))), len(re.findall("[A-Z]", text)), len(text), text.count("#")]


def test_packed_fields_do_not_run_over():
    """255 and 256 documents of a class: one and two bytes a field."""
    t = pa.table({"part": ["p", "p"], "class": [3, 16 | filteraudit.GOOD], "n": [255, 1]})
    for n in (254, 255, 65535, 2 ** 40):
        got = filteraudit._audit(t.set_column(2, "n", pa.array([n, 1])))
        row = next(r for r in got.to_pylist() if r["filter_order"] == "ABCDE" and r["step"] == 1)
        assert (row["removed"], row["kept"], row["good_lost"], row["unique_fails"]) == (n, 1, 0, 0)
        assert all(r["kept"] + r["removed"] <= n + 1 for r in got.to_pylist())
