"""Toxicity scores (operator 10).

Method: logistic regression over hashed words, regularised by counterfactuals.
For every labelled sentence group (document) that names an identity group, a
twin is made in which each identity term is swapped for another term of the
same kind; the loss adds ``swap_weight * (score(x) - score(twin))^2``, so a
mention of a group in itself cannot carry the verdict.

Features: which words occur (lower-cased, hashed to ``BITS`` bits), each
counted once, so one insult weighs the same in a short and a long text.  Only
features seen in enough labelled documents and clearly tied to one label get a
weight; the rest are noise.

The classifier is fitted on at most about ``TRAIN_DOCS`` labelled documents
(a hash sample when there are more), gathered as feature numbers, never as
texts; scoring is one pass over all documents with the weights broadcast.

Defined results: a null or empty text gets the score of a text without any
feature; without labels of both kinds the score is the share of toxic labels
(0 without labels); equal texts get equal scores, and a score of exactly the
threshold counts as toxic; repeated rows give a row each, repeated labels count as
often as they stand there; texts of any length are read whole, in slices; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ndflow.llm.frames import bounded_sample, filter_docs, lean, pick
from ndflow.llm.textcore import U64, Slice, Words, slices

TRAIN_DOCS = 20_000
BITS = 20
THRESHOLD = 0.7
MIN_DOCS = 5
MIN_Z = 4.0
L2 = 0.02
SWAP_WEIGHT = 4.0
STEPS = 300

#: Identity terms by kind; swaps stay within a kind.
IDENTITY_TERMS = {
    "gender": ["women", "men", "girls", "boys", "females", "males"],
    "faith": ["christians", "muslims", "jews", "hindus", "buddhists", "atheists"],
    "origin": ["africans", "asians", "americans", "europeans", "mexicans", "indians", "germans", "chinese"],
    "skin": ["black", "white", "brown"],
    "orientation": ["gay", "straight", "lesbian", "bisexual", "transgender", "queer"],
    "age": ["old", "young", "elderly", "teenage"],
    "ability": ["disabled", "blind", "deaf", "autistic"],
}

#: Word bytes: letters, apostrophe and everything above ASCII.
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[0x61:0x7B] = True
_LETTERS[0x27] = True
_LETTERS[0x80:] = True


def _lowered(s: Slice) -> Slice:
    """The slice with its texts lower-cased (Unicode), so that words of any
    script match whatever their case."""
    texts = [s.doc(i).decode().lower().encode() for i in range(s.n_docs)]
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return Slice(s.lo, s.hi, np.frombuffer(b"".join(texts), np.uint8), off)


def doc_features(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) pairs of a slice, each once, sorted by document."""
    w = Words(_lowered(s), _LETTERS)
    f = w.hash >> U64(64 - BITS)
    pairs = np.unique((w.doc_of().astype(U64) << U64(BITS)) | f)
    return (pairs >> U64(BITS)).astype(np.int64), (pairs & U64((1 << BITS) - 1)).astype(np.int64)


def term_feature(term: str) -> int:
    s = next(slices(pa.array([term], pa.string())))
    return int(doc_features(s)[1][0])


def swap_table() -> dict[int, int]:
    """Feature of each identity term to the feature of the next of its kind."""
    out = {}
    for terms in IDENTITY_TERMS.values():
        f = [term_feature(t) for t in terms]
        out.update(zip(f, f[1:] + f[:1], strict=True))
    return out


class Model:
    """Bias and dense weights of the hashed features."""

    def __init__(self, bias: float, weights: np.ndarray):
        self.bias, self.weights = bias, weights

    def scores(self, s: Slice) -> np.ndarray:
        d, f = doc_features(s)
        z = self.bias + np.bincount(d, self.weights[f], minlength=s.n_docs)[:s.n_docs]
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _gather(batches):
    """Feature lists of labelled documents."""
    for b in batches:
        for s in slices(b.column(0)):
            d, f = doc_features(s)
            cut = np.searchsorted(d, np.arange(s.n_docs + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(cut), pa.array(f, pa.int32())), b.column(1).slice(s.lo, s.n_docs)], names=["f", "y"])


def fit(features: list[np.ndarray], labels: np.ndarray, swap_weight: float = SWAP_WEIGHT) -> Model:
    """Full-batch fit over the chosen features of the gathered documents."""
    n, y = len(labels), labels.astype(float)
    weights = np.zeros(1 << BITS, np.float32)
    share = y.mean() if n else 0.0
    if not 0 < share < 1:
        return Model(60.0 if share == 1 else -60.0, weights)
    d = np.repeat(np.arange(n), [len(f) for f in features])
    f = np.concatenate(features)
    # features tied to a label: difference of the two shares against its error
    df = np.bincount(f, minlength=1 << BITS).astype(float)
    tox = np.bincount(f, y[d], minlength=1 << BITS)
    n1, n0 = y.sum(), n - y.sum()
    p1, p0, p = tox / n1, (df - tox) / n0, df / n
    z = np.abs(p1 - p0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    chosen = np.flatnonzero((df >= MIN_DOCS) & (z >= MIN_Z))
    swaps = swap_table()
    present = set(f[np.isin(f, list(swaps))].tolist())
    chosen = np.union1d(chosen, [x for t in present for x in (t, swaps[t])]).astype(np.int64)
    col = np.full(1 << BITS, -1)
    col[chosen] = np.arange(len(chosen))
    keep = col[f] >= 0
    rows, cols = d[keep], col[f[keep]]
    # twins: documents with identity terms, each term swapped; only the change
    # of the score matters, so only the moved features are listed
    has = np.isin(f, list(swaps))
    t_rows = np.concatenate([d[has], d[has]])
    t_cols = np.concatenate([col[f[has]], col[np.array([swaps[x] for x in f[has].tolist()], np.int64)]]) if has.any() else np.zeros(0, np.int64)
    t_sign = np.concatenate([np.full(has.sum(), -1.0), np.ones(has.sum())])
    m = len(chosen)
    w, bias = np.zeros(m), np.log(share / (1 - share))
    g_w, g_b = np.full(m, 1e-8), 1e-8
    for _ in range(STEPS):
        z = bias + np.bincount(rows, w[cols], minlength=n)
        err = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - y
        grad = np.bincount(cols, err[rows], minlength=m) + L2 * w
        if len(t_rows):
            change = np.bincount(t_rows, t_sign * w[t_cols], minlength=n)
            grad += 2 * swap_weight * np.bincount(t_cols, t_sign * change[t_rows], minlength=m)
        g_w += grad * grad
        g_b += err.sum() ** 2
        w -= 0.5 * grad / np.sqrt(g_w)
        bias -= 0.5 * err.sum() / np.sqrt(g_b)
    weights[chosen] = w
    return Model(float(bias), weights)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          bound: int = TRAIN_DOCS) -> Model:
    """Fit on documents with a text and a label (``labels`` holds the ids it
    may learn from); at most about ``bound`` rows."""
    lab = pick(labels, _id=(id_col, "long"), y=(label_col, "int")).dropna()
    lab = bounded_sample(lab, F.col("_id"), bound)
    d = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string")).filter(F.col("text").isNotNull())
    # the sample has about ``bound`` rows at most: broadcast, so texts are not shuffled
    rows = d.join(F.broadcast(lab), d["doc_id"] == lab["_id"]).select("text", "y").mapInArrow(lean(_gather), "f array<int>, y int")
    feats, y = [], []
    for b in rows.toArrow().to_batches():
        col = b.column(0)
        off, flat = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)
        feats += [flat[a:z].astype(np.int64) for a, z in zip(off[:-1], off[1:], strict=True)]
        y += b.column(1).to_pylist()
    return fit(feats, np.array(y, float))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` of every document row."""
    d = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    m = d.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            for s in slices(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s.lo, s.n_docs), pa.array(m.value.scores(s), pa.float64())], names=["doc_id", "score"])

    return d.mapInArrow(lean(run), "doc_id long, score double").select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below the threshold, all their columns kept."""
    m = docs.sparkSession.sparkContext.broadcast(model)
    return filter_docs(docs, text_col, lambda s: m.value.scores(s) < threshold)
