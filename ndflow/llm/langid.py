"""Language identification (operator 7).

Method: multinomial naive Bayes over hashed character n-grams (2 and 3
characters, lower-cased).  The model is one matrix of log-probabilities
(buckets x languages), broadcast; a batch is scored in numpy: the n-grams of
all its documents are the non-zeros of a sparse matrix, the rows of the log
matrix at their buckets are summed per document.

Training counts come from labelled rows, at most about ``TRAIN_DOCS`` of each
language (a hash sample of a language with more), counted per (language, bucket)
by Spark; priors come from all labelled rows.
The matrix has at most ``MATRIX_CELLS`` cells: many languages get fewer
buckets.

Defined results: a null text or one without a letter is ``und`` with score 0;
without any training row every text is ``und``; ties go to the language first
in code point order; repeated rows give a row each; texts of any length are read
whole, in pieces; every language with a usable row is learnt; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ndflow.llm.frames import per_value_sample, pick
from ndflow.llm.textcore import Slice, slices

TRAIN_DOCS = 8_000
ORDERS = (2, 3)
BUCKETS = 1 << 16
MATRIX_CELLS = 1 << 24
SMOOTHING = 0.5
UNDETERMINED = "und"
#: A longer document is scored in pieces; numbers summed at a time.
PIECE_BYTES = 1 << 20
CELLS = 1 << 20
#: Odd multipliers of the n-gram hash (fixed values).
_MULT = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def code_points(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of a slice and the documents' offsets in them."""
    texts = [s.doc(i).decode().lower() for i in range(s.n_docs)]
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4"), off


def point_pieces(s: Slice) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """``(points, offsets, carried)``: a slice's code points; a very long
    document comes in pieces, each after the last points of the one before."""
    if s.n_docs > 1 or len(s.data) <= PIECE_BYTES:
        yield *code_points(s), 0
        return
    tail, a, keep = np.zeros(0, "<u4"), 0, max(ORDERS) - 1
    while a < len(s.data):
        b = min(len(s.data), a + PIECE_BYTES)
        while b < len(s.data) and s.data[b] & 0xC0 == 0x80:  # not inside a character
            b += 1
        cp = np.concatenate([tail, np.frombuffer(s.data[a:b].tobytes().decode().lower().encode("utf-32-le"), "<u4")])
        yield cp, np.array([0, len(cp)]), len(tail)
        tail, a = cp[-keep:], b


def gram_buckets(cp: np.ndarray, k: int, bits: int) -> np.ndarray:
    """Bucket of every run of ``k`` characters."""
    m = len(cp) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint32)
    x = np.full(m, k * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
    for j in range(k):
        x ^= cp[j:j + m]
        x *= np.uint32(_MULT[j % 3])
        x ^= x >> np.uint32(15)
    return x >> np.uint32(32 - bits)


def _counts(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Sparse counts per (language, bucket) of one partition."""
    total: dict[str, np.ndarray] = {}
    for b in batches:
        langs = b.column(1).to_pylist()
        for s in slices(b.column(0)):
            cp, off = code_points(s)
            for k in ORDERS:
                g = gram_buckets(cp, k, bits)
                for i in range(s.n_docs):
                    lo, hi = off[i], max(off[i], off[i + 1] - k + 1)
                    acc = total.setdefault(langs[s.lo + i], np.zeros(1 << bits, np.int64))
                    if hi > lo:
                        acc += np.bincount(g[lo:hi], minlength=1 << bits)
    for lang, acc in total.items():
        at = np.flatnonzero(acc)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(acc[at], pa.int64())],
                                         names=["lang", "bucket", "n"])


class Model:
    """Languages (sorted) and the log-probability matrix, buckets x languages."""

    def __init__(self, langs: list[str], logp: np.ndarray, prior: np.ndarray, bits: int):
        self.langs, self.logp, self.prior, self.bits = langs, logp, prior, bits

    def scores(self, s: Slice) -> np.ndarray:
        """Log joint of every document of a slice with every language."""
        out = np.tile(self.prior, (s.n_docs, 1))
        for cp, off, behind in point_pieces(s):
            for k in ORDERS:
                # a run that ends among the points carried over was counted with them
                self._add(out, gram_buckets(cp, k, self.bits), np.maximum(off, behind - k + 1 if behind else 0), off[1:] - k + 1)
        return out

    def _add(self, out: np.ndarray, g: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Sums of the log rows of each document's n-grams, ``CELLS`` numbers at
        a time whatever the number of languages."""
        lo = np.minimum(np.maximum(start[:-1], 0), len(g))
        hi = np.minimum(np.maximum(end, lo), len(g))
        step = max(1, CELLS // len(self.langs))
        for a in range(0, len(g), step):
            b = min(len(g), a + step)
            d0, d1 = np.searchsorted(hi, a, side="right"), np.searchsorted(lo, b, side="left")
            if d0 >= d1:
                continue
            c = np.zeros((b - a + 1, len(self.langs)))
            np.cumsum(self.logp[g[a:b]], axis=0, dtype=np.float64, out=c[1:])
            out[d0:d1] += c[np.clip(hi[d0:d1], a, b) - a] - c[np.clip(lo[d0:d1], a, b) - a]


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key: Column | None = None,
          bound: int = TRAIN_DOCS) -> Model:
    """Fit on rows with a text and a language; ``key`` decides the sample."""
    key = F.col(text_col) if key is None else key
    rows = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    per_lang = {r[0]: r[1] for r in rows.groupBy(lang_col).count().toLocalIterator()}  # one row per language
    langs = sorted(per_lang)
    rows = per_value_sample(rows, F.col(lang_col), key, per_lang, bound)
    bits = BUCKETS.bit_length() - 1
    while len(langs) << bits > MATRIX_CELLS:
        bits -= 1
    counts = np.zeros((1 << bits, len(langs)))
    at = {x: i for i, x in enumerate(langs)}
    got = (rows.select(F.col(text_col).cast("string"), F.col(lang_col).cast("string"))
           .mapInArrow(lambda it: _counts(it, bits), "lang string, bucket int, n long")
           .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    if langs:
        pdf = got.toPandas()  # at most MATRIX_CELLS rows
        np.add.at(counts, (pdf["bucket"].to_numpy(), pdf["lang"].map(at).to_numpy()), pdf["n"].to_numpy())
    logp = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * counts.shape[0]))
    n = np.array([per_lang[x] for x in langs], float)
    return Model(langs, logp.astype(np.float32), np.log(n / n.sum()) if langs else n, bits)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score``: the most probable language and its
    posterior probability."""
    d = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    m = d.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            for s in slices(b.column(1), 1 << 19):
                x = m.value.scores(s)
                best = x.argmax(axis=1)
                p = 1 / np.exp(x - x.max(axis=1, keepdims=True)).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(s.lo, s.n_docs), pa.array([m.value.langs[i] for i in best], pa.string()), pa.array(p, pa.float64()),
                     b.column(2).slice(s.lo, s.n_docs)], names=["doc_id", "lang_pred", "score", "letters"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    x = d.select("doc_id", "text", letters)
    if not model.langs:
        return x.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    x = x.mapInArrow(run, "doc_id long, lang_pred string, score double, letters boolean")
    return x.select("doc_id", F.when(F.col("letters"), F.col("lang_pred")).otherwise(UNDETERMINED).alias("lang_pred"),
                    F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"))
