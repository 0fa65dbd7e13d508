"""Filter interaction audit (operator 13).

Method: wide packed counters.  A document's failed filters are a five-bit
mask, and two more bits say whether its label is good or toxic.  Each of the
128 classes maps to one big integer with a field for every measure of all 600
(order, step) outcomes, 1 where the class adds to it.  The integers of a part's
documents are summed and the 3,600 totals are read out of the sum's fields.  A
field is as many bytes wide as the part's row count needs, so no field can run
over into the next.  Equal classes of a part are combined before the shuffle (``n``
documents add ``n`` times their integer), so a part of any size is at most 128
rows for the one task that sums it.

Filter E (a copy of a smaller id's text) is judged over the whole table
without moving texts: 128-bit fingerprints with their ids, the smallest id per
fingerprint by a map-side minimum, and an equi-join on (fingerprint, id), whose
keys are spread however many copies one text has.

Defined results: a null text is an empty one; a null language and an empty one
are the same part ``''``; a null id equals no label and is no copy of anything
nor has copies; rows that repeat one id and text all pass E when the id is the
smallest; a label is good (toxic) when any label row of its id says 1; texts of
any length are read in bounded pieces; an empty table has no parts and gives no
rows; an empty label table gives zeros; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ndflow.llm.frames import pick, stored
from ndflow.llm.textcore import NON_SPACE, U64, Slice, Words, mix64, run_lengths, separator_cuts, slices

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PCT, UPPER_PCT = 200, 50, 3
SYMBOLS = "#$%&*|"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
GOOD, TOXIC = 1 << 5, 1 << 6
#: A text beyond this is read in pieces of about this size.
PIECE_BYTES = 4 << 20

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_POINT = np.ones(256, bool)
_POINT[0x80:0xC0] = False  # continuation bytes
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _marked(mask: np.ndarray, s: Slice) -> np.ndarray:
    """Bytes of a class in each document."""
    return np.diff(np.searchsorted(np.flatnonzero(mask[s.data]), s.offsets))


def _measure(s: Slice) -> tuple[np.ndarray, ...]:
    """Words, distinct words, A-Z, code points and symbols of each document."""
    w = Words(s, NON_SPACE)
    doc = w.doc_of()
    key = mix64(w.hash ^ mix64(doc.astype(U64) + U64(1)))
    order = np.argsort(key)
    first = order[run_lengths(key[order])[0]]
    distinct = np.bincount(doc[first], minlength=s.n_docs)
    return w.counts(), distinct, _marked(_UPPER, s), _marked(_POINT, s), _marked(_SYMBOL, s)


def _measure_long(s: Slice) -> tuple[np.ndarray, ...]:
    """The same for one very long document, piece by piece: only its distinct
    words are held."""
    words, seen, rest = 0, np.zeros(0, U64), np.zeros(3, np.int64)
    for a, b in separator_cuts(s.data, NON_SPACE, PIECE_BYTES):
        part = Slice(0, 1, s.data[a:b], np.array([0, b - a]))
        w = Words(part, NON_SPACE)
        words += len(w)
        seen = np.union1d(seen, w.hash)
        rest += [int(_marked(m, part)[0]) for m in (_UPPER, _POINT, _SYMBOL)]
    return tuple(np.array([x]) for x in (words, len(seen), *rest))


def fails(s: Slice) -> np.ndarray:
    """Bits A to D of each document of a slice."""
    n, distinct, upper, points, symbols = (_measure_long if s.n_docs == 1 and len(s.data) > PIECE_BYTES else _measure)(s)
    return ((n < MIN_WORDS) * 1 + (100 * distinct < DISTINCT_PCT * n) * 2 + (100 * upper > UPPER_PCT * points) * 4 + (symbols > 0) * 8).astype(np.int32)


def _scan(batches):
    for b in batches:
        for s in slices(b.column(2)):
            prints = np.frombuffer(b"".join(hashlib.md5(s.doc(i), usedforsecurity=False).digest() for i in range(s.n_docs)), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(s.lo, s.n_docs), b.column(1).slice(s.lo, s.n_docs), pa.array(np.ascontiguousarray(prints[:, 0])),
                 pa.array(np.ascontiguousarray(prints[:, 1])), pa.array(fails(s))], names=["doc_id", "part", "h1", "h2", "fails"])


def document_classes(docs: DataFrame, labels: DataFrame, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text",
                     part_col: str = "lang") -> DataFrame:
    """``part, class, n``: documents of each part by failed filters (bits A to
    E) and label bits."""
    d = pick(docs, doc_id=(id_col, "long"), part=(part_col, "string"), text=(text_col, "string"))
    d = d.select("doc_id", F.coalesce("part", F.lit("")).alias("part"), "text")
    x = d.mapInArrow(_scan, "doc_id long, part string, h1 long, h2 long, fails int")
    x = stored(x.groupBy("doc_id", "part", "h1", "h2", "fails").agg(F.count(F.lit(1)).alias("n")), spark, "audit")
    first = x.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null").withColumn("_first", F.lit(True))
    x = x.join(first, ["h1", "h2", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    x = x.select("doc_id", "part", "n", F.when(F.col("doc_id").isNull(), F.col("h1")).otherwise(0).alias("_salt"),  # null ids do not meet in one task
                 (F.col("fails") + F.when(copy, 16).otherwise(0)).alias("_f"))
    lab = pick(labels, doc_id=(id_col, "long"), quality=("quality", "int"), toxic=("toxic", "int")).groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)).alias("_g"), F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0)).alias("_t"))
    x = x.join(lab.withColumn("_salt", F.lit(0).cast("long")), ["doc_id", "_salt"], "left")
    cls = F.col("_f") + F.coalesce("_g", F.lit(0)) + F.coalesce("_t", F.lit(0))
    return x.groupBy("part", cls.alias("class")).agg(F.sum("n").alias("n"))


def outcomes(cls: int) -> list[int]:
    """Fields (order, step, measure) to which a document of a class adds 1."""
    out = []
    for o, order in enumerate(ORDERS):
        gone = False
        for step, name in enumerate(order):
            bit = 1 << FILTERS.index(name)
            bad = bool(cls & bit)
            hit = {"kept": not gone and not bad, "removed": not gone and bad, "redundant": gone and bad, "unique_fails": cls & 31 == bit}
            hit |= {"good_lost": hit["removed"] and cls & GOOD, "toxic_lost": hit["removed"] and cls & TOXIC}
            at = (o * len(FILTERS) + step) * len(MEASURES)
            out += [at + i for i, m in enumerate(MEASURES) if hit[m]]
            gone |= bad
    return out


FIELDS = len(ORDERS) * len(FILTERS) * len(MEASURES)


@lru_cache(maxsize=1024)
def packed(cls: int, width: int) -> int:
    """The class's integer: fields of ``width`` bytes, lowest first."""
    b = bytearray(FIELDS * width)
    for f in outcomes(cls):
        b[f * width] = 1
    return int.from_bytes(b, "little")


def unpack(total: int, width: int) -> np.ndarray:
    """All fields of a sum, as (orders, steps, measures)."""
    b = np.frombuffer(total.to_bytes(FIELDS * width, "little"), np.uint8).reshape(FIELDS, width)
    wide = np.zeros((FIELDS, 8), np.uint8)
    wide[:, :width] = b
    return wide.view(np.int64).reshape(len(ORDERS), len(FILTERS), len(MEASURES))


AUDIT_SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES) + ", shapley long"


def _audit(rows: pa.Table) -> pa.Table:
    """The 600 rows of a part from its class counts."""
    n = rows.column("n").to_pylist()
    width = (sum(n).bit_length() + 7) // 8
    total = sum(k * packed(c, width) for c, k in zip(rows.column("class").to_pylist(), n, strict=True))
    x = unpack(total, width)
    letter = np.array([[FILTERS.index(c) for c in o] for o in ORDERS])
    removed = x[:, :, MEASURES.index("removed")]
    shapley = np.array([int(removed[letter == i].sum()) for i in range(len(FILTERS))])
    flat = x.reshape(-1, len(MEASURES))
    cols = [pa.array([rows.column("part")[0].as_py()] * len(flat), pa.string()), pa.array(np.repeat(ORDERS, len(FILTERS)).tolist()),
            pa.array(np.tile(np.arange(1, 6, dtype=np.int32), len(ORDERS))), *[pa.array(flat[:, i].copy()) for i in range(len(MEASURES))],
            pa.array(shapley[letter].reshape(-1))]
    return pa.table(cols, names=["part", "filter_order", "step", *MEASURES, "shapley"])


def audit(docs: DataFrame, labels: DataFrame, spark: SparkSession, **columns) -> DataFrame:
    """600 rows per part: what each step of every order of the five filters
    keeps and removes, alone and together."""
    return document_classes(docs, labels, spark, **columns).groupBy("part").applyInArrow(_audit, AUDIT_SCHEMA)
