"""Text chunks and packed key exchange, shared by the operators that look for
equal word runs across documents.

Documents are dealt into chunks: ranges of ``doc_id`` of about ``CHUNK_BYTES``
of text (see ``CHUNK_BYTES``).  A chunk announces the hashes of its word runs once each, packed into
one binary row per (key bucket, chunk): 4 bytes a hash instead of one row a
run.  A bucket's task sees which hashes several chunks share and sends each of
those chunks its part back.  A run that a third of all documents hold thus
costs one entry per chunk, never one per document or per pair.

Buckets and chunks grow in number with the input before they grow in size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ndflow.llm.frames import text_bytes
from ndflow.llm.textcore import U64

#: Text of a chunk, and at most so many chunks (beyond, chunks grow: 100 MB of
#: text each at 100 TB); keys of a bucket, and at most so many bucket bits.
CHUNK_BYTES = 12 << 20
MAX_CHUNKS = 1 << 20
BUCKET_BYTES = 4 << 20
MAX_BITS = 20
#: Ids sampled for the chunks' bounds: per chunk, and at most in all (32 MB).
SAMPLE_PER_CHUNK = 50
MAX_SAMPLE = 1 << 22


class Plan:
    """Chunk bounds and the number of bucket bits for one input."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int = CHUNK_BYTES):
        size = text_bytes(docs, text_col)
        n = docs.filter(F.col(id_col).isNotNull()).count()
        chunks = min(max(1, -(-size // chunk_bytes)), MAX_CHUNKS)
        entries = size // 6 + 1  # a word and its space are about six bytes
        self.bits = min(MAX_BITS, max(3, int(entries * 4 // BUCKET_BYTES).bit_length()))
        self.bounds = np.zeros(0, np.int64)
        if chunks > 1:
            # range bounds from a hash sample of ids; they shape the chunks, not the result
            share = min(1.0, min(SAMPLE_PER_CHUNK * chunks, MAX_SAMPLE) / max(n, 1))
            pick = F.pmod(F.xxhash64(id_col, F.lit("chunk")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)
            ids = np.sort(docs.filter(F.col(id_col).isNotNull() & pick).select(id_col).toPandas().iloc[:, 0].to_numpy(np.int64))
            self.bounds = np.unique(ids[(np.arange(1, chunks) * len(ids)) // chunks]) if len(ids) else ids

    def chunk_of(self, col: Column, spark) -> Column:
        """Number of the chunk of a non-null id: documents of a lower chunk all
        have smaller ids."""
        bounds = spark.sparkContext.broadcast(self.bounds)

        @F.pandas_udf("int")
        def chunk(ids: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(bounds.value, ids.to_numpy(np.int64), side="right").astype(np.int32))

        return chunk(col)


def short_keys(h: np.ndarray, bits: int) -> np.ndarray:
    """Top ``bits`` + 32 bits of each hash: bucket number and 32-bit key."""
    return h >> U64(32 - bits)


def bucket_runs(sorted_keys: np.ndarray, shift: int) -> Iterator[tuple[int, int, int]]:
    """``(bucket, from, to)`` runs of sorted keys, bucket = key >> shift."""
    if not len(sorted_keys):
        return
    b = sorted_keys >> U64(shift)
    cut = np.flatnonzero(b[1:] != b[:-1]) + 1
    for lo, hi in zip(np.concatenate([[0], cut]).tolist(), np.concatenate([cut, [len(b)]]).tolist(), strict=True):
        yield int(b[lo]), lo, hi


def run_starts(sorted_values: np.ndarray) -> np.ndarray:
    """Indexes at which a new value starts."""
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1]) if len(sorted_values) else np.zeros(0, np.int64)


def run_ends(starts: np.ndarray, n: int) -> np.ndarray:
    """Where the runs that begin at ``starts`` end, of ``n`` values; without
    values there is no run."""
    return np.concatenate([starts[1:], [n]])[:len(starts)].astype(np.int64)


def unpack(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column and the row each comes from."""
    parts = [np.frombuffer(x.as_py(), dtype) for x in column]
    rows = np.repeat(np.arange(len(parts)), np.array([len(p) for p in parts], np.int64))
    return (np.concatenate(parts) if parts else np.zeros(0, dtype)), rows


def text_arrays(table: pa.Table, name: str) -> pa.Array:
    """One contiguous string array of a group's text column."""
    col = table.column(name).combine_chunks()
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
