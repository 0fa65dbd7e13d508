"""Token counts (operator 9).

Method: two tiers, map-side only.  A compact hash table ``pre-token -> number
of tokens`` of frequent pre-tokens is broadcast; misses are encoded by the
tokenizer and kept in a bounded cache of the Python worker.  No pre-token is
ever shuffled.  The table is a warm-up for the caches: it is filled from a
bounded hash sample of documents (``SAMPLE_DOCS``) and changes speed only;
every count is what the tokenizer gives for the whole text.

The byte-level pre-tokenizer cuts a text into pieces that are encoded
independently, so the count of a text is the sum over its pieces.  Texts that
hold a special token's string, or characters on whose class two Unicode
versions may differ, go to the tokenizer whole.

Defined results: a null or empty text has 0 bytes and 0 tokens; one output
row per input row, repeated rows included; texts of any length are counted whole;
pre-tokens of equal frequency are kept in the table in any order, which changes
speed only; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re as std_re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ndflow.llm.frames import bounded_sample, pick

LIMIT = 512
SAMPLE_DOCS = 2000
TABLE_SIZE = 50_000
CACHE_SIZE = 400_000

#: Fixed value: the byte-level BPE split pattern of the vocabulary's library.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class is the same in every Unicode version in use: ASCII
#: with the usual white space, Latin letters, general punctuation.
PLAIN = std_re.compile(r"[\t\n\r\x20-\x7e\u00a1-\u024f\u2010-\u2027\u2030-\u205e]*")


class PieceCounter:
    """Token counter of one Python worker."""

    def __init__(self, path: str, table: dict[str, int]):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.split = regex.compile(SPLIT)
        self.table = table
        self.cache: dict[str, int] = {}

    def whole(self, text: str) -> int:
        return len(self.tok.encode(text, add_special_tokens=False).ids)

    def piece(self, p: str) -> int:
        n = self.cache.get(p)
        if n is None:
            n = self.whole(p)
            if len(self.cache) >= CACHE_SIZE:
                self.cache.clear()
            self.cache[p] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if PLAIN.fullmatch(text) is None or any(s in text for s in self.special):
            return self.whole(text)
        total, table, piece = 0, self.table.get, self.piece
        for p in self.split.findall(text):
            n = table(p)
            total += piece(p) if n is None else n
        return total


_COUNTER: dict[str, PieceCounter] = {}


def _counter(path: str, table: dict[str, int]) -> PieceCounter:
    """One counter per worker process and tokenizer, kept between tasks."""
    c = _COUNTER.get(path)
    if c is None or c.table is not table:
        c = _COUNTER[path] = PieceCounter(path, table)
    return c


def frequent_pieces(docs: DataFrame, path: str, size: int = TABLE_SIZE, sample: int = SAMPLE_DOCS) -> dict[str, int]:
    """The most frequent pre-tokens of a bounded hash sample of documents with
    their token counts: at most ``size`` entries."""
    rows = bounded_sample(docs.filter(F.col("text").isNotNull()), F.col("doc_id"), sample).select("text")

    def count(batches):
        split, c = regex.compile(SPLIT), Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                c.update(split.findall(t))
            for k in [k for k, n in c.most_common()[size:]]:
                del c[k]
        if c:
            yield pa.RecordBatch.from_pydict({"piece": pa.array(list(c), pa.string()), "n": pa.array(list(c.values()), pa.int64())})

    top = (rows.mapInArrow(count, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "piece").limit(size).select("piece"))
    counter = PieceCounter(path, {})
    return {r.piece: counter.whole(r.piece) for r in top.toLocalIterator()}


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per document row."""
    d = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    table = d.sparkSession.sparkContext.broadcast(frequent_pieces(d, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, table.value)
        for b in batches:
            texts = b.column(1)
            for lo in range(0, b.num_rows, 256):
                part = texts.slice(lo, 256).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, 256), pa.array([len(t.encode()) if t else 0 for t in part], pa.int64()),
                     pa.array([counter.count(t) for t in part], pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    out = d.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed tokenizer file lies (the same on every node)."""
    import public_tokenizers

    return public_tokenizers.path(name)
