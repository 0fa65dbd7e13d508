"""Phrase collocation mining (operator 11).

Method: external stream estimation.  All counts live in sorted streams of
(language, words, count) that are written to the shared folder, never in a
table of phrases in memory.

1. *Windows.*  Every word starts one window: itself and up to three following
   words of its piece.  A task combines the windows of a few million words and
   writes them out.  A window ends early where a word or word pair cannot be in
   any candidate because it stands fewer than ``MIN_COUNT`` times in its
   language; a bitmap of at most ``2^MAX_BITS`` bits, broadcast, tells which may
   be frequent.  The bitmap is built from hashes of all words and pairs; when it
   fills up it lets more windows pass and the streams grow longer, but nothing is
   decided by it.
2. *Prefix order.*  The windows are range-sorted by their words; one walk over a
   range adds up every prefix, which gives ``f`` of every phrase of one to four
   words.  The runs that cross a range's borders are added up across ranges.
3. *Lockstep walks.*  A phrase's first parts stand before it in prefix order and
   its last parts before it in suffix order, so one walk over each order carries
   the counts of the open phrases along and gives ``l``, ``r`` and the counts of
   the phrases one word shorter, which it extends.  What is open at a range's
   start is known from the last rows of the ranges before it.
4. *Extensions.*  A phrase that lies in a longer candidate lies in one that is one
   word longer and at least as frequent, so only extensions by one word to the
   right or left are looked at.

A hot word or pair is one row per combined run and never a group: ranges are cut
by whole windows, in even shares of the rows.

Words are told apart by 64-bit hashes while a task combines its windows; streams
hold and compare the words themselves.

Defined results: a null or empty text has no words; a null language is ``und``;
repeated rows count as often as they stand there; equal scores are ranked by
count, then by phrase; texts of any length are read in bounded pieces; an empty
table or one without frequent phrases gives no rows; ids are not read; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ndflow.llm.frames import lean, pick, stored
from ndflow.llm.textcore import U64, Slice, Words, mix64, run_lengths, separator_cuts, slices, window_hashes

ORDER = 4
MIN_COUNT, COVER_PCT, SCALE, KEEP = 30, 80, 2_000_000, 2000
NO_LANG = "und"
#: Words combined by a task before it writes them out; a longer text is read in pieces.
COMBINE_WORDS = 1 << 20
PIECE_BYTES = 4 << 20
#: Rows of a range of the sorted streams; bits of the frequency bitmap.
RANGE_ROWS = 400_000
MIN_BITS, MAX_BITS = 20, 28
MAX_LANGS = 1 << 16

# Bytes that end a piece, and bytes between words.
BREAKS = np.zeros(256, bool)
BREAKS[[ord(c) for c in ".,;:!?"]] = True
BREAKS[0x0A:0x0E] = True
GAPS = BREAKS.copy()
GAPS[[0x20, 0x09]] = True
WORD = ~GAPS


class Run:
    """The words of some texts: hash, language, whether the next word follows in
    the same piece, and whether a window starts here; and the words themselves,
    once each per slice."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.spelled: list[tuple[np.ndarray, pa.Array]] = []
        self.size = 0

    def add(self, s: Slice, lang: np.ndarray, spell: bool) -> None:
        for a, b, own in _pieces(s):
            part = s if (a, b) == (0, len(s.data)) else Slice(0, 1, s.data[a:b], np.array([0, b - a]))
            w = Words(part, WORD, lower=True)
            if not len(w):
                continue
            doc = w.doc_of()
            breaks = np.searchsorted(np.flatnonzero(BREAKS[part.data]), w.start)
            follows = np.zeros(len(w), bool)
            follows[:-1] = (doc[1:] == doc[:-1]) & (breaks[1:] == breaks[:-1])
            mine = w.start < own - a  # words of the look-ahead start no window of their own
            self.parts.append((w.hash, lang[doc], follows, mine))
            self.size += len(w)
            if spell:
                h, first = np.unique(w.hash, return_index=True)
                self.spelled.append((h, _texts(part.data, w.start[first], w.end[first])))

    def arrays(self) -> tuple[np.ndarray, ...]:
        h, lang, follows, mine = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        return h, lang, follows, mine

    def words(self) -> tuple[np.ndarray, pa.Array]:
        """All distinct hashes, sorted, and their words."""
        h = np.concatenate([x for x, _ in self.spelled])
        u, first = np.unique(h, return_index=True)
        return u, pa.concat_arrays([t for _, t in self.spelled]).take(pa.array(first))


def _pieces(s: Slice) -> Iterator[tuple[int, int, int]]:
    """``(from, to, own)`` byte ranges of a slice: a very long text is cut
    between words, each part followed by a look-ahead of three words."""
    n = len(s.data)
    if s.n_docs > 1 or n <= PIECE_BYTES:
        yield 0, n, n
        return
    for a, b in separator_cuts(s.data, WORD, PIECE_BYTES):
        ahead = b
        for _ in range(ORDER - 1):  # to the end of the next word
            for in_word in (False, True):
                while ahead < n and WORD[s.data[ahead]] == in_word:
                    stop = np.flatnonzero(WORD[s.data[ahead:ahead + 4096]] != in_word)
                    ahead = ahead + int(stop[0]) if len(stop) else min(n, ahead + 4096)
        yield a, ahead, b


def _texts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Byte spans as lower-cased strings."""
    size = end - start
    off = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - off[:-1], size) + np.arange(off[-1])
    low = data[at]
    low = low + ((low >= 0x41) & (low <= 0x5A)).astype(np.uint8) * np.uint8(32)
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(low.tobytes())])


def _runs(batches, spell: bool) -> Iterator[tuple[Run, list[str]]]:
    """Runs of about ``COMBINE_WORDS`` words with the languages they use."""
    run, langs = Run(), {}
    for b in batches:
        names = [NO_LANG if x is None else x for x in b.column(0).to_pylist()]
        code = np.array([langs.setdefault(x, len(langs)) for x in names], np.int32)
        for s in slices(b.column(1)):
            run.add(s, code[s.lo:s.hi], spell)
            if run.size >= COMBINE_WORDS:
                yield run, list(langs)
                run = Run()
        if len(langs) > MAX_LANGS // 2:  # codes are packed into 16 bits
            if run.size:
                yield run, list(langs)
            run, langs = Run(), {}
    if run.size:
        yield run, list(langs)


def _language_salts(langs: list[str]) -> np.ndarray:
    """A 64-bit number per language, the same in every task."""
    import hashlib
    return np.array([int.from_bytes(hashlib.md5(x.encode(), usedforsecurity=False).digest()[:8], "little") for x in langs], U64)


def _word_keys(h: np.ndarray, lang: np.ndarray, follows: np.ndarray, salts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every word, and of every word with the next one (0 where none)."""
    if not len(h):
        return h, h
    salt = salts[lang]
    one = mix64(h ^ salt)
    two = np.zeros(len(h), U64)
    two[:-1] = window_hashes(h, 2)
    return one, np.where(follows, mix64(two + salt), U64(0))


# ---- 1. which words and pairs may be frequent

def _count_keys(batches):
    for run, langs in _runs(batches, spell=False):
        h, lang, follows, mine = run.arrays()
        one, two = _word_keys(h, lang, follows, _language_salts(langs))
        keys = np.sort(np.concatenate([one[mine], two[mine & follows]]))
        at, n = run_lengths(keys)
        for a in range(0, len(at), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at[a:a + (1 << 16)]].view(np.int64)), pa.array(n[a:a + (1 << 16)].astype(np.int32))], names=["h", "c"])


def frequent_bitmap(d: DataFrame, spark: SparkSession, min_count: int) -> np.ndarray:
    """A bitmap with the top bits of all keys that stand ``min_count`` times."""
    keys = d.mapInArrow(lean(_count_keys), "h long, c int").groupBy("h").agg(F.sum("c").alias("c")).filter(F.col("c") >= min_count)
    keys = stored(keys.select("h"), spark, "frequent")
    bits = int(np.clip(int(keys.count() * 32).bit_length(), MIN_BITS, MAX_BITS))
    cell = F.expr(f"shiftrightunsigned(h, {64 - bits})")
    word = keys.select(F.shiftright(cell, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(63).cast("int")).alias("b"))
    t = word.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()  # at most 2^(MAX_BITS - 6) rows
    out = np.zeros(1 << (bits - 6), U64)
    out[t.column("w").to_numpy()] = t.column("b").to_numpy().view(U64)
    return out


def _may(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    cell = keys >> U64(64 - (len(bitmap).bit_length() + 5))
    return (bitmap[cell >> U64(6)] >> (cell & U64(63))) & U64(1) == U64(1)


# ---- 2. windows and their prefixes

WINDOW_SCHEMA = "lang string, key string, k int, c long"


def _windows(batches, bitmap):
    """The combined windows of each run.  ``key`` is the words, each followed by
    a space, so a phrase's key begins the keys of all its extensions.  ``k`` 0
    carries the number of words of a language."""
    for run, langs in _runs(batches, spell=True):
        h, lang, follows, mine = run.arrays()
        one, two = _word_keys(h, lang, follows, _language_salts(langs))
        for code, n in enumerate(np.bincount(lang[mine], minlength=len(langs)).tolist()):
            if n:
                yield pa.RecordBatch.from_pylist([{"lang": langs[code], "key": "", "k": 0, "c": n}], schema=_WINDOW)
        link = follows & _may(bitmap, two)
        size = np.where(_may(bitmap, one), 1, 0)
        on = size == 1
        for j in range(1, ORDER):
            on = on & np.concatenate([link[j - 1:], np.zeros(j - 1, bool)])
            size = size + on
        del one, two, on, follows
        vocabulary, spelled = run.words()
        run.spelled, run.parts = [], []
        ids = np.searchsorted(vocabulary, h).astype(U64) + U64(1)  # 0: no word here
        at = np.flatnonzero(mine & (size > 0))
        cols = [np.where(size[at] > j, np.concatenate([ids[j:], np.zeros(j, U64)])[at], U64(0)) for j in range(ORDER)]
        # a window as two numbers: language and two words, two words
        head, tail = (lang[at].astype(U64) << U64(48)) | (cols[0] << U64(24)) | cols[1], (cols[2] << U64(24)) | cols[3]
        one = size[at] == 1
        del ids, cols, h, lang, size, at, link
        alone = np.sort(head[one])
        first, n = run_lengths(alone)
        yield from _spell(langs, spelled, alone[first], np.zeros(len(first), U64), n)
        head, tail = head[~one], tail[~one]
        order = np.lexsort((tail, head))
        head, tail = head[order], tail[order]
        new = np.ones(len(head), bool)
        new[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
        first = np.flatnonzero(new)
        yield from _spell(langs, spelled, head[first], tail[first], np.diff(np.concatenate([first, [len(head)]])))


def _spell(langs: list[str], spelled: pa.Array, head: np.ndarray, tail: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Windows as rows, words written out."""
    low = U64((1 << 24) - 1)
    names, gap, end = pa.array(langs, pa.string()), pa.scalar(" ", spelled.type), pa.scalar("", spelled.type)
    for a in range(0, len(head), 1 << 15):
        x, y = head[a:a + (1 << 15)], tail[a:a + (1 << 15)]
        ids = [v.astype(np.int64) for v in ((x >> U64(24)) & low, x & low, y >> U64(24), y & low)]
        words = [spelled.take(pa.array(np.maximum(v - 1, 0), mask=v == 0)) for v in ids]
        key = pc.binary_join_element_wise(*words, end, gap, null_handling="skip").cast(pa.string())
        yield pa.RecordBatch.from_arrays([names.take(pa.array((x >> U64(48)).astype(np.int32))), key, pa.array(sum((v > 0).astype(np.int32) for v in ids)),
                                          pa.array(n[a:a + (1 << 15)])], names=["lang", "key", "k", "c"])


_WINDOW = pa.schema([("lang", pa.string()), ("key", pa.string()), ("k", pa.int32()), ("c", pa.int64())])


def _ranges(df: DataFrame, rows: int, *order: str) -> DataFrame:
    """``df`` in ranges of about ``rows`` rows each."""
    return df.repartitionByRange(max(1, -(-df.count() // rows)), *order)


def _whole(batches) -> pa.Table | None:
    """One range: ``RANGE_ROWS`` rows by design."""
    got = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(got).combine_chunks() if got else None


def _codes(col: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    d = pc.dictionary_encode(col).combine_chunks()
    d = d.combine_chunks() if isinstance(d, pa.ChunkedArray) else d
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def _prefix_counts(min_count: int):
    def run(batches):
        t = _whole(batches)
        if t is None:
            return
        t = t.sort_by([("lang", "ascending"), ("key", "ascending")])
        c, k = t.column("c").to_numpy(), t.column("k").to_numpy()
        lang, langs = _codes(t.column("lang"))
        lists = pc.split_pattern(t.column("key").combine_chunks(), " ")
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        word, words = _codes(pa.chunked_array([lists.flatten()]))
        start = lists.offsets.to_numpy().astype(np.int64) - int(lists.offsets[0].as_py())
        new = np.ones(t.num_rows, bool)
        new[1:] = lang[1:] != lang[:-1]
        for j in range(1, ORDER + 1):  # runs of equal first j words among the rows that have them
            has = np.flatnonzero(k >= j)
            if not len(has):
                break
            w = word[start[has] + j - 1]
            changed = np.cumsum(new)  # a shorter row in between, or another parent, also ends a run
            cut = np.ones(len(has), bool)
            cut[1:] = (changed[has[1:]] != changed[has[:-1]]) | (w[1:] != w[:-1])
            first = np.flatnonzero(cut)
            f = np.add.reduceat(c[has], first)
            last = np.concatenate([first[1:], [len(has)]]) - 1
            open_run = (has[first] == 0) | (has[last] == t.num_rows - 1)  # may go on in another range
            keep = np.flatnonzero((f >= min_count) | open_run)
            at = has[first[keep]]
            parts = [words.take(pa.array(word[start[at] + i])) for i in range(j)]
            key = pc.binary_join_element_wise(*parts, pa.scalar("", words.type), " ")
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(lang[at])), key.cast(pa.string()), pa.array(np.full(len(at), j, np.int32)), pa.array(f[keep])],
                                             names=["lang", "key", "k", "c"])
            new = np.zeros(t.num_rows, bool)
            new[has[first]] = True
            new[np.flatnonzero(k < j)] = True
        total = np.flatnonzero(k == 0)
        if len(total):
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(lang[total])), pa.array([""] * len(total)), pa.array(np.zeros(len(total), np.int32)),
                                              pa.array(c[total])], names=["lang", "key", "k", "c"])

    return run


def phrase_counts(docs: DataFrame, spark: SparkSession, min_count: int = MIN_COUNT, text_col: str = "text", lang_col: str = "lang",
                  range_rows: int = RANGE_ROWS) -> DataFrame:
    """``lang, key, k, f``: every phrase of ``k`` = 1 to 4 words that stands at
    least ``min_count`` times; ``k`` 0 is the language's number of words."""
    d = pick(docs, lang=(lang_col, "string"), text=(text_col, "string"))
    bitmap = spark.sparkContext.broadcast(frequent_bitmap(d, spark, min_count))
    w = stored(d.mapInArrow(lean(lambda it: _windows(it, bitmap.value)), WINDOW_SCHEMA), spark, "windows")
    x = _ranges(w, range_rows, "lang", "key").mapInArrow(lean(_prefix_counts(min_count)), WINDOW_SCHEMA)
    f = x.groupBy("lang", "key", "k").agg(F.sum("c").alias("f"))
    return stored(f.filter((F.col("f") >= min_count) | (F.col("k") == 0)), spark, "counts")


# ---- 3. first and last parts

PARTS = [f"p{j}" for j in range(1, ORDER)]


def _walk(names: list[str], open_before: list[list[int]]):
    def run(t: pa.Table) -> pa.Table:
        """Rows of one range in the order of ``walk``; a phrase's first parts are
        the last rows of 1 to 3 words before it."""
        t = t.sort_by([("lang", "ascending"), ("walk", "ascending")])
        k, f = t.column("k").to_numpy(), t.column("f").to_numpy()
        before = open_before[t.column("pid")[0].as_py()]
        out = []
        for j in range(1, ORDER):
            at = np.maximum.accumulate(np.where(k == j, np.arange(len(k)), -1))
            part = np.where(at >= 0, f[np.maximum(at, 0)], before[j - 1])
            out.append(pa.array(part, mask=k <= j))
        keep = [c for c in t.column_names if c not in ("walk", "pid")]
        return pa.table([*[t.column(c) for c in keep], *out], names=[*keep, *names])

    return run


def with_parts(x: DataFrame, walk: Column, names: list[str], spark: SparkSession, range_rows: int) -> DataFrame:
    """``x`` (all frequent phrases) with the counts of the parts that begin its
    ``walk`` key: ``names`` are the columns for 1, 2 and 3 words."""
    p = _ranges(x.withColumn("walk", walk), range_rows, "lang", "walk").withColumn("pid", F.spark_partition_id())
    p = stored(p, spark, "walk")
    last = [F.max(F.when(F.col("k") == j, F.struct("lang", "walk", "f")))["f"].alias(f"_{j}") for j in range(1, ORDER)]
    ends = {r.pid: r for r in p.groupBy("pid").agg(*last).collect()}  # one row per range
    before, now = [], [0] * (ORDER - 1)
    for pid in range(max(ends, default=-1) + 1):
        before.append(now)
        if pid in ends:
            now = [v if ends[pid][f"_{j + 1}"] is None else ends[pid][f"_{j + 1}"] for j, v in enumerate(now)]
    cols = [f for f in p.schema.fields if f.name not in ("walk", "pid")]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in cols], *[f"{n} long" for n in names]])
    return stored(p.groupBy("pid").applyInArrow(_walk(names, before), schema), spark, "parts")


def _exact(x) -> Column:
    return x.cast("decimal(19,0)")


def collocations(docs: DataFrame, spark: SparkSession, min_count: int = MIN_COUNT, cover_pct: int = COVER_PCT, scale: int = SCALE, keep: int = KEEP,
                 range_rows: int = RANGE_ROWS, **columns) -> DataFrame:
    """Per language the ``keep`` best phrases: ``lang, rank, phrase, a, l, r, n,
    score``."""
    counts = phrase_counts(docs, spark, min_count, range_rows=range_rows, **columns)
    n = counts.filter("k = 0").select("lang", F.col("f").alias("n"))  # one row per language
    x = counts.filter("k > 0")
    lefts, rights = [f"l{j}" for j in range(1, ORDER)], [f"r{j}" for j in range(1, ORDER)]
    x = with_parts(x, F.col("key"), lefts, spark, range_rows)
    back = F.concat(F.array_join(F.reverse(F.split(F.rtrim("key", F.lit(" ")), " ")), " "), F.lit(" "))
    x = with_parts(x, back, rights, spark, range_rows)
    words = F.split(F.rtrim("key", F.lit(" ")), " ")

    def covers(part: Column) -> Column:
        return 100 * _exact(F.col("f")) >= cover_pct * _exact(part)

    def shorter(side: list[str]) -> Column:  # count of the phrase without its last (first) word
        return F.when(F.col("k") == 3, F.col(side[1])).when(F.col("k") == 4, F.col(side[2]))

    longer = x.filter("k >= 3")
    drop_right = longer.filter(covers(shorter(lefts))).select("lang", F.array_join(F.slice(words, F.lit(1), F.col("k") - 1), " ").alias("phrase"))
    drop_left = longer.filter(covers(shorter(rights))).select("lang", F.array_join(F.slice(words, F.lit(2), F.col("k") - 1), " ").alias("phrase"))
    cuts = []
    for j in range(1, ORDER):  # first part of j words, rest of k - j
        right = F.when(F.col("k") == j + 1, F.col("r1")).when(F.col("k") == j + 2, F.col("r2")).when(F.col("k") == j + 3, F.col("r3"))
        score = F.expr(f"cast(cast({scale} as decimal(18,0)) * cast(f as decimal(19,0)) div (cast({lefts[j - 1]} as decimal(19,0)) + cast(_r as decimal(19,0))) as bigint)")
        cuts.append((right, score, j))
    y = x.filter("k >= 2")
    for right, score, j in cuts:
        y = y.withColumn("_r", right).withColumn(f"_c{j}", F.when(F.col("k") > j, F.struct(
            score.alias("score"), F.lit(j).alias("cut"), F.col(lefts[j - 1]).alias("l"), F.col("_r").alias("r"))))
    y = y.select("lang", F.rtrim("key", F.lit(" ")).alias("phrase"), F.col("f").alias("a"), F.array_min(F.array_compact(F.array("_c1", "_c2", "_c3"))).alias("_m"))
    y = y.join(drop_right.unionAll(drop_left).distinct().hint("merge"), ["lang", "phrase"], "left_anti")
    y = y.select("lang", "phrase", "a", F.col("_m.l").alias("l"), F.col("_m.r").alias("r"), F.col("_m.score").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    top = y.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= keep)
    top = top.join(n.groupBy("lang").agg(F.sum("n").alias("n")), "lang")
    return top.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
