"""Adaptive quality rules (operator 5), DataFrame functions only.

Method: instead of fixed cutoffs, every measure gets cutoffs from the corpus: a
mergeable quantile sketch per language and source, far-out fences, and a join
that gives each document the fences of its group.  A sketch is a histogram of
counts over bins of 2 % relative width (and one for zero), so sketches merge by
addition, cover every document, and give the same fences on every run.

A fence is the upper quartile plus ``SPREAD`` interquartile ranges plus a small
margin.  Symbols and repeated lines are zero in most documents; where they are
zero in more than half of a group, the quartiles are those of the values above
zero, and the language's fence, made in the same way, holds where it is lower:
junk that fills one source's values does not set that source's fence.  Where
fewer than ``RARE`` of a group's documents have any, a value above ``FLOOR`` is an
outlier.  Groups with fewer than ``MIN_GROUP`` documents take the merged sketch of
their language, and below that the merged sketch of all.

Base measures are taken in one pass inside each row (arrays and higher-order
functions; no shuffle): words, characters in words, symbols, repeated lines,
words in repeated 8-word windows.  Windows are compared by 64-bit hashes.

Defined results: a null or empty text has no words and fails the base rules; a
null language or source is a group of its own; values equal to a fence are
inside; repeated rows count as often and give a row each; texts of any length are
read whole, inside their row; other columns are ignored; empty input gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ndflow.llm.frames import stored

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
MIN_GROUP = 100
QUARTILES = (0.25, 0.75)
#: Share of documents with a value above zero, below which any is an outlier.
RARE = 0.01
#: Ratio of a bin's bounds.  Values from 1e-9 to 1e9 are about 2,100 bins.
BIN = 1.02
ZERO_BIN = -(1 << 30)
#: Interquartile ranges beyond the quartile at which a fence stands.
SPREAD = 4.0
#: Added to each fence, so that a measure without spread still leaves room:
#: characters per word.
MARGIN = {"word_len": 1.0}
#: Least fence of the mostly-zero measures: symbols per character, repeated
#: lines per 100 words.
FLOOR = {"symbols": 0.03, "dup_lines": 0.1}
WORD_SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Groups in the fence table below which it is broadcast.
BROADCAST_GROUPS = 100_000


def repeated_words(words: Column, k: int = WINDOW) -> Column:
    """Words that lie in a ``k``-word window found twice or more in the text.

    Positions of repeated windows come from the sorted (hash, position)
    pairs; each covers ``k`` words, less what the next one covers.  Texts
    whose windows are all different stop at the distinct count."""
    n = F.size(words) - (k - 1)
    # a lambda variable binds each intermediate array once
    def bind(value, f):
        return F.element_at(F.transform(F.array(value), f), 1)

    def count(h):
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def dup_positions(s):
            def same(i, j):
                return F.get(s, i)["h"] == F.get(s, j)["h"]
            marked = F.transform(s, lambda x, i: F.when(F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)), x["i"]))
            return F.array_sort(F.filter(marked, lambda x: x.isNotNull()))

        def covered(p):
            return F.aggregate(p, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-k).alias("last")),
                               lambda a, x: F.struct((a["sum"] + F.least(F.lit(k), x - a["last"])).cast("long").alias("sum"), x.alias("last")),
                               lambda a: a["sum"])

        found = bind(bind(pairs, dup_positions), covered)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(found)

    hashes = bind(F.transform(words, lambda w: F.xxhash64(w)),
                  lambda wh: F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(wh, i, F.lit(k)))))
    return F.when(n >= 2, bind(hashes, count)).otherwise(F.lit(0).cast("long"))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Base measures of every document row."""
    d = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"),
                    docs[f"`{lang_col}`"].cast("string").alias("lang"), docs[f"`{source_col}`"].cast("string").alias("source"))
    words = F.filter(F.split("text", WORD_SPLIT), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.select("*", words.alias("w"), lines.alias("l"))
    out = d.select("doc_id", "lang", "source", F.size("w").cast("long").alias("n_words"),
                   F.length(F.regexp_replace("text", WORD_SPLIT, "")).cast("long").alias("word_chars"),
                   F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                   (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
                   repeated_words(F.col("w")).alias("n_repeat_words"))
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))


def _ratios() -> dict[str, Column]:
    n = F.greatest("n_words", F.lit(1)).cast("double")
    return {"symbols": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)).cast("double"), "dup_lines": 100.0 * F.col("n_dup_lines") / n,
            "word_len": F.col("word_chars") / n}


def _bin(x: Column) -> Column:
    """Number of a value's bin: its upper bound is ``BIN`` to that power."""
    return F.when(x > 0, F.ceil(F.log(x) / F.log(F.lit(BIN))).cast("int")).otherwise(ZERO_BIN)


def _upper(b: Column) -> Column:
    return F.when(b == ZERO_BIN, 0.0).otherwise(F.pow(F.lit(BIN), b.cast("double")))


def _quantile(bins: Column, n: Column, p: float) -> Column:
    """Upper bound of the bin that holds the ``p`` quantile of ``n`` values;
    ``bins`` are ordered ``(b, n)``.  Null without values."""
    want = F.greatest(F.lit(1), F.ceil(F.lit(p) * n)).cast("long")
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("at"))
    found = F.aggregate(bins, start, lambda a, x: F.struct((a["seen"] + x["n"]).alias("seen"), F.coalesce(
        a["at"], F.when(a["seen"] + x["n"] >= want, x["b"])).alias("at")), lambda a: a["at"])
    return _upper(found)


def sketches(m: DataFrame) -> DataFrame:
    """``lang, source, measure, b, n``: documents that pass the base rules, per
    bin of each measure."""
    rows = F.array(*[F.struct(F.lit(k).alias("measure"), _bin(e).alias("b")) for k, e in _ratios().items()])
    x = m.filter(~F.col("base_failed")).select("lang", "source", F.inline(rows))
    return x.groupBy("lang", "source", "measure", "b").agg(F.count(F.lit(1)).alias("n"))


def _level(h: DataFrame, keys: list[str], tag: str) -> DataFrame:
    """Fences of the merged sketches of one level, a row per key: ``<tag>_n``
    and, per measure, ``<tag>_lo_``, ``<tag>_hi_`` and ``<tag>_rare_``."""
    g = h.groupBy(*keys, "measure", "b").agg(F.sum("n").alias("n"))
    g = g.groupBy(*keys, "measure").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("b") != ZERO_BIN, F.col("n")).otherwise(0)).alias("above"),
                                        F.array_sort(F.collect_list(F.struct("b", "n"))).alias("bins"))  # a few thousand bins
    mostly_zero = F.col("measure").isin(*FLOOR) & (2 * F.col("above") < F.col("all"))
    bins = F.when(mostly_zero, F.filter("bins", lambda x: x["b"] != ZERO_BIN)).otherwise(F.col("bins"))
    g = g.withColumn("bins", bins).withColumn("of", F.when(mostly_zero, F.col("above")).otherwise(F.col("all")))
    g = g.withColumn("q1", _quantile(F.col("bins"), F.col("of"), QUARTILES[0])).withColumn("q3", _quantile(F.col("bins"), F.col("of"), QUARTILES[1]))
    margin = F.lit(0.0)
    for k, v in MARGIN.items():
        margin = F.when(F.col("measure") == k, F.lit(v)).otherwise(margin)
    room = F.lit(SPREAD) * (F.col("q3") - F.col("q1")) + margin
    g = g.select(*keys, "measure", "all", (F.col("q1") / BIN - room).alias("lo"), (F.col("q3") + room).alias("hi"),
                 mostly_zero.alias("zeros"), (F.col("above") < RARE * F.col("all")).alias("rare"))
    cols = [F.max("all").alias(f"{tag}_n")]
    for k in _ratios():
        cols += [F.max(F.when(F.col("measure") == k, F.col(c))).alias(f"{tag}_{c}_{k}") for c in ("lo", "hi", "zeros", "rare")]
    return g.groupBy(*keys).agg(*cols)


def fences(m: DataFrame) -> DataFrame:
    """Per (lang, source): ``lo_<measure>`` and ``hi_<measure>``."""
    h = stored(sketches(m), m.sparkSession, "sketches")
    a = _level(h, ["lang", "source"], "a").withColumnsRenamed({"lang": "a_lang", "source": "a_source"})
    b = _level(h, ["lang"], "b").withColumnRenamed("lang", "b_lang")
    every = _level(h, [], "c").first()  # one row of numbers
    groups = m.select("lang", "source").distinct()
    g = (groups.join(a, groups["lang"].eqNullSafe(a["a_lang"]) & groups["source"].eqNullSafe(a["a_source"]), "left")
         .join(b, F.col("lang").eqNullSafe(b["b_lang"]), "left"))

    def at(col: str, kind: str) -> Column:
        c = F.lit(every[f"c_{col}"]).cast(kind)
        return F.when(F.col("a_n") >= MIN_GROUP, F.col(f"a_{col}")).when(F.col("b_n") >= MIN_GROUP, F.col(f"b_{col}")).otherwise(c)

    cols = []
    for k in _ratios():
        hi = at(f"hi_{k}", "double")
        if k in FLOOR:
            parent = F.when(F.col("b_n") >= MIN_GROUP, F.col(f"b_hi_{k}")).otherwise(F.lit(every[f"c_hi_{k}"]).cast("double"))
            own = F.when(at(f"rare_{k}", "boolean"), F.lit(0.0)).when(at(f"zeros_{k}", "boolean"), F.least(hi, parent)).otherwise(hi)
            hi = F.when(at(f"rare_{k}", "boolean").isNotNull(), F.greatest(own, F.lit(FLOOR[k])))  # an empty corpus has no fences
        cols += [at(f"lo_{k}", "double").alias(f"lo_{k}"), hi.alias(f"hi_{k}")]
    return g.select("lang", "source", *cols)


def judge(docs: DataFrame, spark: SparkSession, **cols) -> DataFrame:
    """``measures`` plus ``kept``: base rules passed and every measure inside
    the fences of the document's group."""
    m = stored(measures(docs, **cols), spark, "quality")
    f = stored(fences(m), spark, "fences").withColumnsRenamed({"lang": "_lang", "source": "_source"})
    if f.count() <= BROADCAST_GROUPS:
        f = F.broadcast(f)
    x = m.join(f, m["lang"].eqNullSafe(f["_lang"]) & m["source"].eqNullSafe(f["_source"]), "left")
    inside = ~F.col("base_failed")
    for k, e in _ratios().items():
        inside = inside & F.coalesce(e <= F.col(f"hi_{k}"), F.lit(True))
        if k == "word_len":
            inside = inside & F.coalesce(e >= F.col(f"lo_{k}"), F.lit(True))
    return x.select(*m.columns, inside.alias("kept"))


def digest(judged: DataFrame) -> DataFrame:
    """The contract's columns of ``judge``."""
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
