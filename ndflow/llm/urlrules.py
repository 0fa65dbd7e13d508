"""URL filter by a path-template tree (operator 6), DataFrame functions only.

Method, per host: the path's segments are a branch of the host's tree.
1. Variable segments become wildcards: numbers, ids and dates by their shape,
   then any node with ``MIN_CHILDREN`` or more children none of which is common
   (``MAX_CHILD_SHARE``).  Branches that a wildcard joins are looked at again,
   until no node changes, so wildcards nest; the tree has no depth limit.
2. Sibling templates that differ in one literal segment are merged when they are
   alike: a template with labels when its labelled share does not differ by more
   than ``MERGE_Z`` standard errors from the siblings' common share, one without
   labels when all labelled siblings are alike.
3. A template is rejected when its smoothed labelled purity is above ``REJECT``:
   blocked labels of its merged siblings plus ``PRIOR_WEIGHT`` times the purity of
   the branch above it, over labels plus ``PRIOR_WEIGHT``.  The branch's purity is
   smoothed by its own parent in the same way, up to the host, and the host's by
   the share of all labels, ``PRIOR_CAP`` at most.  So a template without labels
   takes its verdict from its siblings and branch; a host without any is allowed.
Labels are the verdicts of the fixed rules, where one fits.

Paths are reduced to (host, template) counts with a partial aggregate first, so
a host with a third of all pages is no single task; templates go back to the
pages by a join of which only rejected templates are the other side.  Nodes are
told apart by 64-bit hashes of their path.

Defined results: host and path are empty for a null url or one without
``://``; such pages have no rule and share the empty template; repeated rows
each give a row and count as often; a purity of exactly ``REJECT`` is allowed;
urls of any length and depth are read whole; an empty table gives no rows, one
without labels allows all; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ndflow.llm.frames import stored

#: Fixed values: (verdict, host, path prefix), the rule is host + path.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
MIN_CHILDREN = 20
MAX_CHILD_SHARE = 0.2
MERGE_Z = 2.0
PRIOR_WEIGHT = 5.0
#: Labels come from rules and are no sample of all pages, so their share counts
#: at most so much for a host that has none.
PRIOR_CAP = 0.25
REJECT = 0.5
#: Rejected templates below which their table is broadcast.
BROADCAST_TEMPLATES = 100_000

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(u, _URL, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(u, _URL, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict (null where none fits)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # longer rules are tested first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def shape(segment: Column) -> Column:
    """A segment with its variable part generalised; literals stay."""
    ext = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    wild = (F.when(stem.rlike(r"^[0-9]+$"), "{n}").when(stem.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), "{date}")
            .when(stem.rlike(r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f-]{27}$") | (stem.rlike(r"^[0-9A-Fa-f]{12,}$") & stem.rlike("[0-9]")), "{id}")
            .when(stem.rlike(r"[0-9]{3,}"), F.regexp_replace(stem, "[0-9]+", "{n}")))
    return F.when(wild.isNotNull(), F.concat(wild, ext)).otherwise(segment)


def templates(pages: DataFrame) -> DataFrame:
    """(host, raw template) counts from rows with host, path and label."""
    return pages.groupBy("host", "raw").agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"),
                                            F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"))


def _prefixes(segs: Column) -> Column:
    """Hash of the first 1, 2, ... segments."""
    return F.aggregate(segs, F.array().cast("array<bigint>"), lambda a, x: F.concat(a, F.array(F.xxhash64(F.try_element_at(a, F.lit(-1)), x))))


def _wildcards(t: DataFrame) -> DataFrame:
    """Add ``template``: segments under nodes with many rare children become
    ``*``, again and again until no node changes."""
    t = t.withColumn("segs", F.split("raw", "/"))
    while True:
        seg = t.select("host", "raw", "n", F.posexplode(F.arrays_zip("segs", _prefixes(F.col("segs")).alias("h"))).alias("pos", "s"))
        seg = seg.select("host", "raw", "n", "pos", F.col("s.segs").alias("seg"), F.col("s.h").alias("h"))
        up = F.lag("h", 1, 0).over(Window.partitionBy("host", "raw").orderBy("pos"))  # the segments of one path
        seg = seg.withColumn("node", up)
        child = seg.groupBy("host", "pos", "node", "seg").agg(F.sum("n").alias("n"))
        node = child.groupBy("host", "pos", "node").agg(F.count(F.lit(1)).alias("kids"), F.sum("n").alias("all"), F.max("n").alias("top"))
        many = node.filter((F.col("kids") >= MIN_CHILDREN) & (F.col("top") <= MAX_CHILD_SHARE * F.col("all"))).select("host", "pos", "node", F.lit(True).alias("wild"))
        x = seg.join(many, ["host", "pos", "node"], "left")
        back = x.groupBy("host", "raw").agg(F.array_sort(F.collect_list(F.struct("pos", F.when(F.col("wild"), "*").otherwise(F.col("seg")).alias("seg")))).alias("s"),
                                            F.coalesce(F.max("wild"), F.lit(False)).alias("changed"))
        t = t.drop("segs").join(back.select("host", "raw", F.col("s.seg").alias("segs"), "changed"), ["host", "raw"])
        t = stored(t, t.sparkSession, "urltree")
        if t.filter("changed").isEmpty():
            return t.drop("changed").withColumn("template", F.array_join("segs", "/")).drop("segs")
        t = t.drop("changed")


def _branch_purity(leaf: DataFrame, prior: float) -> DataFrame:
    """``host, template, above``: the smoothed purity of the branch that holds
    each template, from the host down."""
    segs = F.split("template", "/")
    x = leaf.select("host", "template", "labelled", "blocked", F.posexplode(F.slice(_prefixes(segs), F.lit(1), F.size(segs) - 1)).alias("pos", "h"))
    node = x.groupBy("host", "pos", "h").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    y = x.select("host", "template", "pos", "h").join(node, ["host", "pos", "h"])
    y = y.groupBy("host", "template").agg(F.array_sort(F.collect_list(F.struct("pos", "n", "b"))).alias("way"))  # one per segment
    fold = F.aggregate("way", F.lit(prior).cast("double"), lambda p, w: (w["b"] + PRIOR_WEIGHT * p) / (w["n"] + PRIOR_WEIGHT))
    return y.select("host", "template", fold.alias("above"))


def rejected(t: DataFrame) -> DataFrame:
    """(host, raw) of the templates to reject."""
    t = _wildcards(t)
    leaf = t.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    total = leaf.agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b")).first()
    prior = min(total["b"] / total["n"], PRIOR_CAP) if total["n"] else 0.0
    # siblings: the same template with one literal segment left open
    seg = leaf.select("*", F.posexplode(F.split("template", "/")).alias("pos", "seg")).filter((F.col("seg") != "") & ~F.col("seg").rlike(r"[*{]"))
    parts = F.split("template", "/")
    open_ = F.concat_ws("/", F.slice(parts, F.lit(1), F.col("pos")), F.array(F.lit("+")), F.slice(parts, F.col("pos") + 2, F.size(parts)))
    sib = seg.withColumn("open", open_)
    fam = sib.groupBy("host", "open", "pos").agg(F.sum("labelled").alias("fn"), F.sum("blocked").alias("fb")).filter("fn > 0")
    j = sib.join(fam, ["host", "open", "pos"])
    share, fshare = F.col("blocked") / F.col("labelled"), F.col("fb") / F.col("fn")
    far = F.abs(share - fshare) > MERGE_Z * F.sqrt(fshare * (1 - fshare) / F.col("labelled")) + 1e-9
    j = j.withColumn("far", (F.col("labelled") > 0) & far)
    split = j.filter("far").select("host", "open", "pos").distinct().withColumn("unlike", F.lit(True))
    j = j.join(split, ["host", "open", "pos"], "left")
    best = j.filter(~F.col("far") & ((F.col("labelled") > 0) | F.col("unlike").isNull())).groupBy("host", "template").agg(F.max(F.struct("fn", "fb")).alias("m"))
    s = leaf.join(best, ["host", "template"], "left").join(_branch_purity(leaf, prior), ["host", "template"], "left")
    n, b = F.coalesce(F.col("m.fn"), F.col("labelled")), F.coalesce(F.col("m.fb"), F.col("blocked"))
    purity = (b + PRIOR_WEIGHT * F.coalesce("above", F.lit(prior))) / (n + PRIOR_WEIGHT)
    bad = s.filter(purity > REJECT).select("host", "template")
    return t.join(bad, ["host", "template"]).select(F.col("host").alias("_host"), F.col("raw").alias("_raw"), F.lit(True).alias("_bad"))


def judge(pages: DataFrame, spark: SparkSession, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page row."""
    host, path = host_path(F.col("_url"))
    x = pages.select(pages[f"`{id_col}`"].cast("long").alias("page_id"), pages[f"`{url_col}`"].cast("string").alias("_url"))
    x = x.select("page_id", host.alias("host"), path.alias("path")).withColumn("segs", F.split("path", "/"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    raw = F.array_join(F.transform("segs", shape), "/")
    x = x.select("*", rule.alias("rule"), verdict.alias("ruled"), raw.alias("raw"))
    t = templates(x.withColumn("label", F.when(F.col("ruled").isNotNull(), (F.col("ruled") == "block").cast("int"))))
    bad = stored(rejected(t), spark, "urlbad")
    if bad.count() <= BROADCAST_TEMPLATES:
        bad = F.broadcast(bad)
    y = x.join(bad, (x["host"] == bad["_host"]) & (x["raw"] == bad["_raw"]), "left")
    own = F.when(F.col("_bad"), "block").otherwise("allow")
    return y.select("page_id", "host", "path", "rule", F.coalesce(F.col("ruled"), own).alias("verdict"), F.col("raw").alias("template"))
