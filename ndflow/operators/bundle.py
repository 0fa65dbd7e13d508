"""Bundle operators: size, split decision, greedy packing, chunks, chunk
documents, reassembly and statistics (B1-B10, P4, P5, P7, P8).

Input is a *bundle frame*: one row per bundle with

    bundle_id STRING, bundle_type STRING, timestamp STRING (raw text, nullable),
    entries ARRAY<STRING>  (each entry a compact JSON object, in order)

optionally ``rest STRING`` (a JSON object of the bundle's other fields: meta,
identifier, link, ...) and ``has_id BOOLEAN`` (false where ``bundle_id`` is only
the file and line of a bundle without id), plus any pass-through columns.  A bundle is one record of the input (one
NDJSON line), so all of B1-B7 are narrow: one row in, rows out, no shuffle.
Only reassembly (B8) and statistics (B9) group by bundle, and those groups are
bounded by the size of one input line.

The packing rule is the reference's: keep order, start a new chunk when the
current chunk is non-empty and ``current + entry + overhead > threshold``; an
entry with ``entry + overhead > threshold`` makes the bundle fail as
oversized.  It is evaluated by ``aggregate`` over the entry sizes carrying
only the break positions, then ``slice``: linear in entries, JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ndflow.functions.jsonfn import STRICT_JSON, ZERO_TIME, escape_growth, is_one_value, json_size, one_line, rfc3339_normalized, string_field

# Per-chunk allowance of the packing rule (bytes).
BUNDLE_OVERHEAD = 200

# Bundle types whose documents carry `total` (FHIR R4 rule).
TOTAL_TYPES = ("searchset", "history")


def _header(bundle_id: Column, btype: Column, ts: Column, total: Column | None = None) -> Column:
    """Canonical header with an empty entry list; keys sorted; NULLs dropped."""
    fields = [F.array().cast("array<string>").alias("entry"), bundle_id.alias("id"),
              F.lit("Bundle").alias("resourceType"), ts.alias("timestamp")]
    if total is not None:
        fields.append(total.alias("total"))
    fields.append(btype.alias("type"))
    return F.to_json(F.struct(*fields))


def _splice(header: Column, joined_entries: Column) -> Column:
    """Put the joined entries into the header's empty ``"entry":[]``."""
    return F.concat(F.lit('{"entry":['), joined_entries, F.lit("]"), F.substring(header, 12, 1 << 30))


def _own_id(df: DataFrame) -> Column:
    """The id the document itself carries."""
    return F.when(F.col("has_id"), F.col("bundle_id")) if "has_id" in df.columns else F.col("bundle_id")


def _rest_size(df: DataFrame, escape_html: bool) -> Column:
    """Bytes the other fields add: their object without braces, and a comma."""
    if "rest" not in df.columns:
        return F.lit(0)
    return F.when(F.length("rest") > 2, json_size(F.col("rest"), escape_html) - 1).otherwise(F.lit(0))


def _with_rest(df: DataFrame, doc: Column) -> Column:
    """The document with the bundle's other fields at its end."""
    if "rest" not in df.columns:
        return doc
    return F.when(F.length("rest") > 2, F.concat(F.substring(doc, 1, F.length(doc) - 1), F.lit(","), F.substring("rest", 2, F.length("rest")))).otherwise(doc)


def entry_sizes(entries: Column, escape_html: bool = True) -> Column:
    """B1 applied to every entry."""
    return F.transform(entries, lambda e: json_size(e, escape_html))


def bundle_document(df: DataFrame) -> Column:
    """The JSON document of a bundle frame row, every field of it."""
    h = _header(_own_id(df), F.col("bundle_type"), F.col("timestamp"))
    return _with_rest(df, _splice(h, F.array_join("entries", ",")))


def bundle_size(escape_html: bool = True) -> Column:
    """B1 for a whole bundle row without building the document text."""
    h = _header(F.col("bundle_id"), F.col("bundle_type"), F.col("timestamp"))
    hs = F.octet_length(h).cast("long") + (escape_growth(h) if escape_html else F.lit(0))
    sizes = entry_sizes(F.col("entries"), escape_html)
    n = F.size("entries")
    return hs + F.aggregate(sizes, F.lit(0).cast("long"), lambda a, s: a + s) + F.greatest(n - 1, F.lit(0))


def should_split(size: Column, threshold: int | Column) -> Column:
    """Strictly greater than the threshold."""
    return size > threshold


def pack_breaks(sizes: Column, threshold: int, overhead: int = BUNDLE_OVERHEAD) -> Column:
    """0-based start positions of the chunks (greedy, order kept)."""
    init = F.struct(F.lit(0).cast("long").alias("cur"), F.lit(0).alias("i"),
                    F.array(F.lit(0)).alias("br"))

    def step(acc, s):
        brk = (acc["i"] > 0) & (acc["cur"] + s + overhead > threshold)
        return F.struct(F.when(brk, s).otherwise(acc["cur"] + s).alias("cur"),
                        (acc["i"] + 1).alias("i"),
                        F.when(brk, F.concat(acc["br"], F.array(acc["i"]))).otherwise(acc["br"]).alias("br"))

    return F.aggregate(sizes, init, step, lambda acc: acc["br"])


def with_entry_sizes(df: DataFrame, escape_html: bool = True) -> DataFrame:
    """Add ``sizes`` (B1 per entry), ``entry_bytes`` (their sum) and
    ``max_entry`` unless the frame already carries them (a frame built by
    grouping entry rows computes them in the same aggregate, codegen'd)."""
    if {"sizes", "entry_bytes", "max_entry"} <= set(df.columns):
        return df
    sizes = entry_sizes(F.col("entries"), escape_html)
    x = df.select("*", sizes.alias("sizes"))
    return x.select("*", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b).alias("entry_bytes"),
                    F.array_max("sizes").alias("max_entry"))


def split_bundles(df: DataFrame, threshold: int, overhead: int = BUNDLE_OVERHEAD,
                  escape_html: bool = True) -> DataFrame:
    """B5 + P7: one row per bundle with the split plan.

    Adds ``original_size, was_split, total_chunks, breaks, sizes, status,
    error_resource_type, error_resource_id, error_size``.  A bundle within the
    budget is ``ok`` as it is, with or without id, type and entries (one chunk).
    A larger one is ``invalid`` (no type), ``empty`` (nothing to split),
    ``oversized`` (one entry alone exceeds the budget; reject-table row) or
    ``ok``.  The size counts every field of the bundle.
    The per-entry work (sizes, packing) is array functions on the bundle's
    own row: narrow, no shuffle.
    """
    # columns this function produces replace same-named pass-through columns
    # (e.g. the line ``status`` of a frame that came from ``parse_lines``)
    produced = {"original_size", "status", "breaks", "was_split", "total_chunks", "error_resource_type",
                "error_resource_id", "error_size"}
    d = with_entry_sizes(df.drop(*[c for c in df.columns if c in produced]), escape_html)
    d = d.withColumn("entries", F.coalesce("entries", F.array().cast("array<string>"))) if "entries" in d.columns else d
    h = _header(_own_id(d), F.col("bundle_type"), F.col("timestamp"))
    hs = F.octet_length(h).cast("long") + (escape_growth(h) if escape_html else F.lit(0))
    n = F.size("entries")
    size = hs + F.coalesce(F.col("entry_bytes"), F.lit(0)) + F.greatest(n - 1, F.lit(0)) + _rest_size(d, escape_html)
    d = d.select("*", size.alias("original_size"))
    split = F.col("original_size") > threshold
    # the first oversized entry is searched only when the largest one is over
    over_pos = F.array_position(F.transform("sizes", lambda x: x + overhead > threshold), True)
    over = F.when(split & (F.col("max_entry") + overhead > threshold), (over_pos - 1).cast("int"))
    d = d.select("*", over.alias("_over"))
    status = (F.when(~split, "ok")
              .when(F.col("bundle_id").isNull() | F.col("bundle_type").isNull(), "invalid")
              .when(n == 0, "empty")
              .when(F.col("_over").isNotNull(), "oversized")
              .otherwise("ok"))
    d = d.select("*", status.alias("status"))
    ok = F.col("status") == "ok"
    breaks = F.when(~ok, F.lit(None)).when(split, pack_breaks(F.col("sizes"), threshold, overhead)) \
        .otherwise(F.array(F.lit(0)))
    over_entry = F.try_parse_json(F.try_element_at("entries", F.col("_over") + 1))
    oversized = F.col("status") == "oversized"
    d = d.select("*", breaks.alias("breaks"), (ok & split).alias("was_split"),
                 F.when(oversized, F.coalesce(string_field(over_entry, "$.resource.resourceType"), F.lit("Unknown")))
                 .alias("error_resource_type"),
                 F.when(oversized, F.coalesce(string_field(over_entry, "$.resource.id"), F.lit("unknown")))
                 .alias("error_resource_id"),
                 F.when(oversized, F.try_element_at("sizes", F.col("_over") + 1)).alias("error_size"))
    return d.select("*", F.coalesce(F.size("breaks"), F.lit(0)).alias("total_chunks")).drop("_over")


def chunk_rows(split: DataFrame, escape_html: bool = True, keep_failed: bool = False) -> DataFrame:
    """One row per chunk of every ``ok`` bundle; with ``keep_failed`` also
    one row, without chunk values, of every bundle that has no chunks.

    Adds ``chunk_index, first_index, chunk_id, n_entries, chunk_entries,
    estimated_size``.  ``estimated_size`` follows the reference: it always
    counts ``timestamp`` (zero time when unset) and ``total`` (H11).
    """
    produced = {"chunk_index", "first_index", "n_entries", "chunk_entries", "chunk_id", "estimated_size"}
    all_ = split.drop(*[c for c in split.columns if c in produced])
    x = (all_.select("*", F.posexplode_outer("breaks").alias("chunk_index", "first_index")) if keep_failed
         else all_.filter(F.col("status") == "ok").select("*", F.posexplode("breaks").alias("chunk_index", "first_index")))
    nxt = F.try_element_at(F.col("breaks"), F.col("chunk_index") + 2)
    end = F.when(F.col("chunk_index") + 1 < F.col("total_chunks"), nxt).otherwise(F.size("entries"))  # 0 of an empty bundle
    x = x.select("*", (end - F.col("first_index")).cast("int").alias("n_entries"))  # NULL, as all below, without a chunk
    start = F.col("first_index") + 1
    chunk_id = F.concat(F.col("bundle_id"), F.lit("-chunk-"), F.col("chunk_index").cast("string"))
    x = x.select("*", F.slice("entries", start, F.col("n_entries")).alias("chunk_entries"),
                 F.aggregate(F.slice("sizes", start, F.col("n_entries")), F.lit(0).cast("long"),
                             lambda a, b: a + b).alias("_chunk_bytes"),
                 chunk_id.alias("chunk_id"))
    ts_fmt = F.coalesce(rfc3339_normalized(F.col("timestamp")), F.lit(ZERO_TIME))
    h = _header(F.col("chunk_id"), F.col("bundle_type"), ts_fmt, F.col("n_entries"))
    hs = F.octet_length(h).cast("long") + (escape_growth(h) if escape_html else F.lit(0))
    est = F.when(F.col("chunk_index").isNotNull(), hs + F.coalesce("_chunk_bytes", F.lit(0)) + F.greatest(F.col("n_entries") - 1, F.lit(0)))
    return x.select("*", est.alias("estimated_size")).drop("_chunk_bytes")


def chunk_document(chunks: DataFrame) -> Column:
    """The chunk as a Bundle document; ``timestamp`` only when it parsed,
    ``total`` only for searchset/history; the bundle's other fields on each."""
    ts = rfc3339_normalized(F.col("timestamp"))
    total = F.when(F.col("bundle_type").isin(*TOTAL_TYPES), F.col("n_entries"))
    h = _header(F.col("chunk_id"), F.col("bundle_type"), ts, total)
    return _with_rest(chunks, _splice(h, F.array_join("chunk_entries", ",")))


def reassemble(chunks: DataFrame, keep_columns: tuple[str, ...] = ()) -> DataFrame:
    """B8 + A6: chunks (any order) back to one document per bundle.

    Entries are concatenated by ``chunk_index``; type is the original's,
    ``timestamp`` kept if it parsed, ``total`` only for searchset/history.
    The original bundle id is restored (H9), and with it every other field
    (``rest``).  One shuffle by bundle id; each chunk travels as one pre-joined
    string, so the group holds ``total_chunks`` values.
    """
    asked = keep_columns
    keep_columns = tuple(dict.fromkeys([*keep_columns, *(c for c in ("rest", "has_id") if c in chunks.columns)]))
    per_chunk = chunks.select(
        "bundle_id", "bundle_type", "timestamp", "chunk_index", "n_entries", *keep_columns,
        F.array_join("chunk_entries", ",").alias("_joined"))
    from ndflow.plans.seq import by_key
    g = (by_key(per_chunk, "bundle_id").groupBy("bundle_id")
         .agg(F.first("bundle_type").alias("bundle_type"), F.first("timestamp").alias("timestamp"),
              *[F.first(c).alias(c) for c in keep_columns],
              F.sort_array(F.collect_list(F.struct("chunk_index", "_joined"))).alias("_parts"),
              F.sum("n_entries").cast("int").alias("entry_count"),
              F.count(F.lit(1)).cast("int").alias("n_chunks")))
    ts = rfc3339_normalized(F.col("timestamp"))
    total = F.when(F.col("bundle_type").isin(*TOTAL_TYPES), F.col("entry_count"))
    h = _header(_own_id(g), F.col("bundle_type"), ts, total)
    joined = F.array_join(F.col("_parts._joined"), ",")
    return g.select("bundle_id", "bundle_type", *asked, "entry_count",
                    (F.col("n_chunks") > 1).alias("was_reassembled"),
                    _with_rest(g, _splice(h, joined)).alias("document"))


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Per bundle: entries, chunks, smallest/largest/integer-average
    estimated chunk size.  Bundles without chunks (rows that ``chunk_rows``
    keeps with ``keep_failed``) have zeros."""
    def zero(c):
        return F.coalesce(c, F.lit(0))
    g = chunks.groupBy("bundle_id").agg(
        F.first("original_size").alias("original_size"), zero(F.sum("n_entries")).cast("long").alias("original_entries"),
        F.count("chunk_index").alias("chunks_created"), zero(F.min("estimated_size")).alias("smallest_chunk_size"),
        zero(F.max("estimated_size")).alias("largest_chunk_size"), zero(F.sum("estimated_size")).alias("_total"))
    return g.withColumn("average_chunk_size", F.expr("_total div greatest(chunks_created, 1)")).drop("_total")


def route(resource_type: Column, size: Column, threshold: int) -> Column:
    """Bundle under budget goes direct, over budget is split, anything
    else is a single resource."""
    return (F.when(resource_type == "Bundle", F.when(size > threshold, "bundle_split").otherwise("bundle_direct"))
            .otherwise("single_resource"))


def oversized_resources(res: DataFrame, threshold: int, escape_html: bool = True) -> DataFrame:
    """P5: non-Bundle resources whose canonical size is over the threshold
    (strict).  Expects ``value`` (JSON text) and optional ``resource_type``/
    ``resource_id`` (NULL when absent or not a string)."""
    size = json_size(one_line(F.col("value")), escape_html)
    return (res.withColumn("size", size)
            .filter((F.coalesce(F.col("resource_type"), F.lit("")) != "Bundle") & (F.col("size") > threshold))
            .withColumn("error_resource_type", F.coalesce("resource_type", F.lit("Unknown")))
            .withColumn("error_resource_id", F.coalesce("resource_id", F.lit("unknown")))
            .withColumn("threshold", F.lit(threshold)))


# --------------------------------------------------------------------------
# Bundle lines (NDJSON) -> bundle frame
# --------------------------------------------------------------------------

BUNDLE_LINE_SCHEMA = "resourceType string, id string, type string, timestamp string, entry array<string>"


#: Fields of a bundle that have columns of their own; ``total`` is made anew.
BUNDLE_FIELDS = ("resourceType", "id", "type", "timestamp", "entry", "total")


def bundles_from_lines(lines: DataFrame, value_col: str = "value", canonicalize: bool = True) -> DataFrame:
    """Parse Bundle lines into a bundle frame (P7 fields checked by
    ``bundle_structure``).  ``from_json`` keeps each entry's JSON text and
    handles lines beyond the VARIANT size limit; with ``canonicalize`` each
    entry is re-serialised compact with sorted keys (what the reference
    measures), one entry at a time.  Other fields travel in ``rest``; a bundle
    without id takes its file and line as ``bundle_id`` (``has_id`` false)."""
    p = F.from_json(F.col(value_col), BUNDLE_LINE_SCHEMA, STRICT_JSON)
    fields = F.from_json(F.col(value_col), "map<string, variant>", STRICT_JSON)
    rest = F.to_json(F.map_filter(fields, lambda k, v: ~k.isin(*BUNDLE_FIELDS)))
    x = lines.select("*", p.alias("_b"), rest.alias("_rest"))
    entries = F.col("_b.entry")
    if canonicalize:
        entries = F.transform(entries, one_line)
    place = [F.col(c).cast("string") for c in ("file_name", "line_no") if c in lines.columns]
    fallback = F.concat_ws(":", *place) if place else F.lit(None).cast("string")
    return x.select(
        *[c for c in lines.columns if c not in ("bundle_id", "bundle_type", "timestamp", "entries", "rest", "has_id")],
        F.coalesce(F.col("_b.id"), fallback).alias("bundle_id"), F.col("_b.type").alias("bundle_type"),
        F.col("_b.timestamp").alias("timestamp"), entries.alias("entries"),
        F.coalesce("_rest", F.lit("{}")).alias("rest"), F.col("_b.id").isNotNull().alias("has_id"))


# Bundle structure rules, in the order they are checked.
STRUCTURE_RULES = {
    "json": "invalid JSON",
    "id": "bundle.id must be present and a string",
    "type": "bundle.type must be present and a string",
    "entry": "bundle.entry must be an array",
    "entry_object": "bundle.entry[i] must be an object",
}


def bundle_structure(value: Column) -> Column:
    """First failing structure rule of a Bundle document, NULL if fine.
    Read field by field, so the document's size does not matter; an entry
    beyond the VARIANT limit is told by its first character."""
    h = F.from_json(value, "id variant, type variant", STRICT_JSON)
    arr = F.from_json(value, "entry array<variant>", STRICT_JSON)["entry"]
    raw = F.from_json(value, "entry array<string>", STRICT_JSON)["entry"]
    def is_string(v):
        return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))
    is_object = F.forall(F.arrays_zip(arr.alias("v"), raw.alias("t")), lambda x: F.coalesce(
        F.schema_of_variant(x["v"]).startswith("OBJECT"), F.coalesce(x["t"].startswith("{"), F.lit(False))))
    return (F.when(~is_one_value(value), STRUCTURE_RULES["json"])
            .when(~is_string(h["id"]), STRUCTURE_RULES["id"])
            .when(~is_string(h["type"]), STRUCTURE_RULES["type"])
            .when(raw.isNull(), STRUCTURE_RULES["entry"])
            .when(~is_object, STRUCTURE_RULES["entry_object"]))
