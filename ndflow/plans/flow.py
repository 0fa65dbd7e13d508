"""End-to-end flow (E1): import -> quarantine -> route -> size guard -> split
-> de-identify -> validate -> NDJSON / CSV / Parquet and ledger rows, as one
composition of DataFrame operators.

``plan_flow`` is lazy (one DataFrame per output).  ``run_flow`` reads the text
and de-identifies it once: every line with its outcome goes into the table
``records``, and all sinks are made from that table's columns.

Output is kept by file version.  A file is its path below the source
(``rel_path``), a version its size and time.  Every run that finds new or
changed files writes one *generation*, a folder ``generation=n`` in each sink
(NDJSON: in the folder of each output file);
the ledger, written last, says which generation of a file counts.
``read_output`` shows exactly those rows at any time, during a run too; at its
end a run removes the rows of older versions from all sinks, so plain readers
see the same.  What a run that broke off left behind is cleared by the next.

Bundles over the budget are packed (B4) for the size rule and the ledger's
chunk count.  De-identifying entry by entry gives the same document whether a
bundle is cut into chunks or not (D8, query ``split_metamorphic``), so the
document itself stays one row and is not shuffled.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ndflow.functions.jsonfn import STRICT_JSON, json_size, one_line
from ndflow.operators.bundle import BUNDLE_OVERHEAD, entry_sizes, pack_breaks, route
from ndflow.operators.deid import Retry
from ndflow.operators.deid_doc import deidentify_documents, deidentify_rows
from ndflow.operators.flatten import flatten_tables, infer_schemas, nested_rows
from ndflow.operators.links import dangling_links
from ndflow.session import scratch_path
from ndflow.sinks.files import output_path, stored, write_csv, write_ndjson, write_parquet
from ndflow.sources.ndjson import (NDJSON_GLOB, SPLIT_COLUMNS, file_versions, list_files, number_splits, parse_lines, quarantine, scan_splits,
                                   status_message)

#: Columns of a line that identify its file's version, where the scan has them.
FILE_KEYS = ("rel_path", "file_name", "file_size", "file_mtime")
VERSION = ("file_size", "file_mtime")
#: Paths every document of a type should have (``*``: of any type).
REQUIRED = {"*": ["id"]}


def _routed(ok: DataFrame, threshold: int) -> DataFrame:
    """Canonical size, route and, for bundles, entry sizes and packing.

    ``over_*`` name what exceeds the budget: a resource, or the first entry of
    a large bundle that no chunk can hold."""
    x = ok.withColumn("value", one_line(F.col("value"))).withColumn("size", json_size(F.col("value")))
    x = x.withColumn("route", route(F.col("resource_type"), F.col("size"), threshold))
    bundle = F.col("route").startswith("bundle")
    entries = F.transform(F.from_json("value", "entry array<string>", STRICT_JSON)["entry"], one_line)
    x = x.withColumn("_e", F.when(bundle, F.coalesce(entries, F.array().cast("array<string>"))))
    x = x.withColumn("_s", entry_sizes(F.col("_e")))
    split = F.col("route") == "bundle_split"
    at = F.array_position(F.transform("_s", lambda s: s + BUNDLE_OVERHEAD > threshold), True).cast("int")
    x = x.withColumn("_at", F.when(split & (at > 0), at))
    e = F.try_element_at("_e", F.col("_at"))
    single_over = (F.col("route") == "single_resource") & (F.col("size") > threshold)
    chunks = F.when(split & F.col("_at").isNull() & (F.size("_e") > 0), F.size(pack_breaks(F.col("_s"), threshold)))
    return x.select(
        *ok.columns, "size", "route", F.coalesce(F.size("_e"), F.lit(0)).alias("n_entries"),
        F.coalesce(chunks, F.lit(1)).alias("total_chunks"), (F.col("_at").isNotNull() | single_over).alias("is_over"),
        F.when(F.col("_at").isNotNull(), F.coalesce(F.get_json_object(e, "$.resource.resourceType"), F.lit("Unknown")))
        .otherwise(F.col("resource_type")).alias("over_type"),
        F.when(F.col("_at").isNotNull(), F.coalesce(F.get_json_object(e, "$.resource.id"), F.lit("unknown")))
        .otherwise(F.col("resource_id")).alias("over_id"),
        F.when(F.col("_at").isNotNull(), F.try_element_at("_s", F.col("_at"))).otherwise(F.col("size")).alias("over_size"))


def plan_flow(lines: DataFrame, secret: str, threshold: int, rules: dict[str, dict[str, str]] | None = None) -> dict[str, DataFrame]:
    """Lazy outputs: ``parsed``, ``routed``, ``rejects`` (lines of white space
    are skipped, not rejected), ``oversized`` and ``deidentified``."""
    parsed = parse_lines(lines)
    routed = _routed(parsed.filter(F.col("status") == "ok"), threshold)
    accepted = routed.filter(~F.col("is_over")).select(
        *[c for c in FILE_KEYS if c in lines.columns], "line_no", "resource_type", "route", "n_entries", "total_chunks", "size", "value")
    return {"parsed": parsed, "rejects": quarantine(parsed.filter(~F.col("blank_trimmed"))), "routed": routed,
            "oversized": routed.filter(F.col("is_over")), "deidentified": deidentify_documents(accepted, secret, rules=rules)}


def _stages(status: Column, blank: Column, is_over: Column, route_: Column) -> dict[str, Column]:
    ok = status == "ok"
    fine = ok & ~F.coalesce(is_over, F.lit(False))
    return {"lines": F.lit(True), "blank": blank, "rejected": ~blank & (status != "ok"), "oversized": ok & F.coalesce(is_over, F.lit(False)),
            "accepted": fine, "bundle_split": fine & (route_ == "bundle_split"), "bundle_direct": fine & (route_ == "bundle_direct")}


def _staged(plan: dict[str, DataFrame], threshold: int) -> tuple[DataFrame, dict[str, Column]]:
    parsed = plan["parsed"]
    sized = parsed.withColumn("_b", F.octet_length("value").cast("long") + 1)
    x = _routed(sized.withColumn("value", F.when(F.col("status") == "ok", F.col("value")).otherwise(F.lit("{}"))), threshold)
    return x, _stages(F.col("status"), F.col("blank_trimmed"), F.col("is_over"), F.col("route"))


def stage_counts(plan: dict[str, DataFrame], threshold: int) -> DataFrame:
    """Rows and bytes per stage from one aggregate over the parsed lines:
    (stage, n, bytes)."""
    p, stages = _staged(plan, threshold)
    g = p.agg(*[F.count_if(c).alias(f"n_{k}") for k, c in stages.items()],
              *[F.sum(F.when(c, F.col("_b")).otherwise(0)).cast("long").alias(f"b_{k}") for k, c in stages.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("stage"), F.col(f"n_{k}").alias("n"), F.col(f"b_{k}").alias("bytes"))
                     for k in stages])
    return g.select(F.inline(rows))


# ---- one pass: every line with its outcome

#: What becomes of a line, in the order of the steps.
STAGES = ("blank", "rejected", "oversized", "failed", "accepted")


def record_lines(lines: DataFrame, secret: str, threshold: int, rules: dict[str, dict[str, str]] | None = None,
                 external: Callable[[dict], dict] | None = None, required: dict[str, list[str]] | None = None, retry: Retry | None = None) -> DataFrame:
    """Every line with its ``stage``; accepted ones with the de-identified
    document in ``value``, its resources, links and missing fields; rejected ones
    with their own text in ``raw``.  A document that could not be de-identified
    is ``failed`` (D5): its error, no text."""
    lines = lines if "rel_path" in lines.columns else lines.withColumn("rel_path", F.col("file_name"))
    parsed = parse_lines(lines)
    rejected = ~F.col("status").isin("ok", "blank") & ~F.col("blank_trimmed")
    x = parsed.withColumn("bytes", F.octet_length("value").cast("long") + 1).withColumn("raw", F.when(rejected, F.col("value")))
    x = _routed(x.withColumn("value", F.when(F.col("status") == "ok", F.col("value")).otherwise(F.lit("{}"))), threshold)
    ok = F.col("status") == "ok"
    x = x.withColumn("accepted", ok & ~F.coalesce("is_over", F.lit(False)))
    x = deidentify_rows(x, secret, "value", rules, external, REQUIRED if required is None else required, "accepted", retry)
    stage = (F.when(F.col("blank_trimmed") | (F.col("status") == "blank"), "blank").when(~ok, "rejected").when(~F.col("accepted"), "oversized")
             .when(~F.col("deid_ok"), "failed").otherwise("accepted"))
    kind = F.when(stage == "rejected", F.col("status")).when(stage == "failed", F.concat(F.lit("deidentify_"), F.col("deid_error_type")))
    return x.withColumn("stage", stage).withColumn("error_kind", kind).withColumn(
        "error", F.when(stage == "rejected", status_message(F.col("status"))).otherwise(F.col("deid_error"))).drop(
        "status", "parsed", "blank_trimmed", "accepted", "is_over", "deid_ok", "deid_error", "deid_error_type")


def _numbered(records: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` of ``records`` with ``line_no``: as given by the lines, or from
    the split counts of ``records``, so the text is not read for it."""
    return rows if "line_no" in rows.columns else number_splits(rows, records)


def file_ledger(records: DataFrame, versions: DataFrame) -> DataFrame:
    """One ledger row per file version: lines per stage and chunks written.
    Files without a line are there too, as ``empty``."""
    stage, ok = F.col("stage"), F.col("stage") == "accepted"
    g = records.groupBy("rel_path").agg(
        F.count(F.lit(1)).alias("lines"), *[F.count_if(stage == s).alias(s) for s in STAGES], F.count_if(ok & (F.col("route") == "bundle_split")).alias("bundle_split"),
        F.count_if(ok & (F.col("route") == "bundle_direct")).alias("bundle_direct"), F.sum(F.when(ok, F.col("total_chunks"))).alias("chunks"))
    counts = [c for c in g.columns if c != "rel_path"]
    x = versions.join(g, "rel_path", "left").select(*versions.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
    bad = F.col("oversized") + F.col("rejected") + F.col("failed")
    status = F.when(F.col("accepted") + bad == 0, "empty").when(bad > 0, "completed_with_rejects").otherwise("completed")
    return x.select("*", F.lit("dimp").alias("step"), status.alias("status"))


# ---- files, generations, sinks

def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def _folders(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def _ledger(spark: SparkSession, out_dir: str) -> DataFrame | None:
    path = f"{out_dir}/ledger"
    return spark.read.option("mergeSchema", True).parquet(path) if any(f.startswith("generation=") for f in _folders(spark, path)) else None


def current_versions(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The ledger row of every file's latest version; None before any run."""
    led = _ledger(spark, out_dir)
    if led is None:
        return None
    last = F.max("generation").over(Window.partitionBy("rel_path"))
    return led.withColumn("_g", last).filter("generation = _g").drop("_g")


def read_output(spark: SparkSession, out_dir: str, sink: str) -> DataFrame:
    """The rows of a sink that belong to the latest version of their file; what
    a run in progress or a broken one wrote is not among them."""
    path, now = f"{out_dir}/{sink}", current_versions(spark, out_dir)
    if sink.startswith("csv"):  # columns may differ between generations
        df = None
        for f in _folders(spark, path):
            part = spark.read.option("header", True).csv(f"{path}/{f}").withColumn("generation", F.lit(int(f[11:])))
            df = part if df is None else df.unionByName(part, allowMissingColumns=True)
    else:
        df = spark.read.option("mergeSchema", True).parquet(path)
    return df.join(now.select("rel_path", "generation"), ["rel_path", "generation"], "left_semi") if now is not None else df.limit(0)


def line_versions(lines: DataFrame) -> DataFrame:
    """The file versions of a frame of lines (size and time where it has them)."""
    return lines.groupBy("rel_path").agg(F.first("file_name").alias("file_name"), *[F.max(c).alias(c) for c in VERSION if c in lines.columns])


def pending_versions(versions: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """The file versions that no finished run has processed: by path, and
    size and time where both sides have them."""
    if ledger is None:
        return versions
    keys = ["rel_path", *[c for c in VERSION if c in versions.columns and c in ledger.columns]]
    done = ledger.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = versions["rel_path"] == done["_rel_path"]
    for k in keys[1:]:
        same &= versions[k].eqNullSafe(done[f"_{k}"])
    return versions.join(done, same, "left_anti")


def pending_lines(lines: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Lines of files still to process.  A directory is better given to
    ``run_directory``, which does not read the other files."""
    if ledger is None:
        return lines
    todo = pending_versions(line_versions(lines), ledger).select("rel_path")
    return lines.join(F.broadcast(todo) if _small(todo) else todo, "rel_path", "left_semi")


def _small(df: DataFrame, limit: int = 100_000) -> bool:
    return df.limit(limit + 1).count() <= limit


def run_flow(lines: DataFrame, secret: str, threshold: int, out_dir: str, resume: bool = True, rules: dict[str, dict[str, str]] | None = None,
             external: Callable[[dict], dict] | None = None, required: dict[str, list[str]] | None = None, retry: Retry | None = None,
             versions: DataFrame | None = None, flat_types: tuple[str, ...] | None = None) -> dict[str, str]:
    """Process the files of ``lines`` that are new or changed and write every
    sink; returns the sinks' paths.

    The text is read and de-identified once, into ``records``; the sinks, the
    ledger and the validation come from that table.  The ledger is written
    after all other sinks: a file counts as done only when all its output is
    there.  Validation (``missing``, ``dangling``) is made anew over all current
    files, as one file may hold what another one refers to.

    ``versions`` lists the files of ``lines`` (``file_versions``); without it
    they are taken from the lines.  ``flat_types`` names the types that get flat
    tables (default: all)."""
    spark = lines.sparkSession
    lines = lines if "rel_path" in lines.columns else lines.withColumn("rel_path", F.col("file_name"))
    led, done = _ledger(spark, out_dir), current_versions(spark, out_dir)
    gen = 1 + (0 if led is None else led.agg(F.coalesce(F.max("generation"), F.lit(0))).first()[0])
    _clear_unfinished(spark, out_dir, gen)
    if led is not None:
        _remove_old(spark, out_dir)  # where a run broke off before its end
    at = lambda sink: f"{out_dir}/{sink}/generation={gen}"
    if resume and versions is None:
        lines = pending_lines(lines, done)

    write_parquet(record_lines(lines, secret, threshold, rules, external, required, retry), at("records"))
    rec = spark.read.parquet(at("records"))
    versions = line_versions(rec) if versions is None else versions
    write_parquet(versions, at("versions"))  # the ledger changes below
    versions = spark.read.parquet(at("versions"))
    if versions.limit(1).count():
        _write_sinks(spark, rec, at, flat_types)
        _validate(spark, out_dir, rec, versions, done)
        write_parquet(file_ledger(rec, versions).withColumn("completed_at", F.current_timestamp()), at("ledger"))
        if done is not None:
            _remove_old(spark, out_dir)
    else:
        _delete(spark, at("records"))
        _delete(spark, at("versions"))
    sinks = {k: f"{out_dir}/{k}" for k in ("ndjson", "rejects", "oversized", "csv", "parquet", "records", "missing", "dangling", "ledger")}
    return sinks | {f: f"{out_dir}/{f}" for f in _folders(spark, out_dir)}


def run_directory(spark: SparkSession, src: str, secret: str, threshold: int, out_dir: str, glob: str = NDJSON_GLOB, **options) -> dict[str, str]:
    """``run_flow`` over a directory: the listing decides which files are new or
    changed, and only those are read."""
    listing = scratch_path(spark, f"listing-{uuid.uuid4().hex}")  # one listing for the whole run
    write_parquet(list_files(spark, src, glob), listing)
    files = spark.read.parquet(listing)
    todo = pending_versions(file_versions(files), current_versions(spark, out_dir))
    own = files.filter("file_size > 0").join(todo.select(F.col("rel_path").alias("source_path")), "source_path", "left_semi")
    paths = [re.sub(r"([\\{}\[\]*?])", r"\\\1", r.file_path) for r in own.select("file_path").toLocalIterator()]  # Spark's reader holds this list on the driver too
    lines = scan_splits(spark, paths or src, glob="*", root=src) if paths else scan_splits(spark, src, glob=glob).limit(0)
    return run_flow(lines, secret, threshold, out_dir, versions=todo, **options)


def _clear_unfinished(spark: SparkSession, out_dir: str, gen: int) -> None:
    """Remove what a run left that ended before its ledger (``records`` is the
    first table a run writes)."""
    if not any(int(f[11:]) >= gen for f in _folders(spark, f"{out_dir}/records") if f.startswith("generation=")):
        return
    p, fs = _fs(spark, f"{out_dir}/ndjson/*/generation=*")
    for s in fs.globStatus(p) or []:
        if int(s.getPath().getName()[11:]) >= gen:
            fs.delete(s.getPath(), True)
    for sink in _folders(spark, out_dir):
        for f in _folders(spark, f"{out_dir}/{sink}"):
            if f.startswith("generation=") and int(f[11:]) >= gen:
                _delete(spark, f"{out_dir}/{sink}/{f}")


#: Sinks written at the same time; most are small next to ``records``.
WRITERS = 4


def _write_sinks(spark: SparkSession, rec: DataFrame, at: Callable[[str], str], flat_types: tuple[str, ...] | None = None) -> None:
    good = rec.filter("stage = 'accepted'")
    place, keep = _place(rec), ("rel_path", "file_name", "line_no")

    def ndjson():
        out, gen = at("ndjson").split("/generation=")
        named = good.select("value", output_path(F.col("rel_path")).alias("output_file"), F.lit(int(gen)).alias("generation"))
        write_ndjson(named, out, partition_col=("output_file", "generation"))

    def rejects():
        bad = rec.filter("stage in ('rejected', 'failed')")
        write_parquet(_numbered(rec, bad.select("rel_path", "file_name", *place, "error_kind", "error", F.col("raw").alias("value"))), at("rejects"))

    def oversized():
        over = rec.filter("stage = 'oversized'").select("rel_path", "file_name", *place, "resource_type", "resource_id", "size", "over_type", "over_id", "over_size")
        write_parquet(_numbered(rec, over), at("oversized"))

    def index():
        x = _numbered(rec, good.select("rel_path", "file_name", *place, "resource_type", F.get_json_object("value", "$.id").alias("id"), "route", "n_entries"))
        write_parquet(x, at("parquet"))
        write_csv(spark.read.schema(x.schema).parquet(at("parquet")), at("csv"))

    def tables(kind: str, schema: str):
        rows = _numbered(rec, nested_rows(good, kind, schema, ("rel_path", "file_name", *place))).select(*keep, "_r")
        write_parquet(rows, at(f"nested_{kind}"))
        rows = spark.read.schema(rows.schema).parquet(at(f"nested_{kind}"))
        for name, flat in flatten_tables(rows, kind, keep).items():
            write_parquet(flat, at(f"parquet_{name}"))
            write_csv(flat, at(f"csv_{name}"))

    wanted = good if flat_types is None else good.filter(F.col("resource_type").isin(*flat_types))
    with ThreadPoolExecutor(WRITERS) as pool:
        jobs = [pool.submit(f) for f in (ndjson, rejects, oversized, index)]
        jobs += [pool.submit(tables, kind, schema) for kind, schema in sorted(infer_schemas(wanted).items())]
        for j in jobs:
            j.result()


def _place(rec: DataFrame) -> list[str]:
    """Columns that say where a line stands."""
    return ["line_no"] if "line_no" in rec.columns else ["file_path", *SPLIT_COLUMNS]


def _validate(spark: SparkSession, out_dir: str, rec: DataFrame, versions: DataFrame, done: DataFrame | None) -> None:
    """The validate step over all current files: links that lead nowhere
    and missing fields by type (P11).  Reads the small columns of ``records``."""
    cols = ["rel_path", "resource_type", "resource_id", "resources", "refs", "missing"]
    x = rec.filter("stage = 'accepted'").select(*cols)
    if done is not None:
        old = spark.read.option("mergeSchema", True).parquet(f"{out_dir}/records").filter("stage = 'accepted'")
        kept = done.select("rel_path", "generation").join(versions.select("rel_path"), "rel_path", "left_anti")
        x = x.unionByName(old.join(kept, ["rel_path", "generation"], "left_semi").select(*cols))
    write_parquet(dangling_links(x, ("rel_path",)), f"{out_dir}/dangling")
    n = x.groupBy("resource_type").agg(F.count(F.lit(1)).alias("n_rows"))
    m = x.select("resource_type", F.explode("missing").alias("field")).groupBy("resource_type", "field").agg(F.count(F.lit(1)).alias("n_missing"))
    write_parquet(m.join(n, "resource_type"), f"{out_dir}/missing")


def _remove_old(spark: SparkSession, out_dir: str) -> None:
    """Remove the rows of replaced file versions: their NDJSON folders are
    deleted, the tables' generations that hold some are written again without
    them (Spark's dynamic overwrite), and the ledger last."""
    led = _ledger(spark, out_dir)
    last = F.max("generation").over(Window.partitionBy("rel_path"))
    old = led.select("rel_path", "generation", last.alias("_last")).filter("generation < _last").drop("_last")
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    touched = set()
    for r in old.withColumn("path", output_path(F.col("rel_path"))).toLocalIterator():  # changed files only
        touched.add(r.generation)
        _delete(spark, f"{out_dir}/ndjson/output_file={escape(r.path)}/generation={r.generation}")
    if not touched:
        return
    rel = stored(old, "old-versions")  # the ledger changes below
    sinks = [s for s in _folders(spark, out_dir) if s not in ("ndjson", "missing", "dangling", "ledger")]

    def clean(sink: str) -> None:
        for g in sorted(touched):  # changed files may share few generations
            path = f"{out_dir}/{sink}/generation={g}"
            if not _exists(spark, path):
                continue
            csv = sink.startswith("csv")
            df = spark.read.option("header", True).csv(path) if csv else spark.read.parquet(path)
            if "rel_path" not in df.columns:  # an empty CSV table has no header
                continue
            gone = rel.filter(F.col("generation") == g).select("rel_path")
            n = df.select("rel_path", F.lit(1).alias("_n")).join(gone.withColumn("_gone", F.lit(1)), "rel_path", "left").agg(F.count("_n"), F.count("_gone")).first()
            if n[1] == n[0]:
                _delete(spark, path)
            elif n[1]:
                kept = df.join(gone, "rel_path", "left_anti").select(*df.columns, F.lit(g).alias("generation"))
                (write_csv if csv else write_parquet)(kept, f"{out_dir}/{sink}", ["generation"])

    with ThreadPoolExecutor(WRITERS) as pool:
        list(pool.map(clean, sinks))
    clean("ledger")


def import_directory(spark, src: str, dest: str, source_step: str = "local_import", glob: str = NDJSON_GLOB) -> DataFrame:
    """Check the source (S5), land the lines of every ``*.ndjson`` under it
    unchanged in ``dest`` (one folder per input file, by relative path), and
    return one manifest row per file, empty files included: relative path,
    name, type from the name, the file's own size, non-blank lines,
    ``created_at``.

    Files are told apart by their path below ``src``; ``read_ndjson`` of
    ``dest`` gives each line its original file again."""
    from ndflow.sources.ndjson import check_source, is_blank_trimmed, list_files, name_to_type, read_ndjson

    err = check_source(spark, src) if glob == NDJSON_GLOB else None
    if err:
        raise ValueError(err)
    lines = read_ndjson(spark, src, line_numbers=False, glob=glob)
    lines.select("value", F.col("rel_path").alias("source_file")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("source_file").text(dest)
    counts = lines.groupBy("rel_path").agg(F.count_if(~is_blank_trimmed(F.col("value"))).cast("int").alias("line_count"))
    files = list_files(spark, src, glob)
    m = files.join(counts, "rel_path", "left")
    return m.select("file_name", F.concat(F.lit(source_step + "/"), F.col("rel_path")).alias("file_path"),
                    name_to_type(F.col("file_name")).alias("resource_type"), "file_size", F.lit(source_step).alias("source_step"),
                    F.coalesce("line_count", F.lit(0)).alias("line_count"), F.current_timestamp().alias("created_at"))
