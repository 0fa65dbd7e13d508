"""NDJSON record files: discovery, scan with provenance, line numbers and
line classification (S1-S5, S9, P1-P3, P10).

``read_ndjson`` is a splittable text scan; every other function is a column
expression or a key-grouped aggregate on its output, so a 100 TB directory is
read once, in parallel, with 128 MB splits.

Line numbers need the order of lines inside a file.  A file may span many
splits, so instead of a window over the whole file (one task per file) each
split's line count is aggregated into a small table (one row per split), the
split offsets are a prefix sum over that table, and a line's number is its
split offset plus its index inside the split.  Numbers are made on demand:
a scan without them reads once and shuffles nothing.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ndflow.functions.jsonfn import checked_header, header_status

# Case-insensitive match of the record file extension.
NDJSON_GLOB = "*.[nN][dD][jJ][sS][oO][nN]"
WHITESPACE = " \t\r\n"


def check_source(spark: SparkSession, path: str) -> str | None:
    """Why a path cannot be imported, or None when it can.

    Uses the Hadoop file system of the path (local, HDFS, object stores) and
    a lazy recursive listing that stops at the first ``.ndjson`` file, so a
    directory with millions of files is not listed in full on the driver."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return f"source does not exist: {path}"
    if not fs.getFileStatus(hpath).isDirectory():
        low = path.lower()
        if low.endswith((".crtdl", ".json")):
            return "source is a file; cohort query files are submitted, not imported"
        if low.endswith(".ndjson"):
            return "source is a single file; give the directory that holds it"
        return "source must be a directory"
    files = fs.listFiles(hpath, True)
    while files.hasNext():
        if files.next().getPath().getName().lower().endswith(".ndjson"):
            return None
    return "directory holds no .ndjson files"


def read_ndjson(spark: SparkSession, path: str | list[str], recursive: bool = True, glob: str = NDJSON_GLOB,
                line_numbers: bool = True, files: Column | None = None, broadcast_limit_bytes: int = 64 << 20) -> DataFrame:
    """Every line of every ``*.ndjson`` file (any letter case) under
    ``path``, with ``file_path, rel_path, file_name, file_size, file_mtime`` and,
    unless ``line_numbers`` is false, ``line_no``.

    ``rel_path`` (the path below ``path``) tells files of equal name apart; for a
    directory written by ``import_directory`` it and ``file_name`` are those of
    the original file.  ``files`` is a condition on ``_metadata`` fields, e.g.
    ``F.col("_metadata.file_modification_time") > t``: it is applied to the
    listing, below everything else, so other files are not read.

    Numbering reads the text twice (once for the lines per split) and never
    shuffles it: the table of splits is broadcast, and where it could pass
    ``broadcast_limit_bytes`` the files are taken in as many groups as keep every
    group's table below it.  Where only some lines need numbers (rejects), scan
    with ``line_numbers=False`` and give those lines to ``add_line_numbers``."""
    x = scan_splits(spark, path, recursive, glob, files)
    if not line_numbers:
        return x.drop(*SPLIT_COLUMNS)
    size = split_count_bound(x) * SPLIT_ROW_BYTES
    groups = 1 if size <= broadcast_limit_bytes else min(max(1, file_count(x)), -(-size // max(broadcast_limit_bytes, 1)))
    out = None
    for g in range(groups):
        if groups > 1:
            own = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(groups)) == g  # a condition on the listing: each file is read in one group
            x = scan_splits(spark, path, recursive, glob, own if files is None else files & own)
        part = _with_offsets(x, F.broadcast(split_offsets(x)))
        out = part if out is None else out.unionAll(part)
    return out


#: Where a line stands: start of its file split, and a number that grows inside
#: the split.
SPLIT_COLUMNS = ("split_start", "split_pos")
# Bytes one split-offset row takes in a broadcast relation (path + 3 longs),
# a generous estimate.
SPLIT_ROW_BYTES = 512


def scan_splits(spark: SparkSession, path: str | list[str], recursive: bool = True, glob: str = NDJSON_GLOB,
                files: Column | None = None, root: str | None = None) -> DataFrame:
    """The lines with their file and, in ``SPLIT_COLUMNS``, their place in it.
    ``rel_path`` is below ``root`` where ``path`` lists single files of it."""
    r = spark.read.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    raw = r.text(path if isinstance(path, str) else list(path))
    if files is not None:
        raw = raw.filter(files)
    full = F.col("_metadata.file_path")
    rel = _below(spark, full, [root] if root else [path] if isinstance(path, str) else list(path))
    rel, name = _original(rel)
    return raw.select("value", full.alias("file_path"), rel.alias("rel_path"), name.alias("file_name"),
                      F.col("_metadata.file_size").alias("file_size"), F.col("_metadata.file_modification_time").alias("file_mtime"),
                      F.col("_metadata.file_block_start").alias("split_start"), F.monotonically_increasing_id().alias("split_pos"))


def add_line_numbers(lines: DataFrame, scan: DataFrame, broadcast_limit_bytes: int = 64 << 20) -> DataFrame:
    """``line_no`` for ``lines``, which come from ``scan`` (``scan_splits``) by
    filters and added columns.

    One row per split holds the lines before it; ``lines`` join that table.
    It is broadcast while its size, bounded from the bytes and files of the
    scan, allows it; beyond, the join shuffles only ``lines``, so give it the
    few that need a number."""
    offs = split_offsets(scan)
    if split_count_bound(scan) * SPLIT_ROW_BYTES <= broadcast_limit_bytes:
        offs = F.broadcast(offs)
    return _with_offsets(lines, offs)


def split_offsets(scan: DataFrame, files: tuple[str, ...] = ("file_path",)) -> DataFrame:
    """One row per file split: its first position and the lines of the file
    before it (``files``: the columns that make up one file)."""
    splits = scan.groupBy(*dict.fromkeys([*files, "file_path"]), "split_start").agg(F.count(F.lit(1)).alias("_n"), F.min("split_pos").alias("_m0"))
    before = Window.partitionBy(*files).orderBy("file_path", "split_start").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("file_path", "split_start", "_m0", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))


def _with_offsets(lines: DataFrame, offs: DataFrame) -> DataFrame:
    out = lines.join(offs, ["file_path", "split_start"], "inner")
    return out.select(*[c for c in lines.columns if c not in SPLIT_COLUMNS],
                      (F.col("_off") + F.col("split_pos") - F.col("_m0") + 1).cast("long").alias("line_no"))


def number_splits(rows: DataFrame, scan: DataFrame, file_key: str = "rel_path") -> DataFrame:
    """``line_no`` for some ``rows`` of a stored ``scan`` with ``SPLIT_COLUMNS``,
    counted through all parts of a file (``file_key``).  Reads no text."""
    return _with_offsets(rows, split_offsets(scan, (file_key,))).drop("file_path")


def split_count_bound(scan: DataFrame) -> int:
    """Upper bound of the number of splits of a scan: its partitions (each holds
    whole splits) times what the open cost lets one partition pack.  Counted in
    the JVM; no path reaches the driver's Python."""
    spark = scan.sparkSession
    to_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    split = int(to_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m")))
    cost = int(to_bytes(spark.conf.get("spark.sql.files.openCostInBytes", "4m")))
    parts = scan._jdf.queryExecution().toRdd().getNumPartitions()
    return parts * (split // max(cost, 1) + 2)


def file_count(scan: DataFrame) -> int:
    """Files of a scan, counted in the JVM's listing."""
    jvm = scan.sparkSession.sparkContext._jvm
    return jvm.java.lang.reflect.Array.getLength(scan._jdf.inputFiles())


def list_files(spark: SparkSession, path: str, glob: str = NDJSON_GLOB) -> DataFrame:
    """``file_path, rel_path, source_path, file_name, file_size, file_mtime`` of
    the files under ``path``; contents are not read.  ``source_path`` is the
    original's path for a landed file.  A scan gives empty files no row, so their
    paths come from the reader's own listing, as a JVM dataset."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    jvm = spark.sparkContext._jvm
    listed = spark._jsparkSession.createDataset(jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(raw._jdf.inputFiles()), jvm.org.apache.spark.sql.Encoders.STRING())
    names = DataFrame(listed.toDF(), spark).distinct()
    names = names.select(_decode_name(F.col("value")).alias("file_path"), _below(spark, F.col("value"), [path]).alias("rel_path"))
    seen = raw.select(_below(spark, F.col("_metadata.file_path"), [path]).alias("rel_path"), F.col("length").alias("_size"),
                      F.col("modificationTime").alias("file_mtime"))
    x = names.join(seen, "rel_path", "left").withColumn("file_size", F.coalesce("_size", F.lit(0)))
    source, _ = _original(F.col("rel_path"))
    return x.select("file_path", "rel_path", source.alias("source_path"), F.regexp_extract("rel_path", "([^/]+)$", 1).alias("file_name"), "file_size", "file_mtime")


def file_versions(files: DataFrame) -> DataFrame:
    """The version of every source file of a listing: ``rel_path, file_name,
    file_size, file_mtime``; a landed file counts with all its parts."""
    g = files.groupBy(F.col("source_path").alias("rel_path")).agg(F.sum("file_size").alias("file_size"), F.max("file_mtime").alias("file_mtime"))
    return g.select("rel_path", F.regexp_extract("rel_path", "([^/]+)$", 1).alias("file_name"), "file_size", "file_mtime")


def _below(spark: SparkSession, full: Column, roots: list[str]) -> Column:
    """A file's decoded path below the scanned root."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    decoded = _decode_name(full)
    rel = decoded
    for root in roots:
        p = jvm.org.apache.hadoop.fs.Path(root)
        base = p.getFileSystem(conf).makeQualified(p).toUri().getPath().rstrip("/") + "/"
        at = F.locate(base, decoded)
        rel = F.when(at > 0, decoded.substr(at + len(base), F.length(decoded))).otherwise(rel)
    return rel


def _original(rel: Column) -> tuple[Column, Column]:
    """Relative path and name of the original file: those of the landing
    folder's value for a landed file, else the file's own."""
    landed = F.regexp_extract(rel, "^source_file=([^/]+)/[^/]+$", 1)
    path = F.when(landed != "", _decode_name(landed)).otherwise(rel)
    return path, F.regexp_extract(path, "([^/]+)$", 1)


def _decode_name(name: Column) -> Column:
    """``_metadata`` names are URI-encoded (``%20``, ``%23``); decode them,
    keeping a literal ``+`` (form decoding would turn it into a space)."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def is_blank_trimmed(value: Column) -> Column:
    """Nothing but white space: cut from the left alone, which stops at the first
    other character (cutting from the right first looks at every one)."""
    return F.ltrim(value, F.lit(WHITESPACE)) == ""


def parse_lines(lines: DataFrame, value_col: str = "value", mode: str = "quarantine") -> DataFrame:
    """Classify each line and project the resource header.

    ``status``: ``blank`` (empty line, skipped), ``invalid_json``,
    ``not_object``, ``missing_resource_type``, ``bad_resource_type``,
    ``bad_id`` or ``ok``.  ``resource_type`` is set only when it is a string;
    ``resource_id`` is ``''`` when absent (P2).  One streaming pass per line
    gives validity and header; the document itself is not built.

    ``mode="failfast"`` keeps the reference's rule that a bad line stops the
    run: the job fails with the file and line of a bad line it meets (use
    ``file_counts`` for the first bad line of every file without failing).
    """
    if mode not in ("quarantine", "failfast"):
        raise ValueError(f"unknown mode {mode!r}")
    value = F.col(value_col)
    x = lines.select("*", checked_header(value).alias("_h")).select("*", header_status(value, F.col("_h")).alias("_st"))
    rt, rid = F.col("_h")[0]["resourceType"], F.col("_h")[0]["id"]
    rt_t = F.when(rt.isNotNull(), F.schema_of_variant(rt))
    id_t = F.when(rid.isNotNull(), F.schema_of_variant(rid))
    ok_obj = F.col("_st") == "ok"
    status = (F.when(~ok_obj, F.col("_st"))
              .when(rt_t.isNull(), "missing_resource_type")
              .when(rt_t != "STRING", "bad_resource_type")
              .when(id_t.isNotNull() & (id_t != "STRING"), "bad_id")
              .otherwise("ok"))
    outcome = F.struct(status.alias("status"),
                       F.when(ok_obj & (rt_t == "STRING"), F.try_variant_get(rt, "$", "string")).alias("resource_type"),
                       F.when(ok_obj, F.when(id_t.isNull(), F.lit("")).when(id_t == "STRING", F.try_variant_get(rid, "$", "string")))
                       .alias("_rid"),
                       is_blank_trimmed(value).alias("blank_trimmed"))
    # filters on the outcome stay above the explode; pushed below a plain projection
    # they would make and parse every line again for each mention of the status
    y = x.select(*lines.columns, F.explode(F.array(outcome)).alias("_o")).select(*lines.columns, "_o.*")
    parsed = F.col("status").isin("ok", "missing_resource_type", "bad_resource_type", "bad_id")
    out = y.select(*lines.columns, "status", "resource_type", parsed.alias("parsed"),
                   F.when(parsed, F.col("_rid")).alias("resource_id"), "blank_trimmed")
    if mode == "failfast":
        where = F.concat_ws(" ", F.lit("file"), F.coalesce(F.col("file_name").cast("string"), F.lit("?")),
                            F.lit("line"), F.coalesce(F.col("line_no").cast("string"), F.lit("?")))
        bad = ~F.col("status").isin("ok", "blank")
        # a filter predicate is evaluated on every row (a dropped column would
        # be pruned away)
        check = F.when(bad, F.raise_error(F.concat(where, F.lit(": "), status_message(F.col("status"))))) \
            .otherwise(F.lit(True))
        out = out.filter(check)
    return out


# Error text per line status (what the reference reports).
STATUS_MESSAGES = {
    "invalid_json": "failed to parse JSON",
    "not_object": "failed to parse JSON: not an object",
    "missing_resource_type": "missing resourceType field",
    "bad_resource_type": "resourceType is not a string",
    "bad_id": "id is not a string",
}


def status_message(status: Column) -> Column:
    m = F.lit(None).cast("string")
    expr = None
    for k, v in STATUS_MESSAGES.items():
        expr = (F.when(status == k, v) if expr is None else expr.when(status == k, v))
    return expr.otherwise(m)


def quarantine(parsed: DataFrame) -> DataFrame:
    """P10 (quarantine mode): every bad line as a reject row
    ``(file_name, line_no, error_kind, error, value)``; blank lines are not
    errors."""
    bad = parsed.filter(~F.col("status").isin("ok", "blank"))
    return bad.select("file_name", "line_no", F.col("status").alias("error_kind"),
                      status_message(F.col("status")).alias("error"), "value")


#: Lines of one counting slice: their parsed flags fit the bits of a long.
SLICE_LINES = 62


def file_counts(parsed: DataFrame, keys: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """A1 + failfast stop point per file.  ``keys`` tell files apart (give
    ``("rel_path",)`` for a scanned directory).

    ``n_parsed``: lines that parse as JSON objects; ``n_nonblank``: lines not
    blank after trimming; ``first_error_line``: where a failfast read stops;
    ``n_parsed_before_error``: the reference's per-file count.

    Lines are counted per slice of 62 line numbers, combined map-side and
    without a sort; a slice keeps its parsed lines as bits of a long.  Slices
    before the file's first error count whole, the one that holds it counts
    the bits below it.
    """
    err = ~F.col("parsed") & (F.col("status") != "blank")
    at = F.col("line_no") % SLICE_LINES
    per = parsed.groupBy(*keys, F.floor(F.col("line_no") / SLICE_LINES).alias("_sl")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(~F.col("blank_trimmed")).alias("n_nonblank"), F.count_if(F.col("parsed")).alias("n_parsed"),
        F.count_if(F.col("status") == "ok").alias("n_valid"), F.min(F.when(err, F.col("line_no"))).alias("_e"),
        F.bit_or(F.when(F.col("parsed"), F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))).otherwise(0)).alias("_bits"))
    first = per.groupBy(*keys).agg(F.min("_e").alias("first_error_line"))
    from ndflow.plans.seq import join_null_safe
    x = join_null_safe(per, first, list(keys))
    e = F.col("first_error_line")
    below = F.call_function("shiftleft", F.lit(1).cast("long"), (e % SLICE_LINES).cast("int")) - 1
    before = (F.when(e.isNull() | (F.col("_sl") < F.floor(e / SLICE_LINES)), F.col("n_parsed"))
              .when(F.col("_sl") == F.floor(e / SLICE_LINES), F.bit_count(F.col("_bits").bitwiseAND(below)).cast("long")).otherwise(F.lit(0)))
    return x.groupBy(*keys).agg(
        F.sum("n_lines").alias("n_lines"), F.sum("n_nonblank").alias("n_nonblank"), F.sum("n_parsed").alias("n_parsed"),
        F.min("first_error_line").alias("first_error_line"), F.sum("n_valid").alias("n_valid"), F.sum(before).alias("n_parsed_before_error"))


def name_to_type(file_name: Column) -> Column:
    """Resource type from a file name: drop ``.ndjson``, first token split
    on ``_ - .``, else ``Unknown``."""
    base = F.regexp_replace(file_name, r"\.ndjson$", "")
    tok = F.regexp_extract(base, r"^[_.\-]*([^_.\-]+)", 1)
    return F.when(tok == "", "Unknown").otherwise(tok)


def manifest(parsed: DataFrame, source_step: str = "local_import", root: str = "import") -> DataFrame:
    """S4 over lines that come from a table: one manifest row per file, sizes are
    the bytes of the lines plus a newline each.  Files on disk have their own
    size, time and empty files: use ``import_directory``."""
    return (parsed.groupBy("file_name").agg(
        F.sum(F.octet_length("value") + 1).cast("long").alias("file_size"),
        F.count_if(~F.col("blank_trimmed")).cast("int").alias("line_count"))
        .select("file_name", F.concat(F.lit(root + "/"), F.col("file_name")).alias("file_path"),
                name_to_type(F.col("file_name")).alias("resource_type"), "file_size",
                F.lit(source_step).alias("source_step"), "line_count"))
