"""Scalar column functions (X1-X14, X19): names, URLs, input kinds, error
classes, backoff, and human-readable sizes, rates and durations.

All are built-in expressions (no Python UDF), so they stay in codegen.
Number formatting rounds half up on the binary value after scaling
(``floor(x * 100 + 0.5)``); the reference's printf may differ on exact ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# URLs and names
# --------------------------------------------------------------------------


def path_base(p: Column) -> Column:
    """Last element of a slash path; ``.`` for empty; ``/`` for all slashes."""
    trimmed = F.regexp_replace(p, "/+$", "")
    last = F.regexp_extract(trimmed, "([^/]*)$", 1)
    return (F.when(p == "", ".").when(trimmed == "", "/").otherwise(last))


def url_to_name(url: Column, fallback: Column | str = "download.ndjson", strip_query: bool = False) -> Column:
    """File name for a downloaded URL: last path element (``.`` or ``/``
    fall back), ``.ndjson`` appended unless present (case-insensitive).
    ``strip_query`` drops ``?query`` and ``#fragment`` first (H18)."""
    u = F.regexp_replace(url, r"[?#].*$", "") if strip_query else url
    b = path_base(u)
    fb = F.lit(fallback) if isinstance(fallback, str) else fallback
    name = F.when(b.isin(".", "/"), fb).otherwise(b)
    return F.when(F.lower(name).endswith(".ndjson"), name).otherwise(F.concat(name, F.lit(".ndjson")))


# Markers of a cohort-extraction result URL.
RESULT_URL_MARKERS = ("/fhir/extraction/", "/fhir/result/")


def input_kind(source: Column, is_dir: Column, is_query_doc: Column) -> Column:
    """``local_directory``, ``torch_result_url``, ``http_url``,
    ``crtdl_file``; default ``local_directory``.  Directory and query-document
    tests come in as columns (they need the file system)."""
    http = source.startswith("http://") | source.startswith("https://")
    result = source.contains(RESULT_URL_MARKERS[0]) | source.contains(RESULT_URL_MARKERS[1])
    qfile = source.endswith(".crtdl") | source.endswith(".json")
    return (F.when(source.isNull() | (source == ""), F.lit(None))
            .when(is_dir, "local_directory")
            .when(http & result, "torch_result_url")
            .when(http, "http_url")
            .when(qfile & is_query_doc, "crtdl_file")
            .otherwise("local_directory"))


# Host names that are rewritten to the configured base URL.
INTERNAL_HOSTS = ("torch", "torch-proxy", "localhost", "127.0.0.1")
URL_HOST_RE = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
URL_PATH_RE = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)"
URL_QUERY_RE = r"^[^?#]*\?([^#]*)"


def absolute_url(raw: Column, base_url: str) -> Column:
    """Relative URL -> base + URL; absolute URL on an internal host ->
    base scheme and host with the URL's path and query; others unchanged.  The
    host is compared as written, without user and port."""
    is_abs = raw.startswith("http://") | raw.startswith("https://")
    host = F.regexp_extract(raw, URL_HOST_RE, 1)
    path = F.regexp_extract(raw, URL_PATH_RE, 1)
    query = F.regexp_extract(raw, URL_QUERY_RE, 1)
    base_origin = F.regexp_extract(F.lit(base_url), r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    rewritten = F.concat(base_origin, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return (F.when(~is_abs, F.concat(F.lit(base_url), raw))
            .when(host.isin(*INTERNAL_HOSTS), rewritten)
            .otherwise(raw))


# --------------------------------------------------------------------------
# Errors and retry
# --------------------------------------------------------------------------

def is_transient_status(status: Column) -> Column:
    """5xx, 408 and 429 are transient."""
    return ((status >= 500) & (status < 600)) | status.isin(408, 429)


def http_error_type(status: Column) -> Column:
    return F.when(is_transient_status(status), "transient").otherwise("non_transient")


# Case-insensitive substrings that mark a network error.
NETWORK_PATTERNS = ("connection refused", "connection reset", "no such host", "timeout", "temporary failure",
                    "network is unreachable", "deadline exceeded", "eof")


def is_network_error(msg: Column, word_boundary: bool = False) -> Column:
    """Any network pattern in the message (``eof`` matches inside words,
    as in the reference, unless ``word_boundary``)."""
    low = F.lower(msg)
    pats = list(NETWORK_PATTERNS)
    out = None
    for p in pats:
        c = low.rlike(r"\beof\b") if (word_boundary and p == "eof") else low.contains(p)
        out = c if out is None else (out | c)
    return F.coalesce(out, F.lit(False))


# Error classes (category, message) in the order they are tested.
ERROR_CLASSES = {
    "network": ("network", "Network connectivity issue"),
    "disk": ("filesystem", "Insufficient disk space"),
    "permission": ("filesystem", "Permission denied"),
    "other": ("validation", "An error occurred"),
}
# Message parts that tell a full disk or a refused access.
DISK_PATTERNS = ("no space left", "disk full")
PERMISSION_PATTERNS = ("permission denied", "access denied")


def classify_error(msg: Column) -> Column:
    """struct(category, message, retryable)."""
    low = F.lower(msg)
    net = is_network_error(msg)
    disk = low.contains(DISK_PATTERNS[0]) | low.contains(DISK_PATTERNS[1])
    perm = low.contains(PERMISSION_PATTERNS[0]) | low.contains(PERMISSION_PATTERNS[1])
    c = ERROR_CLASSES
    cat = (F.when(net, c["network"][0]).when(disk, c["disk"][0]).when(perm, c["permission"][0])
           .otherwise(c["other"][0]))
    text = (F.when(net, c["network"][1]).when(disk, c["disk"][1]).when(perm, c["permission"][1])
            .otherwise(c["other"][1]))
    return F.struct(cat.alias("category"), text.alias("message"), net.alias("retryable"))


def step_error_type(http_status: Column, msg: Column) -> Column:
    """Typed HTTP error -> its class; otherwise network -> transient;
    else non_transient (classified from stored columns, H7)."""
    return (F.when(http_status.isNotNull() & (http_status > 0), http_error_type(http_status))
            .when(is_network_error(msg), "transient").otherwise("non_transient"))


def should_retry(error_type: Column, current: Column, max_retries: Column | int) -> Column:
    """Whether a failed attempt is tried again (transient, and attempts left)."""
    return (error_type == "transient") & (current < max_retries)


def backoff_ms(attempt: Column, initial_ms: int, max_ms: int) -> Column:
    """min(initial * 2^max(attempt, 0), max), whole milliseconds."""
    return F.least(F.lit(initial_ms).cast("double") * F.pow(F.lit(2.0), F.greatest(attempt, F.lit(0))),
                   F.lit(max_ms).cast("double")).cast("long")


def next_poll_interval(current: Column, max_interval: Column | int) -> Column:
    """X11: double the interval, capped."""
    return F.least(current * 2, F.lit(max_interval) if isinstance(max_interval, int) else max_interval)


# --------------------------------------------------------------------------
# Text formatting
# --------------------------------------------------------------------------

def fixed2(x: Column) -> Column:
    """Two decimals, half up: ``floor(x * 100 + 0.5)`` split into parts."""
    c = F.floor(x * 100 + 0.5).cast("long")
    return F.concat(((c - c % 100) / 100).cast("long").cast("string"), F.lit("."),
                    F.lpad((c % 100).cast("string"), 2, "0"))


def fixed0(x: Column) -> Column:
    return F.floor(x + 0.5).cast("long").cast("string")


KB, MB, GB, TB = 1024, 1024 ** 2, 1024 ** 3, 1024 ** 4


def format_bytes(b: Column, with_tb: bool = True) -> Column:
    """``%.2f TB/GB/MB/KB`` or ``%d B``; the command-line variant stops
    at GB (``with_tb=False``)."""
    bd = b.cast("double")
    out = F.when(b >= TB, F.concat(fixed2(bd / TB), F.lit(" TB"))) if with_tb else None
    gb = F.concat(fixed2(bd / GB), F.lit(" GB"))
    out = F.when(b >= GB, gb) if out is None else out.when(b >= GB, gb)
    return (out.when(b >= MB, F.concat(fixed2(bd / MB), F.lit(" MB")))
            .when(b >= KB, F.concat(fixed2(bd / KB), F.lit(" KB")))
            .otherwise(F.concat(b.cast("long").cast("string"), F.lit(" B"))))


def format_items_rate(r: Column) -> Column:
    """X13."""
    return F.when(r < 0.01, "< 0.01 items/sec").otherwise(F.concat(fixed2(r), F.lit(" items/sec")))


def format_bytes_rate(r: Column) -> Column:
    """X13."""
    return (F.when(r >= GB, F.concat(fixed2(r / GB), F.lit(" GB/sec")))
            .when(r >= MB, F.concat(fixed2(r / MB), F.lit(" MB/sec")))
            .when(r >= KB, F.concat(fixed2(r / KB), F.lit(" KB/sec")))
            .otherwise(F.concat(fixed0(r), F.lit(" B/sec"))))


def _round_div(x: Column, unit: int) -> Column:
    """Round a non-negative count to a multiple of ``unit``, half away from
    zero; returns the number of units."""
    return F.floor((x + F.lit(unit // 2)) / F.lit(unit)).cast("long")


def _hms(total_s: Column) -> Column:
    h = (total_s / 3600).cast("long")
    m = ((total_s % 3600) / 60).cast("long")
    s = total_s % 60
    hs, ms_, ss = h.cast("string"), m.cast("string"), s.cast("string")
    return (F.when(h > 0, F.concat(hs, F.lit("h"), ms_, F.lit("m"), ss, F.lit("s")))
            .when(m > 0, F.concat(ms_, F.lit("m"), ss, F.lit("s")))
            .otherwise(F.concat(ss, F.lit("s"))))


SEC = 1_000_000  # microseconds


def format_duration(us: Column) -> Column:
    """X14 (elapsed, from microseconds): under 1 s rounded to ms (``150ms``,
    ``0s``), else rounded to seconds in ``1h2m3s`` form."""
    r = _round_div(us, 1000)
    sub = F.when(r == 0, "0s").when(r >= 1000, "1s").otherwise(F.concat(r.cast("string"), F.lit("ms")))
    return F.when(us < SEC, sub).otherwise(_hms(_round_div(us, SEC)))


def format_eta(us: Column) -> Column:
    """X14 (ETA, from microseconds): ``< 1s``; under a minute rounded
    seconds; then ``XmYs``; then ``XhYm`` (truncated)."""
    s_trunc = (us / SEC).cast("long")
    return (F.when(us < SEC, "< 1s")
            .when(us < 60 * SEC, _hms(_round_div(us, SEC)))
            .when(us < 3600 * SEC, F.concat((s_trunc / 60).cast("long").cast("string"), F.lit("m"),
                                            (s_trunc % 60).cast("string"), F.lit("s")))
            .otherwise(F.concat((s_trunc / 3600).cast("long").cast("string"), F.lit("h"),
                                ((s_trunc / 60).cast("long") % 60).cast("string"), F.lit("m"))))


def format_age(us: Column) -> Column:
    """X14 (job age, from microseconds): ``Ns``, ``Nm``, ``Nh``, ``Nd``,
    truncated."""
    s = (us / SEC).cast("long")
    return (F.when(us < 60 * SEC, F.concat(s.cast("string"), F.lit("s")))
            .when(us < 3600 * SEC, F.concat((s / 60).cast("long").cast("string"), F.lit("m")))
            .when(us < 86400 * SEC, F.concat((s / 3600).cast("long").cast("string"), F.lit("h")))
            .otherwise(F.concat((s / 86400).cast("long").cast("string"), F.lit("d"))))


# Status symbols (job list and step list differ for pending).
JOB_SYMBOLS = {"completed": "✓", "in_progress": "→", "failed": "✗", "pending": "○"}
STEP_SYMBOLS = {"completed": "✓", "in_progress": "→", "failed": "✗", "pending": " "}


def status_symbol(status: Column, for_job: bool = True) -> Column:
    """X19."""
    table = JOB_SYMBOLS if for_job else STEP_SYMBOLS
    out = None
    for k, v in table.items():
        out = F.when(status == k, v) if out is None else out.when(status == k, v)
    return out.otherwise(" ")
