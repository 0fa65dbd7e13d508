"""Remote sources: extraction-result parsing and URL download.

``extraction_urls`` parses result documents of both dialects with
``from_json`` and array functions (no Python).  ``fetch_lines`` streams the
lines of a DataFrame of URLs out of tasks as rows, with the row-level retry
rule (D6); ``fetch`` lands them through Spark's writer and returns a manifest
row per URL.  The fetcher is injected, so tests and air-gapped runs use
``file://`` URLs.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ndflow.functions.jsonfn import is_one_value
from ndflow.functions.scalars import absolute_url

RESULT_SCHEMA = ("resourceType string, "
                 "parameter array<struct<name string, part array<struct<name string, valueUrl string>>>>, "
                 "output array<struct<type string, url string>>, error array<string>")


def extraction_urls(docs: DataFrame, base_url: str, doc_col: str = "doc", key_col: str = "doc_id") -> DataFrame:
    """One row per URL listed in a result document, made absolute (X4);
    a document without URLs keeps one row with NULL url and its ``status``
    (``empty``, ``empty_with_errors``, ``unknown_format``, ``invalid_json``)."""
    p = F.from_json(F.col(doc_col), RESULT_SCHEMA)
    x = docs.select(key_col, doc_col, p.alias("_r"))
    params = F.filter("_r.parameter", lambda q: q["name"] == "output")
    d1 = F.flatten(F.transform(params, lambda q: F.transform(
        F.filter(q["part"], lambda s: (s["name"] == "url") & F.coalesce(s["valueUrl"] != "", F.lit(False))),
        lambda s: s["valueUrl"])))
    d2 = F.transform(F.filter("_r.output", lambda o: F.coalesce(o["url"] != "", F.lit(False))), lambda o: o["url"])
    is_d1 = F.coalesce(F.col("_r.resourceType") == "Parameters", F.lit(False))
    has_out = F.get_json_object(F.col(doc_col), "$.output").isNotNull()
    urls = F.when(is_d1, F.coalesce(d1, F.array().cast("array<string>"))).when(has_out, F.coalesce(d2, F.array().cast("array<string>")))
    n_err = F.coalesce(F.size("_r.error"), F.lit(0))
    status = (F.when(~is_one_value(F.col(doc_col)), "invalid_json")
              .when(~is_d1 & ~has_out, "unknown_format")
              .when(F.size(urls) > 0, "ok")
              .when(~is_d1 & (n_err > 0), "empty_with_errors")
              .otherwise("empty"))
    y = x.select(key_col, status.alias("status"), F.posexplode_outer(urls).alias("url_index", "raw_url"))
    return y.select(key_col, "url_index", "raw_url",
                    F.when(F.col("raw_url").isNotNull(), absolute_url(F.col("raw_url"), base_url)).alias("url"),
                    "status")


def urllib_fetcher(url: str, timeout: float = 60.0) -> Iterator[bytes]:
    """The response line by line; a body is never held whole."""
    with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310 - caller-chosen URLs
        yield from r


def _http_status(exc: Exception) -> int:
    return exc.code if isinstance(exc, urllib.error.HTTPError) else 0


LINE_SCHEMA = ("url string, file_name string, attempt int, line_no long, value string, n_bytes long, "
               "status string, http_status int, error string")


def fetch_lines(urls: DataFrame, fetcher: Callable[[str], Iterable[bytes] | bytes] = urllib_fetcher, max_attempts: int = 5,
                initial_ms: int = 1000, max_ms: int = 30000, url_col: str = "url", name_col: str = "file_name",
                batch_lines: int = 4096) -> DataFrame:
    """The lines of every URL as rows, streamed through tasks, and one
    closing row per URL (``status`` not NULL) with its outcome.

    Transient failures (5xx, 408, 429, network messages) are retried with
    capped exponential backoff; lines of an attempt that broke off carry its
    number, so only those of the last one count.  The caller decides the
    parallelism (``repartition``)."""
    import pandas as pd

    from ndflow.functions.scalars import NETWORK_PATTERNS

    def transient(exc: Exception) -> bool:
        st = _http_status(exc)
        if st:
            return 500 <= st < 600 or st in (408, 429)
        msg = str(exc).lower()
        return any(p in msg for p in NETWORK_PATTERNS)

    cols = [c.split()[0] for c in LINE_SCHEMA.split(", ")]

    def one(url, name):
        for attempt in range(1, max_attempts + 1):
            n = size = 0
            try:
                got = fetcher(url)
                for raw in (got.splitlines(keepends=True) if isinstance(got, bytes) else got):
                    n, size = n + 1, size + len(raw)
                    yield (url, name, attempt, n, raw.rstrip(b"\r\n").decode("utf-8", "replace"), len(raw), None, None, None)
                yield (url, name, attempt, n, None, size, "ok", None, None)
                return
            except Exception as e:  # noqa: BLE001 - classified
                if not transient(e) or attempt == max_attempts:
                    yield (url, name, attempt, None, None, None, "failed", _http_status(e) or None, str(e))
                    return
            time.sleep(min(initial_ms * 2 ** (attempt - 1), max_ms) / 1000.0)

    def run(batches):
        for pdf in batches:
            rows = []
            for url, name in zip(pdf[url_col], pdf[name_col]):
                for row in one(url, name):
                    rows.append(row)
                    if len(rows) >= batch_lines:
                        yield pd.DataFrame(rows, columns=cols)
                        rows = []
            yield pd.DataFrame(rows, columns=cols)

    return urls.select(F.col(url_col).alias(url_col), F.col(name_col).alias(name_col)).mapInPandas(run, LINE_SCHEMA)


def fetch(urls: DataFrame, dest_dir: str, fetcher: Callable[[str], Iterable[bytes] | bytes] = urllib_fetcher, max_attempts: int = 5,
          initial_ms: int = 1000, max_ms: int = 30000, url_col: str = "url", name_col: str = "file_name") -> DataFrame:
    """Download every URL and land its lines under ``dest_dir``, one
    folder per URL (``file_name=.../url_key=...``), through Spark's committer:
    any Hadoop file system works, two URLs with one name stay apart, a failed
    URL leaves earlier files as they are.

    Returns ``(url, file_name, file_path, file_size, line_count, status,
    attempts, http_status, error)``, one row per URL and name; a pair that is
    listed again is downloaded once."""
    import uuid

    from ndflow.plans.seq import join_null_safe
    from ndflow.session import scratch_path
    spark = urls.sparkSession
    staged = scratch_path(spark, f"fetch-{uuid.uuid4().hex}")  # one download, read twice below
    urls = urls.select(url_col, name_col).distinct().repartition(max(1, urls._jdf.queryExecution().toRdd().getNumPartitions()))
    fetch_lines(urls, fetcher, max_attempts, initial_ms, max_ms, url_col, name_col).write.parquet(staged)
    rows = spark.read.schema(LINE_SCHEMA).parquet(staged).withColumn("url_key", F.substring(F.sha2("url", 256), 1, 16))
    done = rows.filter(F.col("status").isNotNull())
    ok = done.filter("status = 'ok'").select("url", "file_name", F.col("attempt").alias("_last"))
    lines = join_null_safe(rows.filter(F.col("status").isNull()), ok, ["url", "file_name"]).filter("attempt = _last")
    (lines.select("value", "file_name", "url_key").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("file_name", "url_key").text(dest_dir))
    counts = lines.groupBy("url", "file_name").agg(F.count_if(F.trim("value") != "").alias("line_count"))
    counts = counts.withColumnsRenamed({"url": "_u", "file_name": "_f"})
    good = F.col("status") == "ok"
    path = F.concat(F.lit(dest_dir.rstrip("/") + "/file_name="), F.col("file_name"), F.lit("/url_key="), F.col("url_key"))
    return done.join(counts, done["url"].eqNullSafe(counts["_u"]) & done["file_name"].eqNullSafe(counts["_f"]), "left").select(
        "url", "file_name", F.when(good, path).alias("file_path"), F.when(good, F.col("n_bytes")).alias("file_size"),
        F.when(good, F.coalesce("line_count", F.lit(0))).alias("line_count"), "status", F.col("attempt").alias("attempts"), "http_status", "error")


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#:]*)", 1)
