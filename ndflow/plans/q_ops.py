"""Registered queries: scalar functions (X1-X14, X19), row retry (D6),
run ledger (J2, J3, O1-O3, L1-L5, A5, X15, X17, X18) and progress (W1-W7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ndflow.functions import scalars as X
from ndflow.operators import ledger as L
from ndflow.operators import progress as W
from ndflow.operators.retry import INITIAL_BACKOFF_MS, MAX_ATTEMPTS, MAX_BACKOFF_MS, retry_outcomes
from ndflow.plans import fixtures as FX
from ndflow.plans.registry import register, with_ctes

# ---------------------------------------------------------------------------
# SQL twins of the scalar helpers (DuckDB)
# ---------------------------------------------------------------------------


def s_fixed2(x: str) -> str:
    c = f"CAST(floor(({x}) * 100 + 0.5) AS BIGINT)"
    return f"(CAST({c} // 100 AS VARCHAR) || '.' || lpad(CAST({c} % 100 AS VARCHAR), 2, '0'))"


def s_fixed0(x: str) -> str:
    return f"CAST(CAST(floor(({x}) + 0.5) AS BIGINT) AS VARCHAR)"


def s_format_bytes(b: str, with_tb: bool = True) -> str:
    d = f"CAST({b} AS DOUBLE)"
    tb = f"WHEN {b} >= 1099511627776 THEN {s_fixed2(d + ' / 1099511627776')} || ' TB' " if with_tb else ""
    return (f"(CASE {tb}WHEN {b} >= 1073741824 THEN {s_fixed2(d + ' / 1073741824')} || ' GB' "
            f"WHEN {b} >= 1048576 THEN {s_fixed2(d + ' / 1048576')} || ' MB' "
            f"WHEN {b} >= 1024 THEN {s_fixed2(d + ' / 1024')} || ' KB' "
            f"ELSE CAST(CAST({b} AS BIGINT) AS VARCHAR) || ' B' END)")


def s_items_rate(r: str) -> str:
    return f"(CASE WHEN {r} < 0.01 THEN '< 0.01 items/sec' ELSE {s_fixed2(r)} || ' items/sec' END)"


def s_bytes_rate(r: str) -> str:
    return (f"(CASE WHEN {r} >= 1073741824 THEN {s_fixed2(r + ' / 1073741824')} || ' GB/sec' "
            f"WHEN {r} >= 1048576 THEN {s_fixed2(r + ' / 1048576')} || ' MB/sec' "
            f"WHEN {r} >= 1024 THEN {s_fixed2(r + ' / 1024')} || ' KB/sec' "
            f"ELSE {s_fixed0(r)} || ' B/sec' END)")


def s_round_div(x: str, unit: int) -> str:
    return f"CAST(floor(({x} + {unit // 2}) / {unit}) AS BIGINT)"


def s_hms(t: str) -> str:
    h, m, s = f"({t} // 3600)", f"(({t} % 3600) // 60)", f"({t} % 60)"
    return (f"(CASE WHEN {h} > 0 THEN CAST({h} AS VARCHAR) || 'h' || CAST({m} AS VARCHAR) || 'm' || CAST({s} AS VARCHAR) || 's' "
            f"WHEN {m} > 0 THEN CAST({m} AS VARCHAR) || 'm' || CAST({s} AS VARCHAR) || 's' "
            f"ELSE CAST({s} AS VARCHAR) || 's' END)")


def s_format_duration(us: str) -> str:
    r = s_round_div(us, 1000)
    return (f"(CASE WHEN {us} < 1000000 THEN (CASE WHEN {r} = 0 THEN '0s' WHEN {r} >= 1000 THEN '1s' "
            f"ELSE CAST({r} AS VARCHAR) || 'ms' END) ELSE {s_hms(s_round_div(us, 1_000_000))} END)")


def s_format_eta(us: str) -> str:
    st = f"({us} // 1000000)"
    return (f"(CASE WHEN {us} < 1000000 THEN '< 1s' WHEN {us} < 60000000 THEN {s_hms(s_round_div(us, 1_000_000))} "
            f"WHEN {us} < 3600000000 THEN CAST({st} // 60 AS VARCHAR) || 'm' || CAST({st} % 60 AS VARCHAR) || 's' "
            f"ELSE CAST({st} // 3600 AS VARCHAR) || 'h' || CAST(({st} // 60) % 60 AS VARCHAR) || 'm' END)")


def s_format_age(us: str) -> str:
    st = f"({us} // 1000000)"
    return (f"(CASE WHEN {us} < 60000000 THEN CAST({st} AS VARCHAR) || 's' "
            f"WHEN {us} < 3600000000 THEN CAST({st} // 60 AS VARCHAR) || 'm' "
            f"WHEN {us} < 86400000000 THEN CAST({st} // 3600 AS VARCHAR) || 'h' "
            f"ELSE CAST({st} // 86400 AS VARCHAR) || 'd' END)")


def s_network(msg: str) -> str:
    pats = " OR ".join(f"contains(lower({msg}), '{p}')" for p in X.NETWORK_PATTERNS)
    return f"coalesce(({pats}), false)"


def s_transient(st: str) -> str:
    return f"(({st} >= 500 AND {st} < 600) OR {st} IN (408, 429))"


def s_step_error_type(st: str, msg: str) -> str:
    return (f"(CASE WHEN {st} IS NOT NULL AND {st} > 0 THEN (CASE WHEN {s_transient(st)} THEN 'transient' ELSE 'non_transient' END) "
            f"WHEN {s_network(msg)} THEN 'transient' ELSE 'non_transient' END)")


def s_job_symbol(st: str) -> str:
    return (f"(CASE {st} WHEN 'completed' THEN '✓' WHEN 'in_progress' THEN '→' WHEN 'failed' THEN '✗' "
            f"WHEN 'pending' THEN '○' ELSE ' ' END)")


def s_step_symbol(st: str) -> str:
    return f"(CASE {st} WHEN 'completed' THEN '✓' WHEN 'in_progress' THEN '→' WHEN 'failed' THEN '✗' ELSE ' ' END)"


# ---------------------------------------------------------------------------
# Names, URLs, input kinds (FX-URL = pages.url, FX-LEDGER inputs)
# ---------------------------------------------------------------------------

BASE_URL = "https://fhir.example.org:8443"


def _url_variants(spark, sf_dir):
    """By page_id mod 4: 0 -> path and query only (relative),
    1 -> host replaced by ``torch:8080``, 2 -> unchanged, 3 -> host replaced
    by ``localhost``."""
    p = FX.table(spark, sf_dir, "pages")
    rel = F.regexp_replace("url", r"^[a-zA-Z]+://[^/]*", "")
    m = F.col("page_id") % 4
    v = (F.when(m == 0, rel).when(m == 1, F.concat(F.lit("http://torch:8080"), rel))
         .when(m == 2, F.col("url")).otherwise(F.concat(F.lit("http://localhost"), rel)))
    return p.select("page_id", "url", v.alias("raw_url"))


_SQL_URLS = """
urls AS (
  SELECT page_id, url, CASE page_id % 4
     WHEN 0 THEN regexp_replace(url, '^[a-zA-Z]+://[^/]*', '')
     WHEN 1 THEN 'http://torch:8080' || regexp_replace(url, '^[a-zA-Z]+://[^/]*', '')
     WHEN 2 THEN url
     ELSE 'http://localhost' || regexp_replace(url, '^[a-zA-Z]+://[^/]*', '') END AS raw_url
  FROM pages)"""


def s_path_base(p: str) -> str:
    t = f"regexp_replace({p}, '/+$', '')"
    return f"(CASE WHEN {p} = '' THEN '.' WHEN {t} = '' THEN '/' ELSE regexp_extract({t}, '([^/]*)$', 1) END)"


def s_url_to_name(u: str, strip: bool) -> str:
    x = f"regexp_replace({u}, '[?#].*$', '')" if strip else u
    b = s_path_base(x)
    n = f"(CASE WHEN {b} IN ('.', '/') THEN 'download.ndjson' ELSE {b} END)"
    return f"(CASE WHEN ends_with(lower({n}), '.ndjson') THEN {n} ELSE {n} || '.ndjson' END)"


@register("url_to_name", sql=with_ctes(_SQL_URLS, select=f"""
SELECT page_id, {s_url_to_name('url', False)} AS file_name, {s_url_to_name('url', True)} AS file_name_clean FROM urls"""))
def q_url_to_name(spark, sf_dir):
    u = _url_variants(spark, sf_dir)
    return u.select("page_id", X.url_to_name(F.col("url")).alias("file_name"),
                    X.url_to_name(F.col("url"), strip_query=True).alias("file_name_clean"))


@register("absolute_url", sql=with_ctes(_SQL_URLS, select=f"""
SELECT page_id, raw_url,
  CASE WHEN NOT (starts_with(raw_url, 'http://') OR starts_with(raw_url, 'https://')) THEN '{BASE_URL}' || raw_url
       WHEN regexp_extract(raw_url, '{X.URL_HOST_RE}', 1) IN ('torch', 'torch-proxy', 'localhost', '127.0.0.1')
       THEN 'https://fhir.example.org:8443' || regexp_extract(raw_url, '{X.URL_PATH_RE}', 1)
            || CASE WHEN regexp_extract(raw_url, '{X.URL_QUERY_RE}', 1) <> '' THEN '?' || regexp_extract(raw_url, '{X.URL_QUERY_RE}', 1) ELSE '' END
       ELSE raw_url END AS absolute_url
FROM urls"""))
def q_absolute_url(spark, sf_dir):
    u = _url_variants(spark, sf_dir)
    return u.select("page_id", "raw_url", X.absolute_url(F.col("raw_url"), BASE_URL).alias("absolute_url"))


@register("name_to_type", sql=with_ctes(_SQL_URLS, select="""
SELECT page_id, coalesce(nullif(regexp_extract(regexp_replace(n, '\\.ndjson$', ''), '^[_.\\-]*([^_.\\-]+)', 1), ''), 'Unknown') AS resource_type
FROM (SELECT page_id, regexp_replace(regexp_replace(url, '^[a-zA-Z]+://', ''), '[/?#=&]', '_', 'g') || '.ndjson' AS n FROM urls)"""))
def q_name_to_type(spark, sf_dir):
    from ndflow.sources.ndjson import name_to_type
    u = _url_variants(spark, sf_dir)
    n = F.concat(F.regexp_replace(F.regexp_replace("url", "^[a-zA-Z]+://", ""), "[/?#=&]", "_"), F.lit(".ndjson"))
    return u.select("page_id", name_to_type(n).alias("resource_type"))


@register("input_kind", sql=with_ctes(FX.SQL_LEDGER, select="""
SELECT job_id, CASE WHEN input_source IS NULL OR input_source = '' THEN NULL
  WHEN starts_with(input_source, '/') OR starts_with(input_source, './') THEN 'local_directory'
  WHEN (starts_with(input_source, 'http://') OR starts_with(input_source, 'https://'))
       AND (contains(input_source, '/fhir/extraction/') OR contains(input_source, '/fhir/result/')) THEN 'torch_result_url'
  WHEN starts_with(input_source, 'http://') OR starts_with(input_source, 'https://') THEN 'http_url'
  WHEN (ends_with(input_source, '.crtdl') OR ends_with(input_source, '.json')) AND ends_with(input_source, '.crtdl') THEN 'crtdl_file'
  ELSE 'local_directory' END AS input_kind
FROM ledger_jobs"""))
def q_input_kind(spark, sf_dir):
    j = FX.ledger_jobs(spark, sf_dir)
    src = F.col("input_source")
    is_dir = src.startswith("/") | src.startswith("./")
    return j.select("job_id", X.input_kind(src, is_dir, src.endswith(".crtdl")).alias("input_kind"))


# ---------------------------------------------------------------------------
# Errors, retry, backoff (FX-CALLS)
# ---------------------------------------------------------------------------

@register("status_class", sql=with_ctes(FX.SQL_CALLS, select=f"""
SELECT http_status, {s_transient('http_status')} AS transient,
       CASE WHEN {s_transient('http_status')} THEN 'transient' ELSE 'non_transient' END AS error_type,
       count(*) AS n
FROM calls GROUP BY http_status"""))
def q_status_class(spark, sf_dir):
    c = FX.call_log(spark, sf_dir)
    return (c.groupBy("http_status").agg(F.count(F.lit(1)).alias("n"))
            .select("http_status", X.is_transient_status(F.col("http_status")).alias("transient"),
                    X.http_error_type(F.col("http_status")).alias("error_type"), "n"))


@register("error_class", sql=with_ctes(FX.SQL_CALLS, select=f"""
SELECT http_status, message, {s_network('message')} AS is_network,
  CASE WHEN {s_network('message')} THEN 'network'
       WHEN contains(lower(message), 'no space left') OR contains(lower(message), 'disk full')
         OR contains(lower(message), 'permission denied') OR contains(lower(message), 'access denied') THEN 'filesystem'
       ELSE 'validation' END AS category,
  CASE WHEN {s_network('message')} THEN 'Network connectivity issue'
       WHEN contains(lower(message), 'no space left') OR contains(lower(message), 'disk full') THEN 'Insufficient disk space'
       WHEN contains(lower(message), 'permission denied') OR contains(lower(message), 'access denied') THEN 'Permission denied'
       ELSE 'An error occurred' END AS error_text,
  {s_network('message')} AS retryable,
  {s_step_error_type('http_status', 'message')} AS step_error_type,
  count(*) AS n
FROM calls WHERE http_status <> 200 GROUP BY http_status, message"""))
def q_error_class(spark, sf_dir):
    c = FX.call_log(spark, sf_dir).filter(F.col("http_status") != 200)
    g = c.groupBy("http_status", "message").agg(F.count(F.lit(1)).alias("n"))
    k = X.classify_error(F.col("message"))
    return g.select("http_status", "message", X.is_network_error(F.col("message")).alias("is_network"),
                    k["category"].alias("category"), k["message"].alias("error_text"),
                    k["retryable"].alias("retryable"),
                    X.step_error_type(F.col("http_status"), F.col("message")).alias("step_error_type"), "n")


@register("retry_outcomes", sql=with_ctes(FX.SQL_CALLS, select=f"""
SELECT call_id, attempt AS attempts,
  CASE WHEN success THEN 'succeeded' WHEN error_type = 'non_transient' THEN 'failed_non_transient'
       WHEN attempt >= {MAX_ATTEMPTS} THEN 'exhausted' ELSE 'retry_pending' END AS outcome,
  CASE WHEN NOT success THEN message END AS last_error,
  error_type AS last_error_type,
  CASE WHEN NOT success AND error_type = 'transient' AND attempt < {MAX_ATTEMPTS}
       THEN CAST(least({INITIAL_BACKOFF_MS} * pow(2, greatest(attempt - 1, 0)), {MAX_BACKOFF_MS}) AS BIGINT) END AS next_delay_ms
FROM (
  SELECT r.*, least(coalesce(p.first_terminal, p.n), {MAX_ATTEMPTS}) AS decided
  FROM (SELECT *, http_status = 200 AS success,
               CASE WHEN http_status = 200 THEN NULL ELSE {s_step_error_type('http_status', 'message')} END AS error_type,
               row_number() OVER (PARTITION BY call_id ORDER BY ts, seq) AS attempt
        FROM calls) r
  JOIN (SELECT call_id, count(*) AS n,
               min(CASE WHEN success OR error_type = 'non_transient' THEN attempt END) AS first_terminal
        FROM (SELECT call_id, http_status = 200 AS success,
                     CASE WHEN http_status = 200 THEN NULL ELSE {s_step_error_type('http_status', 'message')} END AS error_type,
                     row_number() OVER (PARTITION BY call_id ORDER BY ts, seq) AS attempt FROM calls)
        GROUP BY call_id) p ON r.call_id = p.call_id)
WHERE attempt = decided"""))
def q_retry_outcomes(spark, sf_dir):
    return retry_outcomes(FX.call_log(spark, sf_dir))


@register("backoff_schedule", sql="""
SELECT event_id, CAST(event_id % 8 - 1 AS INTEGER) AS attempt,
       CAST(least(1000 * pow(2, greatest(CAST(event_id % 8 - 1 AS INTEGER), 0)), 30000) AS BIGINT) AS backoff_ms,
       CAST(least((1 + event_id % 40) * 2, 30) AS BIGINT) AS next_poll_s
FROM events""")
def q_backoff_schedule(spark, sf_dir):
    e = FX.table(spark, sf_dir, "events")
    att = (F.col("event_id") % 8 - 1).cast("int")
    return e.select("event_id", att.alias("attempt"),
                    X.backoff_ms(att, INITIAL_BACKOFF_MS, MAX_BACKOFF_MS).alias("backoff_ms"),
                    X.next_poll_interval(1 + F.col("event_id") % 40, 30).cast("long").alias("next_poll_s"))


# ---------------------------------------------------------------------------
# Text formats
# ---------------------------------------------------------------------------

@register("format_bytes", sql=f"""
SELECT o_orderkey, b, {s_format_bytes('b')} AS text, {s_format_bytes('b', False)} AS text_cli
FROM (SELECT o_orderkey, CAST(trunc(o_totalprice * pow(10, o_orderkey % 10)) AS BIGINT) AS b FROM orders)""")
def q_format_bytes(spark, sf_dir):
    o = FX.table(spark, sf_dir, "orders")
    b = (F.col("o_totalprice") * F.pow(F.lit(10.0), (F.col("o_orderkey") % 10).cast("double"))).cast("long")
    x = o.select("o_orderkey", b.alias("b"))
    return x.select("o_orderkey", "b", X.format_bytes(F.col("b")).alias("text"),
                    X.format_bytes(F.col("b"), with_tb=False).alias("text_cli"))


@register("format_durations", sql=f"""
SELECT event_id, {s_format_eta('us')} AS eta_text, {s_format_duration('us')} AS duration_text,
       {s_format_age('us')} AS age_text, {s_format_duration('small_us')} AS short_text
FROM (SELECT event_id, epoch_us(ts) - epoch_us(date_trunc('day', ts)) AS us,
             CAST(trunc(value * 1000) AS BIGINT) AS small_us FROM events)""")
def q_format_durations(spark, sf_dir):
    e = FX.table(spark, sf_dir, "events")
    us = W.now_us_of(F.col("ts")) - W.now_us_of(F.date_trunc("day", F.col("ts")))
    x = e.select("event_id", us.alias("us"), (F.col("value") * 1000).cast("long").alias("small_us"))
    return x.select("event_id", X.format_eta(F.col("us")).alias("eta_text"),
                    X.format_duration(F.col("us")).alias("duration_text"),
                    X.format_age(F.col("us")).alias("age_text"),
                    X.format_duration(F.col("small_us")).alias("short_text"))


# ---------------------------------------------------------------------------
# Run ledger (FX-LEDGER)
# ---------------------------------------------------------------------------

AS_OF = "2000-01-01 00:00:00"

_SQL_SSUM = """
ssum AS (
  SELECT job_id, count(*) AS n_steps,
    coalesce(max({'pos': pos, 'step_id': step_id, 'name': name, 'status': status, 'retry_count': retry_count}) FILTER (WHERE status <> 'pending'),
             min({'pos': pos, 'step_id': step_id, 'name': name, 'status': status, 'retry_count': retry_count})) AS cur,
    min({'pos': pos, 'step_id': step_id, 'name': name, 'status': status, 'retry_count': retry_count}) FILTER (WHERE status = 'pending') AS np,
    bool_and(status = 'completed') AS all_done,
    bool_or(name IN ('torch', 'local_import', 'http_import') AND status = 'completed') AS import_done
  FROM ledger_steps GROUP BY job_id)"""


def _ledger(spark, sf_dir):
    return FX.ledger_jobs(spark, sf_dir), FX.ledger_steps(spark, sf_dir)


@register("job_list", sql=with_ctes(FX.SQL_LEDGER, select=f"""
SELECT j.job_id, j.status, {s_job_symbol('j.status')} AS symbol, j.current_step,
       j.total_files AS files, coalesce((SELECT arg_min(retry_count, (pos, retry_count)) FROM ledger_steps s
         WHERE s.job_id = j.job_id AND s.name = j.current_step), 0) AS retries,
       {s_format_age("(epoch_us(TIMESTAMP '" + AS_OF + "') - epoch_us(j.created_at))")} AS age,
       strftime(j.created_at, '%Y-%m-%d %H:%M:%S') AS created_at
FROM ledger_jobs j"""))
def q_job_list(spark, sf_dir):
    jobs, steps = _ledger(spark, sf_dir)
    return L.job_list(jobs, steps, F.lit(AS_OF).cast("timestamp_ntz")).orderBy(F.desc("created_at"), "job_id")


@register("jobs_by_status", sql=with_ctes(FX.SQL_LEDGER, select="""
SELECT status, count(*) AS n_jobs, CAST(sum(total_files) AS BIGINT) AS files FROM ledger_jobs GROUP BY status"""))
def q_jobs_by_status(spark, sf_dir):
    jobs = FX.ledger_jobs(spark, sf_dir)
    return jobs.groupBy("status").agg(F.count(F.lit(1)).alias("n_jobs"), F.sum("total_files").cast("long").alias("files"))


@register("jobs_complete", sql=with_ctes(FX.SQL_LEDGER, _SQL_SSUM, select="""
SELECT j.job_id, coalesce(s.all_done AND s.n_steps > 0, false) AS complete
FROM ledger_jobs j LEFT JOIN ssum s ON j.job_id = s.job_id"""))
def q_jobs_complete(spark, sf_dir):
    return L.jobs_complete(*_ledger(spark, sf_dir))


@register("next_pending", sql=with_ctes(FX.SQL_LEDGER, _SQL_SSUM, select="""
SELECT j.job_id, s.np.name AS next_pending_step FROM ledger_jobs j LEFT JOIN ssum s ON s.job_id = j.job_id"""))
def q_next_pending(spark, sf_dir):
    jobs, steps = _ledger(spark, sf_dir)
    return jobs.select("job_id").join(L.step_summary(steps).select("job_id", "next_pending_step"), "job_id", "left")


@register("next_step", sql=with_ctes(FX.SQL_LEDGER, select="""
SELECT job_id, step_id, name, lead(name) OVER (PARTITION BY job_id ORDER BY pos, step_id) AS next_step
FROM ledger_steps"""))
def q_next_step(spark, sf_dir):
    _, steps = _ledger(spark, sf_dir)
    return L.next_steps(steps)


@register("blocked_steps", sql=with_ctes(FX.SQL_LEDGER, select="""
SELECT job_id, step_id, name, 'import' AS blocked_by FROM ledger_steps s
WHERE name IN ('dimp', 'validation', 'csv_conversion', 'parquet_conversion')
  AND NOT EXISTS (SELECT 1 FROM ledger_steps i WHERE i.job_id = s.job_id
                  AND i.name IN ('torch', 'local_import', 'http_import') AND i.status = 'completed')"""))
def q_blocked_steps(spark, sf_dir):
    _, steps = _ledger(spark, sf_dir)
    return L.blocked_steps(steps)


@register("resume_point", sql=with_ctes(FX.SQL_LEDGER, _SQL_SSUM, select="""
SELECT j.job_id,
  CASE WHEN s.cur IS NULL OR j.status = 'completed' THEN NULL WHEN s.cur.status <> 'completed' THEN s.cur.name ELSE nx.next_step END AS resume_step,
  CASE WHEN s.cur IS NULL OR j.status = 'completed' THEN 'done' WHEN s.cur.status = 'failed' THEN 'retry'
       WHEN s.cur.status <> 'completed' THEN 'run' WHEN nx.next_step IS NULL THEN 'done'
       WHEN nx.next_step IN ('dimp', 'validation', 'csv_conversion', 'parquet_conversion') AND NOT coalesce(s.import_done, false) THEN 'blocked'
       ELSE 'run' END AS action
FROM ledger_jobs j LEFT JOIN ssum s ON j.job_id = s.job_id
LEFT JOIN (SELECT job_id, step_id, lead(name) OVER (PARTITION BY job_id ORDER BY pos, step_id) AS next_step FROM ledger_steps) nx
  ON nx.job_id = j.job_id AND nx.step_id = s.cur.step_id"""))
def q_resume_point(spark, sf_dir):
    return L.resume_point(*_ledger(spark, sf_dir))


_SQL_STEP_LINE = f"""
{s_step_symbol('status')} || ' ' || name || ' - ' || status
 || CASE WHEN status IN ('completed', 'in_progress') THEN ' (' || CAST(files_processed AS VARCHAR) || ' files'
         || CASE WHEN bytes_processed > 0 THEN ', ' || {s_format_bytes('bytes_processed', False)} ELSE '' END || ')' ELSE '' END
 || CASE WHEN retry_count > 0 THEN ' [' || CAST(retry_count AS VARCHAR) || ' retries]' ELSE '' END
 || CASE WHEN error_message IS NOT NULL THEN ' | Error: ' || error_message ELSE '' END"""


@register("job_status", sql=with_ctes(FX.SQL_LEDGER, select=f"""
SELECT j.job_id,
  'Status: ' || j.status || ' | Current Step: ' || coalesce(j.current_step, '') || ' | Files: ' || CAST(j.total_files AS VARCHAR)
    || CASE WHEN j.error_message IS NOT NULL THEN ' | Error: ' || j.error_message ELSE '' END AS summary,
  coalesce(t.steps_text, '') AS steps_text
FROM ledger_jobs j
LEFT JOIN (SELECT job_id, string_agg({_SQL_STEP_LINE}, chr(10) ORDER BY pos, step_id) AS steps_text
           FROM ledger_steps GROUP BY job_id) t ON t.job_id = j.job_id"""))
def q_job_status(spark, sf_dir):
    return L.job_status(*_ledger(spark, sf_dir))


@register("ledger_state", sql=with_ctes(FX.SQL_STEP_EVENTS, select="""
SELECT job_id, step_id, arg_max(to_status, (ts, seq)) AS status,
       count(*) FILTER (WHERE event = 'retry') AS retries, count(*) AS n_events
FROM events_l GROUP BY job_id, step_id"""))
def q_ledger_state(spark, sf_dir):
    return L.ledger_state(FX.step_events(spark, sf_dir))


@register("bad_transitions", sql=with_ctes(FX.SQL_STEP_EVENTS, select="""
SELECT job_id, step_id, seq, from_status, to_status FROM (
  SELECT job_id, step_id, seq, to_status, lag(to_status) OVER (PARTITION BY job_id, step_id ORDER BY ts, seq) AS from_status
  FROM events_l)
WHERE from_status IS NOT NULL AND from_status <> to_status
  AND NOT ((from_status = 'pending' AND to_status = 'in_progress') OR (from_status = 'in_progress' AND to_status IN ('completed', 'failed'))
           OR (from_status = 'failed' AND to_status = 'in_progress'))"""))
def q_bad_transitions(spark, sf_dir):
    return L.bad_transitions(FX.step_events(spark, sf_dir))


@register("step_validity", sql=with_ctes(FX.SQL_LEDGER, select="""
SELECT job_id, step_id,
  CASE WHEN name NOT IN ('torch', 'local_import', 'http_import', 'dimp', 'validation', 'csv_conversion', 'parquet_conversion') THEN 'invalid step name: ' || name
       WHEN status NOT IN ('pending', 'in_progress', 'completed', 'failed') THEN 'invalid step status: ' || status
       WHEN retry_count < 0 THEN 'retry_count cannot be negative'
       WHEN files_processed < 0 THEN 'files_processed cannot be negative'
       WHEN bytes_processed < 0 THEN 'bytes_processed cannot be negative'
       WHEN status IN ('in_progress', 'completed') AND started_at IS NULL THEN 'started_at must be set when step is in_progress or completed'
       WHEN status = 'completed' AND completed_at IS NULL THEN 'completed_at must be set when step is completed'
  END AS step_error
FROM ledger_steps"""))
def q_step_validity(spark, sf_dir):
    _, steps = _ledger(spark, sf_dir)
    return steps.select("job_id", "step_id", L.step_error(steps).alias("step_error"))


@register("job_validity", sql=with_ctes(FX.SQL_LEDGER, select=f"""
SELECT j.job_id,
  CASE WHEN coalesce(j.job_id, '') = '' THEN 'job_id is required'
       WHEN NOT regexp_matches(j.job_id, '{L.UUID_RE}') THEN 'invalid job_id: must be a valid UUID'
       WHEN coalesce(j.input_source, '') = '' THEN 'input_source is required'
       WHEN j.input_type = 'http_url' AND NOT (starts_with(j.input_source, 'http://') OR starts_with(j.input_source, 'https://'))
            THEN 'input_source must be a valid HTTP(S) URL when input_type is http_url'
       WHEN j.input_type NOT IN ('local_directory', 'http_url', 'crtdl_file', 'torch_result_url') THEN 'invalid input_type: ' || j.input_type
       WHEN j.status NOT IN ('pending', 'in_progress', 'completed', 'failed') THEN 'invalid status: ' || j.status
       WHEN NOT EXISTS (SELECT 1 FROM ledger_steps s WHERE s.job_id = j.job_id AND s.name = j.current_step) THEN 'current_step not found in job steps'
       WHEN j.total_files < 0 THEN 'total_files cannot be negative'
       WHEN j.total_bytes < 0 THEN 'total_bytes cannot be negative'
  END AS job_error
FROM ledger_jobs j"""))
def q_job_validity(spark, sf_dir):
    return L.job_error(*_ledger(spark, sf_dir))


# ---------------------------------------------------------------------------
# Progress (FX-PROGRESS: window widened to 12 h)
# ---------------------------------------------------------------------------

PROGRESS_WINDOW_S = 12 * 3600


def _samples(spark, sf_dir):
    return FX.progress_samples(spark, sf_dir).withColumn("n", F.col("items"))


@register("eta_window", sql=with_ctes(FX.SQL_PROGRESS, select=f"""
SELECT run_id, n, items, window_samples, avg_sec_per_item, 1.0 / avg_sec_per_item AS items_per_sec,
       CASE WHEN window_samples < 2 THEN NULL WHEN total_items - items <= 0 THEN 0.0
            ELSE (total_items - items) * avg_sec_per_item END AS eta_sec,
       window_samples >= 2 AND (total_items - items <= 0 OR avg_sec_per_item IS NOT NULL) AS eta_valid
FROM (
  SELECT run_id, items AS n, items, CAST(len(w) AS INTEGER) AS window_samples, total_items,
         CASE WHEN len(w) >= 2 AND items - w[1].items > 0 AND (epoch_us(ts) - epoch_us(w[1].ts)) / 1e6 > 0
              THEN ((epoch_us(ts) - epoch_us(w[1].ts)) / 1e6) / (items - w[1].items) END AS avg_sec_per_item
  FROM (
    SELECT run_id, ts, items, max(items) OVER (PARTITION BY run_id) AS total_items,
           list_filter(list(struct_pack(ts := ts, items := items)) OVER (PARTITION BY run_id ORDER BY ts, seq
                       ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
                       lambda s: epoch_us(s.ts) > epoch_us(ts) - {PROGRESS_WINDOW_S * 1_000_000}) AS w
    FROM progress))"""))
def q_eta_window(spark, sf_dir):
    return W.eta_window(_samples(spark, sf_dir), window_seconds=PROGRESS_WINDOW_S)


@register("instant_rate", sql=with_ctes(FX.SQL_PROGRESS, select="""
SELECT run_id, n, coalesce(last_value(ir IGNORE NULLS) OVER w, 0.0) AS items_per_sec,
       coalesce(last_value(br IGNORE NULLS) OVER w, 0.0) AS bytes_per_sec
FROM (
  SELECT run_id, items AS n, ts, seq,
    CASE WHEN dt > 0 THEN (items - p_items) / dt END AS ir,
    CASE WHEN dt > 0 THEN (bytes - p_bytes) / dt END AS br
  FROM (SELECT *, lag(items) OVER o AS p_items, lag(bytes) OVER o AS p_bytes,
               (epoch_us(ts) - epoch_us(lag(ts) OVER o)) / 1e6 AS dt
        FROM progress WINDOW o AS (PARTITION BY run_id ORDER BY ts, seq)))
WINDOW w AS (PARTITION BY run_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def q_instant_rate(spark, sf_dir):
    return W.instant_rate(_samples(spark, sf_dir))


@register("average_rate", sql=with_ctes(FX.SQL_PROGRESS, select="""
SELECT run_id, items AS n,
  CASE WHEN el > 0 THEN items / el ELSE 0.0 END AS avg_items_per_sec,
  CASE WHEN el > 0 THEN bytes / el ELSE 0.0 END AS avg_bytes_per_sec,
  CASE WHEN total = 0 THEN 0.0 ELSE items / total * 100 END AS percent
FROM (SELECT *, (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY run_id))) / 1e6 AS el,
             max(items) OVER (PARTITION BY run_id) AS total FROM progress)"""))
def q_average_rate(spark, sf_dir):
    return W.average_rate(_samples(spark, sf_dir))


@register("throughput_summary", sql=with_ctes(FX.SQL_PROGRESS, select=f"""
SELECT run_id, CAST(items AS VARCHAR) || ' items (' || {s_format_bytes('bytes')} || ') in ' || {s_format_duration('el_us')}
       || ' | Avg: ' || {s_items_rate('ir')} || ', ' || {s_bytes_rate('br')} AS summary
FROM (SELECT run_id, items, bytes, el_us,
             CASE WHEN el_us / 1e6 > 0 THEN items / (el_us / 1e6) ELSE 0.0 END AS ir,
             CASE WHEN el_us / 1e6 > 0 THEN bytes / (el_us / 1e6) ELSE 0.0 END AS br
      FROM (SELECT run_id, arg_max(items, (ts, seq)) AS items, arg_max(bytes, (ts, seq)) AS bytes,
                   epoch_us(max(ts)) - epoch_us(min(ts)) AS el_us FROM progress GROUP BY run_id))"""))
def q_throughput_summary(spark, sf_dir):
    return W.throughput_summary(_samples(spark, sf_dir))
