"""Registry of named queries: Spark builder + DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame``.  The oracle is an equivalent
SQL text over the driver's tables (``None`` when the operator is not
expressible in SQL; the driver then checks row counts only).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def with_ctes(*ctes: str, select: str) -> str:
    """Join CTE bodies (each ``name AS (...)``, comma lists allowed) and a
    final SELECT into one statement."""
    body = ",\n".join(c.strip().rstrip(",") for c in ctes)
    return f"WITH RECURSIVE {body}\n{select}"


# --- SQL helpers shared by the oracles (DuckDB dialect) ---------------------

def sql_json_size(e: str) -> str:
    """DuckDB twin of ``jsonfn.json_size`` (escape_html=True)."""
    return (f"CAST(strlen({e}) + 5 * (length({e}) - length(translate({e}, '<>&', '')))"
            f" + 3 * (length({e}) - length(translate({e}, chr(8232) || chr(8233), ''))) AS BIGINT)")


def sql_header(id_e: str, type_e: str, ts_e: str, total_e: str | None = None) -> str:
    """DuckDB twin of ``bundle._header``: sorted keys, NULL fields left out."""
    total = "" if total_e is None else \
        f" || CASE WHEN {total_e} IS NOT NULL THEN '\"total\":' || CAST({total_e} AS VARCHAR) || ',' ELSE '' END"
    return ("('{\"entry\":[],\"id\":' || CAST(to_json(" + id_e + ") AS VARCHAR) || ',\"resourceType\":\"Bundle\",'"
            f" || CASE WHEN {ts_e} IS NOT NULL THEN '\"timestamp\":' || CAST(to_json({ts_e}) AS VARCHAR) || ',' ELSE '' END"
            f"{total} || '\"type\":' || CAST(to_json({type_e}) AS VARCHAR) || '}}')")


def sql_splice(header: str, joined: str) -> str:
    return f"('{{\"entry\":[' || {joined} || ']' || substr({header}, 12))"


SQL_RFC3339_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def sql_rfc3339(ts: str) -> str:
    return (f"CASE WHEN regexp_matches({ts}, '{SQL_RFC3339_RE}') AND "
            f"try_strptime(regexp_replace({ts}, '(\\.\\d+)?(Z|[+-]\\d{{2}}:\\d{{2}})$', ''), '%Y-%m-%dT%H:%M:%S') IS NOT NULL "
            f"THEN regexp_replace(regexp_replace({ts}, '\\.\\d+', ''), '[+-]00:00$', 'Z') END")
