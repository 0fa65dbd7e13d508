"""De-identification.

Rules are native expressions: a keyed hash for ids, the same hash on both
sides of ``Type/id`` references so links still join (H22), and a rule table
``column -> action`` compiled to column expressions over flattened
resources; the nested document is rebuilt by ``to_json(struct(...))`` from a
template.  An external de-identifier stays possible through ``external``
(``mapInPandas``, Arrow batches).
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PSEUDONYM_HEX = 32

_KEYS: dict = {}


def key_column(secret: str | Column) -> Column:
    """The key as a one-row scalar subquery: it is bound when the query runs
    and does not appear as a literal in plans or logs.  Inside array functions,
    where Spark takes no subquery, put it in a column first and pass that."""
    if isinstance(secret, Column):
        return secret
    spark = SparkSession.active()
    at = (id(spark), secret)
    if at not in _KEYS or _KEYS[at].sparkSession is not spark:
        _KEYS[at] = spark.createDataFrame([(secret + ":",)], "k string")
    return _KEYS[at].scalar()


def pseudonym(resource_type: Column, resource_id: Column, secret: str | Column, n: int = PSEUDONYM_HEX) -> Column:
    """Keyed, consistent pseudonym of ``Type/id``: the first ``n`` hex
    digits of sha256(secret ':' Type '/' id); 32 digits keep 10^11 resources
    apart."""
    return F.substring(F.sha2(F.concat(key_column(secret), resource_type, F.lit("/"), resource_id), 256), 1, n)


# Reference shapes - [base/]Type/id[/_history/version] and
# urn:uuid: or urn:oid: names.
REFERENCE_RE = r"^((?:[A-Za-z][A-Za-z0-9+.\-]*://[^?#]*/)?)([A-Za-z]+)/([^/?#]+)((?:/_history/[^/?#]+)?)$"
URN_RE = r"^(urn:(?:uuid|oid)):(.+)$"


def pseudonymize_reference(ref: Column, secret: str | Column, n: int = PSEUDONYM_HEX) -> Column:
    """The id in a reference or ``fullUrl`` becomes the pseudonym that its
    resource gets: relative, absolute and versioned references keep their base
    and version; ``urn:uuid:x`` maps alike wherever it stands; other text is
    unchanged."""
    base, t, i, version = (F.regexp_extract(ref, REFERENCE_RE, g) for g in (1, 2, 3, 4))
    urn, name = F.regexp_extract(ref, URN_RE, 1), F.regexp_extract(ref, URN_RE, 2)
    return (F.when(t != "", F.concat(base, t, F.lit("/"), pseudonym(t, i, secret, n), version))
            .when(urn != "", F.concat(urn, F.lit(":"), pseudonym(urn, name, secret, n))).otherwise(ref))


# The actions a rule table may use.
ACTIONS = ("keep", "drop", "pseudonym", "year", "prefix3", "record_number")


def apply_rules(df: DataFrame, rules: dict[str, str], resource_type: str, secret: str) -> DataFrame:
    """D3: compile ``{column: action}`` into one projection.  Columns without
    a rule are dropped (unknown fields never leak)."""
    out = []
    for c, action in rules.items():
        col = F.col(c)
        if action == "keep":
            e = col
        elif action == "drop":
            continue
        elif action == "pseudonym":
            e = pseudonym(F.lit(resource_type), col, secret)
        elif action == "year":
            e = F.substring(col, 1, 4)
        elif action == "prefix3":
            e = F.concat(F.substring(col, 1, 3), F.lit("**"))
        elif action == "record_number":
            e = F.concat(F.lit("MRN-"), pseudonym(F.lit(resource_type + "-mrn"), col, secret))
        else:
            raise ValueError(f"unknown action {action!r}; use one of {ACTIONS}")
        out.append(e.alias(c))
    return df.select(*out)


# Security labels put on de-identified resources and bundles.
SECURITY_TAGS = [("REDACTED", "redacted"), ("CRYTOHASH", "cryptographic hash function"),
                 ("GENERALIZED", "exact value is replaced with a general value"), ("PSEUDED", "pseudonymized")]
SECURITY_SYSTEM = "http://terminology.hl7.org/CodeSystem/v3-ObservationValue"


def security_meta() -> Column:
    """``meta.security`` list as a literal array of structs (sorted keys)."""
    return F.struct(F.array(*[F.struct(F.lit(code).alias("code"), F.lit(disp).alias("display"),
                                       F.lit(SECURITY_SYSTEM).alias("system"))
                              for code, disp in SECURITY_TAGS]).alias("security"))


def rebuild(template) -> Column:
    """Nested JSON shape from a template: dict -> struct (keys as given, so
    pass them sorted), one-element list -> array of that shape, str -> column
    name, Column -> itself."""
    if isinstance(template, Column):
        return template
    if isinstance(template, str):
        return F.col(template)
    if isinstance(template, list):
        return F.array(rebuild(template[0]))
    return F.struct(*[rebuild(v).alias(k) for k, v in template.items()])


def pseudonym_map(resources: DataFrame, secret: str, prefix_len: int = 2) -> DataFrame:
    """Distinct ``(resource_type, resource_id)`` with the keyed pseudonym
    and a sequential pseudonym (``PA_00001`` style, in id order per type; more
    digits when five are not enough).

    Ids are numbered through sampled id ranges, so a large type is spread over
    all tasks whatever its ids look like."""
    from ndflow.plans.seq import range_row_number
    d = resources.select("resource_type", "resource_id").distinct()
    n = range_row_number(d, ["resource_type"], "resource_id", "n")
    num = F.col("n").cast("string")
    return n.select("resource_type", "resource_id",
                    pseudonym(F.col("resource_type"), F.col("resource_id"), secret).alias("pseudonym"),
                    F.concat(F.upper(F.substring("resource_type", 1, prefix_len)), F.lit("_"),
                             F.when(F.length(num) < 5, F.lpad(num, 5, "0")).otherwise(num)).alias("sequential"))


@dataclass(frozen=True)
class Retry:
    """How a call is tried again (D6): network-type failures
    (``ConnectionError``, ``TimeoutError``, or any exception with ``transient =
    True``) up to ``max_attempts`` times with capped exponential backoff; other
    failures stop at once."""

    max_attempts: int = 5
    initial_ms: int = 1000
    max_ms: int = 30000

    def call(self, work: Callable):
        """``(ok, error kind, error, attempts, result)``; never raises."""
        attempts = 0
        while True:
            attempts += 1
            try:
                return True, None, None, attempts, work()
            except Exception as e:  # noqa: BLE001 - classified and kept as a row
                passing = isinstance(e, (ConnectionError, TimeoutError)) or bool(getattr(e, "transient", False))
                if passing and attempts < self.max_attempts:
                    time.sleep(min(self.initial_ms * 2 ** (attempts - 1), self.max_ms) / 1000.0)
                    continue
                return False, "transient" if passing else "non_transient", f"{type(e).__name__}: {e}", attempts, None


def external(df: DataFrame, fn: Callable[[dict], dict], doc_col: str = "value",
             key_col: str = "src_key", max_attempts: int = 5, initial_ms: int = 1000,
             max_ms: int = 30000) -> DataFrame:
    """Run a document-in, document-out de-identifier on every row through
    Arrow batches, tried again as ``Retry`` says.  Output ``(key, ok,
    error_type, error, attempts, value)``: a failing document becomes a row with
    ``ok = false`` instead of failing the job.  Batch size follows
    ``spark.sql.execution.arrow.maxRecordsPerBatch``."""
    import pandas as pd

    retry = Retry(max_attempts, initial_ms, max_ms)

    def one(doc: str):
        return retry.call(lambda: json.dumps(fn(json.loads(doc)), sort_keys=True, separators=(",", ":"), ensure_ascii=False))

    def run(batches):
        for pdf in batches:
            res = [one(d) for d in pdf[doc_col]]
            cols = list(zip(*res)) if res else [[], [], [], [], []]
            yield pd.DataFrame({key_col: pdf[key_col], "ok": cols[0], "error_type": cols[1], "error": cols[2],
                                "attempts": cols[3], "value": cols[4]})

    key_type = dict(df.dtypes)[key_col]
    schema = f"{key_col} {key_type}, ok boolean, error_type string, error string, attempts int, value string"
    return df.select(key_col, doc_col).mapInPandas(run, schema)
