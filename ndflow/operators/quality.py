"""Data-quality operators: chunk contract, manifest validity, query-document
check, missing fields and dangling references (P6, P8, P9, P11, P12, J4).

Rules are ordered ``when`` chains that return the first failing rule, so a
whole table is checked in one narrow pass; cross-reference checks are one
anti join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ndflow.functions.jsonfn import RFC3339_RE, is_one_value


# Rule messages, in the order the rules are checked.
CHUNK_RULES = {
    "bundle": "resourceType must be Bundle",
    "type": "type must be document or collection",
    "id": "id must match <id>-chunk-<n>",
    "entries": "entry must be non-empty",
    "total": "total must equal entry count",
    "timestamp": "timestamp must be RFC 3339",
    "entry_type": "entry resource needs a resourceType",
}
MANIFEST_RULES = {
    "extension": "file_name must end with .ndjson",
    "path": "unsafe file_path detected: ",
    "size": "file_size must be greater than 0",
    "lines": "line_count cannot be negative",
    "step": "invalid source_step: ",
}
QUERY_DOC_RULES = {
    "empty": "file is empty",
    "json": "not valid JSON",
    "parameters": "uses FHIR Parameters format",
    "both": "missing both 'cohortDefinition' and 'dataExtraction' keys",
    "cohort": "missing 'cohortDefinition' key",
    "extraction": "missing 'dataExtraction' key",
    "cohort_object": "'cohortDefinition' must be an object",
    "inclusion": "cohortDefinition missing 'inclusionCriteria'",
    "extraction_object": "'dataExtraction' must be an object",
    "groups": "dataExtraction missing 'attributeGroups'",
}


def _jtype(v: Column, path: str) -> Column:
    f = F.try_variant_get(v, path, "variant")
    return F.when(f.isNotNull(), F.schema_of_variant(f))


def _with(value: Column, body) -> Column:
    """``body`` of a value that is made once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def chunk_contract_error(doc: Column) -> Column:
    """First rule a chunk document breaks, NULL if it meets the contract.
    A text that is not exactly one JSON value is no Bundle.  Fields are read
    one by one, so the document's size does not matter."""
    def header(d, h):
        return (F.when(F.coalesce(h["resourceType"], F.lit("")) != "Bundle",
                       CHUNK_RULES["bundle"])
                .when(~F.coalesce(h["type"], F.lit("")).isin("document", "collection"),
                      CHUNK_RULES["type"])
                .when(~F.coalesce(h["id"], F.lit("")).rlike(r"^.+-chunk-[0-9]+$"),
                      CHUNK_RULES["id"])
                .otherwise(_with(F.get_json_object(d, "$.entry"), lambda t: _with(
                    F.coalesce(F.json_array_length(t), F.lit(0)), lambda n: entries(h, t, n)))))

    def entries(h, text, n):
        total, ts = h["total"], h["timestamp"]
        rt_list = F.transform(F.from_json(text, "array<string>"), lambda e: F.get_json_object(e, "$.resource.resourceType"))
        return (F.when(n == 0, CHUNK_RULES["entries"])
                .when(total.isNotNull() & (total != n), CHUNK_RULES["total"])
                .when(ts.isNotNull() & ~ts.rlike(RFC3339_RE), CHUNK_RULES["timestamp"])
                .when(~F.forall(rt_list, lambda t: F.coalesce(t, F.lit("")) != ""),
                      CHUNK_RULES["entry_type"]))

    fields = "resourceType string, type string, id string, total long, timestamp string"
    return _with(doc, lambda v: _with(F.when(is_one_value(v), v), lambda d: _with(F.from_json(d, fields), lambda h: header(d, h))))


# Known step names (manifest ``source_step`` and ledger).
STEP_NAMES = ("torch", "local_import", "http_import", "dimp", "validation", "csv_conversion",
              "parquet_conversion")


def safe_path(path: Column) -> Column:
    """Whether a relative path stays below its root: cleaned of ``.``, empty and
    ``name/..`` parts, it must not be absolute nor begin with ``..``."""
    part = F.filter(F.split(path, "/"), lambda x: (x != "") & (x != "."))
    up = F.aggregate(part, F.array().cast("array<string>"), lambda a, x: F.when(
        (x == "..") & (F.size(a) > 0) & (F.get(a, F.size(a) - 1) != ".."), F.slice(a, F.lit(1), F.size(a) - 1)).otherwise(F.concat(a, F.array(x))))
    return ~path.startswith("/") & ~F.coalesce(F.get(up, F.lit(0)).startswith(".."), F.lit(False))


def manifest_error(file_name: Column, file_path: Column, file_size: Column, line_count: Column,
                   source_step: Column) -> Column:
    """First failing manifest rule (extension, safe path, size, lines,
    step)."""
    unsafe = ~safe_path(file_path)
    return (F.when(~F.lower(file_name).endswith(".ndjson"), MANIFEST_RULES["extension"])
            .when(unsafe, F.concat(F.lit(MANIFEST_RULES["path"]), file_path))
            .when(file_size <= 0, MANIFEST_RULES["size"])
            .when(line_count < 0, MANIFEST_RULES["lines"])
            .when(~source_step.isin(*STEP_NAMES), F.concat(F.lit(MANIFEST_RULES["step"]), source_step)))


def query_doc_error(doc: Column) -> Column:
    """Cohort-query document check; first failure, NULL when valid.  (A
    query is a small parameter document; beyond 16 MiB it is not valid.)"""
    v = F.when(is_one_value(doc), F.try_parse_json(doc))
    has = lambda p: F.try_variant_get(v, p, "variant").isNotNull()
    return (F.when(F.length(doc) == 0, QUERY_DOC_RULES["empty"])
            .when(v.isNull() | ~F.coalesce(F.schema_of_variant(v), F.lit("")).startswith("OBJECT"), QUERY_DOC_RULES["json"])
            .when(F.try_variant_get(v, "$.resourceType", "string") == "Parameters", QUERY_DOC_RULES["parameters"])
            .when(~has("$.cohortDefinition") & ~has("$.dataExtraction"),
                  QUERY_DOC_RULES["both"])
            .when(~has("$.cohortDefinition"), QUERY_DOC_RULES["cohort"])
            .when(~has("$.dataExtraction"), QUERY_DOC_RULES["extraction"])
            .when(~_jtype(v, "$.cohortDefinition").startswith("OBJECT"), QUERY_DOC_RULES["cohort_object"])
            .when(~has("$.cohortDefinition.inclusionCriteria"), QUERY_DOC_RULES["inclusion"])
            .when(~_jtype(v, "$.dataExtraction").startswith("OBJECT"), QUERY_DOC_RULES["extraction_object"])
            .when(~has("$.dataExtraction.attributeGroups"), QUERY_DOC_RULES["groups"]))


def missing_fields(df: DataFrame, group_col: str, required: list[str]) -> DataFrame:
    """Per group and required field, rows where the field is NULL or
    empty.  One pass: a single aggregate with one ``count_if`` per field,
    then an unpivot of the small result."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in required:
        aggs.append(F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == "")).alias(f"m_{c}"))
    g = df.groupBy(group_col).agg(*aggs)
    stack = ", ".join(f"'{c}', m_{c}" for c in required)
    return g.selectExpr(group_col, "n_rows", f"stack({len(required)}, {stack}) AS (field, n_missing)")


def dangling_references(refs: DataFrame, targets: DataFrame) -> DataFrame:
    """References ``(ref_type, ref_id, ...)`` with no target
    ``(resource_type, resource_id)``: one anti join (shuffle on the key; AQE
    turns it into a broadcast when the target side is measured small)."""
    t = targets.select(F.col("resource_type").alias("ref_type"), F.col("resource_id").alias("ref_id")).distinct()
    return refs.join(t, ["ref_type", "ref_id"], "left_anti")
