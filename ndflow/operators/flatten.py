"""Flatten JSON resources into typed columns, one frame per resource type
(F1, the input of the CSV and Parquet conversions K4/K5)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

# The Patient paths the pipeline extracts.
PATIENT_PATHS = {
    "id": ("$.id", "string"),
    "family": ("$.name[0].family", "string"),
    "given": ("$.name[0].given[0]", "string"),
    "birth_date": ("$.birthDate", "string"),
    "gender": ("$.gender", "string"),
    "country": ("$.address[0].country", "string"),
    "postal_code": ("$.address[0].postalCode", "string"),
    "mrn": ("$.identifier[0].value", "string"),
    "phone": ("$.telecom[0].value", "string"),
}

ENCOUNTER_PATHS = {
    "id": ("$.id", "string"),
    "status": ("$.status", "string"),
    "period": ("$.period", "string"),
    "subject": ("$.subject.reference", "string"),
}


def flatten(lines: DataFrame, paths: dict[str, tuple[str, str]], resource_type: str | None = None,
            value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One typed column per ``name -> (json path, type)``, read from one VARIANT
    of the value.  A value beyond the VARIANT limit is read path by path.
    ``resource_type`` keeps the rows of one type.  An ``array<...>`` type keeps
    every element of a path; a path with ``[0]`` takes the first."""
    # filters on the parsed value stay above the explode; pushed below a plain
    # projection they would parse every text once more
    x = lines.select(*keep, F.col(value_col).alias("_text")).select("*", F.explode(F.array(F.try_parse_json("_text"))).alias("_v"))

    def read(path, kind):
        by_path = F.get_json_object("_text", path)
        slow = F.from_json(by_path, kind) if kind.startswith(("array", "struct", "map")) else by_path.cast(kind)
        return F.when(F.col("_v").isNotNull(), F.try_variant_get("_v", path, kind)).otherwise(slow)

    if resource_type is not None:
        x = x.filter(read("$.resourceType", "string") == resource_type)
    return x.select(*keep, *[read(p, t).alias(c) for c, (p, t) in paths.items()])


# ---- every type, every element

#: Names that may not be table or column names as they are.
_PLAIN = r"[^A-Za-z0-9_]"


def infer_schemas(lines: DataFrame, value_col: str = "value", type_col: str = "resource_type") -> dict[str, str]:
    """the shape of every resource type, from all its documents: one
    aggregate of VARIANT schemas, one row per type.  A type whose documents all
    pass the VARIANT limit (16 MiB each) has none."""
    x = lines.select(type_col, F.try_parse_json(F.col(value_col)).alias("_v")).filter(F.col("_v").isNotNull())
    rows = x.groupBy(type_col).agg(F.schema_of_variant_agg("_v").alias("s")).collect()
    return {r[0]: _ddl(r["s"]) for r in rows if r["s"].startswith("OBJECT<") and r["s"] != "OBJECT<>"}


def _ddl(schema: str) -> str:
    """A VARIANT schema as a type that keeps shape, its leaves as exact text."""
    quoted = r"`(?:[^`]|``)*`"
    parts = re.split(f"({quoted})", schema)
    for i in range(0, len(parts), 2):
        t = parts[i].replace("OBJECT<>", "STRING")
        t = re.sub(r"\b(BIGINT|DOUBLE|FLOAT|BOOLEAN|VOID|VARIANT|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|UUID)\b(?!\s*:)", "STRING", t)
        t = re.sub(r"\bDECIMAL\(\d+,\s*\d+\)", "STRING", t)
        parts[i] = re.sub(r"\bOBJECT<", "STRUCT<", t)
    return "".join(parts)


def nested_rows(lines: DataFrame, resource_type: str, schema: str, keep: tuple[str, ...], value_col: str = "value",
                type_col: str = "resource_type") -> DataFrame:
    """``keep`` columns and the documents of one type as a struct ``_r``, whose
    names are plain and differ not only in case."""
    x = lines.filter(F.col(type_col) == resource_type).select(*keep, F.from_json(value_col, schema).alias("_r"))
    return x.select(*keep, F.col("_r").cast(_plain(x.schema["_r"].dataType)).alias("_r"))


def _plain(t):
    if isinstance(t, ArrayType):
        return ArrayType(_plain(t.elementType))
    if not isinstance(t, StructType):
        return t
    used: set[str] = set()
    return StructType([StructField(_free(re.sub(_PLAIN, "_", f.name), used), _plain(f.dataType)) for f in t.fields])


def flatten_tables(rows: DataFrame, name: str, keep: tuple[str, ...]) -> dict[str, DataFrame]:
    """Flat tables of ``nested_rows``: the type's own table with one column per
    single value (``period_start``), and one child table per repeated element
    (``Patient_name``, ``Patient_name_given``, ...), one row per occurrence,
    with the ``keep`` columns and the element's place in every list around it
    (``name_no``, ``given_no``, from 0).  No element is left out; all values are
    text.  Names that differ in case only get a number."""
    out: dict[str, DataFrame] = {}

    def table(title: str, df: DataFrame, keys: list[str], value: Column, kind: StructType) -> None:
        cols, lists, used = [], [], {k.lower() for k in keys}

        def walk(v: Column, t: StructType, prefix: str) -> None:
            for f in t.fields:
                c = v.getField(f.name)
                path = prefix + f.name
                if isinstance(f.dataType, StructType):
                    walk(c, f.dataType, path + "_")
                elif isinstance(f.dataType, ArrayType):
                    lists.append((path, c, f.dataType.elementType))
                else:
                    cols.append(c.alias(_free(path, used)))

        walk(value, kind, "")
        out[_free_title(title, out)] = df.select(*keys, *cols)
        for path, c, element in lists:
            child(f"{title}_{path}", path, df, keys, c, element)

    def child(title: str, path: str, df: DataFrame, keys: list[str], lst: Column, element) -> None:
        no = _free(path + "_no", {k.lower() for k in keys})
        x = df.select(*keys, F.posexplode(lst).alias(no, "_r"))
        own = [*keys, no]
        if isinstance(element, StructType):
            table(title, x, own, F.col("_r"), element)
        elif isinstance(element, ArrayType):
            child(title, path + "_item", x, own, F.col("_r"), element.elementType)
        else:
            out[_free_title(title, out)] = x.select(*own, F.col("_r").alias(_free("value", {k.lower() for k in own})))

    table(re.sub(_PLAIN, "_", name), rows, list(keep), F.col("_r"), rows.schema["_r"].dataType)
    return out


def _free(name: str, used: set[str]) -> str:
    n, i = name, 2
    while n.lower() in used:
        n, i = f"{name}_{i}", i + 1
    used.add(n.lower())
    return n


def _free_title(title: str, taken: dict) -> str:
    return _free(title, {t.lower() for t in taken})
