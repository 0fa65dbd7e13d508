"""References of whole documents (P12, J4): every ``reference`` of a resource of
any type, at any depth, contained and URN links included.

A link is resolved inside its document where it can be: ``#id`` by the contained
resources of the resource that holds it, any other target by the ``fullUrl`` of
the bundle's entries.  What is left is ``Type/id``, looked up among the
resources of all documents, or names something outside every document.
"""

from __future__ import annotations

import json
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ndflow.operators.deid import REFERENCE_RE

LINK_FIELDS = "path string, target string, ref_type string, ref_id string, inside boolean"
_TYPED = re.compile(REFERENCE_RE)


def document_links(doc) -> tuple[list[tuple], list[tuple]]:
    """``(resources, links)`` of a parsed document: ``(type, id, fullUrl)`` of
    every resource that others can name, and ``(path, target, ref_type, ref_id,
    inside)`` of every link."""
    resources: list[tuple] = []
    links: list[tuple] = []
    urls: set[str] = set()
    stack = [(doc, "", None, None, False)]  # value, path, contained ids in reach, fullUrl of the entry, is contained
    while stack:
        v, path, contained, url, local = stack.pop()
        if isinstance(v, list):
            stack += [(x, path, contained, url, local) for x in reversed(v)]
            continue
        if not isinstance(v, dict):
            continue
        kind = v.get("resourceType")
        if isinstance(kind, str):
            own = v.get("id") if isinstance(v.get("id"), str) else None
            if not local:
                resources.append((kind, own, url))
                inside = v.get("contained")
                contained = {c["id"] for c in inside if isinstance(c, dict) and isinstance(c.get("id"), str)} if isinstance(inside, list) else set()
            path = f"{path}/{kind}" if path else kind
        full = v.get("fullUrl") if isinstance(v.get("fullUrl"), str) else None
        if full is not None:
            urls.add(full)
        target = v.get("reference")
        if isinstance(target, str):
            m = _TYPED.match(target)
            links.append((path, target, m[2] if m else None, m[3] if m else None,
                          target == "#" or (target.startswith("#") and target[1:] in (contained or set()))))
        for k in reversed(list(v)):
            if isinstance(v[k], (dict, list)):
                stack.append((v[k], f"{path}.{k}" if path else k, contained, full if k == "resource" else url, local or k == "contained"))
    return resources, [(p, t, rt, ri, ok or t in urls) for p, t, rt, ri, ok in links]


def extract_links(docs: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns with ``resources`` and ``refs`` of every document; a
    text that is not JSON has none."""
    def run(batches):
        for b in batches:
            out = []
            for t in b.column(b.num_columns - 1).to_pylist():
                try:
                    out.append(document_links(json.loads(t)) if t is not None else ([], []))
                except ValueError:
                    out.append(([], []))
            res, refs = struct_lists([x for x, _ in out], RESOURCES), struct_lists([x for _, x in out], REFS)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], res, refs], names=[*keep, "resources", "refs"])

    x = docs.select(*keep, value_col)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in x.schema.fields[:-1]],
                        f"resources array<struct<type string, id string, url string>>, refs array<struct<{LINK_FIELDS}>>"])
    return x.mapInArrow(run, schema)


RESOURCES = pa.struct([("type", pa.string()), ("id", pa.string()), ("url", pa.string())])
REFS = pa.struct([("path", pa.string()), ("target", pa.string()), ("ref_type", pa.string()), ("ref_id", pa.string()), ("inside", pa.bool_())])


def struct_lists(rows, kind: pa.StructType) -> pa.ListArray:
    """Lists of tuples, one list per row, as lists of structs, column by column."""
    flat = [r for x in rows for r in x]
    fields = [pa.array([r[i] for r in flat], f.type) for i, f in enumerate(kind)]
    offsets = pa.array([0, *accumulate(len(x) for x in rows)], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, names=[f.name for f in kind]))


def dangling_links(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Links that lead nowhere, ``keep`` columns with ``path, target,
    ref_type, ref_id``.

    ``docs`` has ``resources`` and ``refs`` (``extract_links`` or
    ``deidentify_rows``).  Links resolved inside their document are left out
    first; the others with a type meet the ids of all documents in one anti
    join; targets that many links share are looked up once."""
    out = docs.select(*keep, F.inline("refs")).filter("not inside")
    known = docs.select(F.inline("resources")).filter("type is not null and id is not null").select(
        F.col("type").alias("ref_type"), F.col("id").alias("ref_id")).distinct()
    targets = out.filter("ref_type is not null").select("ref_type", "ref_id").distinct().join(known, ["ref_type", "ref_id"], "left_anti")
    lost = out.join(targets, ["ref_type", "ref_id"])
    cols = [*keep, "path", "target", "ref_type", "ref_id"]
    return lost.select(*cols).unionAll(out.filter("ref_type is null").select(*cols))
