"""Cohort selection and attribute projection (J5, re-aimed).

The reference hands a cohort query document to an extraction server.  Here
the same document shape drives Spark directly: ``inclusionCriteria`` become
filters and a semi join, ``attributeGroups`` become the projection.  The
query document is a small driver-side parameter; all data work is
distributed.  ``cohort_extract`` takes flat criteria on one patient frame;
``extract_groups`` takes criteria trees over resources of any type.

Supported criteria (a documented subset):
  {"name": <column>, "type": "code", "value": v}            column = v
  {"name": <column>, "type": "range", "min": a, "max": b}   a <= column <= b
  {"name": "encounter", "type": "has", "value": status}     has an encounter
                                                             with that status
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cohort_extract(patients: DataFrame, encounters: DataFrame, query: dict) -> DataFrame:
    crit = query["cohortDefinition"]["inclusionCriteria"]
    p = patients
    for c in crit:
        if c["type"] == "code":
            p = p.filter(F.col(c["name"]) == F.lit(c["value"]))
        elif c["type"] == "range":
            col = F.col(c["name"]).cast("int")
            p = p.filter((col >= c["min"]) & (col <= c["max"]))
        elif c["type"] == "has":
            e = (encounters.filter(F.col("status") == F.lit(c["value"]))
                 .select(F.regexp_extract("subject", r"^Patient/(.+)$", 1).alias("id")))
            p = p.join(e, "id", "left_semi")
        else:
            raise ValueError(f"unsupported criterion type {c['type']!r}")
    cols: list[str] = []
    for g in query["dataExtraction"]["attributeGroups"]:
        cols += [a for a in g["attributes"] if a not in cols]
    return p.select("id", *[c for c in cols if c != "id"])


# ---- criteria trees over resources of any type

def _predicate(c: dict) -> Column:
    """One criterion as a condition on its type's frame.

    ``code``: equals ``value`` (a list: one of them); ``range``: ``min`` to
    ``max``, both included, either may be missing; ``age``: whole years from a
    birth date to ``on``; ``exists``: the attribute has a value."""
    col, kind = F.col(c["name"]), c["type"]
    if kind == "code":
        v = c["value"]
        return col.isin(*v) if isinstance(v, list) else col == F.lit(v)
    if kind in ("range", "age"):
        n = col.cast("decimal(38,9)")
        if kind == "age":
            n = F.floor(F.months_between(F.lit(c["on"]).cast("date"), col.cast("date"), False) / 12)
        out = n.isNotNull()
        for key, test in (("min", lambda x: n >= x), ("max", lambda x: n <= x)):
            if c.get(key) is not None:
                out &= test(F.lit(c[key]))
        return out
    if kind == "exists":
        return col.isNotNull()
    raise ValueError(f"unsupported criterion type {kind!r}")


def _fits(c: dict) -> Column:
    return F.coalesce(_predicate(c), F.lit(False))


def cohort_patients(frames: dict[str, DataFrame], definition: dict) -> DataFrame:
    """Rows of the ``Patient`` frame that meet a cohort definition.

    ``inclusionCriteria`` is a list whose elements must all hold; an element is
    a criterion or a list of alternatives of which one must hold.
    ``exclusionCriteria`` has the same form: a patient who meets all of it is
    left out.  A criterion names the attribute, and in ``resourceType`` the
    frame it is looked up in (``Patient`` by default); other frames have a
    ``patient`` column with the patient's id, and the criterion holds for a
    patient with any row that fits.

    Alternatives on the patient are one filter.  Alternatives on other types
    become one semi join with the distinct patients of all of them, so the
    number of joins is the number of elements that need one."""
    patients = frames["Patient"]
    for element in definition.get("inclusionCriteria", []):
        patients = _narrow(frames, patients, element)
    excluded = definition.get("exclusionCriteria", [])
    if excluded:
        out = patients
        for element in excluded:
            out = _narrow(frames, out, element)
        patients = patients.join(out.select("id").distinct(), "id", "left_anti")
    return patients


def _narrow(frames: dict[str, DataFrame], patients: DataFrame, element) -> DataFrame:
    alternatives = element if isinstance(element, list) else [element]
    if not alternatives:
        return patients
    here = [c for c in alternatives if c.get("resourceType", "Patient") == "Patient"]
    there: dict[str, list[dict]] = {}
    for c in alternatives:
        if c not in here:
            there.setdefault(c["resourceType"], []).append(c)

    def any_of(cs: list[dict]) -> Column:
        out = F.lit(False)
        for c in cs:
            out |= _fits(c)
        return out

    if not there:
        return patients.filter(any_of(here))
    ids = None
    for kind, cs in there.items():
        if kind not in frames:
            raise ValueError(f"no frame of type {kind!r}")
        x = frames[kind].filter(any_of(cs)).select(F.col("patient").alias("id"))
        ids = x if ids is None else ids.unionAll(x)
    if here:
        ids = ids.unionAll(patients.filter(any_of(here)).select("id"))
    return patients.join(ids.distinct(), "id", "left_semi")


def extract_groups(frames: dict[str, DataFrame], query: dict) -> dict[str, DataFrame]:
    """One frame per attribute group of a cohort query: ``id`` and, for
    other types than ``Patient``, ``patient``, then the group's attributes.  A
    group's ``filter`` (criteria as above) keeps some of its rows.  Two groups
    of one type stay two frames."""
    cohort = cohort_patients(frames, query["cohortDefinition"])
    members = cohort.select(F.col("id").alias("patient")).distinct()
    out = {}
    for g in query["dataExtraction"]["attributeGroups"]:
        kind = g.get("resourceType", "Patient")
        if kind not in frames:
            raise ValueError(f"no frame of type {kind!r}")
        own = cohort if kind == "Patient" else frames[kind].join(members, "patient", "left_semi")
        for c in g.get("filter", []):
            own = own.filter(_fits(c))
        keys = ["id"] if kind == "Patient" else ["id", "patient"]
        name, i = g.get("name", kind), 2
        while name in out:
            name, i = f"{g.get('name', kind)}_{i}", i + 1
        out[name] = own.select(*keys, *[a for a in dict.fromkeys(g["attributes"]) if a not in keys])
    return out
