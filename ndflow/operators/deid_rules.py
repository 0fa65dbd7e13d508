"""De-identification rules for whole documents (D3): which value stays, by
resource type and path, everything else goes (default deny).

A rule is ``path pattern -> kind``.  Paths run from the resource that holds the
value (entry resources and contained ones start anew), names joined by dots,
list positions left out.  A pattern's part may be a name, a name with ``*`` in
it, or ``**`` for any number of parts.  The first rule that fits decides: those
of the resource's own type, then those of ``*``; a user's rules come before
both.  What a rule does not name is removed.

Kinds:

``keep``       text, number or truth value as it is
``number``     numbers and truth values as they are, text goes
``tree``       everything below as it is
``id``         pseudonym of the resource
``link``       reference, URL or URN with its ids as pseudonyms
``search``     request or search URL: ids and search values as pseudonyms
``date``       the year
``region``     an address: country and the first three of the postal code
``record``     an identifier: its value as a pseudonym, social security removed
``drop``       removed
"""

from __future__ import annotations

import re
from functools import lru_cache

KINDS = ("keep", "number", "tree", "id", "link", "search", "date", "region", "record", "drop")

# Codes, units and other values that name no one, by data type.
_CODED = ("status", "type", "use", "mode", "intent", "priority", "gender", "kind", "class", "rank", "sequence", "relation", "active", "code", "system",
          "version", "unit", "comparator", "currency", "contentType", "size", "language", "userSelected", "doNotPerform", "linkId")
_DATES = ("*Date", "*DateTime", "*Instant", "date", "issued", "recorded", "authoredOn", "sent", "received", "start", "end", "creation", "period")

#: Rules for every type.  Extensions, narrative and notes have none, so they go.
ANY_TYPE: dict[str, str] = {
    "id": "id", "**.extension.**": "drop", "**.modifierExtension.**": "drop", "**._*.**": "drop",
    "meta.profile": "keep", "meta.versionId": "keep", "meta.lastUpdated": "date", "meta.tag": "keep", "meta.tag.*": "keep",
    "**.identifier": "record", "**.address": "region", "**.reference": "link", "**.coding.display": "keep", "code.text": "keep",
    **{f"**.{n}": "keep" for n in _CODED},
    **{f"**.{n}": "date" for n in _DATES},
    "**.value": "number", "**.value*": "number", "**.multipleBirth*": "number", "**.deceasedBoolean": "number", "**.total": "number", "**.count": "number",
}

_DEFINITION = {"name": "keep", "title": "keep", "url": "keep", "item.**.text": "keep", "item.**.prefix": "keep"}
#: Rules of single types.
BY_TYPE: dict[str, dict[str, str]] = {
    "Bundle": {"timestamp": "keep", "link.url": "search", "entry.link.url": "search", "entry.fullUrl": "link", "entry.search.score": "number",
               "entry.request.method": "keep", "entry.request.url": "search", "entry.request.ifNoneExist": "search", "entry.request.ifMatch": "keep",
               "entry.request.ifNoneMatch": "keep", "entry.request.ifModifiedSince": "date", "entry.response.location": "link", "entry.response.etag": "keep",
               "entry.response.lastModified": "date"},
    "Organization": {"name": "keep"}, "Medication": {"name": "keep"},
    "Questionnaire": _DEFINITION, "ValueSet": _DEFINITION, "CodeSystem": _DEFINITION, "StructureDefinition": _DEFINITION,
}


def _pattern(text: str) -> re.Pattern:
    parts, out = text.split("."), ""
    for i, p in enumerate(parts):
        if p == "**":
            out += r"(?:[^.]+\.)*" if i + 1 < len(parts) else r"(?:[^.]+(?:\.|$))*"
        else:
            out += "".join("[^.]*" if c == "*" else re.escape(c) for c in p) + (r"\." if i + 1 < len(parts) else "")
    if text.endswith(".**"):
        out = out.removesuffix(r"\.(?:[^.]+(?:\.|$))*") + r"(?:\..*)?"  # the element itself and all below
    return re.compile(out + r"\Z")


class Rules:
    """Rules compiled for look-up; answers are remembered by type and path."""

    def __init__(self, own: dict[str, dict[str, str]] | None = None):
        sources = [own or {}, {**BY_TYPE, "*": ANY_TYPE}]
        for kinds in [k for s in sources for k in s.values()]:
            for kind in kinds.values():
                if kind not in KINDS:
                    raise ValueError(f"unknown kind {kind!r}; use one of {KINDS}")
        self._of = [{t: [(_pattern(p), k) for p, k in rules.items()] for t, rules in s.items()} for s in sources]
        self.kind = lru_cache(maxsize=1 << 16)(self._kind)

    def _kind(self, resource_type: str, path: str) -> str | None:
        for s in self._of:
            for t in (resource_type, "*"):
                for pattern, kind in s.get(t, ()):
                    if pattern.match(path):
                        return kind
        return None
