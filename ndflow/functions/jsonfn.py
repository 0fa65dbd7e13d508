"""JSON column functions: strict parse, canonical byte size, field access.

All functions return ``Column`` expressions that stay in the JVM, next to the
scan; the JSON parsers among them run interpreted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters the reference's JSON encoder escapes to \uXXXX.
# '<', '>' and '&' grow from 1 to 6 bytes; U+2028 and U+2029 from 3 to 6 bytes.
HTML_ESCAPED = "<>&"
LINE_SEPARATORS = "\u2028\u2029"


def escape_growth(json_text: Column) -> Column:
    """Extra bytes the reference's encoder spends on HTML-safe escapes.

    Byte searches, without a regex, find the few texts with such a character;
    only those are counted, by the bytes they lose without it."""
    def lost(chars: str) -> Column:
        found, without = F.lit(False), json_text
        for c in chars:
            found, without = found | F.contains(json_text, F.lit(c)), F.replace(without, F.lit(c), F.lit(""))
        return F.when(found, F.octet_length(json_text) - F.octet_length(without)).otherwise(F.lit(0))

    # a line separator takes 3 bytes and grows by 3
    return 5 * lost(HTML_ESCAPED) + lost(LINE_SEPARATORS)


def json_size(json_text: Column, escape_html: bool = True) -> Column:
    """Byte size of an already canonical (compact, sorted-key) JSON text (B1)."""
    base = F.octet_length(json_text).cast("long")
    return base + escape_growth(json_text) if escape_html else base


def canonical_json(value: Column) -> Column:
    """Compact JSON with sorted keys, via VARIANT (keys sort on parse)."""
    return F.to_json(F.try_parse_json(value))


# Parser settings under which only RFC 8259 text parses (no single quotes, raw
# control characters, NaN or leading zeros), whatever the text's length.
STRICT_JSON = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowUnquotedControlChars": "false",
               "allowUnquotedFieldNames": "false", "allowNonNumericNumbers": "false", "allowNumericLeadingZeros": "false",
               "allowBackslashEscapingAnyCharacter": "false", "allowComments": "false", "maxStringLen": "2147483647",
               "maxNestingDepth": "10000"}


def is_one_value(value: Column) -> Column:
    """Whether a text is exactly one JSON value and nothing else.

    The text is placed inside an object, ``{"v":TEXT,"end":1}``: the strict
    parser must reach ``end``, so a stray closing bracket or junk fails.  It is
    also placed inside an array, which must then hold one element, so
    ``1,"k":2`` fails.  What passes both is one value.  Both passes stream;
    no document is built and there is no size limit."""
    end = F.from_json(F.concat(F.lit('{"v":'), value, F.lit(',"end":1}')), "end int", STRICT_JSON)["end"]
    n = F.json_array_length(F.concat(F.lit("["), value, F.lit("]")))
    return F.coalesce((end == 1) & (n == 1), F.lit(False))


def parse_status(value: Column) -> Column:
    """Strict status of a line (H3): ``blank`` (zero length), ``invalid_json``,
    ``not_object`` or ``ok``.  A valid single value is an object exactly when
    its first non-blank character is ``{``."""
    return (F.when(F.length(value) == 0, F.lit("blank"))
            .when(~is_one_value(value), F.lit("invalid_json"))
            .when(F.substring(F.ltrim(value, F.lit(" \t\r\n")), 1, 1) != "{", F.lit("not_object"))
            .otherwise(F.lit("ok")))


# What ends a checked line; a text cannot hold it by chance.
_END = uuid.uuid4().hex


def checked_header(value: Column) -> Column:
    """Strict check and header of a line that starts with ``{``, in one pass:
    NULL or anything but two elements unless the line is exactly one JSON value.

    The text becomes the first element of ``[TEXT,{"id":END}]``.  If it is one
    value, the array has two elements and ends with ``END``; a closing bracket or
    a comma inside the text ends the array early or makes it longer.  The first
    element then holds ``resourceType`` and ``id``; other fields are skipped, not
    built, and duplicate keys keep the last value."""
    wrapped = F.concat(F.lit("["), value, F.lit(',{"id":"' + _END + '"}]'))
    return F.when(_is_object(value), F.from_json(wrapped, f"array<struct<{_struct_ddl(HEADER_SCHEMA)}>>", STRICT_JSON))


def header_status(value: Column, header: Column) -> Column:
    """``parse_status`` from the ``checked_header`` of a line.  Lines that start
    otherwise are no objects; only they take the general check."""
    whole = (F.size(header) == 2) & (F.try_variant_get(F.try_element_at(header, F.lit(2))["id"], "$", "string") == _END)
    return (F.when(F.octet_length(value) == 0, F.lit("blank"))
            .when(_is_object(value), F.when(F.coalesce(whole, F.lit(False)), F.lit("ok")).otherwise(F.lit("invalid_json")))
            .when(is_one_value(value), F.lit("not_object")).otherwise(F.lit("invalid_json")))


def _is_object(value: Column) -> Column:
    return F.startswith(F.ltrim(value, F.lit(" \t\r\n")), F.lit("{"))


def _struct_ddl(fields: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (f.split() for f in fields.split(", ")))


def strict_parse(value: Column) -> tuple[Column, Column]:
    """``(doc, status)``: the VARIANT of a strictly valid value and its status.
    The VARIANT is NULL for a value that is not valid, or beyond 16 MiB (use
    the streaming readers there)."""
    status = parse_status(value)
    return F.when(status.isin("ok", "not_object"), F.try_parse_json(value)), status


def one_line(value: Column) -> Column:
    """Canonical JSON text; a valid value beyond the VARIANT limit keeps its
    own text, with line breaks (white space there) as spaces."""
    broken = F.contains(value, F.lit("\n")) | F.contains(value, F.lit("\r"))
    own = F.when(broken, F.regexp_replace(value, "[\r\n]", " ")).otherwise(value)
    return F.coalesce(canonical_json(value), own)


HEADER_SCHEMA = "resourceType variant, id variant"


def header_fields(value: Column) -> Column:
    """``struct(resourceType, id)`` as VARIANTs read in one streaming pass
    (other fields are skipped, not materialised); duplicate keys: last wins."""
    return F.from_json(value, HEADER_SCHEMA)


def variant_type(v: Column, path: str) -> Column:
    """Type name of a field in a VARIANT (NULL when the field is absent)."""
    f = F.try_variant_get(v, path, "variant")
    return F.when(f.isNull(), F.lit(None)).otherwise(F.schema_of_variant(f))


def string_field(v: Column, path: str) -> Column:
    """A field only when it holds a JSON string (``variant_get`` alone would
    turn ``5`` into ``'5'``)."""
    return F.when(variant_type(v, path) == "STRING", F.try_variant_get(v, path, "string"))


# RFC 3339 shape accepted by the reference's time parser.
RFC3339_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
ZERO_TIME = "0001-01-01T00:00:00Z"


def rfc3339_normalized(ts_text: Column) -> Column:
    """Re-emit an RFC 3339 time as the reference formats it after parsing:
    fraction dropped, zero offset written as ``Z``; NULL if it does not parse
    (X16)."""
    ok = ts_text.rlike(RFC3339_RE) & F.try_to_timestamp(
        F.regexp_replace(ts_text, r"(\.\d+)?(Z|[+-]\d{2}:\d{2})$", ""), F.lit("yyyy-MM-dd'T'HH:mm:ss")).isNotNull()
    out = F.regexp_replace(F.regexp_replace(ts_text, r"\.\d+", ""), r"[+-]00:00$", "Z")
    return F.when(ok, out)
