"""Per-value coercion of JSON payload fields, as native Column expressions.

The landing jobs receive loosely typed JSON (numbers as text with ``$`` and
thousands separators, objects where text is expected, ISO timestamps with a
``Z``).  Each rule below is one expression evaluated inside whole-stage
codegen; there is no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

# JSON values that a Python ``or`` chain treats as "no value" (falsy).
_FALSY_JSON = ['""', "false", "null", "[]", "{}"]


def vtext(doc: Column, path: str) -> Column:
    """``doc->>'key'`` on a VARIANT document: the value at ``path`` as text
    (numbers and booleans printed, objects/arrays as JSON text; JSON null
    and a missing key give NULL)."""
    return F.try_variant_get(doc, path, "string")


def vnum(doc: Column, path: str, dtype: str = "decimal(18,4)") -> Column:
    """``(doc->>'key')::numeric``: exact for JSON numbers (no DOUBLE round
    trip), numeric text is parsed, anything else gives NULL."""
    return F.try_variant_get(doc, path, dtype)


def vmoney(doc: Column, path: str, dtype: str = "decimal(18,4)", read: Column | None = None) -> Column:
    """``vnum`` (or ``read``, if it was read already) for amounts: a finite number
    that ``dtype`` can't hold is an error (under ANSI), never NULL."""
    wide = F.try_variant_get(doc, path, "double")
    beyond = F.when(F.abs(wide) < float("inf"), wide).cast(dtype)
    return F.coalesce(vnum(doc, path, dtype) if read is None else read, beyond)


def vjson(doc: Column, path: str) -> Column:
    """The value at ``path`` as JSON text (strings keep their quotes)."""
    return F.to_json(F.try_variant_get(doc, path, "variant"))


def to_num(v: Column, dtype: DataType = DecimalType(18, 4)) -> Column:
    """Loose number: drop ``,`` and ``$``, trim, parse; anything else NULL.

    JSON objects/arrays arrive as their JSON text and fail the parse, as does
    the empty text.  ``v`` is evaluated once.
    """
    return F.trim(F.translate(v, ",$", "")).try_cast(dtype)


def parse_ts(v: Column) -> Column:
    """ISO-8601 text to TIMESTAMP, ``Z`` meaning UTC; anything else NULL.

    The guard rejects forms such as ``2024`` that a plain cast accepts but an
    ISO parser does not.
    """
    s = F.trim(v.cast("string"))
    iso = s.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?$")
    return F.when(iso, s.try_cast("timestamp"))


def truthy_json(j: Column) -> Column:
    """Python truthiness of a JSON value given as JSON text."""
    zero_number = j.rlike(r"^-?[0-9]") & (j.try_cast("double") == 0)
    return j.isNotNull() & ~j.isin(*_FALSY_JSON) & ~zero_number


def first_truthy(doc: Column, *paths: str) -> Column:
    """``d.get(a) or d.get(b) or ...`` as text: the first truthy value (an
    empty string, 0, false, null, [] and {} are skipped)."""
    return F.coalesce(*[F.when(truthy_json(vjson(doc, p)), vtext(doc, p)) for p in paths])


def nullif_blank(v: Column) -> Column:
    return F.when(v != "", v)


def to_bool(v: Column) -> Column:
    """``text::boolean``: true/false/t/f/yes/no/on/off/1/0, else NULL."""
    s = F.lower(F.trim(v))
    return (F.when(s.isin("true", "t", "yes", "y", "on", "1"), F.lit(True))
             .when(s.isin("false", "f", "no", "n", "off", "0"), F.lit(False)))
