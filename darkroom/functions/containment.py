"""JSON containment over VARIANT, as a native expression.

`contains(document, pattern)` is true where the document holds everything the
pattern says, with values compared by type (the number 200 is not the text "200"):

- an object holds a pattern object if each of its members is there and holds the
  pattern's value; other members do not matter;
- an array holds a pattern array if each of its items is held by some item of the
  document's array: order and repeats do not matter, like sets;
- numbers are equal by value (200 and 200.0), texts by code points;
- a plain value is also held by an array that has it, at the top level only.

The pattern is a Python value known when the query is written, so the recursion
unfolds into one expression; documents are never parsed in Python. A NULL
document holds nothing. An empty pattern object or array is held by every
document of its kind.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT64 = -(1 << 63), (1 << 63) - 1


def _member(document: Column, key: str) -> Column:
    for quote in ("'", '"'):
        if quote not in key:
            return F.try_variant_get(document, f"$[{quote}{key}{quote}]", "variant")
    raise ValueError(f"a key with both kinds of quotes cannot be named in a path: {key}")


def _items(document: Column) -> Column:
    return F.try_variant_get(document, "$", "array<variant>")


def _kind(document: Column, *kinds: str) -> Column:
    name = F.regexp_extract(F.schema_of_variant(document), "^[A-Z]+", 0)
    return name.isin(*kinds)


def _equals(document: Column, value) -> Column:
    if value is None:
        return F.is_variant_null(document)
    if isinstance(value, bool):
        return _kind(document, "BOOLEAN") & (F.try_variant_get(document, "$", "boolean") == F.lit(value))
    if isinstance(value, str):
        return _kind(document, "STRING") & (F.try_variant_get(document, "$", "string") == F.lit(value))
    if isinstance(value, (int, float)):
        whole = INT64[0] <= value <= INT64[1] and value == int(value)
        exact = F.try_variant_get(document, "$", "bigint") == F.lit(int(value)).cast("bigint") if whole else F.lit(False)
        near = F.try_variant_get(document, "$", "double") == F.lit(float(value))
        return (_kind(document, "BIGINT") & exact) | (_kind(document, "DECIMAL", "DOUBLE", "FLOAT") & near)
    raise TypeError(f"no JSON value: {value!r}")


def _holds(document: Column, pattern) -> Column:
    if isinstance(pattern, dict):
        held = F.try_variant_get(document, "$", "map<string,variant>").isNotNull()
        for key, value in pattern.items():
            held = held & _holds(_member(document, key), value)
    elif isinstance(pattern, (list, tuple)):
        held = _items(document).isNotNull()
        for value in pattern:
            held = held & _some_holds(document, value)
    else:
        held = _equals(document, pattern)
    return F.coalesce(held, F.lit(False))


def _some_holds(document: Column, pattern) -> Column:
    return F.exists(_items(document), lambda item: _holds(item, pattern))


def contains(document: Column, pattern) -> Column:
    """Whether the VARIANT `document` holds `pattern` (dict, list or plain value)."""
    held = _holds(document, pattern)
    if not isinstance(pattern, (dict, list, tuple)):
        held = held | F.coalesce(F.exists(_items(document), lambda item: _equals(item, pattern)), F.lit(False))
    return held
