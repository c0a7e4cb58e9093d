"""EXIF-record expressions: Python-style falsy-or chains, strict date parsing,
key-presence defaults. All native Spark SQL expressions.

The EXIF record is a JSON object kept as text. Values are read with
`get_json_object` (keeps the source spelling, e.g. '4.0'); truthiness is read
from the canonical JSON token of a VARIANT, which tells the string "0" (truthy)
from the number 0 (falsy).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical JSON tokens of falsy Python values: None, False, '', [], {}.
_FALSY_TOKENS = ("null", "false", '""', "[]", "{}")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _path(key: str) -> str:
    # Keys are plain EXIF tag names; bracket form copes with any character.
    return "$['" + key.replace("'", "\\'") + "']"


def json_token(variant: Column, key: str) -> Column:
    """Canonical JSON text of a member ('0', '"0"', 'false', '[]', ...), NULL when absent."""
    return F.to_json(F.try_variant_get(variant, _path(key), "variant"))


def json_tokens(variant: Column, keys: tuple[str, ...]) -> Column:
    """Struct of the members `keys` as VARIANT values, read in one pass over
    the object (NULL members when absent or when the record is no object).
    `to_json` of a field is its canonical token, as `json_token` gives it."""
    fields = ", ".join("`" + k.replace("`", "``") + "`: variant" for k in keys)
    return F.try_variant_get(variant, "$", f"struct<{fields}>")


def truthy_token(token: Column) -> Column:
    """Python truthiness of a JSON value given by its canonical token."""
    numeric_zero = F.coalesce(token.try_cast("double") == 0, F.lit(False))
    return token.isNotNull() & ~token.isin(*_FALSY_TOKENS) & ~numeric_zero


def json_value(record: Column, key: str) -> Column:
    """Member as text: strings unquoted, other values as JSON text."""
    return F.get_json_object(record, _path(key))


def first_truthy(record: Column | str, keys: tuple[str, ...], variant: Column | None = None) -> Column:
    """`r.get(k1) or r.get(k2) or ... r.get(kn)`: the first truthy candidate,
    else the last candidate as it is (it may be 0 or '' or NULL)."""
    rec = _col(record)
    var = variant if variant is not None else F.try_parse_json(rec)
    *heads, last = keys
    out = json_value(rec, last)
    for key in reversed(heads):
        out = F.when(truthy_token(json_token(var, key)), json_value(rec, key)).otherwise(out)
    return out


# Characters Python's str.strip() removes (str.isspace).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_text(value: Column) -> Column:
    """`str(v).strip()`."""
    return F.btrim(value, F.lit(PY_WHITESPACE))


def clean_text(value: Column) -> Column:
    """`str(v).strip() or None`: strip whitespace, blank becomes NULL."""
    return F.nullif(strip_text(value), F.lit(""))


# strptime('%Y:%m:%d %H:%M:%S') accepts exactly this text: a four-digit year,
# one- or two-digit parts (day may be ' 7'), any run of blanks between date and
# time, and nothing after the seconds. Second 60/61 and impossible dates fail
# later, in datetime(), as they do here in try_make_timestamp_ntz.
EXIF_DATE_PATTERN = (
    r"^(\d{4}):(1[0-2]|0[1-9]|[1-9]):(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])"
    r"\s+(2[0-3]|[0-1]\d|\d):([0-5]\d|\d):([0-5]\d|\d)$"
)


def exif_date_ok(text: Column | str) -> Column:
    """The text has strptime's accepted shape (see EXIF_DATE_PATTERN)."""
    t = _col(text)
    # '$' in Java also matches before a final line break; strptime does not.
    return t.rlike(EXIF_DATE_PATTERN) & ~t.rlike(r"[\r\n]$")


def exif_date_from_parts(ok: Column, parts: Column) -> Column:
    """Timestamp from the six numeric parts of a text that passed `exif_date_ok`
    (`parts` = split on ':' and blanks); impossible dates and year 0 are NULL."""
    p = [F.element_at(parts, i).cast("int") for i in range(1, 7)]
    ts = F.try_make_timestamp_ntz(p[0], p[1], p[2], p[3], p[4], p[5].cast("decimal(16,6)"))
    return F.when(ok & (p[0] >= 1), ts)


def exif_date_parts(text: Column | str) -> Column:
    return F.split(_col(text), r"[:\s]+")


def parse_exif_date(text: Column | str) -> Column:
    """Strict EXIF date parse to TIMESTAMP_NTZ; anything else is NULL."""
    return exif_date_from_parts(exif_date_ok(text), exif_date_parts(text))


def first_present(record: Column | str, keys: tuple[str, ...], default: str) -> Column:
    """`r.get(k1, r.get(k2, default))`: chosen by key presence; empty or null
    values are kept. Works on a map<string,string> column."""
    m = _col(record)
    out: Column = F.lit(default)
    for key in reversed(keys):
        out = F.when(F.map_contains_key(m, F.lit(key)), F.element_at(m, F.lit(key))).otherwise(out)
    return out
