"""Key and label expressions of the backup ledger and the card import."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from darkroom.functions.names import base_name


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def root_of(source_type: Column | str, roots: Mapping[str, str]) -> Column:
    """Root directory of a source tag, from the (small, fixed) root configuration,
    made absolute as listed paths are.
    A CASE expression, so no join or broadcast is needed."""
    st = _col(source_type)
    out: Column | None = None
    for tag, root in roots.items():
        out = F.when(st == tag, F.lit(os.path.abspath(root))) if out is None else out.when(st == tag, F.lit(os.path.abspath(root)))
    return out if out is not None else F.lit(None).cast("string")


def under_root(path: Column | str, root: Column) -> Column:
    """Path lies strictly below root (`root + '/'` prefix; no LIKE wildcards)."""
    return _col(path).startswith(F.concat(root, F.lit("/")))


def storage_key(path: Column | str, source_type: Column | str, root: Column) -> Column:
    """`source_type/relative_path`; a path outside the root, or whose relative
    path starts with '..', falls back to its base name; '\\' becomes '/'."""
    p = _col(path)
    # Relative part below the root: drop len(root)+1 leading characters.
    rel = F.when(under_root(p, root), p.substr(F.length(root) + 2, F.length(p)))
    rel = F.when(rel.isNull() | rel.startswith(".."), base_name(p)).otherwise(rel)
    return F.concat(_col(source_type), F.lit("/"), F.replace(rel, F.lit("\\"), F.lit("/")))


def full_uri(bucket: str, key: Column | str) -> Column:
    """`s3://bucket/key` as stored in the audit table."""
    return F.concat(F.lit(f"s3://{bucket}/"), _col(key))


def object_tags(source_type: Column | str, upload_date: str, file_size: Column | str, path: Column | str) -> Column:
    """Tag map of an upload (insertion order kept)."""
    return F.create_map(
        F.lit("source_type"), _col(source_type),
        F.lit("upload_date"), F.lit(upload_date),
        F.lit("file_size"), _col(file_size).cast("string"),
        F.lit("original_path"), _col(path),
    )


def tag_text(tags: Column | str) -> Column:
    """`k=v&k=v` text of a tag map; values are not URL-encoded."""
    return F.array_join(
        F.transform(F.map_entries(_col(tags)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&"
    )


DATE_IN_NAME = r"([0-9]{4})([0-9]{2})([0-9]{2})"


def date_dir(name: Column | str, run_date: str, validate: bool = False) -> Column:
    """`YYYY/MM/DD` from the leftmost eight digits of a file name; otherwise
    the run date given as 'YYYY/MM/DD'. As in the card script the digits are
    not checked to be a date (`DSC_12345678` -> 1234/56/78); `validate=True`
    sends digits that are no calendar date to the run date instead."""
    n = _col(name)
    parts = [F.regexp_extract(n, DATE_IN_NAME, i) for i in (1, 2, 3)]
    found = F.concat_ws("/", *parts)
    use = n.rlike(DATE_IN_NAME)
    if validate:
        real = F.try_make_timestamp_ntz(*[p.try_cast("int") for p in parts], F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"))
        use = use & real.isNotNull() & (parts[0].try_cast("int") >= 1)
    return F.when(use, found).otherwise(F.lit(run_date))
