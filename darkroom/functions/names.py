"""Path and file-name expressions (native Spark SQL, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from darkroom.constants import IMAGE_EXTENSIONS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path: Column | str) -> Column:
    """Last path component (`basename`); '' for a path ending in '/'."""
    return F.regexp_extract(_col(path), r"[^/]*$", 0)


def stem(name: Column | str) -> Column:
    """Name without its last suffix: 'a.b.JPG' -> 'a.b', '.jpg' -> '', 'x' -> 'x'."""
    return F.regexp_replace(_col(name), r"\.[^.]*$", "")


def extension(name: Column | str) -> Column:
    """Text after the last dot ('' without a dot); shell `${name##*.}` keeps the
    whole name when there is no dot, callers handle that case."""
    return F.regexp_extract(_col(name), r"\.([^.]*)$", 1)


def path_suffix(name: Column | str) -> Column:
    """pathlib's `suffix`: '.JPG' for 'a.JPG' and '.h.JPG'; '' for '.jpg' and 'a.'."""
    return F.regexp_extract(_col(name), r"^.+(\.[^.]+)$", 1)


def is_jpeg(name: Column | str) -> Column:
    """JPEG test on the lower-cased name (stack parent preference)."""
    lowered = F.lower(_col(name))
    return lowered.endswith(".jpg") | lowered.endswith(".jpeg")


def is_image_any_case(name: Column | str) -> Column:
    """Backup and card listings: suffix compared case-insensitively."""
    return F.lower(path_suffix(name)).isin(*IMAGE_EXTENSIONS)


def is_image_exact_case(name: Column | str) -> Column:
    """Metadata listing: name ends with a suffix spelled all lower or all upper
    case (a mixed-case '.Jpg' is not listed; a bare '.jpg' is)."""
    n = _col(name)
    cond = F.lit(False)
    for ext in IMAGE_EXTENSIONS:
        cond = cond | n.endswith(ext) | n.endswith(ext.upper())
    return cond


def has_excluded_component(path: Column | str, excluded: tuple[str, ...]) -> Column:
    """True when any whole '/'-separated component of the path is excluded."""
    if not excluded:
        return F.lit(False)
    return F.arrays_overlap(F.split(_col(path), "/"), F.array(*[F.lit(e) for e in excluded]))
