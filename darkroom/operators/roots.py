"""Source tags by the longest root that holds a file.

Roots may lie in one another (a library inside an images folder): a file belongs
to the deepest one above it, and is tagged once. Roots are a table, so there may
be many. Directories, not files, are matched: each distinct directory gives one
row per ancestor, these meet the roots in an equality join, and the longest match
comes back to the files by directory (one row each, so AQE may split a directory
that holds a third of all files).

Files under no root, and NULL paths, keep a NULL tag, root and key. A root that is
listed under several tags takes the first by name. Trailing slashes do not matter;
'/' is the root of everything. Extra columns of the listing are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from darkroom.functions.keys import storage_key


def ancestors(directory: Column) -> Column:
    """An absolute directory and all above it; '' is the file system's root."""
    parts = F.split(directory, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def tag_by_root(listing: DataFrame, roots: DataFrame, path: str = "file_path") -> DataFrame:
    """`listing` with root_tag, root and s3_key; `roots` holds (source_type, root)."""
    known = roots.where(F.col("root").isNotNull() & F.col("source_type").isNotNull())
    known = known.groupBy(F.regexp_replace("root", "/+$", "").alias("_root")).agg(F.min("source_type").alias("_tag"))
    files = listing.withColumn("_dir", F.when(F.col(path).contains("/"), F.regexp_extract(path, "(?s)^(.*)/[^/]*$", 1)))
    above = files.select(F.col("_dir").alias("_of")).where(F.col("_of").isNotNull()).distinct().withColumn("_at", F.explode(ancestors(F.col("_of"))))
    best = above.join(known, F.col("_at") == F.col("_root")).groupBy("_of").agg(F.max_by(F.struct("_tag", "_root"), F.length("_at")).alias("_best"))
    tagged = files.join(best, F.col("_dir") == F.col("_of"), "left")
    tag, root = F.col("_best._tag"), F.col("_best._root")
    return tagged.select(
        *[F.col(f"`{c}`") for c in listing.columns], tag.alias("root_tag"),
        F.when(root == "", F.lit("/")).otherwise(root).alias("root"), storage_key(path, tag, root).alias("s3_key"))
