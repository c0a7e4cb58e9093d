"""Fixture views derived from the driver tables (FIXTURES.md section B).

Each view is one SQL text written once and rendered for two dialects: Spark
(`spark.sql` with DataFrame arguments, no global temp views) and DuckDB (the
correctness oracle). Rendering only swaps a handful of function spellings.

The `%` rules below decide which synthetic file is on disk, which one was
backed up and which one failed: they derive *state*. Listings and cards hold
every document; only deletion queries look at `fx_files`, the files that are
still on disk, because a missing file is what they are about.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROOTS = {
    "internal": "/srv/images",
    "external": "/mnt/ext/images",
    "immich_upload": "/srv/library/upload",
}
BUCKET = "photo-backup"
# Parameters of the synthetic runs (fixed literals, for repeatable results).
RUN_TS = "2024-02-01 00:00:00"
RUN_DATE = "2024/02/01"
LEDGER_UPLOADED_AT = "2024-01-01 00:00:00"
CATALOGUE_CREATED_AT = "2024-01-15 00:00:00"
PREVIOUS_RUN_CUTOFF = "2024-01-15 00:00:00"

_DIALECT = {
    "spark": {
        "string": "STRING",
        "ts_lit": "TIMESTAMP_NTZ",
        # Built from wall-clock parts: date_format on TIMESTAMP_NTZ goes through
        # the session time zone and moves times inside a DST gap.
        "hour": "{Y} || '-' || {M} || '-' || {D} || 'T' || {h} || ':00:00'",
        "bytes": "octet_length({0})",
        "ymd": "{Y} || '/' || {M} || '/' || {D}",
        "exifts": "{Y} || ':' || {M} || ':' || {D} || ' ' || {h} || ':' || {m} || ':' || {s}",
        "rlike": "regexp_like({0}, {1})",
    },
    "duckdb": {
        "string": "VARCHAR",
        "ts_lit": "TIMESTAMP",
        "hour": "strftime({0}, '%Y-%m-%dT%H:00:00')",
        "bytes": "strlen({0})",
        "ymd": "strftime({0}, '%Y/%m/%d')",
        "exifts": "strftime({0}, '%Y:%m:%d %H:%M:%S')",
        "rlike": "regexp_matches({0}, {1})",
    },
}


def _f(dialect: str, name: str, *args: str) -> str:
    parts = {}
    if dialect == "spark" and args:
        t = args[0]
        pad = "lpad(CAST({fn}({t}) AS STRING), {w}, '0')"
        parts = {
            k: pad.format(fn=fn, t=t, w=w)
            for k, fn, w in (("Y", "year", 4), ("M", "month", 2), ("D", "day", 2), ("h", "hour", 2), ("m", "minute", 2), ("s", "second", 2))
        }
    return _DIALECT[dialect][name].format(*args, **parts)


def _root_case(col: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ROOTS.items())
    return f"CASE {col} {arms} END"


def _views(d: str) -> dict[str, tuple[str, tuple[str, ...]]]:
    """name -> (SELECT text, upstream names). Upstreams are written @name."""
    s = _DIALECT[d]["string"]
    ts = _DIALECT[d]["ts_lit"]
    return {
        "fx_assets": (
            f"""SELECT event_id AS asset_id,
       'DSCF' || lpad(CAST(user_id AS {s}), 5, '0') ||
       CASE event_type WHEN 'click' THEN '.JPG' WHEN 'view' THEN '.jpeg' WHEN 'error' THEN '.RAF'
                       WHEN 'purchase' THEN '.CR2' ELSE '' END AS original_file_name,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE {_f(d, 'hour', 'ts')} END AS local_date_time,
       CAST(CASE WHEN event_id % 7 = 0 THEN 2 WHEN event_id % 11 = 0 THEN 0 ELSE NULL END AS INT) AS stack_count
FROM @events""",
            ("events",),
        ),
        "fx_exif": (
            f"""SELECT event_id, ts, event_type,
       '/srv/images/' || {_f(d, 'ymd', 'ts')} || '/E' || CAST(event_id AS {s}) || '.JPG' AS file_path,
       CASE WHEN event_id % 17 = 0 THEN '0000:00:00 00:00:00' WHEN event_id % 3 = 0 THEN ''
            ELSE {_f(d, 'exifts', 'ts')} END AS date_time_original,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE {_f(d, 'exifts', 'ts')} END AS create_date,
       CASE user_id % 4 WHEN 0 THEN 'FUJIFILM' WHEN 1 THEN ' Canon ' WHEN 2 THEN '' ELSE NULL END AS make,
       (event_id % 8) * 100 AS iso,
       CASE WHEN event_id % 16 = 0 THEN 64 ELSE NULL END AS iso_value
FROM @events""",
            ("events",),
        ),
        "fx_docs": (
            f"""SELECT doc_id, lang,
       CASE doc_id % 3 WHEN 0 THEN 'internal' WHEN 1 THEN 'external' ELSE 'immich_upload' END AS source_type,
       CASE doc_id % 3 WHEN 0 THEN '/srv/images' WHEN 1 THEN '/mnt/ext/images' ELSE '/srv/library/upload' END
       || '/' || CASE source WHEN 'src3' THEN 'thumbs/' WHEN 'src7' THEN 'backups/' ELSE '' END
       || lang || '/b' || CAST(doc_id AS {s})
       || '/IMG_' || CASE WHEN doc_id % 5 = 0 THEN 'x' ELSE '202401' || lpad(CAST(1 + doc_id % 28 AS {s}), 2, '0') END
       || '_' || CAST(doc_id % 50 AS {s})
       || CASE doc_id % 6 WHEN 0 THEN '.JPG' WHEN 1 THEN '.Jpeg' WHEN 2 THEN '.raf' WHEN 3 THEN '.dng'
                          WHEN 4 THEN '.png' ELSE '.txt' END AS file_path,
       CAST({_f(d, 'bytes', 'text')} AS BIGINT) AS file_size,
       md5(text) AS md5_checksum,
       doc_id % 7 <> 0 AS on_disk
FROM @documents""",
            ("documents",),
        ),
        # What a later listing finds: the files that are still on disk.
        "fx_files": ("SELECT * FROM @fx_docs WHERE on_disk", ("fx_docs",)),
        "fx_catalogue": (
            f"""SELECT doc_id AS id, file_path, source_type,
       CASE WHEN doc_id % 10 = 0 THEN 'error' ELSE 'uploaded' END AS status,
       CASE WHEN doc_id % 10 = 0 THEN NULL ELSE file_size END AS file_size,
       CASE WHEN doc_id % 10 = 0 THEN NULL ELSE md5_checksum END AS md5_checksum
FROM @fx_docs
WHERE doc_id % 4 <> 1 AND doc_id % 6 <> 5 AND NOT {_f(d, 'rlike', 'file_path', "'/(thumbs|backups)/'")}""",
            ("fx_docs",),
        ),
        # Backup ledger as a previous run left it: keys as that run derived them.
        "fx_ledger": (
            f"""SELECT id, file_path,
       source_type || '/' || substr(file_path, length({_root_case('source_type')}) + 2) AS s3_key,
       source_type, file_size, {ts} '{LEDGER_UPLOADED_AT}' AS uploaded_at,
       CAST(NULL AS {ts}) AS last_verified_at, md5_checksum, status
FROM @fx_catalogue""",
            ("fx_catalogue",),
        ),
    }


def fixture_names() -> tuple[str, ...]:
    return tuple(_views("spark"))


def duckdb_ctes(*names: str) -> str:
    """`WITH` clause defining the named views (and their upstreams) for DuckDB."""
    views = _views("duckdb")
    order: list[str] = []

    def visit(n: str) -> None:
        if n in views and n not in order:
            for up in views[n][1]:
                visit(up)
            order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        text, ups = views[n]
        for up in ups:
            text = text.replace("@" + up, up)
        parts.append(f"{n} AS (\n{text}\n)")
    return "WITH " + ",\n".join(parts)


class Fixtures:
    """Spark DataFrames of the fixture views over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        if name not in self._cache:
            text, ups = _views("spark")[name]
            kwargs = {}
            for up in ups:
                text = text.replace("@" + up, "{" + up + "}")
                kwargs[up] = self.view(up) if up.startswith("fx_") else self.table(up)
            self._cache[name] = self.spark.sql(text, **kwargs)
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_"):
            return self.view(name)
        raise AttributeError(name)


def exif_records(fx_exif: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """EXIF JSON records (file_path, metadata_json) built from fx_exif's typed
    columns; absent values are left out of the object (explicit option, not
    the session default)."""
    from pyspark.sql import functions as F

    obj = F.struct(
        F.col("date_time_original").alias("DateTimeOriginal"),
        F.col("create_date").alias("CreateDate"),
        F.col("make").alias("Make"),
        F.col("iso").alias("ISO"),
        F.col("iso_value").alias("ISOValue"),
    )
    return fx_exif.select(
        "event_id", "ts", "event_type", "file_path", *keep,
        F.to_json(obj, {"ignoreNullFields": "true"}).alias("metadata_json"),
    )
