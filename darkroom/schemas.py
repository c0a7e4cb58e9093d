"""Table schemas (photo catalogue, backup ledger, deletion audit, assets)."""

from pyspark.sql import types as T

_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampNTZType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


CATALOGUE = _struct(
    ("id", _L, True), ("file_path", _S, False), ("date_taken", _TS, True), ("camera_make", _S, True),
    ("camera_model", _S, True), ("lens", _S, True), ("shutter_speed", _S, True), ("iso", _S, True),
    ("aperture", _S, True), ("focal_length", _S, True), ("metadata_json", _S, True), ("created_at", _TS, True),
)
LEDGER = _struct(
    ("id", _L, True), ("file_path", _S, False), ("s3_key", _S, False), ("source_type", _S, False),
    ("file_size", _L, True), ("uploaded_at", _TS, True), ("last_verified_at", _TS, True),
    ("md5_checksum", _S, True), ("status", _S, True),
)
AUDIT = _struct(
    ("id", _L, True), ("file_path", _S, False), ("s3_key", _S, False), ("s3_full_path", _S, True), ("source_type", _S, False),
    ("file_size", _L, True), ("uploaded_at", _TS, True), ("md5_checksum", _S, True),
    ("original_status", _S, True), ("deleted_at", _TS, True),
)
ASSETS = _struct(
    ("asset_id", _S, False), ("original_file_name", _S, True), ("local_date_time", _S, True),
    ("stack_count", T.IntegerType(), True),
)
