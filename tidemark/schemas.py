"""Schemas of the landing documents and the raw tables.

Fixed values: field names, column names and types are the data contract, so they must
not change. JSON is always read with these schemas, never inferred: a field that a
document lacks is then NULL, and an empty list stays an empty list.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


_long, _int, _text = T.LongType(), T.IntegerType(), T.StringType()
_time, _bool = T.TimestampType(), T.BooleanType()
_ids = T.ArrayType(_long)

# ---- landing documents, one JSON document per file ----

OBSERVED = _struct(
    ("app_id", _long),
    ("player_count", _int),
    ("api_result", _int),
    ("logical_date", _time),
    ("observed_at", _time),
    ("latency_ms", _int),
    ("status", _text),
)

UNOBSERVABLE = _struct(
    ("app_id", _long),
    ("logical_date", _time),
    ("observed_at", _time),
    ("latency_ms", _int),
    ("status", _text),
)

BUNDLE = _struct(
    ("logical_date", _time),
    ("tracked_count", _int),
    ("observed", T.ArrayType(OBSERVED)),
    ("unobservable", T.ArrayType(UNOBSERVABLE)),
)

APP_LIST = _struct(
    ("logical_date", _time),
    ("fetched_at", _time),
    ("app_count", _int),
    (
        "apps",
        T.ArrayType(
            _struct(
                ("appid", _long),
                ("name", _text),
                ("last_modified", _long),
                ("price_change_number", _long),
            )
        ),
    ),
)

MOST_PLAYED = _struct(
    ("logical_date", _time),
    ("fetched_at", _time),
    ("most_played_count", _int),
    ("most_played", T.ArrayType(_struct(("appid", _long)))),
)

# The envelope is kept as text here and opened by operators.metadata.unwrap_details.
APP_DETAILS = _struct(
    ("app_id", _long),
    ("logical_date", _time),
    ("observed_at", _time),
    ("latency_ms", _int),
    ("envelope", _text),
)

# ---- raw tables ----

TRACKED_UNIVERSE = _struct(
    ("app_id", _long),
    ("name", _text),
    ("source", _text),
    ("tracked_from", _time),
    ("is_active", _bool),
)

APP_METADATA = _struct(
    ("app_id", _long),
    ("data", T.VariantType()),
    ("first_loaded_at", _time),
    ("updated_at", _time),
)

PLAYER_COUNTS = _struct(
    ("app_id", _long),
    ("player_count", _int),
    ("logical_hour", _time),
    ("observed_at", _time),
    ("s3_key", _text),
    ("loaded_at", _time),
)

SNAPSHOT_RUNS = _struct(
    ("run_id", _text),
    ("logical_hour", _time),
    ("tracked_count", _int),
    ("observed_count", _int),
    ("unobservable_app_ids", _ids),
    ("loaded_count", _int),
    ("latency_p50_ms", _int),
    ("latency_max_ms", _int),
    ("s3_key", _text),
    ("recorded_at", _time),
)

CATALOG_RUNS = _struct(
    ("run_id", _text),
    ("logical_date", _time),
    ("app_list_count", _int),
    ("chart_count", _int),
    ("skipped_chart_app_ids", _ids),
    ("newly_tracked_count", _int),
    ("reactivated_count", _int),
    ("deactivated_count", _int),
    ("no_metadata_app_ids", _ids),
    ("metadata_upserted_count", _int),
    ("app_list_key", _text),
    ("most_played_key", _text),
    ("recorded_at", _time),
)

RAW_TABLES = {
    "tracked_universe": TRACKED_UNIVERSE,
    "app_metadata": APP_METADATA,
    "player_counts": PLAYER_COUNTS,
    "snapshot_runs": SNAPSHOT_RUNS,
    "catalog_runs": CATALOG_RUNS,
}

# The only statuses an hour can have.
HOUR_STATUSES = ("complete", "ran_short", "unrecorded", "unaudited")

# The curated ids that are tracked whether or not the app list names them.
SEED_APP_IDS = (
    730, 440, 570, 578080, 252490, 304930, 3240220,
    1174180, 1091500, 945360, 359550, 252950, 271590,
)

# Fixed value: the name of a seed entity that the app list does not know.
UNLISTED_NAME = "(not in app list)"

# Fixed value: evidence runs that must all list an entity before it counts as unobservable.
KNOWN_UNOBSERVABLE_HOURS = 24
