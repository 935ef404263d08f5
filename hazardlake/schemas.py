"""Declared schemas. Column names and types are fixed values of the data model."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


_S, _D, _TS = T.StringType(), T.DoubleType(), T.TimestampType()
_TEXTS = T.ArrayType(_S)

# Canonical event as JSON text carries it (times still text).
EVENT = _struct(
    ("event_id", _S), ("source", _S), ("hazard_type", _S), ("title", _S),
    ("severity", _D), ("lat", _D), ("lon", _D), ("place", _S),
    ("occurred_at", _S), ("updated_at", _S), ("ingested_at", _S),
    ("url", _S), ("description", _S), ("zones", _TEXTS),
)
EVENT_TIMES = ("occurred_at", "updated_at", "ingested_at")
SILVER = T.StructType(
    [T.StructField(f.name, _TS if f.name in EVENT_TIMES else f.dataType) for f in EVENT.fields]
)

BUS = _struct(
    ("key", T.BinaryType()), ("value", T.BinaryType()), ("topic", _S),
    ("partition", T.IntegerType()), ("offset", T.LongType()), ("timestamp", _TS),
)
BRONZE = _struct(
    ("event_key", _S), ("raw_json", _S), ("topic", _S), ("partition", T.IntegerType()),
    ("offset", T.LongType()), ("kafka_timestamp", _TS), ("bronze_ingested_at", _TS),
)
HAZARD_COLUMNS = [
    "event_id", "source", "hazard_type", "severity", "severity_level", "lat", "lon",
    "geo_source", "place", "occurred_at", "updated_at", "title", "url", "description",
]
NEAR_COLUMNS = [
    "event_id", "source", "hazard_type", "severity", "severity_level", "lat", "lon",
    "geo_source", "place", "occurred_at", "title", "url", "distance_km",
]
RETRIEVED_COLUMNS = [
    "event_id", "source", "hazard_type", "severity_level", "place", "distance_km",
    "similarity", "title", "url", "description", "lat", "lon",
]
ZONE_LOOKUP = _struct(("zone_url", _S), ("lat", _D), ("lon", _D))

# Feed snapshots. `geometry` stays raw JSON text: it may nest to any depth, and the
# spelling of numbers in it matters for descriptions.
QUAKE_FEATURE = _struct(
    ("id", _S), ("geometry", _S),
    ("properties", _struct(
        ("time", T.LongType()), ("updated", T.LongType()), ("type", _S), ("title", _S),
        ("mag", _D), ("place", _S), ("url", _S))),
)
ALERT_FEATURE = _struct(
    ("id", _S), ("geometry", _S),
    ("properties", _struct(
        ("id", _S), ("description", _S), ("instruction", _S), ("event", _S),
        ("headline", _S), ("severity", _S), ("areaDesc", _S), ("onset", _S),
        ("effective", _S), ("sent", _S), ("web", _S), ("affectedZones", _TEXTS))),
)
FEATURE = {"usgs": QUAKE_FEATURE, "nws": ALERT_FEATURE}
TOPIC = {"usgs": "earthquakes", "nws": "weather-alerts"}
