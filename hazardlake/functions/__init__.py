"""Column functions: Column in, Column out, all inside the JVM."""

from .geo import geo_source, haversine_km, lat_of, lon_of, vertex_centroid
from .numbers import round_exact
from .severity import severity_level, severity_rank
from .text import (alert_text, event_text, first_text, lower_or, prompt_block, quake_text,
                   strip_text)
from .times import iso_from_millis, iso_utc, parse_iso, to_iso
from .vectors import dot, l2_normalize

__all__ = [
    "alert_text", "dot", "event_text", "first_text", "geo_source", "haversine_km",
    "iso_from_millis", "iso_utc", "l2_normalize", "lat_of", "lon_of", "lower_or",
    "parse_iso", "prompt_block", "quake_text", "round_exact", "severity_level", "severity_rank",
    "strip_text", "to_iso", "vertex_centroid",
]
