"""JSON texts to the nearest hazards, in one plan."""

from pyspark.sql import DataFrame

from ..operators.events import latest_per_key, parse_events, quality_gate
from ..operators.gold import enrich, gold_hazards
from ..operators.radius import hazards_near


def current_hazards(bronze: DataFrame, lookup: DataFrame) -> DataFrame:
    """Raw bronze texts to map-ready hazards, newest version each."""
    silver = latest_per_key(quality_gate(parse_events(bronze)))
    return gold_hazards(enrich(silver, lookup))


def nearest_from_raw(bronze: DataFrame, lookup: DataFrame, lat: float, lon: float,
                     radius_km: float, limit: int = 50) -> DataFrame:
    return hazards_near(current_hazards(bronze, lookup), lat, lon, radius_km, limit)
