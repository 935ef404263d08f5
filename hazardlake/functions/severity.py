"""Severity scales and bands."""

from pyspark.sql import Column, functions as F

# Alert categories and their rank. Any other category has no rank.
CATEGORY_RANK = {"Extreme": 4, "Severe": 3, "Moderate": 2, "Minor": 1}

# Lower bounds of each band, per scale.
LEVELS = ("extreme", "severe", "moderate", "minor")
MAGNITUDE_BOUNDS = (7.0, 6.0, 4.5, 2.5)
CATEGORY_BOUNDS = (4.0, 3.0, 2.0, 1.0)
NO_LEVEL = "unknown"
MAGNITUDE_SOURCE = "usgs"


def severity_rank(category: Column) -> Column:
    ranked = F.lit(None).cast("double")
    for name, rank in CATEGORY_RANK.items():
        ranked = F.when(category == name, F.lit(float(rank))).otherwise(ranked)
    return ranked


def _band(severity: Column, bounds: tuple[float, ...]) -> Column:
    """Index of the first bound reached, as a level name."""
    reached = [F.when(severity >= bound, F.lit(level)) for bound, level in zip(bounds, LEVELS)]
    return F.coalesce(*reached, F.lit(NO_LEVEL))


def severity_level(source: Column, severity: Column) -> Column:
    """Level on the scale of the row's own source; NULL severity is `unknown`."""
    return F.when(
        source == MAGNITUDE_SOURCE, _band(severity, MAGNITUDE_BOUNDS)
    ).otherwise(_band(severity, CATEGORY_BOUNDS))
