"""Positions and distances on a sphere."""

from pyspark.sql import Column, functions as F

from .numbers import round_exact

# Fixed value: mean Earth radius in km.
EARTH_RADIUS_KM = 6371.0
# A GeoJSON position inside coordinate text: "[lon, lat" with optional further numbers.
POSITION = r"\[\s*(-?[0-9][0-9.eE+-]*)\s*,\s*(-?[0-9][0-9.eE+-]*)"


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon)
    return F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * (2 * EARTH_RADIUS_KM)


def _ordinate(geometry_json: Column, index: int) -> Column:
    return F.get_json_object(geometry_json, f"$.coordinates[{index}]").try_cast("double")


def lon_of(point_json: Column) -> Column:
    """Longitude of a GeoJSON point (listed first)."""
    return _ordinate(point_json, 0)


def lat_of(point_json: Column) -> Column:
    """Latitude of a GeoJSON point (listed second)."""
    return _ordinate(point_json, 1)


def vertex_centroid(geometry_json: Column) -> Column:
    """Mean of all listed vertices at any nesting depth, 4 decimals, as struct(lat, lon).

    The repeated closing vertex of a ring counts like any other, and longitudes are
    averaged plainly. Without vertices both fields are NULL.
    """
    coordinates = F.get_json_object(geometry_json, "$.coordinates")

    def mean(group: int) -> Column:
        values = F.regexp_extract_all(coordinates, F.lit(POSITION), F.lit(group))
        total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v.try_cast("double"))
        bound = F.array(F.try_divide(total, F.size(values)))
        return F.transform(bound, lambda x: round_exact(x, 4))[0]

    return F.struct(mean(2).alias("lat"), mean(1).alias("lon"))


def geo_source(lat: Column, zone_lat: Column) -> Column:
    """Where a row's position comes from; only its own latitude is tested."""
    return F.when(lat.isNotNull(), F.lit("point")).when(
        zone_lat.isNotNull(), F.lit("zone_centroid"))
