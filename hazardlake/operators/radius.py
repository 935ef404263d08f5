"""Distance search: around one point, or around every row of a points table."""

from math import asin, cos, degrees, radians, sin

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import haversine_km, round_exact
from ..functions.geo import EARTH_RADIUS_KM
from ..schemas import NEAR_COLUMNS
from ..session import BROADCAST_BYTES, NARROW_BROADCAST_ROWS, row_bytes

# Defaults of a search.
DEFAULT_RADIUS_KM = 500.0
DEFAULT_LIMIT = 50

KM_PER_DEGREE = radians(1.0) * EARTH_RADIUS_KM
SLACK = 1e-9
# Grid level L has cells of BASE_DEGREES * 2^L degrees; level 10 spans the sphere.
BASE_DEGREES = 0.25
TOP_LEVEL = 10
ROWS_PER_SLICE = 200_000
# Shuffled hazards are sent once per grid level. Levels are joined while the pairs compared grow by this factor at most.
MORE_PAIRS = 1.5


def _near_box(lat: float, lon: float, radius_km: float) -> Column:
    """A latitude/longitude box around the circle, for Parquet min/max skipping.

    Longitudes are periodic: positions stored one turn further east or west are in the box too, and
    those beyond are all let through to the exact distance.
    """
    dlat = radius_km / KM_PER_DEGREE + SLACK
    in_lat = F.col("lat").between(lat - dlat, lat + dlat)
    if abs(lat) + dlat >= 90:
        return in_lat
    dlon = degrees(asin(min(1.0, sin(radius_km / EARTH_RADIUS_KM) / cos(radians(lat))))) + SLACK
    west, east = lon - dlon, lon + dlon
    in_lon = (F.col("lon") < -360) | (F.col("lon") > 360)
    for turn in (-360, 0, 360):
        in_lon = in_lon | F.col("lon").between(west + turn, east + turn)
    return in_lat & in_lon


def hazards_near(hazards: DataFrame, lat: float, lon: float,
                 radius_km: float = DEFAULT_RADIUS_KM, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Hazards within the radius, nearest first; distances are rounded after the cut."""
    distance = haversine_km(F.lit(float(lat)), F.lit(float(lon)), F.col("lat"), F.col("lon"))
    return (
        hazards.filter(_near_box(lat, lon, radius_km))
        .withColumn("distance_km", distance)
        .filter(F.col("distance_km") <= radius_km)
        .orderBy("distance_km", "event_id").limit(limit)
        .withColumn("distance_km", round_exact(F.col("distance_km"), 1))
        .select(*NEAR_COLUMNS))


def _level(radius_km: Column) -> Column:
    """The finest grid level whose cells are at least as high as the radius."""
    ratio = radius_km / (KM_PER_DEGREE * BASE_DEGREES)
    level = F.ceil(F.log2(F.greatest(ratio, F.lit(1.0))))
    return F.least(level, F.lit(TOP_LEVEL)).cast("int")


def _cell_size(level: Column) -> Column:
    return F.pow(F.lit(2.0), level) * BASE_DEGREES


def _columns(level: Column) -> Column:
    """Number of cells around a latitude circle."""
    return F.greatest(F.floor(F.lit(360.0) / _cell_size(level)), F.lit(1)).cast("int")


def _cell_id(level: Column, row: Column, column: Column) -> Column:
    return (level.cast("long") * 1024 + row) * 2048 + column


def _row_index(lat: Column, level: Column) -> Column:
    return F.greatest(F.floor((lat + 90) / _cell_size(level)), F.lit(0)).cast("int")


def _column_index(lon: Column, level: Column) -> Column:
    return F.floor((lon + 180) * _columns(level) / 360).cast("int")


def grid_cell(lat: Column, lon: Column, level: Column) -> Column:
    """The one grid cell of a position."""
    column = F.pmod(_column_index(lon, level), _columns(level))
    return _cell_id(level, _row_index(lat, level), column)


def _raised(level: Column, tiers: tuple[int, ...] | None) -> Column:
    out = level if tiers is None else F.lit(tiers[-1])
    for tier in reversed((tiers or ())[:-1]):
        out = F.when(level <= tier, tier).otherwise(out)
    return out.cast("int")


def _with_reach(points: DataFrame, radius: Column, tiers: tuple[int, ...] | None = None) -> DataFrame:
    """Points with their grid level and the rows and columns of cells their circle may
    touch, also across the date line and the poles. With `tiers` the level is raised to the next of them."""
    return _reaching(points.withColumns({
        "_r": radius, "_qlat": F.col("lat"), "_qlon": F.col("lon"), "_level": _raised(_level(radius), tiers)})
        .drop("lat", "lon", "radius_km"))


def _reaching(circles: DataFrame) -> DataFrame:
    """The rows and columns of cells of level `_level` that circles (_qlat, _qlon, _r) may touch."""
    lat, lon, level = F.col("_qlat"), F.col("_qlon"), F.col("_level")
    around, dlat, dlon = F.col("_around"), F.col("_dlat"), F.col("_dlon")
    reach = F.sin(F.col("_r") / EARTH_RADIUS_KM) / F.cos(F.radians(lat))
    return (
        circles.withColumns({
            "_around": _columns(level), "_dlat": F.col("_r") / KM_PER_DEGREE + SLACK,
            "_dlon": F.degrees(F.asin(F.least(reach, F.lit(1.0)))) + SLACK})
        .withColumns({
            "_south": _row_index(lat - dlat, level),
            "_north": _row_index(F.least(lat + dlat, F.lit(90.0)), level),
            "_west": _column_index(lon - dlon, level), "_east": _column_index(lon + dlon, level)})
        .withColumn("_ring", (F.abs(lat) + dlat >= 90)
                    | (F.col("_east") - F.col("_west") + 1 >= around))
        .withColumns({
            "_west": F.when(F.col("_ring"), F.lit(0)).otherwise(F.col("_west")),
            "_east": F.when(F.col("_ring"), around - 1).otherwise(F.col("_east"))})
        .drop("_ring", "_dlat", "_dlon"))


def _with_cells(reaching: DataFrame) -> DataFrame:
    """One row per point and touched cell."""
    return (
        reaching.withColumn("_row", F.explode(F.sequence("_south", "_north")))
        .withColumn("_column", F.explode(F.sequence("_west", "_east")))
        .withColumn("_cell", _cell_id(
            F.col("_level"), F.col("_row"), F.pmod("_column", "_around")))
        .drop("_level", "_around", "_south", "_north", "_west", "_east", "_row", "_column"))


def touched_cells(points: DataFrame, radius: Column, tiers: tuple[int, ...] | None = None) -> tuple[DataFrame, list[int]]:
    """The points once per grid cell their circle may touch (`_cell`), and the grid levels in use (eleven at most; with
    `tiers`, which must end in TOP_LEVEL, some of these only)."""
    reaching = _with_reach(points, radius, tiers)
    return _with_cells(reaching), sorted(r[0] for r in reaching.select("_level").distinct().collect())


def _survey(reaching: DataFrame, rows: int) -> tuple[list[int], bool]:
    """The grid levels in use (eleven at most), and whether the touched cells fit a broadcast."""
    cells = ((F.col("_north") - F.col("_south") + 1)
             * (F.col("_east") - F.col("_west") + 1)).cast("long")
    levels, n, size = reaching.agg(
        F.collect_set("_level"), F.sum(cells), F.sum(cells * row_bytes(reaching))).first()
    return sorted(levels), (n or 0) <= rows and (size or 0) <= BROADCAST_BYTES


def _levels_reached(reaching: DataFrame, rows: int) -> dict[int, float] | None:
    """The grid levels in use and the largest radius at each, if the points themselves fit a broadcast and lie on the sphere."""
    whole = F.coalesce((F.abs("_qlat") <= 90) & ~F.isnan("_r"), F.lit(True))
    found = reaching.groupBy("_level").agg(F.max("_r"), F.count("*"), F.sum(row_bytes(reaching)), F.every(whole)).collect()
    if sum(r[2] for r in found) > rows or sum(r[3] or 0 for r in found) > BROADCAST_BYTES or not all(r[4] for r in found):
        return None
    return {r[0]: r[1] for r in found if r[0] is not None and r[1] is not None}


def _around_hazards(placed: DataFrame, reached: dict[int, float]) -> DataFrame:
    """Hazards once per cell that may hold a point they are near to: the cells that a circle of the level's largest radius
    touches. They are made as they are joined."""
    each = F.array(*[F.struct(F.lit(level).alias("level"), F.lit(float(r)).alias("r")) for level, r in sorted(reached.items())])
    circles = placed.withColumns({"_qlat": F.col("lat"), "_qlon": F.col("lon"), "_each": F.explode(each)}).withColumns(
        {"_level": F.col("_each.level"), "_r": F.col("_each.r")}).drop("_each")
    return _with_cells(_reaching(circles)).drop("_qlat", "_qlon", "_r")


def _tiers(reaching: DataFrame) -> tuple[int, ...]:
    """The grid levels to use: of those of the points, as few as MORE_PAIRS allows. Pairs compared grow with the
    area of the cells."""
    points = {r[0]: r[1] for r in reaching.groupBy("_level").count().collect() if r[0] is not None}
    left, most = sorted(points), MORE_PAIRS * sum(n * 4 ** level for level, n in points.items())
    while len(left) > 1:
        kept = left[1:]
        if sum(n * 4 ** min(t for t in kept if t >= level) for level, n in points.items()) > most:
            break
        left = kept
    return (*[t for t in left if t < TOP_LEVEL], TOP_LEVEL)


def _narrow(df: DataFrame, key: str) -> list[str]:
    """The key, and the columns whose values have a fixed width."""
    fixed = (T.NumericType, T.BooleanType, T.DatetimeType)
    return [key, *[f.name for f in df.schema.fields if f.name != key and isinstance(f.dataType, fixed)]]


def _slices(counts: DataFrame, rows_per_slice: int, name: str) -> DataFrame:
    """Cells with more rows than one task should hold, and how many slices they need."""
    return counts.filter(F.col("count") > rows_per_slice).select(
        "_cell", F.ceil(F.col("count") / rows_per_slice).cast("int").alias(name))


def _sliced(points: DataFrame, hazards: DataFrame, point_key: str, hazard_key: str,
            rows_per_slice: int) -> tuple[DataFrame, DataFrame]:
    """Cut crowded cells into a matrix of slices so that each pair meets in one slice.

    Crowded cells of either side are found by a partial count. There are fewer of
    them than grid cells on the sphere (a fixed number), so that list is broadcast.
    """
    crowded = F.broadcast(
        _slices(hazards.groupBy("_cell").count(), rows_per_slice, "_hs").join(
            _slices(points.groupBy("_cell").count(), rows_per_slice, "_ps"),
            "_cell", "full_outer"))

    def place(df: DataFrame, key: str, own: str, other: str, own_slot: str, other_slot: str):
        own_n, other_n = F.coalesce(own, F.lit(1)), F.coalesce(other, F.lit(1))
        return df.join(crowded, "_cell", "left").select(
            *df.columns, F.pmod(F.xxhash64(key), own_n).cast("int").alias(own_slot),
            F.explode(F.sequence(F.lit(0), other_n - 1)).alias(other_slot))

    return (place(points, point_key, "_ps", "_hs", "_pslot", "_hslot"),
            place(hazards, hazard_key, "_hs", "_ps", "_hslot", "_pslot"))


def _within_radius(placed: DataFrame, pts: DataFrame, keys: list[str]) -> DataFrame:
    """The pairs that share `keys` and are within the point's radius."""
    distance = haversine_km(F.col("_qlat"), F.col("_qlon"), F.col("lat"), F.col("lon"))
    close = F.abs(F.col("lat") - F.col("_qlat")) * KM_PER_DEGREE <= F.col("_r") + SLACK
    return (
        placed.join(pts, keys).filter(close)
        .withColumn("distance_km", distance)
        .filter(F.col("distance_km") <= F.col("_r")))


def radius_join(points: DataFrame, hazards: DataFrame, radius_km: float | None = None,
                point_key: str = "qid", hazard_key: str = "event_id",
                broadcast_rows: int = NARROW_BROADCAST_ROWS,
                rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Every (point, hazard) pair within the radius, with the unrounded `distance_km`.

    `points` has a key, `lat`, `lon` and, unless `radius_km` is given, a `radius_km`
    column; its other columns are carried along. Both keys must be unique. Hazards
    stay in place when the cells that the points touch, or else the points, are few (checked); otherwise keys, positions and
    columns of fixed width meet by grid cell of few levels, crowded cells being cut into slices. Only if there are wider
    columns, they are joined to the pairs; else no pair is shuffled.
    """
    radius = F.lit(float(radius_km)) if radius_km is not None else F.col("radius_km")
    reaching = _with_reach(points, radius)
    levels, few = _survey(reaching, broadcast_rows)
    placed = hazards.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    reached = _levels_reached(reaching, broadcast_rows) if not few else None
    if reached:
        pts = reaching.withColumn("_cell", grid_cell(F.col("_qlat"), F.col("_qlon"), F.col("_level"))).drop(
            "_level", "_around", "_south", "_north", "_west", "_east")
        return _within_radius(_around_hazards(placed, reached), F.broadcast(pts), ["_cell"]).withColumnRenamed(
            "_r", "radius_km").drop("_qlat", "_qlon", "_cell")
    if not few:
        tiers = _tiers(reaching)
        reaching = _with_reach(points, radius, tiers)
        levels = sorted({min(t for t in tiers if t >= level) for level in levels})
    pts = _with_cells(reaching)
    cells = [grid_cell(F.col("lat"), F.col("lon"), F.lit(level)) for level in levels]
    if len(cells) == 1:
        placed = placed.withColumn("_cell", cells[0])
    else:
        none = F.array().cast("array<bigint>")
        placed = placed.withColumn("_cell", F.explode(F.array(*cells) if cells else none))

    keys = ["_cell"]
    if few:
        pts = F.broadcast(pts)
    else:
        own = _narrow(points.drop("lat", "lon", "radius_km"), point_key)
        pts, placed = _sliced(
            pts.select(*own, "_qlat", "_qlon", "_r", "_cell"),
            placed.select(*_narrow(hazards.drop("lat", "lon"), hazard_key), "lat", "lon", "_cell"),
            point_key, hazard_key, rows_per_slice)
        keys += ["_pslot", "_hslot"]
    pairs = _within_radius(placed, pts, keys)
    if not few:
        for side, key in ((hazards, hazard_key), (points.drop("lat", "lon", "radius_km"), point_key)):
            narrow = _narrow(side, key)
            wide = [c for c in side.columns if c not in (*narrow, "lat", "lon")]
            pairs = pairs.join(side.select(key, *wide), key) if wide else pairs
    return pairs.withColumnRenamed("_r", "radius_km").drop(
        "_qlat", "_qlon", "_cell", "_pslot", "_hslot")


def nearest_per_point(pairs: DataFrame, point_key: str = "qid",
                      limit: int | Column = DEFAULT_LIMIT, most: int | None = None) -> DataFrame:
    """Per point the nearest pairs up to `limit` (a number or a column), ranked by `n`.

    A constant bound lets Spark drop the rest before the shuffle. For a column of limits it is
    `most`, if the caller has checked that none is above it (`split_queries` does); no row that
    a limit asks for is dropped.
    """
    order = Window.partitionBy(point_key).orderBy("distance_km", "event_id")
    ranked = pairs.withColumn("n", F.row_number().over(order))
    if most is not None:
        ranked = ranked.filter(F.col("n") <= most)
    return ranked.filter(F.col("n") <= limit).withColumn(
        "distance_km", round_exact(F.col("distance_km"), 1))


def near_report(queries: DataFrame, hits: DataFrame, point_key: str = "qid") -> DataFrame:
    """One row per query: the query echoed, the number of hits, the hits in order.

    `hits` come from `nearest_per_point`: a list is as long as its query's limit at most.
    """
    fields = [c for c in NEAR_COLUMNS if c in hits.columns]
    entry = F.struct("n", *fields)
    lists = hits.groupBy(point_key).agg(F.sort_array(F.collect_list(entry)).alias("_hits"))
    empty = F.array().cast(lists.schema["_hits"].dataType)
    return (
        queries.join(lists, point_key, "left")
        .withColumn("hazards", F.coalesce("_hits", empty))
        .withColumn("count", F.size("hazards")).drop("_hits"))
