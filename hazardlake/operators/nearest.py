"""Nearest-first search around every row of a points table, without making all pairs.

Rows whose keys and positions fit a broadcast (measured) are sent to the tasks as a tree (see `kdtree`), in which each point finds
its own nearest ones; no pair is shuffled. Otherwise points and rows meet by cubes:

Positions are points of the unit sphere, filed in an octree: cubes of side 2, 1/2, 1/8, ... Rows are counted
per cube. A search starts from the cubes around its point that are just large enough to hold as many
rows as it wants; the counts of cubes bound how far its last hit can be, cubes beyond that are dropped, and crowded
ones are refined until few rows are left. Only then do points and rows meet, by cube. So the pairs grow with
the points times their limits, however the rows are spread.
"""

from __future__ import annotations

from math import pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import haversine_km, round_exact
from ..functions.geo import EARTH_RADIUS_KM
from ..session import BROADCAST_BYTES, fits_broadcast, measure, ship_code, stored
from .kdtree import Tree, unit_vectors
from .radius import DEFAULT_LIMIT

# Cubes of level L have a side of 2 / 2^L; those of the finest level measure 12 m.
FINEST = 20
STEP = 2
LEVELS = tuple(range(0, FINEST + 1, STEP))
# A cube is refined while it holds more rows than this, and more than so many times the point's limit.
FEW_ROWS = 32
CROWDED = 2
# Distances are compared along the chord, with room for rounding.
SLACK = 1 + 1e-9
TINY = 1e-12
TASKS_PER_CORE = 4
# A task finds so many hits, more or less.
HITS_PER_TASK = 200_000
AXES = ("x", "y", "z")
CUBE = ("level", "cx", "cy", "cz")


def _unit_vector(lat: Column, lon: Column) -> dict[str, Column]:
    lat, lon = F.radians(lat), F.radians(lon)
    return {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}


def _chord(km: Column) -> Column:
    """The straight distance, on the unit sphere, of points so many km apart."""
    return F.sin(F.least(km / (2 * EARTH_RADIUS_KM), F.lit(pi / 2))) * 2


def _side(level: Column) -> Column:
    # By shift, not by pow: it is used many times a cube.
    return F.lit(2.0) / F.call_function("shiftleft", F.lit(1), level)


def _placed(hazards: DataFrame, key: str, most: int) -> DataFrame:
    """(key, lat, lon) and the finest cube of every row with a position. Of rows at the very same
    position, which are equally near to any point, the `most` of smallest key are enough."""
    rows = hazards.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(key, "lat", "lon")
    same = Window.partitionBy("lat", "lon").orderBy(key)
    rows = rows.withColumn("_same", F.row_number().over(same)).filter(F.col("_same") <= most)
    at = _unit_vector(F.col("lat"), F.col("lon"))
    finest = {f"c{a}": F.floor((at[a] + 1) * (1 << (FINEST - 1))).cast("int") for a in AXES}
    return rows.select(key, "lat", "lon", *[c.alias(n) for n, c in finest.items()])


def _by_cube(rows: DataFrame, levels: list[int]) -> DataFrame:
    """Every row once per level, with its cube there."""
    columns = [c for c in rows.columns if c not in CUBE]
    each = rows.withColumn("level", F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")))
    shifted = [F.expr(f"shiftright(c{a}, {FINEST} - level)").alias(f"c{a}") for a in AXES]
    return each.select(*columns, "level", *shifted)


def _measured(cubes: DataFrame) -> DataFrame:
    """Cubes around points, with the least (`near`) and greatest (`far`) distance to the point; only those that the
    sphere goes through and that are not beyond the point's reach."""
    side = _side(F.col("level"))
    near, far, inner, outer = [], [], [], []
    for a in AXES:
        low = F.col(f"c{a}") * side - 1
        high, at = low + side, F.col(a)
        near.append(F.greatest(low - at, at - high, F.lit(0.0)))
        far.append(F.greatest(F.abs(at - low), F.abs(at - high)))
        inner.append(F.greatest(low, -high, F.lit(0.0)))
        outer.append(F.greatest(F.abs(low), F.abs(high)))

    def length(parts):
        return F.sqrt(sum((p * p for p in parts[1:]), parts[0] * parts[0]))

    on_sphere = (length(inner) <= SLACK) & (length(outer) >= 2 - SLACK)
    return cubes.withColumn("near", length(near)).filter(on_sphere & (F.col("near") <= F.col("reach") * SLACK + TINY)) \
        .withColumn("far", length(far))


def _within_reach(cubes: DataFrame) -> DataFrame:
    """The cubes that can hold one of a point's nearest `limit` rows: as far as the cubes that surely hold
    so many, taken in order of their far ends, reach. A point has a bounded number of cubes."""
    ordered = Window.partitionBy("qid").orderBy("far", *CUBE)
    every = Window.partitionBy("qid")
    upto = F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    enough = F.min(F.when(F.col("_upto") >= F.col("limit"), F.col("far"))).over(every)
    return cubes.withColumn("_upto", upto).withColumn("reach", F.least("reach", F.coalesce(enough, F.col("reach")))) \
        .drop("_upto").filter(F.col("near") <= F.col("reach") * SLACK + TINY)


def _spread(rows: DataFrame) -> DataFrame:
    """Rows dealt over the cores: each of them is multiplied, so that few bytes are much work."""
    return rows.repartition(TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)


def _start(points: DataFrame, counts: DataFrame) -> DataFrame:
    """The cubes around each point from which its search starts.

    Their level is the finest at which the point's own cube holds `limit` rows, or whose cubes are
    as large as the radius, if that is finer.
    """
    own = points.select("qid", "limit", *[
        F.floor((F.col(a) + 1) * (1 << (FINEST - 1))).cast("int").alias(f"c{a}") for a in AXES])
    full = _by_cube(own, list(LEVELS)).join(counts, list(CUBE)).filter(F.col("n") >= F.col("limit")) \
        .groupBy("qid").agg(F.max("level").alias("full"))
    of_radius = F.floor(F.log2(F.lit(2.0) / F.greatest("chord", F.lit(TINY)))).cast("int")
    of_radius = F.least(F.greatest(of_radius, F.lit(0)), F.lit(FINEST))
    # The farthest corner of a cube is the length of its diagonal away from any point in it.
    sure = F.coalesce(_side(F.col("full")) * 3 ** 0.5, F.lit(2.0))
    searches = points.join(full, "qid", "left").withColumns({
        "level": F.greatest(F.coalesce("full", F.lit(0)), of_radius - of_radius % STEP),
        "reach": F.least("chord", sure)}).drop("full")
    side, reach = _side(F.col("level")), F.col("reach") * SLACK + TINY
    cubes = _spread(searches)
    for a in AXES:
        first, last = F.floor((F.col(a) + 1 - reach) / side), F.floor((F.col(a) + 1 + reach) / side)
        cubes = cubes.withColumn(f"c{a}", F.explode(F.sequence(F.greatest(first, F.lit(0)).cast("int"), last.cast("int"))))
    return _within_reach(_measured(cubes).join(counts, list(CUBE)))


def _refined(cubes: DataFrame, counts: DataFrame) -> DataFrame:
    """Crowded cubes replaced by the smaller ones in them that hold rows and are within reach."""
    crowded = F.col("crowded")
    parts = range(1 << STEP)
    inner = _spread(cubes.filter(crowded).drop("n", "near", "far", "crowded")).withColumn("level", F.col("level") + STEP)
    for a in AXES:
        # What is beyond reach along one axis is dropped before the next one multiplies it.
        low = F.col(f"c{a}") * _side(F.col("level")) - 1
        gap = F.greatest(low - F.col(a), F.col(a) - low - _side(F.col("level")))
        inner = inner.withColumn(f"c{a}", F.explode(F.array(*[F.shiftleft(f"c{a}", STEP) + p for p in parts]))) \
            .filter(gap <= F.col("reach") * SLACK + TINY)
    inner = _measured(inner).join(counts, list(CUBE))
    return _within_reach(cubes.filter(~crowded).drop("crowded").unionByName(inner))


def _with_crowded(cubes: DataFrame) -> DataFrame:
    many = F.col("n") > F.greatest(F.lit(FEW_ROWS), F.col("limit") * CROWDED)
    return cubes.withColumn("crowded", many & (F.col("level") < FINEST))


def nearest_candidates(points: DataFrame, hazards: DataFrame, key: str = "event_id", most: int = DEFAULT_LIMIT,
                       placed: DataFrame | None = None) -> DataFrame:
    """(qid, limit, key, distance_km): pairs among which are the `limit` nearest rows of every point within its
    radius; a point meets a number of rows that is bounded by a multiple of its limit.

    `points` has qid, lat, lon, radius_km and limit, none above `most`. Rows are crowded at a spot without end only
    if they differ in position by less than the finest cube; they all are candidates then.
    """
    placed = placed or stored(_placed(hazards, key, most), "nearest-rows")
    counts = stored(_by_cube(placed.select("cx", "cy", "cz"), list(LEVELS)).groupBy(*CUBE).agg(
        F.count("*").alias("n")), "nearest-counts")
    wanted = points.filter((F.col("limit") > 0) & (F.col("radius_km") >= 0)).select(
        "qid", F.col("limit").cast("long").alias("limit"), "lat", "lon", F.col("radius_km").cast("double").alias("radius_km"))
    wanted = wanted.withColumns({**_unit_vector(F.col("lat"), F.col("lon")), "chord": _chord(F.col("radius_km"))})
    cubes = stored(_with_crowded(_start(stored(wanted, "nearest-points"), counts)), "nearest-cubes")
    while not cubes.filter("crowded").isEmpty():
        cubes = stored(_with_crowded(_refined(cubes, counts)), "nearest-cubes")
    levels = sorted(r["level"] for r in cubes.select("level").distinct().collect())  # of LEVELS
    asked = cubes.select(*CUBE, "qid", "limit", "radius_km", "reach", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    pairs = asked.join(_by_cube(placed, levels), list(CUBE)).withColumn(
        "distance_km", haversine_km(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon")))
    near_enough = (F.col("distance_km") <= F.col("radius_km")) & (
        _chord(F.col("distance_km")) <= F.col("reach") * SLACK + TINY)
    return pairs.filter(near_enough).select("qid", "limit", key, "distance_km")


def _found_in_tree(points: DataFrame, lat: np.ndarray, lon: np.ndarray, name: str) -> DataFrame:
    """`points` with `name`: the numbers of rows (by their positions) among which are the `limit` nearest within the radius, and
    few others."""
    spark = points.sparkSession
    ship_code(spark)
    sent = spark.sparkContext.broadcast(Tree(unit_vectors(lat, lon)))

    @F.arrow_udf("array<int>")
    def search(lat: pa.Array, lon: pa.Array, radius: pa.Array, limit: pa.Array) -> pa.Array:
        lat, lon, radius = (c.to_numpy(zero_copy_only=False).astype(float) for c in (lat, lon, radius))
        whole = np.isfinite(lat) & np.isfinite(lon)
        reach = 2 * np.sin(np.fmin(radius / (2 * EARTH_RADIUS_KM), pi / 2))
        counts = np.zeros(len(lat), np.int64)
        counts[whole], rows = sent.value.nearest(
            unit_vectors(lat[whole], lon[whole]), reach[whole], limit.to_numpy(zero_copy_only=False)[whole])
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(rows.astype(np.int32)))

    return points.withColumn(name, search("lat", "lon", "radius_km", "limit"))


def _ranked_in_tree(points: DataFrame, placed: DataFrame, key: str, carried: list[str]) -> DataFrame:
    """(qid, key, lat and lon of the row, distance_km, n, `carried`): the hits of every point, ranked by unrounded distance,
    then key. Only the numbers of the rows found are shuffled; the result is partitioned by qid."""
    spark = points.sparkSession
    rows = placed.select(key, "lat", "lon").toArrow()
    lat, lon = (rows.column(c).to_numpy().astype(float) for c in ("lat", "lon"))
    finite = np.isfinite(lat) & np.isfinite(lon)  # others are near to nothing
    rows = rows.filter(pa.array(finite)).append_column("_row", pa.array(np.arange(int(finite.sum())), pa.int32()))
    known = spark.createDataFrame(rows.to_pandas() if not rows.num_rows else rows, schema=T.StructType([
        *placed.select(key, "lat", "lon").schema.fields, T.StructField("_row", T.IntegerType())]))
    known = known.withColumnsRenamed({"lat": "_lat", "lon": "_lon"})
    wanted = points.filter((F.col("limit") > 0) & (F.col("radius_km") >= 0)).withColumns({
        "limit": F.col("limit").cast("long"), "radius_km": F.col("radius_km").cast("double")})
    hits = wanted.agg(F.sum(F.least("limit", F.lit(rows.num_rows)))).first()[0] or 0
    tasks = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-int(hits) // HITS_PER_TASK))
    found = _found_in_tree(wanted.repartition(tasks), lat[finite], lon[finite], "_found").repartition(tasks, "qid")
    pairs = found.withColumn("_row", F.explode("_found")).drop("_found").join(F.broadcast(known), "_row").withColumn(
        "distance_km", haversine_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")))
    order = Window.partitionBy("qid").orderBy("distance_km", key)
    return pairs.filter(F.col("distance_km") <= F.col("radius_km")).withColumn("n", F.row_number().over(order)).filter(
        F.col("n") <= F.col("limit")).select(
        "qid", key, F.col("_lat").alias("lat"), F.col("_lon").alias("lon"), "distance_km", "n", *carried)


def _with_columns_of(hits: DataFrame, hazards: DataFrame, key: str) -> DataFrame:
    """Hits (with key, lat and lon) with the other columns of their rows; hits stay in place where rows are few."""
    if set(hazards.columns) <= {key, "lat", "lon"}:
        return hits.drop(*[c for c in ("lat", "lon") if c not in hazards.columns])
    rows = stored(hazards, "nearest-hazards")
    return hits.drop("lat", "lon").join(F.broadcast(rows) if fits_broadcast(rows) else rows, key)


def nearest_join(points: DataFrame, hazards: DataFrame, radius_km: float | None = None,
                 limit: int | None = None, point_key: str = "qid", hazard_key: str = "event_id",
                 most: int | None = None, tree_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per point the nearest rows within its radius, up to its limit, ranked by `n`; distances rounded after the cut.

    Equal to ranking all pairs of `radius_join` by distance, then key, and to `nearest_per_point`. Radius and limit
    are numbers, or columns `radius_km` and `limit` of `points`; `most` is a bound on the limits that the caller has
    checked (else it is looked up). Both keys must be unique. Points without a position, or with a
    radius or limit that is null or not positive, have no hits. Other columns of both sides are carried along; those of
    `hazards` are joined to the ranked pairs.
    """
    asked = points.withColumnRenamed(point_key, "qid")
    asked = asked.withColumn("radius_km", F.lit(float(radius_km))) if radius_km is not None else asked
    asked = asked.withColumn("limit", F.lit(limit)) if limit is not None else asked
    if most is None:
        most = limit if limit is not None else asked.agg(F.max("limit")).first()[0] or 1
    asked = asked.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    others = [c for c in asked.columns if c not in ("qid", "lat", "lon", "limit", *hazards.columns)]
    placed = stored(_placed(hazards, hazard_key, most), "nearest-rows")
    if measure(placed)[1] <= tree_bytes:
        ranked = _ranked_in_tree(asked, placed, hazard_key, others)
        return _with_columns_of(ranked, hazards, hazard_key).withColumn(
            "distance_km", round_exact(F.col("distance_km"), 1)).withColumnRenamed("qid", point_key)
    found = nearest_candidates(asked.select("qid", "lat", "lon", "radius_km", "limit"), hazards, hazard_key, most, placed)
    order = Window.partitionBy("qid").orderBy("distance_km", hazard_key)
    # The constant bound lets every task cut its rows before the shuffle.
    ranked = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= most) \
        .filter(F.col("n") <= F.col("limit")).drop("limit")
    return ranked.join(hazards, hazard_key).join(asked.select("qid", *others), "qid") \
        .withColumn("distance_km", round_exact(F.col("distance_km"), 1)).withColumnRenamed("qid", point_key)
