import random

import pytest
from pyspark.sql import functions as F

from hazardlake.operators import radius
from hazardlake.operators.requests import clean_output, split_queries, validate_queries
from hazardlake.schemas import NEAR_COLUMNS
from helpers import haversine, plan_of, rows

H = "event_id string, lat double, lon double"


def _hazards(spark, data):
    df = spark.createDataFrame(data, H)
    for name in NEAR_COLUMNS:
        if name not in df.columns and name != "distance_km":
            df = df.withColumn(name, F.lit(None).cast("string"))
    return df


def _positions(rng, n, crowd=0):
    spread = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)]
    return spread + [(40 + rng.uniform(0, .2), -100 + rng.uniform(0, .2)) for _ in range(crowd)]


def test_nearest_first_and_rounded_last(spark):
    data = [("far", 0.0, 9.0), ("near", 0.0, 1.0), ("same", 0.0, -1.0), ("none", None, 1.0)]
    near = radius.hazards_near(_hazards(spark, data), 0, 0, 500)
    assert near.columns == NEAR_COLUMNS
    assert [(r.event_id, r.distance_km) for r in near.collect()] == [("near", 111.2), ("same", 111.2)]
    assert radius.hazards_near(_hazards(spark, data), 0, 0, 5000, 1).count() == 1


def test_the_edge_belongs_to_the_circle(spark):
    edge = haversine(0, 0, 0, 3.0)
    hazards = _hazards(spark, [("edge", 0.0, 3.0)])
    assert radius.hazards_near(hazards, 0, 0, edge + 1e-9).count() == 1
    assert radius.hazards_near(hazards, 0, 0, edge - 1e-6).count() == 0


@pytest.mark.parametrize("centre", [(0, 0), (10, 179.95), (-10, -179.95), (89.5, 20), (-90, 0), (60, 100)])
def test_box_misses_nothing(spark, centre):
    rng = random.Random(1)
    data = [(str(i), *p) for i, p in enumerate(_positions(rng, 3000))]
    data += [("w", 10.0, -179.9), ("e", -10.0, 179.9), ("pole", 89.9, -160.0)]
    hazards = _hazards(spark, data).cache()
    for r in (50, 900, 8000, 20000):
        got = {x.event_id for x in radius.hazards_near(hazards, *centre, r, 10_000).collect()}
        assert got == {i for i, lat, lon in data if haversine(*centre, lat, lon) <= r}
    hazards.unpersist()


def _pairs(df):
    return sorted((r.qid, r.event_id) for r in df.collect())


@pytest.mark.parametrize("how", ["broadcast", "sliced", "one slice"])
def test_join_equals_nested_loops(spark, how):
    rng = random.Random(2)
    hazards = [(f"h{i}", *p) for i, p in enumerate(_positions(rng, 1200, 300))]
    hazards += [("nowhere", None, None), ("date line", 12.0, 180.0), ("pole", 90.0, 0.0)]
    radii = [1, 30, 120, 500, 1500, 4000, 9000, 20000]
    points = [(i, *p, float(radii[i % 8])) for i, p in enumerate(_positions(rng, 60, 40))]
    points += [(500, 12.0, -179.9, 40.0), (501, 89.95, 10.0, 30.0), (502, -90.0, 0.0, 700.0)]
    settings = {"broadcast": {}, "one slice": {"broadcast_rows": 0},
                "sliced": {"broadcast_rows": 0, "rows_per_slice": 9}}[how]
    got = radius.radius_join(
        spark.createDataFrame(points, "qid long, lat double, lon double, radius_km double"),
        spark.createDataFrame(hazards, H), **settings)
    expect = sorted((q, h) for q, a, b, r in points for h, lat, lon in hazards
                    if lat is not None and haversine(a, b, lat, lon) <= r)
    assert _pairs(got) == expect
    assert {"distance_km", "radius_km", "lat", "lon"} <= set(got.columns)
    assert not [c for c in got.columns if c.startswith("_")]


def test_join_without_points(spark):
    points = spark.createDataFrame([], "qid long, lat double, lon double")
    hazards = spark.createDataFrame([("a", 1.0, 1.0)], H)
    assert radius.radius_join(points, hazards, 10).count() == 0


def test_small_points_do_not_move_the_hazards(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0)], "qid long, lat double, lon double")
    hazards = spark.range(100).select(
        F.col("id").cast("string").alias("event_id"), F.col("id").cast("double").alias("lat"),
        F.lit(0.0).alias("lon"))
    plan = radius.radius_join(points, hazards, 500)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_report(spark):
    queries = spark.createDataFrame(
        [(1, 0.0, 0.0, 500.0, 2), (2, 80.0, 0.0, 10.0, 5)],
        "qid long, lat double, lon double, radius_km double, limit int")
    hazards = _hazards(spark, [("a", 0.0, 3.0), ("b", 0.0, 1.0), ("c", 0.0, 2.0)])
    hits = radius.nearest_per_point(radius.radius_join(queries, hazards), limit=F.col("limit"))
    report = {r.qid: r for r in radius.near_report(queries, hits).collect()}
    assert report[1]["count"] == 2 and [h.event_id for h in report[1].hazards] == ["b", "c"]
    assert report[2]["count"] == 0 and report[2].hazards == [] and report[2].radius_km == 10.0
    assert radius.nearest_per_point(radius.radius_join(queries, hazards), limit=1).count() == 1


def test_validation(spark):
    ok = (10.0, 20.0, 300.0, 50, "why")
    bad = {"lat": (90.1, 0.0, 1.0, 1, "why"), "lon": (0.0, -180.5, 1.0, 1, "why"),
           "radius_km": (0.0, 0.0, 0.0, 1, "why"), "limit": (0.0, 0.0, 1.0, 501, "why"),
           "question": (0.0, 0.0, 1.0, 1, "hm")}
    more = {"radius_km": (0.0, 0.0, 20000.1, 1, "why"), "lat": (float("nan"), 0.0, 1.0, 1, "why"),
            "lon": (0.0, None, 1.0, 1, "why"), "limit": (0.0, 0.0, 1.0, 0, "why"),
            "question": (0.0, 0.0, 1.0, 1, None)}
    schema = "lat double, lon double, radius_km double, limit int, question string"
    edges = [(90.0, 180.0, 20000.0, 500, "abc"), (-90.0, -180.0, 0.1, 1, "abc")]
    df = spark.createDataFrame([ok, *edges], schema)
    assert {r.reason for r in validate_queries(df).collect()} == {None}
    for cases in (bad, more):
        checked = validate_queries(spark.createDataFrame(list(cases.values()), schema))
        assert [r.reason for r in checked.collect()] == list(cases)
    valid, rejected = split_queries(spark.createDataFrame([ok, *bad.values()], schema))
    assert (valid.count(), rejected.count()) == (1, 5)
    assert validate_queries(df.drop("limit", "question")).filter("reason is null").count() == 3


def test_clean_output(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.5, None)], "v double, s string").withColumn(
        "t", F.timestamp_seconds(F.lit(0)))
    assert rows(clean_output(df)) == [
        (None, "x", "1970-01-01T00:00:00Z"), (1.5, None, "1970-01-01T00:00:00Z")]


def test_longitudes_beyond_the_date_line(spark):
    """A position stored as 181 east is the one at 179 west, for the box as for the grid."""
    hazards = spark.createDataFrame(
        [("east", 0.0, 181.0), ("far", 0.0, 541.0), ("other", 0.0, 0.0)], "event_id string, lat double, lon double")
    full = hazards.select("*", *[F.lit(None).cast("string").alias(c) for c in radius.NEAR_COLUMNS
                                 if c not in ("event_id", "lat", "lon", "distance_km")])
    found = {r.event_id for r in radius.hazards_near(full, 0.0, -170.0, 1100.0).collect()}
    points = spark.createDataFrame([(1, 0.0, -170.0)], "qid int, lat double, lon double")
    assert found == {r.event_id for r in radius.radius_join(points, hazards, 1100.0).collect()} == {"east", "far"}


def test_limits_are_never_shortened(spark):
    pairs = spark.range(700).select(F.lit(1).alias("qid"), F.format_string("e%03d", "id").alias("event_id"),
                                    F.col("id").cast("double").alias("distance_km"), F.lit(700).alias("limit"))
    assert radius.nearest_per_point(pairs, limit=F.col("limit")).count() == 700


def test_wide_columns_stay_out_of_the_grid_shuffle(spark):
    hazards = spark.createDataFrame([("a", 1.0, 1.0, "long text")], "event_id string, lat double, lon double, body string")
    points = spark.createDataFrame([(1, 1.0, 1.0, "wide")], "qid int, lat double, lon double, extra string")
    df = radius.radius_join(points, hazards, 10.0, broadcast_rows=0)
    assert df.first().body == "long text" and df.first().extra == "wide"
    grid = [line for line in plan_of(df).split("\n\n") if "hashpartitioning(_cell" in line]
    assert grid and not any("body" in block or "extra" in block for block in grid)


def test_pairs_of_narrow_columns_are_not_shuffled(spark):
    """Columns of fixed width come along by the grid: what is shuffled are rows and points, never pairs."""
    hazards = spark.createDataFrame([(7, 1.0, 1.0, 3)], "seq long, lat double, lon double, size int")
    points = spark.createDataFrame([(1, 1.0, 1.0, 10.0, 2.5)], "qid int, lat double, lon double, radius_km double, weight double")
    df = radius.radius_join(points, hazards, hazard_key="seq", broadcast_rows=0)
    assert (df.first().size, df.first().weight, df.first().distance_km) == (3, 2.5, 0.0)
    assert sorted(df.columns) == sorted(["qid", "weight", "radius_km", "seq", "size", "lat", "lon", "distance_km"])
    shuffled = [block for block in plan_of(df).split("\n\n") if "hashpartitioning(" in block]
    assert shuffled and all("hashpartitioning(_cell" in block for block in shuffled)


def test_points_are_sent_where_their_cells_are_many(spark):
    """Points that fit a broadcast are sent once each, and hazards stay in place, poles and date line included."""
    rng = random.Random(4)
    radii = [0.0, 5, 90, 700, 2500, 9000, 12000, 20000, 20100]
    points = [(i, lat, lon, float(radii[i % 9])) for i, (lat, lon) in enumerate(
        _positions(rng, 80) + [(90.0, 5.0), (-90.0, 5.0), (89.9, 179.9), (0.0, -180.0), (0.0, 539.5), (10.0, 179.99)])]
    points += [(900, None, 1.0, 50.0), (901, 1.0, 1.0, None)]
    data = [(str(i), *p) for i, p in enumerate(_positions(rng, 900, 60))]
    data += [("w", 10.0, -179.9), ("e", 0.0, 180.0), ("over", 0.0, 541.0), ("pole", 90.0, -160.0), ("south", -89.9, 0.0), ("half", 1.0, None)]
    df = radius.radius_join(spark.createDataFrame(points, "qid long, lat double, lon double, radius_km double"),
                            spark.createDataFrame(data, H), broadcast_rows=len(points))
    assert "hashpartitioning" not in plan_of(df)
    assert _pairs(df) == sorted((q, h) for q, a, b, r in points for h, lat, lon in data
                                if None not in (a, b, r, lat, lon) and haversine(a, b, lat, lon) <= r)


def test_few_levels_are_shuffled(spark):
    """Levels that little work lies in are joined to the next; every level of a point is covered by one in use."""
    reaching = spark.range(100).select((2 + F.col("id") % 7).cast("int").alias("_level"))
    assert radius._tiers(reaching) == (8, radius.TOP_LEVEL) or radius._tiers(reaching)[-3:] == (7, 8, radius.TOP_LEVEL)
    assert radius._tiers(reaching.filter("_level < 0")) == (radius.TOP_LEVEL,)
    points = spark.range(300).select(F.col("id").alias("qid"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"),
                                     (100.0 * (1 + F.col("id") % 40)).alias("radius_km"))
    assert len(radius._tiers(radius._with_reach(points, F.col("radius_km")))) <= 3
