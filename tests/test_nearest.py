"""Nearest-first joins against a plain ranking of all pairs."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardlake.operators import kdtree, nearest
from helpers import haversine, plan_of

H = "event_id string, lat double, lon double"
Q = "qid long, lat double, lon double, radius_km double, limit int"


def _expected(points, hazards):
    out = []
    for qid, lat, lon, radius, limit in points:
        if None in (lat, lon, radius, limit):
            continue
        near = sorted((haversine(lat, lon, a, b), h) for h, a, b in hazards if a is not None and b is not None)
        out += [(qid, n, h) for n, (d, h) in enumerate([x for x in near if x[0] <= radius][:max(0, limit)], 1)]
    return sorted(out)


def _got(df):
    return sorted((r.qid, r.n, r.event_id) for r in df.collect())


def _data(seed=2):
    """Spread rows, a dense spot, many rows at one position, and rows at the poles and the date line."""
    rng = random.Random(seed)
    hazards = [(f"s{i:04d}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(900)]
    hazards += [(f"d{i:04d}", 40 + rng.uniform(0, .01), -100 + rng.uniform(0, .01)) for i in range(700)]
    hazards += [(f"p{i:04d}", 10.0, 20.0) for i in range(300)]
    hazards += [("nowhere", None, 1.0), ("half", 1.0, None), ("line", 12.0, 180.0), ("over", 12.0, 541.0), ("pole", 90.0, 0.0)]
    radii = [1, 30, 500, 4000, 20000, 20038]
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180), float(radii[i % 6]), 1 + i % 60) for i in range(60)]
    points += [(100 + i, 40 + rng.uniform(0, .01), -100 + rng.uniform(-.01, .02), 20000.0, 1 + 7 * i) for i in range(20)]
    points += [(200, 10.0, 20.0, 1.0, 40), (201, 10.0, 20.0, 0.0, 500), (202, 10.001, 20.0, 300.0, 350), (203, 12.0, -179.99, 5.0, 9),
               (204, 89.99, 77.0, 3000.0, 12), (205, -90.0, 0.0, 20000.0, 5), (206, None, 1.0, 5.0, 5), (207, 1.0, 1.0, None, 5),
               (208, 1.0, 1.0, 5.0, None), (209, 1.0, 1.0, 5000.0, 0), (210, 40.005, -99.995, 20000.0, 2000)]
    return points, hazards


def test_equals_a_ranking_of_all_pairs(spark):
    points, hazards = _data()
    got = nearest.nearest_join(spark.createDataFrame(points, Q), spark.createDataFrame(hazards, H))
    assert _got(got) == _expected(points, hazards)
    assert {"lat", "lon", "radius_km", "distance_km", "n"} <= set(got.columns)


def test_pairs_grow_with_points_times_limit(spark):
    """A third of all rows in one spot, and every point beside it: not all pairs are made, and twice the rows
    make no more."""
    rng = random.Random(9)
    points = [(i, 40 + rng.uniform(-.02, .03), -100 + rng.uniform(-.02, .03), 20000.0, 5) for i in range(60)]
    made = []
    for size in (1500, 6000):
        hazards = [(f"d{i:05d}", 40 + rng.uniform(0, .01), -100 + rng.uniform(0, .01)) for i in range(size)]
        hazards += [(f"s{i:05d}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(2 * size)]
        h, q = spark.createDataFrame(hazards, H), spark.createDataFrame(points, Q)
        made.append(nearest.nearest_candidates(q, h, most=5).count())
        if size == 1500:
            assert _got(nearest.nearest_join(q, h)) == _expected(points, hazards)
    assert max(made) <= 60 * 5 * 12 < 60 * 1500


def test_one_radius_and_limit_for_all(spark):
    hazards = [("a", 0.0, 1.0), ("b", 0.0, 2.0), ("c", 0.0, 1.0), ("far", 0.0, 90.0)]
    points = spark.createDataFrame([(1, 0.0, 0.0, "note"), (2, 0.0, 91.0, None)], "place int, lat double, lon double, body string")
    rows = spark.createDataFrame(hazards, H).withColumn("title", F.lit("t"))
    got = nearest.nearest_join(points, rows, 500.0, 2, point_key="place").collect()
    assert sorted((r.place, r.n, r.event_id, r.distance_km, r.body, r.title) for r in got if r.place == 1) == [
        (1, 1, "a", 111.2, "note", "t"), (1, 2, "c", 111.2, "note", "t")]
    assert [r.event_id for r in got if r.place == 2] == ["far"]


@pytest.mark.parametrize("empty", ["points", "hazards"])
def test_empty_sides(spark, empty):
    points, hazards = _data()
    got = nearest.nearest_join(spark.createDataFrame([] if empty == "points" else points[:9], Q),
                               spark.createDataFrame([] if empty == "hazards" else hazards[:50], H))
    assert got.count() == 0


def test_few_bytes_of_many_cubes_are_dealt_over_the_cores(spark):
    """A refined cube is 64 smaller ones: the work is split however small the tables are."""
    cubes = spark.createDataFrame(
        [(1, 5, 0.5, 0.5, 0.5, 0.1, 0.1, 0, 0, 0, 0, 99, 0.0, 1.0, True)],
        "qid long, limit long, lat double, lon double, x double, y double, z double, level int, cx int, cy int, cz int, "
        "n long, near double, far double, crowded boolean").withColumn("reach", F.lit(1.0)).withColumn("radius_km", F.lit(1.0))
    counts = spark.createDataFrame([(2, 2, 2, 2, 9)], "level int, cx int, cy int, cz int, n long")
    refined = nearest._refined(cubes, counts)
    assert refined.count() <= 1
    assert "REPARTITION_BY_NUM" in plan_of(refined) and str(4 * spark.sparkContext.defaultParallelism) in plan_of(refined)


def test_both_ways_are_equal(spark):
    """Rows sent as a tree, and rows met by cubes: the same hits and columns; no pair of the tree is shuffled."""
    points, hazards = _data()
    p, h = spark.createDataFrame(points, Q), spark.createDataFrame(hazards, H).withColumn("title", F.lit("t"))
    tree, cubes = nearest.nearest_join(p, h), nearest.nearest_join(p, h, tree_bytes=0)
    assert _got(tree) == _got(cubes) == _expected(points, hazards) and set(tree.columns) == set(cubes.columns)
    plan = tree.groupBy("qid").agg(F.collect_list("event_id"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_tree_finds_ties_and_no_farther_row():
    rng = np.random.default_rng(5)
    at = kdtree.unit_vectors(rng.integers(-9, 9, 3000) * 10.0, rng.integers(-18, 18, 3000) * 10.0)  # many at one place
    tree = kdtree.Tree(at)
    asked = kdtree.unit_vectors(rng.uniform(-90, 90, 700), rng.uniform(-180, 180, 700))
    asked[:200] = at[:200]
    reach, limit = rng.choice([0.0, .01, .3, 2.0], 700), rng.integers(1, 900, 700)
    counts, rows = tree.nearest(asked, reach, limit)
    for point, r, k, found in zip(asked, reach, limit, np.split(rows, np.cumsum(counts)[:-1])):
        chord = np.sqrt(((at - point) ** 2).sum(1))
        last = min(r, np.sort(chord)[k - 1]) * kdtree.SLACK + kdtree.TINY
        assert set(found.tolist()) == set(np.flatnonzero(chord <= last).tolist())
    assert kdtree.Tree(at[:0]).nearest(asked, reach, limit)[0].tolist() == [0] * 700
