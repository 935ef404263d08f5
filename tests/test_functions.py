import math
import random

import pytest
from pyspark.sql import functions as F

from hazardlake import functions as H
from helpers import column, haversine


def test_times(spark):
    assert column(spark, [1747577000999, 0, -1], "long", H.iso_from_millis) == [
        "2025-05-18T14:03:20Z", "1970-01-01T00:00:00Z", "1969-12-31T23:59:59Z"]
    assert column(spark, ["2026-05-18T12:59:00-06:00", "", None, "soon"], "string", H.iso_utc) == [
        "2026-05-18T18:59:00Z", None, None, None]
    parsed = column(spark, ["2026-05-18T14:03:00Z", "2026-05-18T14:03:00.123Z", "2026-05-18", "x"],
                    "string", lambda c: H.to_iso(H.parse_iso(c)))
    assert parsed == ["2026-05-18T14:03:00Z", None, None, None]


@pytest.mark.parametrize("source, cases", [
    ("usgs", [(7.0, "extreme"), (6.99, "severe"), (4.5, "moderate"), (2.5, "minor"),
              (2.49, "unknown"), (None, "unknown"), (float("nan"), "extreme")]),
    ("nws", [(4.0, "extreme"), (3.0, "severe"), (2.0, "moderate"), (1.0, "minor"),
             (0.5, "unknown"), (None, "unknown")]),
    (None, [(7.0, "extreme"), (None, "unknown")]),
])
def test_severity_level(spark, source, cases):
    got = column(spark, [v for v, _ in cases], "double",
                 lambda c: H.severity_level(F.lit(source), c))
    assert got == [level for _, level in cases]


def test_severity_rank(spark):
    assert column(spark, ["Extreme", "Severe", "Moderate", "Minor", "Unknown", "odd", None],
                  "string", H.severity_rank) == [4.0, 3.0, 2.0, 1.0, None, None, None]


def test_text_rules(spark):
    assert column(spark, ["Flood", "", None], "string", lambda c: H.lower_or(c, "alert")) == [
        "flood", "alert", "alert"]
    assert column(spark, [None, ""], "string", lambda c: H.first_text(c, F.lit(""))) == ["", ""]
    assert column(spark, [" a ", None, ""], "string", lambda c: H.alert_text(F.lit("Rain "), c)) == [
        "Rain \n\nInstructions:  a", "Rain", "Rain"]
    assert column(spark, [" \tx y\n "], "string", H.strip_text) == ["x y"]
    assert column(spark, [None, "d "], "string", lambda c: H.event_text(F.lit(None), c)) == [
        ".", ". d"]


def test_quake_text(spark):
    points = ["[1,2,10]", "[1,2,10.0]", "[1,2,10.50]", "[1,2,null]", "[1,2]"]
    depth = lambda c: F.get_json_object(F.concat(F.lit('{"coordinates":'), c, F.lit("}")),
                                        "$.coordinates[2]")
    got = column(spark, points, "string", lambda c: H.quake_text(F.lit("T"), depth(c)))
    assert got == ["T. Depth 10 km.", "T. Depth 10.0 km.", "T. Depth 10.5 km.",
                   "T. Depth None km.", "T. Depth None km."]
    assert column(spark, [None], "string", lambda c: H.quake_text(c, F.lit("1"))) == [
        "None. Depth 1 km."]


def test_vertex_centroid(spark):
    shapes = {
        '{"type":"Point","coordinates":[10,20.5,7]}': (20.5, 10.0),
        '{"type":"Polygon","coordinates":[[[0,0],[3,6],[0,0]]]}': (2.0, 1.0),
        '{"coordinates":[[[[1, 2, 5],[3,4,6]]],[[[-1e1,6,7]]]]}': (4.0, -2.0),
        '{"type":"Polygon","coordinates":[]}': (None, None),
        '{"type":"GeometryCollection","geometries":[]}': (None, None),
        None: (None, None),
    }
    got = column(spark, list(shapes), "string", H.vertex_centroid)
    assert [(c.lat, c.lon) for c in got] == list(shapes.values())


def test_haversine(spark):
    pairs = [(0, 0, 0, 180), (10, 179.9, 10, -179.9), (90, 0, -90, 0), (39.5, -98.35, 39.5, -98.35)]
    df = spark.createDataFrame([tuple(map(float, p)) for p in pairs], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(H.haversine_km(*map(F.col, "abcd"))).collect()]
    assert got == pytest.approx([haversine(*p) for p in pairs], abs=1e-6)


def test_vectors(spark):
    unit = column(spark, [[3.0, 4.0], [0.0, 0.0]], "array<float>", H.l2_normalize)
    assert unit == [[0.6, 0.8], [0.0, 0.0]]
    assert column(spark, [[3.0, 4.0]], "array<double>", lambda c: H.dot(c, c)) == [25.0]
    assert math.isclose(column(spark, [[1.0] * 384], "array<float>", lambda c: H.dot(
        H.l2_normalize(c), H.l2_normalize(c)))[0], 1.0)


def test_prompt_block(spark):
    long = "x" * 500
    got = column(spark, [long, None], "string", lambda c: H.prompt_block(
        F.lit(1), F.lit("flood"), F.lit("minor"), F.lit(None), F.lit(3.0), c))
    assert got == ["[1] flood (severity: minor) — None, 3.0 km away\n" + "x" * 400,
                   "[1] flood (severity: minor) — None, 3.0 km away\n"]


def test_rounding_goes_by_the_binary_value(spark):
    rng = random.Random(9)
    values = [0.00015, -0.00015, 0.03125, 0.09375, 2.67505, 1.00005, -1.00005, 0.0, -98.35, 179.99995,
              *[(2 * rng.randrange(-1800000, 1800000) + 1) / 20000 for _ in range(2000)],
              *[rng.uniform(-180, 180) for _ in range(2000)]]
    assert column(spark, values, "double", lambda c: H.round_exact(c, 4)) == [
        round(v, 4) for v in values]
    assert column(spark, [0.25, 0.35, 12.05, 999.95], "double", lambda c: H.round_exact(c, 1)) == [
        round(v, 1) for v in (0.25, 0.35, 12.05, 999.95)]


def test_centroid_rounding(spark):
    shape = '{"type":"LineString","coordinates":[[0.0001,5.0001],[0.0002,5.0002]]}'
    got = column(spark, [shape], "string", H.vertex_centroid)[0]
    assert (got.lat, got.lon) == (round((5.0001 + 5.0002) / 2, 4), round((0.0001 + 0.0002) / 2, 4))
