import json
import os

import pytest
from pyspark.sql import functions as F

from hazardlake.operators import gold, radius, reports, zones
from hazardlake.schemas import HAZARD_COLUMNS, SILVER
from hazardlake.sources import lookup, tables
from helpers import plan_of, rows

SHAPE = "event_id string, lat double, lon double, zones array<string>"


@pytest.fixture
def centres(spark):
    return spark.createDataFrame(
        [("A", 0.0, 0.0), ("B", 5.0, 6.0), ("bad", None, None)],
        "zone_url string, lat double, lon double")


@pytest.fixture(params=["in place", "joined"])
def fill(request):
    """Both forms: the lookup sent to the rows, and rows joined to the lists they name."""
    options = {} if request.param == "in place" else {"broadcast_rows": -1}
    return lambda events, lookup_rows: zones.zone_fill(events, lookup_rows, **options)


def test_zone_fill(spark, centres, fill):
    events = spark.createDataFrame([
        ("first hit", None, None, ["miss", "A", "B"]), ("order", None, None, ["B", "A"]),
        ("half", 1.0, None, ["B"]), ("other half", None, 2.0, ["B"]), ("point", 1.0, 2.0, ["B"]),
        ("no zones", None, None, []), ("null zones", None, None, None),
        ("all miss", None, None, ["miss", None]), ("no centre", None, None, ["bad", "B"]),
        ("half, no hit", 1.0, None, ["miss"]),
    ], SHAPE)
    got = fill(events, centres)
    assert got.columns[0] == "event_id"
    assert {r.event_id: (r.geo_source, r.lat, r.lon) for r in got.collect()} == {
        "first hit": ("zone_centroid", 0.0, 0.0), "order": ("zone_centroid", 5.0, 6.0),
        "half": ("point", 1.0, 6.0), "other half": ("zone_centroid", 5.0, 2.0),
        "point": ("point", 1.0, 2.0), "no zones": (None, None, None),
        "null zones": (None, None, None), "all miss": (None, None, None),
        "no centre": ("zone_centroid", 5.0, 6.0), "half, no hit": ("point", 1.0, None),
    }


def test_zone_fill_equals_a_plain_loop(spark, fill):
    table = {f"u{i}": (float(i), float(-i)) for i in range(0, 400, 3)}
    names = lambda i: [f"u{(i * k) % 400}" for k in range(1, 1 + i % 6)]
    events = spark.createDataFrame([(str(i), None, None, names(i)) for i in range(500)], SHAPE)
    centres = spark.createDataFrame(
        [(u, *c) for u, c in table.items()], "zone_url string, lat double, lon double")
    got = {r.event_id: (r.lat, r.lon)
           for r in fill(events, centres).collect()}
    assert got == {str(i): next((table[z] for z in names(i) if z in table), (None, None))
                   for i in range(500)}


def test_empty_lookup(spark, fill):
    events = spark.createDataFrame([("a", None, None, ["A"]), ("b", 1.0, 1.0, ["A"])], SHAPE)
    empty = spark.createDataFrame([], "zone_url string, lat double, lon double")
    assert rows(fill(events, empty), "event_id", "geo_source") == [
        ("a", None), ("b", "point")]


def test_repeated_zones_have_one_answer(spark, fill):
    events = spark.createDataFrame([("a", None, None, ["A"])], SHAPE)
    twice = [("A", 2.0, 2.0), ("A", 1.0, 9.0), ("A", 1.0, 1.0), ("A", None, 0.0)]
    for order in (twice, twice[::-1]):
        lookup_rows = spark.createDataFrame(order, "zone_url string, lat double, lon double")
        assert [(r.lat, r.lon) for r in fill(events, lookup_rows).collect()] == [(1.0, 1.0)]


def test_rows_are_read_once_and_stay_where_they_are(spark, centres, root):
    spark.createDataFrame([(str(i), None, None, ["A"] if i % 2 else None) for i in range(50)], SHAPE).write.parquet(root + "/e")
    plan = plan_of(zones.zone_fill(spark.read.parquet(root + "/e"), centres))
    rows_part = plan.split("===== Subqueries =====")[0]
    assert rows_part.count("Scan parquet") == 2 * 1 and "Exchange" not in rows_part and "Join" not in rows_part


def test_crowded_and_rare_lists(spark):
    """A third of the rows have one list, the others one each: no row without a need or with that list is shuffled."""
    table = {f"u{i}": (float(i % 90), float(-i % 180)) for i in range(0, 3000, 2)}
    data = [(str(i), None if i % 5 else 1.0, None if i % 5 else 2.0, ["u0", "u2"] if i % 3 == 0 else [f"u{i}", "u4"])
            for i in range(3000)]
    events = spark.createDataFrame(data, SHAPE)
    centres = spark.createDataFrame([(u, *c) for u, c in table.items()], "zone_url string, lat double, lon double")
    got = {r.event_id: (r.lat, r.lon) for r in zones.zone_fill(events, centres, broadcast_rows=0).collect()}
    assert got == {i: (lat, lon) if lat else next(table[z] for z in names if z in table) for i, lat, lon, names in data}


def _silver(spark):
    data = [("a", "usgs", 7.0, 1.0, 2.0, None), ("b", "nws", 3.0, None, None, ["A"]),
            ("c", "nws", None, None, None, ["none"]), ("d", "usgs", 1.9, 3.0, 4.0, [])]
    df = spark.createDataFrame(
        data, "event_id string, source string, severity double, lat double, lon double, zones array<string>")
    return df.select(*[
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in SILVER.fields])


def test_gold(spark, centres):
    enriched = gold.enrich(_silver(spark), centres)
    hazards = gold.gold_hazards(enriched)
    assert hazards.columns == HAZARD_COLUMNS
    assert rows(hazards, "event_id", "severity_level", "geo_source") == [
        ("a", "extreme", "point"), ("b", "severe", "zone_centroid"), ("d", "unknown", "point")]
    summary = gold.gold_summary(enriched)
    assert rows(summary, "source", "severity_level", "event_count") == [
        ("nws", "severe", 1), ("nws", "unknown", 1), ("usgs", "extreme", 1), ("usgs", "unknown", 1)]
    assert tuple(gold.coverage(enriched).first()) == (4, 3)
    assert rows(gold.geo_source_counts(enriched)) == [
        (None, 1), ("point", 2), ("zone_centroid", 1)]
    assert [r.event_id for r in gold.top_hazards(hazards, 2).collect()] == ["a", "b"]
    assert gold.top_groups(summary, 1).count() == 1
    assert gold.row_total(hazards).first().total == 3
    assert gold.sample_rows(hazards, ["event_id"], 2).count() == 2


def test_unresolved_missing_and_coverage(spark, centres):
    events = spark.createDataFrame(
        [("a", None, None, ["C", "A", "D"]), ("b", None, 1.0, ["C"]), ("c", 1.0, 1.0, ["X"]),
         ("d", None, None, None), ("e", None, None, [])], SHAPE)
    wanted = zones.unresolved_zones(events)
    assert [r.zone_url for r in wanted.collect()] == ["A", "C", "D"]
    assert rows(zones.missing_zones(wanted, centres)) == [("C",), ("D",)]
    fetched = zones.zone_centroids(spark.createDataFrame(
        [("C", '{"coordinates":[[1,2],[3,4]]}'), ("D", '{"coordinates":[]}')],
        "zone_url string, geometry string"))
    assert rows(fetched) == [("C", 3.0, 2.0), ("D", None, None)]
    assert zones.zone_coverage(wanted, centres, fetched).first().asDict() == {
        "wanted": 3, "cached": 3, "to_fetch": 2, "ok": 1, "failed": 1}
    assert rows(zones.refresh_zone_lookup(centres, fetched)) == rows(
        centres.unionByName(fetched.filter("zone_url = 'C'")))


def test_lookup_file_and_table(spark, root):
    path = os.path.join(root, "lookup.json")
    with open(path, "w") as f:
        json.dump({"https://z/A": [1.5, 2], "https://z/B": [], "https://z/C": [3, 4]}, f, indent=2)
    assert rows(lookup.read_zone_lookup(spark, path)) == [
        ("https://z/A", 1.5, 2.0), ("https://z/C", 3.0, 4.0)]
    assert lookup.read_zone_lookup(spark, path + "-none").count() == 0
    lines = os.path.join(root, "lines")
    written = spark.createDataFrame([("A", 1.0, 2.0), ("B\"é", 3.5, 4.0), ("C", None, None)], "zone_url string, lat double, lon double")
    lookup.write_zone_lookup(written, lines)
    assert len([f for f in os.listdir(lines) if f.endswith(".txt")]) > 1  # by several tasks
    assert rows(lookup.read_zone_lookup(spark, lines).filter("lat is not null")) == [("A", 1.0, 2.0), ("B\"é", 3.5, 4.0)]
    with open(path, "w") as f:
        json.dump({"one line": [1, 2], "too": [3, 4]}, f)
    assert rows(lookup.read_zone_lookup(spark, path)) == [("one line", 1.0, 2.0), ("too", 3.0, 4.0)]
    table = os.path.join(root, "lookup")
    batch = spark.createDataFrame([("A", 1.0, 2.0), ("B", None, None)],
                                  "zone_url string, lat double, lon double")
    lookup.save_zone_lookup(spark, table, batch)
    lookup.save_zone_lookup(spark, table, batch.withColumn("lat", F.lit(9.0)))
    assert rows(lookup.read_zone_lookup(spark, table)) == [("A", 1.0, 2.0), ("B", 9.0, None)]


def test_reports(spark, centres):
    silver = _silver(spark)
    enriched = gold.enrich(silver, centres)
    parts = reports.gold_report(silver, gold.gold_hazards(enriched), gold.gold_summary(enriched))
    assert tuple(parts["coverage"].first()) == (4, 3)
    assert parts["top_groups"].count() == 4 and parts["top_hazards"].count() == 3
    assert reports.silver_report(silver)["total"].first().total == 4
    assert rows(reports.silver_report(silver)["types"], "source", "event_count") == [
        ("nws", 2), ("usgs", 2)]
    bronze = spark.createDataFrame([("t", "k", 1)], "topic string, event_key string, kafka_timestamp int")
    assert rows(reports.bronze_report(bronze)["topics"]) == [("t", 1)]


def test_stored_gold_is_read_by_box_and_column(spark, centres, root):
    path = os.path.join(root, "gold")
    hazards = gold.gold_hazards(gold.enrich(_silver(spark), centres))
    tables.overwrite_table(hazards, path, cluster_by=[F.col("lat"), F.col("event_id")])
    stored = tables.read_table(spark, path)
    near = radius.hazards_near(stored, 1.0, 2.0, 300.0)
    assert [r.event_id for r in near.collect()] == ["a", "b"]
    plan = plan_of(near)
    assert "GreaterThanOrEqual(lat" in plan and "LessThanOrEqual(lon" in plan
    assert "TakeOrderedAndProject" in plan
    counted = plan_of(gold.geo_source_counts(stored))
    assert "ReadSchema: struct<geo_source:string>" in counted
