import json
import os

import pytest
from pyspark.sql import functions as F

from hazardlake.operators import events
from hazardlake.schemas import EVENT
from hazardlake.sources import bus, feeds, tables
from helpers import rows

AT = "2026-01-02T03:04:05Z"


def _at():
    return F.lit("2026-01-02 03:04:05").cast("timestamp")


def _features(spark, source, *features):
    df = spark.createDataFrame([(json.dumps({"features": list(features)}),)], "value string")
    return feeds.features_of(df, source)


def _quake(**props):
    base = {"time": 1747577000999, "updated": 1747577100000, "type": "Quarry Blast", "title": "M 1",
            "mag": 1.2, "place": "P", "url": "u"}
    return {"id": "us1", "geometry": {"type": "Point", "coordinates": [-98.5, 39.25, 10]},
            "properties": {**base, **props}}


def test_quakes(spark):
    got = feeds.normalize_usgs(_features(spark, "usgs", _quake(), _quake(type=None, mag=None)), _at())
    assert got.columns == EVENT.fieldNames()
    first, second = got.collect()
    assert first.asDict() == {
        "event_id": "us1", "source": "usgs", "hazard_type": "quarry blast", "title": "M 1",
        "severity": 1.2, "lat": 39.25, "lon": -98.5, "place": "P",
        "occurred_at": "2025-05-18T14:03:20Z", "updated_at": "2025-05-18T14:05:00Z",
        "ingested_at": AT, "url": "u", "description": "M 1. Depth 10 km.", "zones": None}
    assert (second.hazard_type, second.severity) == ("earthquake", None)


def _alert(geometry=None, **props):
    base = {"id": "urn1", "event": "Flood Watch", "headline": "H", "severity": "Severe",
            "areaDesc": "A", "description": " rain ", "instruction": "go up",
            "onset": "2026-05-18T12:59:00-06:00", "effective": "2026-05-18T11:00:00-06:00",
            "sent": "2026-05-18T10:00:00-06:00", "web": "w", "affectedZones": ["z1", "z2"]}
    return {"id": "feature-url", "geometry": geometry, "properties": {**base, **props}}


def test_alerts(spark):
    shape = {"type": "Polygon", "coordinates": [[[0, 0], [3, 6], [0, 0]]]}
    got = feeds.normalize_nws(_features(
        spark, "nws", _alert(shape), _alert(onset=None, effective="", web="", headline="", event=""),
        _alert(event=None, headline=None, severity="Unknown", description=None, instruction=None,
               affectedZones=None, onset=None)), _at())
    assert got.columns == EVENT.fieldNames()
    a, b, c = got.collect()
    assert a.asDict() == {
        "event_id": "urn1", "source": "nws", "hazard_type": "flood watch", "title": "H",
        "severity": 3.0, "lat": 2.0, "lon": 1.0, "place": "A", "occurred_at": "2026-05-18T18:59:00Z",
        "updated_at": "2026-05-18T16:00:00Z", "ingested_at": AT, "url": "w",
        "description": "rain \n\nInstructions: go up", "zones": ["z1", "z2"]}
    assert (b.occurred_at, b.url, b.title, b.hazard_type, b.lat) == (
        "2026-05-18T16:00:00Z", "feature-url", "", "alert", None)
    assert (c.hazard_type, c.title, c.severity, c.description, c.zones, c.occurred_at) == (
        "alert", None, None, "", [], "2026-05-18T17:00:00Z")


def test_malformed_features_are_set_aside(spark):
    short, no_id, bare = _quake(), _quake(), _quake(updated=None)
    short["geometry"]["coordinates"] = [1, 2]
    del no_id["id"]
    good, bad = feeds.split_features(_features(spark, "usgs", _quake(), short, no_id, bare), "usgs")
    assert good.count() == 1 and sorted(r.reason for r in bad.collect()) == [
        "coordinates", "id", "updated"]
    good, bad = feeds.split_features(_features(
        spark, "nws", _alert(), _alert({"type": "GeometryCollection"}), _alert(id=None)), "nws")
    assert good.count() == 1 and sorted(r.reason for r in bad.collect()) == ["coordinates", "id"]


def test_read_feed(spark, root):
    for i in range(2):
        with open(os.path.join(root, f"{i}.json"), "w") as f:
            json.dump({"type": "FeatureCollection", "features": [_quake(), _quake()]}, f, indent=1)
    got = feeds.read_feed(spark, root, "usgs")
    assert got.columns == ["poll", "file", "position", "id", "geometry", "properties"]
    assert sorted(r.position for r in got.collect()) == [0, 0, 1, 1]
    assert got.select("file").distinct().count() == 2


def test_bus_roundtrip(spark, root):
    event = spark.createDataFrame(
        [("a", "nws", 1.5, ["z"]), ("b", "nws", None, None)],
        "event_id string, source string, severity double, zones array<string>")
    bus.write_bus(event, "weather-alerts", root)
    bus.write_bus(event, "weather-alerts", root)
    read = bus.read_bus(spark, root, streaming=False)
    assert read.count() == 4 and read.filter("key = cast('a' as binary)").select("partition").distinct().count() == 1
    back = events.parse_events(events.to_bronze(read)).select("event_id", "severity", "zones").distinct()
    assert rows(back) == [("a", 1.5, ["z"]), ("b", None, None)]


def _batch(spark, *data):
    return spark.createDataFrame(data, "event_id string, updated_at int, ingested_at int, tag string")


def test_upserted_table(spark, root):
    path = os.path.join(root, "t")
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path)
    first = _batch(spark, ("a", 1, 1, "0"), ("a", 2, 1, "0"), ("n", None, 1, "0"), ("b", 5, 1, "0"))
    assert tables.upsert_batch(first, 0, path)
    second = _batch(spark, ("a", 2, 0, "1"), ("n", 9, 1, "1"), ("b", 4, 1, "1"), ("c", None, 1, "1"))
    assert tables.upsert_batch(second, 1, path)
    expect = [("a", 2, 0, "1"), ("b", 5, 1, "0"), ("c", None, 1, "1"), ("n", None, 1, "0")]
    assert rows(tables.read_table(spark, path)) == expect
    assert not tables.upsert_batch(second.withColumn("tag", F.lit("again")), 1, path)
    assert rows(tables.read_table(spark, path)) == expect
    third = _batch(spark, ("a", 3, 0, "2"), ("n", 9, 1, "2"), ("c", 1, 1, "2"))
    assert tables.upsert_batch(third, 2, path)
    assert rows(tables.read_table(spark, path)) == [
        ("a", 3, 0, "2"), ("b", 5, 1, "0"), ("c", None, 1, "1"), ("n", None, 1, "0")]


def _files(path):
    return {os.path.relpath(os.path.join(folder, f), path) for folder, _, names in os.walk(f"{path}/data")
            for f in names if f.endswith(".parquet")}


def test_an_upsert_rewrites_only_the_buckets_of_its_keys(spark, root):
    path = os.path.join(root, "t")
    tables.upsert_batch(_batch(spark, *[(f"k{i}", 1, 0, "old") for i in range(200)]), 0, path, buckets=8)
    first = tables.read_pointer(spark, path)
    before = _files(path)
    tables.upsert_batch(_batch(spark, ("k7", 2, 0, "new"), ("k7", 0, 0, "older")), 1, path)
    second = tables.read_pointer(spark, path)
    moved = [b for b in range(8) if first.at[b] != second.at[b]]
    assert len(moved) == 1 and second.at[moved[0]] == 1 and second.batch_id == 1
    kept = {f for f in before if f"{tables.BUCKET}={moved[0]}/" not in f}
    assert kept < before <= _files(path) and len(_files(path) - before) == 1
    got = rows(tables.read_table(spark, path), "event_id", "tag")
    assert got == sorted((f"k{i}", "new" if i == 7 else "old") for i in range(200))
    # Readers of the first pointer still find their files; the next write deletes them.
    assert tables.read_buckets(spark, path, first).count() == 200
    tables.upsert_batch(_batch(spark, ("k8", 2, 0, "new")), 2, path)
    assert not [f for f in _files(path) if f.startswith(f"data/write=0/{tables.BUCKET}={moved[0]}/")]
    assert tables.read_table(spark, path).count() == 200


def test_upserts_equal_a_replay(spark, root):
    """Random batches, NULL and equal versions among them, against one process going through them."""
    import random
    rng = random.Random(6)
    path, stored = os.path.join(root, "t"), {}
    for n in range(5):
        data = {f"k{rng.randrange(30)}": rng.choice([None, 1, 2, 3]) for _ in range(12)}
        tables.upsert_batch(_batch(spark, *[(k, v, 0, str(n)) for k, v in data.items()]), n, path, buckets=4)
        for k, v in data.items():
            old = stored.get(k)
            if old is None or (v is not None and old[0] is not None and v >= old[0]):
                stored[k] = (v, str(n))
    assert {r.event_id: (r.updated_at, r.tag) for r in tables.read_table(spark, path).collect()} == stored


def test_a_bucket_may_become_empty(spark, root):
    path = os.path.join(root, "t")
    tables.upsert_batch(_batch(spark, ("a", 1, 1, "x"), ("b", 1, 1, "x")), 0, path, buckets=1)
    none = tables.read_buckets(spark, path, tables.read_pointer(spark, path)).filter("event_id = 'none'")
    tables.replace_buckets(none, [0], path, "event_id")
    assert tables.read_pointer(spark, path).at == [-1] and tables.read_table(spark, path).count() == 0


def test_readers_keep_their_view(spark, root):
    path = os.path.join(root, "t")
    tables.overwrite_table(_batch(spark, ("a", 1, 1, "old")), path)
    view = tables.read_table(spark, path)
    tables.overwrite_table(spark.createDataFrame([(1, 2.0)], "x int, y double"), path,
                           cluster_by=[F.col("x")])
    assert rows(view) == [("a", 1, 1, "old")]
    assert rows(tables.read_table(spark, path)) == [(1, 2.0)]
    tables.overwrite_table(tables.read_table(spark, path).withColumn("y", F.col("y") + 1), path)
    assert rows(tables.read_table(spark, path)) == [(1, 3.0)]


def test_unfinished_write_is_not_seen(spark, root):
    path = os.path.join(root, "t")
    tables.overwrite_table(_batch(spark, ("a", 1, 1, "old")), path)
    _batch(spark, ("lost", 1, 1, "x")).write.parquet(f"{path}/data/write=1")
    open(f"{path}/pointer-half.tmp", "w").write("{")
    assert rows(tables.read_table(spark, path), "event_id") == [("a",)]
    tables.overwrite_table(_batch(spark, ("b", 1, 1, "new")), path)
    assert rows(tables.read_table(spark, path), "event_id") == [("b",)]
