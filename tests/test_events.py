import json
import random

from pyspark.sql import functions as F

from hazardlake.operators import events, merge
from hazardlake.schemas import SILVER
from helpers import plan_of, rows


def _raw(spark, *texts):
    return spark.createDataFrame([(t if t is None or isinstance(t, str) else json.dumps(t),)
                                  for t in texts], "raw_json string")


def test_parse_keeps_good_fields(spark):
    parsed = events.parse_events(_raw(
        spark, {"event_id": "a", "severity": "7", "lat": 1.5, "updated_at": "2026-05-18T14:03:00Z",
                "zones": ["z"], "extra": 1}, "not json", None))
    assert parsed.schema.fieldNames() == SILVER.fieldNames()
    assert [f.dataType for f in parsed.schema] == [f.dataType for f in SILVER]
    assert rows(parsed, "event_id", "severity", "lat", "zones") == [
        (None, None, None, None), (None, None, None, None), ("a", None, 1.5, ["z"])]


def test_quality_gate(spark):
    parsed = events.parse_events(_raw(
        spark, "not json", None, {"hazard_type": "x"}, {"event_id": "n"},
        {"event_id": "t", "hazard_type": "test message"}, {"event_id": "k", "hazard_type": "x"}))
    assert rows(events.quality_gate(parsed), "event_id") == [("k",)]


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", 10, 1), ("a", 10, 2), ("a", None, 9), ("b", None, 1), ("b", None, None)],
        "event_id string, updated_at int, ingested_at int")
    assert rows(events.latest_per_key(df)) == [("a", 10, 2), ("b", None, 1)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("hot"), F.col("id") % 1).alias("event_id"), F.col("id").alias("updated_at"),
        F.col("id").alias("ingested_at"))
    latest = events.latest_per_key(df)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert rows(latest) == [("hot0", 999, 999)]


def test_bronze(spark):
    bus = spark.createDataFrame(
        [(bytearray(b"k"), bytearray("{é}", "utf-8"), "earthquakes", 1, 5, None)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    got = events.to_bronze(bus).first()
    assert (got.event_key, got.raw_json, got.partition, got.offset) == ("k", "{é}", 1, 5)
    assert got.bronze_ingested_at is not None


def _versions(spark, data):
    return spark.createDataFrame(data, "event_id string, updated_at int, tag string")


def test_merge_latest(spark):
    old = _versions(spark, [("eq", 10, "old"), ("null", None, "old"), ("newer", 5, "old"),
                            ("late", 5, "old"), ("only", 1, "old"), ("gone", 3, "old")])
    new = _versions(spark, [("eq", 10, "new"), ("null", 7, "new"), ("newer", 6, "new"),
                            ("late", 4, "new"), ("fresh", None, "new"), ("gone", None, "new")])
    expect = [("eq", 10, "new"), ("fresh", None, "new"), ("gone", 3, "old"), ("late", 5, "old"),
              ("newer", 6, "new"), ("null", None, "old"), ("only", 1, "old")]
    assert rows(merge.merge_latest(old, new)) == expect
    plan = plan_of(merge.merge_latest(old, new))
    assert plan.count("Scan ExistingRDD") == 2 * 2  # in the tree, and in the list below it
    assert rows(merge.merge_latest(old, new.select("tag", "updated_at", "event_id"))) == expect


def _replay(batches):
    table = {}
    for batch in batches:
        for key, version, tag in batch:
            held = table.get(key)
            if held is None or (version is not None and held[1] is not None and version >= held[1]):
                table[key] = (key, version, tag)
    return sorted(table.values(), key=lambda r: r[0])


def test_folding_equals_upserting_one_by_one(spark):
    rng = random.Random(7)
    keys = [f"k{i:02d}" for i in range(60)]
    batches = []
    for b in range(6):
        chosen = rng.sample(keys, 35)
        batches.append([(k, rng.choice([None, 1, 2, 3]), f"{b}-{k}") for k in chosen])
    expect = _replay(batches)
    frames = [_versions(spark, b) for b in batches]
    assert sorted(map(tuple, merge.merge_all(frames).collect())) == sorted(expect)
    step = frames[0]
    for frame in frames[1:]:
        step = merge.merge_latest(step, frame)
    assert sorted(map(tuple, step.collect())) == sorted(expect)
    base = merge.merge_all(frames[:3])
    tail = frames[3].withColumn("b", F.lit(3))
    for i in (4, 5):
        tail = tail.unionByName(frames[i].withColumn("b", F.lit(i)))
    folded = merge.fold_onto(base, tail, "b")
    assert sorted(map(tuple, folded.collect())) == sorted(expect)


def test_first_seen_and_new_only(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "event_id string, at int")
    first = events.first_seen(df, "event_id", [F.col("at")])
    assert rows(first) == [("a", 1), ("b", 3)]
    seen = spark.createDataFrame([("a",)], "event_id string")
    assert rows(events.new_only(df, seen)) == [("b", 3)]
