"""Hazard-shaped inputs that Spark derives from the given tables.

Every row of a source table yields one row here; nothing is sampled.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import l2_normalize, to_iso
from ..schemas import EVENT

FEATURES_PER_SNAPSHOT = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for work that is heavy per row: one that comes as fewer splits than
    there are cores is dealt out over them, any larger one is read as it is."""
    df = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _text(*parts: Column | str | int) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def _grid(key: Column, factor: int, span: int) -> Column:
    """A position in degrees with two decimals, spread over the whole range."""
    return ((key * factor) % span - span // 2).cast("double") / 100


def hazard_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as versions of hazards: several per id, typed, positions partly missing."""
    n, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    quake = n % 2 == 0
    severity = F.when(n % 13 == 0, None).when(quake, F.col("value") / 12.5).otherwise(
        (1 + n % 4).cast("double"))
    placed = n % 3 != 0
    second = F.date_trunc("second", ts)
    return spread_table(spark, sf_dir, "events").select(
        _text(F.when(quake, "us").otherwise("urn"), F.col("user_id")).alias("event_id"),
        F.when(quake, "usgs").otherwise("nws").alias("source"),
        F.when(n % 97 == 0, "test message").otherwise(F.col("event_type")).alias("hazard_type"),
        F.when(n % 11 != 0, _text(F.col("event_type"), " ", n)).alias("title"),
        severity.alias("severity"),
        F.when(placed, _grid(n, 7919, 18000)).alias("lat"),
        F.when(placed, _grid(n, 104729, 36000)).alias("lon"),
        _text("place ", F.col("user_id") % 20).alias("place"),
        F.date_trunc("minute", ts).alias("occurred_at"),
        second.alias("updated_at"),
        F.timestamp_seconds(F.unix_seconds(second) + n % 3600).alias("ingested_at"),
        _text("https://example.org/", n).alias("url"),
        _text("Report ", n, " of ", F.col("user_id")).alias("description"),
        F.array(_text("z", n * 31 % 60), _text("z", n * 17 % 60)).alias("zones"),
        n.alias("seq"),
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centroids of half of the 60 zones the versions name."""
    ids = table(spark, sf_dir, "events").select((F.col("event_id") * 7 % 60).alias("id"))
    return ids.distinct().filter("id < 30").select(
        _text("z", F.col("id")).alias("zone_url"),
        (20 + F.col("id") % 30).cast("double").alias("lat"),
        (F.col("id") - 120).cast("double").alias("lon"))


def zone_geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched outlines of all zones the events name; the highest ones are empty."""
    ids = table(spark, sf_dir, "events").select((F.col("event_id") * 31 % 60).alias("id"))
    i = F.col("id")
    ring = _text('{"type":"Polygon","coordinates":[[[', i, ",", i, "],[", i + 2, ",", i + 1,
                 "],[", i, ",", i, "]]]}")
    return ids.distinct().select(
        _text("z", i).alias("zone_url"),
        F.when(i < 50, ring).otherwise('{"type":"Polygon","coordinates":[]}').alias("geometry"))


def event_texts(versions: DataFrame) -> DataFrame:
    """Versions with their times as text, as producers emit them."""
    times = ("occurred_at", "updated_at", "ingested_at")
    return versions.withColumns({c: to_iso(F.col(c)) for c in times}).select(*EVENT.fieldNames())


def bus_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small raw records in the six bus columns."""
    n = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        _text("k", F.col("user_id")).cast("binary").alias("key"),
        _text('{"event_id":"k', F.col("user_id"), '","seq":', n, "}").cast("binary").alias("value"),
        F.when(n % 2 == 0, "earthquakes").otherwise("weather-alerts").alias("topic"),
        (F.col("user_id") % 8).cast("int").alias("partition"), n.alias("offset"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("timestamp"))


def versions_by_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as polls of 50 entries, each a version number of its user's record."""
    n = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), F.floor(n / 50).alias("poll"),
        (n % 50).alias("position"), (n * 7919 % 1000).alias("updated"))


def keyed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short keyed rows with a version that is sometimes missing."""
    n = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        _text("k", F.col("user_id")).alias("k"),
        F.when(n % 17 != 0, n * 7919 % 50).alias("v"), n.alias("seq"))


def geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GeoJSON text per event: polygon, deep multi-polygon, point, or none."""
    n = F.col("event_id")
    x, y = n % 90, n % 45
    polygon = _text('{"type":"Polygon","coordinates":[[[', x, ",", y, "],[", x + 2, ",", y + 1,
                    "],[", x, ",", y, "]]]}")
    multi = _text('{"type":"MultiPolygon","coordinates":[[[[', x, ", ", y, ", 7],[", x + 4, ",",
                  y + 2, ",7]]],[[[-", x, ",-", y, "]]]]}")
    point = _text('{"type":"Point","coordinates":[', x, ".25,", y, ".5]}")
    return spread_table(spark, sf_dir, "events").select(
        "event_id", F.when(n % 4 == 0, polygon).when(n % 4 == 1, multi)
        .when(n % 4 == 2, point).alias("geometry"))


def _quoted(name: str, value: Column) -> Column:
    return F.coalesce(_text(f'"{name}":"', value, '"'), F.lit(f'"{name}":null'))


def quake_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earthquake feed documents, FEATURES_PER_SNAPSHOT events each."""
    n, user = F.col("event_id"), F.col("user_id")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    depth = F.when(n % 5 == 0, "10.0").when(n % 5 == 1, "null").otherwise(_text(n % 700))
    feature = _text(
        '{"id":"us', user, '","geometry":{"type":"Point","coordinates":[', n % 180, ".5,-",
        n % 90, ".25,", depth, ']},"properties":{"time":', millis, ',"updated":', millis + n % 5000,
        ',"mag":', F.when(n % 13 == 0, "null").otherwise(_text(n % 8, ".5")), ",",
        _quoted("type", F.when(n % 7 == 0, None).when(n % 7 == 1, "").otherwise("Quarry Blast")),
        ",", _quoted("title", F.when(n % 11 != 0, _text("M at ", user))), ",",
        _quoted("place", _text("place ", user % 20)), ',"url":"https://example.org/', n, '"}}')
    return _snapshots(spread_table(spark, sf_dir, "events"), feature)


def alert_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather-alert feed documents, FEATURES_PER_SNAPSHOT events each."""
    n, user = F.col("event_id"), F.col("user_id")
    at = _text(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"), "-06:00")
    category = F.element_at(
        F.array(*map(F.lit, ("Extreme", "Severe", "Moderate", "Minor", "Unknown"))),
        (n % 5 + 1).cast("int"))
    x, y = n % 90, n % 45
    ring = _text('{"type":"Polygon","coordinates":[[[', x, ",", y, "],[", x + 2, ",", y + 1,
                 "],[", x, ",", y, "]]]}")
    feature = _text(
        '{"id":"https://example.org/a/', n, '","geometry":',
        F.when(n % 3 == 0, "null").otherwise(ring), ',"properties":{"id":"urn', n, '",',
        _quoted("event", F.when(n % 7 == 0, None).when(n % 7 == 1, "").otherwise("Flood Watch")),
        ",", _quoted("headline", F.when(n % 4 == 0, "").otherwise(_text("Headline ", n))), ",",
        _quoted("severity", category), ",", _quoted("areaDesc", _text("area ", user % 20)), ",",
        _quoted("description", F.when(n % 6 != 0, _text("  Rain over ", user, " "))), ",",
        _quoted("instruction", F.when(n % 2 == 0, F.lit("Move up. "))), ",",
        _quoted("onset", F.when(n % 9 != 0, at)), ",",
        _quoted("effective", F.when(n % 2 == 0, F.lit("")).otherwise(at)), ",",
        _quoted("sent", at), ",", _quoted("web", F.when(n % 8 == 0, F.lit("http://w.example"))),
        ',"affectedZones":', F.when(n % 10 == 0, "null").otherwise(_text('["z', n % 60, '"]')),
        "}}")
    return _snapshots(spread_table(spark, sf_dir, "events"), feature)


def _snapshots(events: DataFrame, feature: Column) -> DataFrame:
    entry = F.struct("event_id", feature.alias("f"))
    ordered = F.sort_array(F.collect_list(entry))
    body = F.array_join(F.transform(ordered, lambda e: e.f), ",")
    snapshot = F.floor(F.col("event_id") / FEATURES_PER_SNAPSHOT).alias("poll")
    return events.groupBy(snapshot).agg(
        _text('{"type":"FeatureCollection","features":[', body, "]}").alias("value"))


def search_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as a place to search around, with its own radius and limit."""
    key = F.col("s_suppkey")
    return spread_table(spark, sf_dir, "supplier").select(
        key.alias("qid"), _grid(key, 7919, 18000).alias("lat"), _grid(key, 104729, 36000).alias("lon"),
        (100 * (1 + key % 40)).cast("double").alias("radius_km"),
        (1 + key % 60).cast("int").alias("limit"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search requests of every kind, many outside the allowed ranges."""
    n = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        n.alias("qid"), (n % 250 - 125).cast("double").alias("lat"),
        (n % 410 - 205).cast("double").alias("lon"),
        (n * 7 % 30000 - 100).cast("double").alias("radius_km"), (n % 700).cast("int").alias("limit"),
        F.substring("event_type", 1, (n % 6).cast("int")).alias("question"))


def unit_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", l2_normalize(F.col("embedding")).alias("vec"))
