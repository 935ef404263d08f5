"""The query list: each entry runs one operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import parse_iso, severity_level, to_iso, vertex_centroid
from ..operators import ask, changes, events, gold, grounding, merge, nearest, radius, retrieval, zones
from ..operators.requests import MAX_LIMIT, clean_output, split_queries, validate_queries
from ..schemas import EVENT, RETRIEVED_COLUMNS, TOPIC, ZONE_LOOKUP
from ..session import configure, fits_broadcast, scratch_dir, stored
from ..sources import bus, feeds, lookup, tables
from ..streaming import layers, publish, versions
from . import inputs as I
from .flagship import nearest_from_raw
from .pipeline import refresh_parts, run_pipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)
    QUERIES[fn.__name__] = run
    return fn


def _iso(*names: str) -> dict:
    return {n: to_iso(F.col(n)) for n in names}


# Shared steps ---------------------------------------------------------------

def _silver(spark, sf):
    return events.latest_per_key(events.quality_gate(I.hazard_versions(spark, sf)))


def _enriched(spark, sf):
    return gold.enrich(_silver(spark, sf), I.zone_lookup(spark, sf))


def _hazards(spark, sf):
    return gold.gold_hazards(_enriched(spark, sf))


def _raw(spark, sf, column="raw_json"):
    records = bus.to_bus(I.event_texts(I.hazard_versions(spark, sf)), "t")
    return records.select(F.col("value").cast("string").alias(column))


# Bronze and silver ----------------------------------------------------------

@query
def bronze_decode(spark, sf):
    bronze = events.to_bronze(I.bus_records(spark, sf), F.timestamp_seconds(F.lit(0)))
    return bronze.withColumns(_iso("kafka_timestamp", "bronze_ingested_at"))


@query
def topic_counts(spark, sf):
    return gold.topic_counts(events.to_bronze(I.bus_records(spark, sf)))


@query
def bronze_sample(spark, sf):
    bronze = events.to_bronze(I.bus_records(spark, sf)).withColumns(_iso("kafka_timestamp"))
    return gold.sample_rows(bronze, ["topic", "event_key", "kafka_timestamp"],
                            order=["offset"])


@query
def parse_events(spark, sf):
    parsed = events.parse_events(_raw(spark, sf))
    return parsed.withColumns(_iso("occurred_at", "updated_at", "ingested_at")).withColumns({
        "zones": F.array_join("zones", ","), "severity": F.round("severity", 6)})


@query
def parse_timestamps(spark, sf):
    """Three spellings of one time: only the fixed format is read."""
    n = F.col("event_id")
    at = to_iso(F.col("ts").cast("timestamp"))
    text = F.when(n % 3 == 0, at).when(n % 3 == 1, F.replace(at, F.lit("Z"), F.lit(".123Z"))
                                       ).otherwise(F.substring(at, 1, 10))
    return I.table(spark, sf, "events").select("event_id", to_iso(parse_iso(text)).alias("at"))


@query
def quality_gate(spark, sf):
    gated = events.quality_gate(events.parse_events(_raw(spark, sf)))
    return gated.select("event_id", "hazard_type", "url")


@query
def latest_per_key(spark, sf):
    return _silver(spark, sf).select(
        "event_id", to_iso(F.col("updated_at")).alias("updated_at"), "seq")


@query
def merge_two_batches(spark, sf):
    rows = I.keyed_versions(spark, sf)
    half = rows.count() // 2
    order = [F.desc_nulls_last("v"), F.desc("seq")]
    old = events.latest_per_key(rows.filter(F.col("seq") < half), "k", order)
    new = events.latest_per_key(rows.filter(F.col("seq") >= half), "k", order)
    return merge.merge_latest(old, new, "k", "v")


@query
def fold_batches(spark, sf):
    rows = I.keyed_versions(spark, sf)
    size = -(-rows.count() // 4)
    tagged = rows.withColumns({
        "batch": F.floor(F.col("seq") / size),
        "slot": F.concat_ws("/", F.col("k"), F.floor(F.col("seq") / size).cast("string"))})
    order = [F.desc_nulls_last("v"), F.desc("seq")]
    reduced = events.latest_per_key(tagged, "slot", order).drop("slot")
    return merge.fold_batches(reduced, "batch", "k", "v")


@query
def type_counts(spark, sf):
    return gold.top_groups(gold.type_counts(_silver(spark, sf)))


@query
def silver_sample(spark, sf):
    silver = _silver(spark, sf).withColumns(_iso("occurred_at"))
    return gold.sample_rows(
        silver, ["source", "event_id", F.round("severity", 6).alias("severity"), "lat", "lon",
                 "occurred_at", "title"], order=["event_id"])


# Gold -----------------------------------------------------------------------

@query
def severity_levels(spark, sf):
    return I.hazard_versions(spark, sf).select(
        "seq", severity_level(F.col("source"), F.col("severity")).alias("severity_level"))


@query
def zone_fill(spark, sf):
    return _enriched(spark, sf).select("event_id", "geo_source", "lat", "lon")


@query
def zone_fill_versions(spark, sf):
    """All versions, some with a latitude only."""
    rows = I.hazard_versions(spark, sf).withColumn(
        "lon", F.when(F.col("seq") % 5 != 0, F.col("lon")))
    filled = zones.zone_fill(rows, I.zone_lookup(spark, sf))
    return filled.select("seq", "geo_source", "lat", "lon")


@query
def zone_fill_joined(spark, sf):
    """All versions against a lookup that lists each zone twice: the smaller latitude counts."""
    lookup = I.zone_lookup(spark, sf)
    twice = lookup.unionByName(lookup.withColumn("lat", F.col("lat") + 1))
    filled = zones.zone_fill(I.hazard_versions(spark, sf), twice)
    return filled.select("seq", "geo_source", "lat", "lon")


@query
def zone_fill_by_lists(spark, sf):
    """The form for a large lookup: rows joined to the lists of zones they name."""
    filled = zones.zone_fill(I.hazard_versions(spark, sf), I.zone_lookup(spark, sf), broadcast_rows=0)
    return filled.select("seq", "geo_source", "lat", "lon")


@query
def gold_hazards(spark, sf):
    return _hazards(spark, sf).withColumns({
        **_iso("occurred_at", "updated_at"), "severity": F.round("severity", 6)})


@query
def gold_summary(spark, sf):
    return gold.gold_summary(gold.with_level(_silver(spark, sf))).withColumns(
        _iso("latest_event_at"))


@query
def geo_source_counts(spark, sf):
    return gold.geo_source_counts(_enriched(spark, sf))


@query
def coverage(spark, sf):
    return gold.coverage(_enriched(spark, sf))


@query
def row_total(spark, sf):
    return gold.row_total(_silver(spark, sf))


@query
def top_hazards(spark, sf):
    return gold.top_hazards(_hazards(spark, sf)).select(
        "source", "hazard_type", "severity_level", "geo_source", "lat", "lon", "place",
        "event_id")


@query
def top_groups(spark, sf):
    summary = gold.gold_summary(gold.with_level(_silver(spark, sf)))
    return gold.top_groups(summary).withColumns(_iso("latest_event_at"))


@query
def gold_table_roundtrip(spark, sf):
    """Overwrite a table with another schema, clustered by cell, and read it back."""
    path = scratch_dir(spark, "gold")
    hazards = _hazards(spark, sf)
    tables.overwrite_table(hazards.drop("geo_source"), path)
    cell = radius.grid_cell(F.col("lat"), F.col("lon"), F.lit(4))
    tables.overwrite_table(hazards, path, cluster_by=[cell, F.col("event_id")])
    return tables.read_table(spark, path).select("event_id", "geo_source", "lat", "lon")


# Zones ----------------------------------------------------------------------

@query
def vertex_centroids(spark, sf):
    return I.geometries(spark, sf).select(
        "event_id", vertex_centroid(F.col("geometry")).alias("c")).select("event_id", "c.*")


@query
def unresolved_zones(spark, sf):
    return zones.unresolved_zones(_silver(spark, sf))


@query
def missing_zones(spark, sf):
    wanted = zones.unresolved_zones(I.hazard_versions(spark, sf))
    return zones.missing_zones(wanted, I.zone_lookup(spark, sf))


@query
def zone_coverage(spark, sf):
    wanted = zones.unresolved_zones(I.hazard_versions(spark, sf))
    fetched = zones.zone_centroids(I.zone_geometries(spark, sf))
    return zones.zone_coverage(wanted, I.zone_lookup(spark, sf), fetched)


@query
def refresh_zone_lookup(spark, sf):
    fetched = zones.zone_centroids(I.zone_geometries(spark, sf))
    return zones.refresh_zone_lookup(I.zone_lookup(spark, sf), fetched)


@query
def zone_lookup_file(spark, sf):
    """The lookup written as JSON objects and read back; a missing file adds nothing."""
    path = scratch_dir(spark, "lookup")
    lookup.write_zone_lookup(I.zone_lookup(spark, sf), path)
    return lookup.read_zone_lookup(spark, path).unionByName(
        lookup.read_zone_lookup(spark, path + "-none")).select(*ZONE_LOOKUP.fieldNames())


# Feeds, changes, bus --------------------------------------------------------

def _as_of():
    return F.lit("2026-01-02 03:04:05").cast("timestamp")


@query
def normalize_quakes(spark, sf):
    features, _ = feeds.split_features(
        feeds.features_of(I.quake_snapshots(spark, sf), "usgs"), "usgs")
    out = feeds.normalize_usgs(features, _as_of(), ("poll", "position"))
    return out.withColumn("zones", F.array_join("zones", ","))


@query
def normalize_alerts(spark, sf):
    features, _ = feeds.split_features(
        feeds.features_of(I.alert_snapshots(spark, sf), "nws"), "nws")
    out = feeds.normalize_nws(features, _as_of(), ("poll", "position"))
    return out.withColumn("zones", F.array_join("zones", ","))


@query
def rejected_features(spark, sf):
    """Features that lack what they need: here half of the quakes lose a part."""
    damaged = I.quake_snapshots(spark, sf).withColumn(
        "value", F.regexp_replace("value", r',null\]', "]"))
    _, rejected = feeds.split_features(feeds.features_of(damaged, "usgs"), "usgs")
    return rejected.groupBy("poll", "reason").agg(F.count("*").alias("n"))


@query
def damaged_documents(spark, sf):
    """Every third snapshot is cut short: per poll, features kept and rows rejected by reason."""
    cut = F.when(F.col("poll") % 3 == 0, F.expr("left(value, length(value) - 2)")).otherwise(F.col("value"))
    features = feeds.features_of(I.quake_snapshots(spark, sf).withColumn("value", cut), "usgs")
    kept, rejected = feeds.split_features(features, "usgs")
    every = kept.select("poll", F.lit("kept").alias("outcome")).unionByName(
        rejected.select("poll", F.col("reason").alias("outcome")))
    return every.groupBy("poll", "outcome").agg(F.count("*").alias("n"))


@query
def read_feed(spark, sf):
    """Snapshots landed as files, one document each, read back as features."""
    path = scratch_dir(spark, "landing")
    I.quake_snapshots(spark, sf).write.partitionBy("poll").text(path)
    features = feeds.read_feed(spark, f"{path}/poll=*", "usgs")
    return features.select("position", "id", "properties.updated", "properties.mag")


def _records(records):
    """Every field of the records' JSON bodies, and how many fields each body has."""
    body = F.col("value").cast("string")
    fields = F.from_json(body, EVENT)
    return records.select(F.col("key").cast("string").alias("key"), "topic", F.size(F.json_object_keys(body)).alias("k"),
                          fields.alias("e")).select("key", "topic", "k", "e.*").withColumns({
                              "severity": F.round("severity", 6), "zones": F.array_join("zones", ",")})


@query
def bus_records(spark, sf):
    return _records(bus.to_bus(I.event_texts(I.hazard_versions(spark, sf)), "earthquakes"))


@query
def bus_roundtrip(spark, sf):
    """Both topics written as record files and read as one source."""
    path = scratch_dir(spark, "bus")
    rows = I.event_texts(I.hazard_versions(spark, sf))
    for source, topic in TOPIC.items():
        bus.write_bus(rows.filter(F.col("source") == source), topic, f"{path}/{topic}")
    read = bus.read_bus(spark, [f"{path}/{t}" for t in TOPIC.values()], streaming=False)
    return _records(read)


@query
def change_log(spark, sf):
    return changes.detect_changes(
        I.versions_by_poll(spark, sf), "id", "updated", "poll", ("position",))


@query
def change_log_chunked(spark, sf):
    """The same in many chunks per key, as very long histories are scanned."""
    rows = I.versions_by_poll(spark, sf)
    return changes.detect_changes(
        rows, "id", "updated", "poll", ("position",), rows_per_chunk=max(1, rows.count() // 12))


@query
def change_log_one_poll(spark, sf):
    """All rows under one landing time and told apart by a text: cut into ranges of the whole order."""
    rows = I.versions_by_poll(spark, sf)
    landed = rows.withColumns({"file": F.format_string("f%012d", "poll"), "poll": F.lit(7).cast("bigint")})
    tagged = changes.detect_changes(landed, "id", "updated", "poll", ("file", "position"),
                                    rows_per_chunk=max(1, rows.count() // 12))
    return tagged.select("id", "file", "position", "updated", "kind")


@query
def poll_report(spark, sf):
    return changes.poll_report(change_log(spark, sf))


@query
def first_seen(spark, sf):
    return events.first_seen(I.versions_by_poll(spark, sf), "id",
                             [F.col("poll"), F.col("position")])


@query
def new_only(spark, sf):
    """Second-half rows whose key the first half lacks (keys pair user and value)."""
    rows = I.table(spark, sf, "events").select(
        F.concat_ws("-", "user_id", F.floor("value").cast("string")).alias("event_id"),
        F.col("event_id").alias("seq"))
    half = rows.count() // 2
    return events.new_only(rows.filter(F.col("seq") >= half), rows.filter(F.col("seq") < half))


# Search ---------------------------------------------------------------------

@query
def hazards_near(spark, sf):
    return clean_output(radius.hazards_near(_hazards(spark, sf), 39.5, -98.35, 2000.0)).withColumn(
        "severity", F.round("severity", 6))


@query
def nearest_from_json(spark, sf):
    near = nearest_from_raw(_raw(spark, sf), I.zone_lookup(spark, sf), 39.5, -98.35, 2000.0)
    return clean_output(near).withColumn("severity", F.round("severity", 6))


def _placed_versions(spark, sf):
    return I.hazard_versions(spark, sf).select("seq", "event_id", "lat", "lon")


def _pairs(df):
    return df.select("qid", "seq", F.round("distance_km", 3).alias("distance_km"))


@query
def radius_join(spark, sf):
    return _pairs(radius.radius_join(
        I.search_points(spark, sf).select("qid", "lat", "lon"), _placed_versions(spark, sf).drop("event_id"),
        500.0, hazard_key="seq"))


@query
def radius_join_own_radius(spark, sf):
    return _pairs(radius.radius_join(
        I.search_points(spark, sf).drop("limit"), _placed_versions(spark, sf).drop("event_id"), hazard_key="seq"))


@query
def radius_join_sliced(spark, sf):
    """The shuffled form, with crowded cells cut into slices."""
    hazards = _placed_versions(spark, sf).drop("event_id")
    return _pairs(radius.radius_join(
        I.search_points(spark, sf).drop("limit"), hazards, hazard_key="seq",
        broadcast_rows=0, rows_per_slice=max(4, hazards.count() // 100)))


@query
def near_beyond_the_line(spark, sf):
    """Positions stored up to a turn further east are found all the same."""
    turned = _hazards(spark, sf).withColumn("lon", F.col("lon") + 360)
    near = radius.hazards_near(turned, 10.0, -170.0, 3000.0)
    return near.select("event_id", "distance_km")


@query
def near_report(spark, sf):
    points = I.search_points(spark, sf)
    hits = nearest.nearest_join(points, _hazards(spark, sf))
    report = radius.near_report(points, hits.select(*LISTED))
    return report.select("qid", "lat", "lon", "radius_km", "count", _listed().alias("hazards"))


# What `_listed` shows of a hit.
LISTED = ("qid", "n", "event_id", "distance_km")


def _listed():
    return F.array_join(F.transform("hazards", lambda h: F.concat_ws(
        ":", h.event_id, h.distance_km.cast("string"))), "|")


@query
def nearest_versions(spark, sf):
    """The eight versions nearest to every supplier's place, within 300 km."""
    versions = _placed_versions(spark, sf)
    hits = nearest.nearest_join(I.search_points(spark, sf).select("qid", "lat", "lon"), versions.drop("event_id"),
                                300.0, 8, hazard_key="seq")
    return hits.select("qid", "n", "seq", "distance_km")


@query
def near_requests(spark, sf):
    """Every request: its report, or the reason it is refused (limits above 500 among them)."""
    valid, refused = split_queries(I.requests(spark, sf))
    hits = nearest.nearest_join(valid.drop("question"), _hazards(spark, sf), most=MAX_LIMIT)
    report = radius.near_report(valid, hits.select(*LISTED)).select("qid", "count", F.md5(_listed()).alias("hazards"))
    return report.unionByName(refused.select("qid", "reason"), allowMissingColumns=True)


@query
def requests_checked(spark, sf):
    return validate_queries(I.requests(spark, sf)).select("qid", "reason")


@query
def output_cleaned(spark, sf):
    rows = I.hazard_versions(spark, sf).select(
        "seq", F.when(F.col("seq") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("lat")).alias("lat"),
        "updated_at")
    return clean_output(rows)


# Retrieval and grounding ----------------------------------------------------

def _vector_hazards(spark, sf):
    """Newest hazards with a vector and a long text each."""
    vectors = I.unit_vectors(spark, sf).select("vec_id", "vec")
    texts = I.table(spark, sf, "documents").select("doc_id", F.col("text").alias("description"))
    n_vectors, n_texts = vectors.count(), texts.count()
    full = gold.enrich(_silver(spark, sf), I.zone_lookup(spark, sf)).withColumns({
        "vec_id": F.col("seq") % n_vectors, "doc_id": F.col("seq") % n_texts})
    named = stored(full.select(*[c for c in full.columns if c in RETRIEVED_COLUMNS and c != "description"],
                               "vec_id", "doc_id"), "vector-hazards")
    if fits_broadcast(named) and fits_broadcast(vectors):  # texts are not shuffled
        joined = texts.join(F.broadcast(named), "doc_id").join(F.broadcast(vectors), "vec_id")
    else:
        joined = named.join(vectors, "vec_id").join(texts, "doc_id")
    return joined.drop("vec_id", "doc_id")


def _questions(spark, sf):
    vectors = I.unit_vectors(spark, sf)
    n_vectors = vectors.count()
    points = I.search_points(spark, sf)
    return (
        points.withColumns({
            "vec_id": F.col("qid") % n_vectors, "k": (1 + F.col("qid") % 7).cast("int"),
            "question": F.concat(F.lit("What is near place "), F.col("qid").cast("string"), F.lit("?"))})
        .join(vectors.select("vec_id", F.col("vec").alias("qvec")), "vec_id")
        .drop("vec_id", "limit"))


def _retrieved(spark, sf, k=5):
    return retrieval.geo_semantic_topk(_questions(spark, sf), _vector_hazards(spark, sf), k)


@query
def cosine_topk(spark, sf):
    """Per label: the five vectors closest to the label's first one."""
    vectors = I.unit_vectors(spark, sf)
    asked = vectors.groupBy("label").agg(F.min_by("vec", "vec_id").alias("qvec"))
    pairs = vectors.join(asked, "label")
    return retrieval.cosine_topk(pairs, 5, by="label", tie="vec_id").select(
        "label", "n", "vec_id", F.round("similarity", 3).alias("similarity"))


@query
def nearest_vectors(spark, sf):
    """The ten vectors closest to the mean of all."""
    vectors = I.unit_vectors(spark, sf)
    mean = (vectors.select(F.posexplode("vec").alias("i", "x"))
            .groupBy("i").agg(F.avg("x").alias("x")).orderBy("i").collect())
    near = retrieval.nearest_vectors(vectors, [r.x for r in mean], 10, tie="vec_id")
    return near.select("vec_id", F.round("similarity", 3).alias("similarity"))


@query
def geo_semantic_topk(spark, sf):
    return _retrieved(spark, sf).withColumn("description", F.md5("description"))


@query
def geo_semantic_topk_bounded(spark, sf):
    """The same rows with bounds on what parts of the grid cells can hold."""
    found = retrieval.bounded_semantic_topk(_questions(spark, sf), _vector_hazards(spark, sf))
    return found.withColumn("description", F.md5("description"))


@query
def geo_semantic_topk_own_k(spark, sf):
    return _retrieved(spark, sf, None).select("qid", "n", "event_id", "similarity")


def _documents_as_events(spark, sf):
    return I.spread_table(spark, sf, "documents").select(
        F.col("doc_id").alias("event_id"), F.col("source").alias("title"),
        F.col("text").alias("description"))


def _millionths(vec):
    return F.transform(vec, lambda x: F.round(x * 1e6).cast("bigint"))


@query
def embed_events(spark, sf):
    """Hashed, weighted, unit-length text vectors of every document: all places and weights that are not zero."""
    vec = _millionths(F.col("vec"))
    places = F.filter(F.transform(vec, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda p: p.x != 0)
    listed = F.array_join(F.transform(places, lambda p: F.concat_ws(":", p.i, p.x)), ",")
    return retrieval.embed_events(_documents_as_events(spark, sf), dtype="float64").select(
        "event_id", F.length("text").alias("text_chars"), F.size("vec").alias("dimensions"),
        F.size(places).alias("terms"), F.md5(listed).alias("weights"))


def _letter_counter():
    """Stands in for a sentence model: how often each letter from a to z is in a text."""
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    return lambda texts: [[float(t.count(c)) for c in letters] for t in texts]


@query
def embed_plugged_in(spark, sf):
    """The same documents through a model that is loaded in the tasks."""
    embedder = retrieval.model_embedder(_letter_counter)
    return retrieval.embed_events(_documents_as_events(spark, sf), embedder).select(
        "event_id", F.array_join(_millionths(F.col("vec")), ",").alias("weights"))


@query
def citations(spark, sf):
    return grounding.citations(_retrieved(spark, sf))


@query
def prompt_text(spark, sf):
    return grounding.prompt_text(_retrieved(spark, sf), _questions(spark, sf))


@query
def guardrail_answers(spark, sf):
    return grounding.guardrail_answers(_questions(spark, sf), _retrieved(spark, sf))


@query
def grounded_requests(spark, sf):
    rows = grounding.grounded_requests(_questions(spark, sf), _retrieved(spark, sf))
    cited = F.array_join(F.transform("citations", lambda c: F.concat_ws(
        ":", c.n.cast("string"), c.event_id)), "|")
    return rows.select("qid", F.md5("prompt").alias("prompt"), "answer", "needs_model",
                       cited.alias("citations"))


def _asked(spark, sf):
    """Requests of every kind with a vector each; every third names no radius."""
    vectors = I.unit_vectors(spark, sf).select("vec_id", F.col("vec").alias("qvec"))
    n = vectors.count()
    return (
        I.requests(spark, sf).drop("limit")
        .withColumn("radius_km", F.when(F.col("qid") % 3 != 0, F.col("radius_km")))
        .withColumn("vec_id", F.col("qid") % n).join(vectors, "vec_id").drop("vec_id"))


def _envelope(rows):
    cited = F.array_join(F.transform("citations", lambda c: F.concat_ws(
        ":", c.n.cast("string"), c.event_id)), "|")
    return rows.withColumns({"citations": cited, "answer": F.md5("answer")})


@query
def ask_requests(spark, sf):
    """Every request answered, its prompt standing in for a model's answer, or refused."""
    return _envelope(ask.ask(_asked(spark, sf), _vector_hazards(spark, sf), lambda prompt: prompt))


@query
def ask_without_model(spark, sf):
    return _envelope(ask.ask(_asked(spark, sf), _vector_hazards(spark, sf)))


@query
def indexed_vectors(spark, sf):
    """How many hazards have a vector to be found by."""
    return retrieval.vector_count(_vector_hazards(spark, sf))


# Streams --------------------------------------------------------------------

@query
def stream_silver(spark, sf):
    """Two drops of bus records through bronze into silver, with a restart between."""
    root = scratch_dir(spark, "layers")
    rows = I.hazard_versions(spark, sf)
    half = rows.count() // 2
    for part in (F.col("seq") < half, F.col("seq") >= half):
        bus.write_bus(I.event_texts(rows.filter(part)), "earthquakes", f"{root}/bus")
        layers.run_bronze(bus.read_bus(spark, f"{root}/bus"), f"{root}/bronze", f"{root}/c/bronze")
        layers.run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/c/silver")
    return tables.read_table(spark, f"{root}/silver").select(
        "event_id", to_iso(F.col("updated_at")).alias("updated_at"), "url")


def _two_drops(spark, sf, run):
    """Poll rows in two drops through a publishing stream; what it passed on."""
    root = scratch_dir(spark, "publish")
    rows = I.versions_by_poll(spark, sf)
    half = rows.agg(F.max("poll")).first()[0] // 2

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    for part in (F.col("poll") <= half, F.col("poll") > half):
        rows.filter(part).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        run(stream, f"{root}/state", f"{root}/checkpoint", sink)
    return spark.read.parquet(f"{root}/out").drop("batch")


@query
def stream_changes(spark, sf):
    return _two_drops(spark, sf, lambda stream, state, checkpoint, sink: publish.publish_changes(
        stream, state, checkpoint, sink, key="id", order=("poll", "position")))


@query
def stream_first_seen(spark, sf):
    return _two_drops(spark, sf, lambda stream, state, checkpoint, sink: publish.publish_new(
        stream, state, checkpoint, sink, key="id", order=("poll", "position")))


@query
def rollup_two_drops(spark, sf):
    """Rollup and coverage kept per bucket of silver, renewed after each of two drops from the buckets they touched."""
    root = scratch_dir(spark, "rollup")
    rows = I.hazard_versions(spark, sf).filter(F.col("hazard_type") != "test message")
    half = I.hazard_versions(spark, sf).count() // 2
    for batch, part in enumerate((F.col("seq") < half, F.col("seq") >= half)):
        tables.upsert_batch(rows.filter(part), batch, f"{root}/silver")
        refresh_parts(spark, f"{root}/silver", f"{root}/parts", I.zone_lookup(spark, sf))
    parts = tables.read_table(spark, f"{root}/parts")
    return gold.summary_of_parts(parts).withColumns(_iso("latest_event_at"))


@query
def stream_versions(spark, sf):
    """The same two drops through Spark's keyed state, with a restart between."""
    root = scratch_dir(spark, "versions")
    rows = I.versions_by_poll(spark, sf)
    half = rows.agg(F.max("poll")).first()[0] // 2
    for part in (F.col("poll") <= half, F.col("poll") > half):
        rows.filter(part).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        changed = versions.changed_versions(stream, "id", order=("poll", "position"))
        (changed.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").outputMode("append")
         .trigger(availableNow=True).start(f"{root}/out").awaitTermination())
    return spark.read.parquet(f"{root}/out")


@query
def feeds_to_summary(spark, sf):
    """Both feeds from landed files to the rollup."""
    root = scratch_dir(spark, "feeds")
    I.quake_snapshots(spark, sf).write.partitionBy("poll").text(f"{root}/landing/usgs")
    I.alert_snapshots(spark, sf).write.partitionBy("poll").text(f"{root}/landing/nws")
    landing = {s: f"{root}/landing/{s}/poll=*" for s in ("usgs", "nws")}
    run_pipeline(spark, landing, root, lookup=I.zone_lookup(spark, sf))
    return tables.read_table(spark, f"{root}/gold/summary").withColumns(_iso("latest_event_at"))
