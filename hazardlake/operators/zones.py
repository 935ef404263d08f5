"""Zone lookups: which zones matter, and filling positions from zone centroids."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import geo_source, vertex_centroid
from ..session import measure, stored

# A lookup is sent to every task only when it is measured to stay below both bounds.
LOOKUP_ROWS = 100_000
LOOKUP_BYTES = 16 << 20


def unresolved_zones(events: DataFrame) -> DataFrame:
    """Sorted distinct zones named by events without a latitude."""
    return (events.filter(F.col("lat").isNull())
            .select(F.explode("zones").alias("zone_url"))
            .distinct().orderBy("zone_url"))


def missing_zones(zones: DataFrame, cache: DataFrame) -> DataFrame:
    """Zones not in the lookup yet."""
    return zones.join(cache.select("zone_url"), "zone_url", "left_anti")


def zone_centroids(geometries: DataFrame) -> DataFrame:
    """(zone_url, geometry) to (zone_url, lat, lon); without vertices both are NULL."""
    centre = vertex_centroid(F.col("geometry"))
    return geometries.select("zone_url", centre.alias("c")).select("zone_url", "c.lat", "c.lon")


def refresh_zone_lookup(cache: DataFrame, fetched: DataFrame) -> DataFrame:
    """The lookup plus the fetched centroids it lacks."""
    usable = fetched.filter(F.col("lat").isNotNull())
    return cache.unionByName(missing_zones(usable, cache).select(*cache.columns))


def zone_coverage(zones: DataFrame, cache: DataFrame, fetched: DataFrame) -> DataFrame:
    """One row: zones wanted, cached and to fetch; fetches that gave a centroid or not."""
    wanted = zones.select("zone_url", F.lit(True).alias("wanted"))
    known = cache.select("zone_url", F.lit(True).alias("known"))
    got = fetched.select("zone_url", F.col("lat").isNotNull().alias("got"))
    all_zones = wanted.join(known, "zone_url", "full_outer").join(got, "zone_url", "left")
    todo = F.col("wanted") & F.col("known").isNull()
    ok, count_if = F.coalesce("got", F.lit(False)), F.count_if
    return all_zones.agg(
        F.count("wanted").alias("wanted"), F.count("known").alias("cached"),
        count_if(todo).alias("to_fetch"), count_if(todo & ok).alias("ok"),
        count_if(todo & ~ok).alias("failed"))


def unique_lookup(lookup: DataFrame) -> DataFrame:
    """One complete centroid per zone: of several, that of the smallest latitude, then longitude."""
    return (
        lookup.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .groupBy("zone_url").agg(F.min(F.struct("lat", "lon")).alias("c"))
        .select("zone_url", "c.lat", "c.lon"))


def resolve_zones(zone_lists: DataFrame, lookup: DataFrame) -> DataFrame:
    """(zones) to (zones, zone_lat, zone_lon): the first zone in list order with a centroid."""
    centre = F.struct(F.col("lat").alias("zone_lat"), F.col("lon").alias("zone_lon"))
    return (
        zone_lists.select("zones", F.posexplode("zones").alias("pos", "zone_url"))
        .join(lookup, "zone_url")
        .groupBy("zones").agg(F.min_by(centre, "pos").alias("c"))
        .select("zones", "c.*"))


def _fill(rows: DataFrame, lat: Column, lon: Column) -> DataFrame:
    return rows.withColumns({
        "geo_source": geo_source(F.col("lat"), lat),
        "lat": F.coalesce("lat", lat), "lon": F.coalesce("lon", lon)})


def _slots(lookup: DataFrame, n: int) -> DataFrame:
    """One row: the lookup as an array of `n` slots, each with the zones whose hash falls there."""
    slot = F.pmod(F.xxhash64("zone_url"), F.lit(n))
    filled = lookup.groupBy(slot.alias("slot")).agg(F.collect_list(F.struct("zone_url", "lat", "lon")).alias("zones"))
    every = lookup.sparkSession.range(n).withColumnRenamed("id", "slot").join(filled, "slot", "left")
    ordered = F.array_sort(F.collect_list(F.struct("slot", F.coalesce(
        "zones", F.array().cast(filled.schema["zones"].dataType)).alias("zones"))))
    return every.agg(F.transform(ordered, lambda s: s["zones"]).alias("slots"))


def _fill_in_place(events: DataFrame, lookup: DataFrame, n: int, open_row: Column) -> DataFrame:
    """Every row finds its zones in a small lookup that is sent to all tasks: no row is shuffled or joined."""
    slots = _slots(lookup, n).scalar()

    def centre(zone: Column) -> Column:
        found = F.filter(F.get("_slots", F.pmod(F.xxhash64(zone), F.lit(n)).cast("int")), lambda e: e["zone_url"] == zone)
        return F.get(found, F.lit(0))

    first = F.get(F.filter(F.transform("zones", centre), lambda c: c.isNotNull()), F.lit(0))
    found = events.withColumn("_slots", slots).withColumn("_centre", F.when(open_row, first)).drop("_slots")
    return _fill(found, F.col("_centre.lat"), F.col("_centre.lon")).drop("_centre")


def _fill_joined(events: DataFrame, lookup: DataFrame, open_row: Column) -> DataFrame:
    """Each distinct zone list is resolved once and joined to its rows. The rows are stored, so that they are
    computed once; those that need no zone stay out of the join, and lists that a thousandth of the open rows
    or more have (a thousand lists at most) are sent to them instead."""
    rows = stored(events.withColumn("_open", open_row), "zone-rows")
    waiting = rows.filter("_open")
    counts = stored(waiting.groupBy("zones").agg(F.count("*").alias("n")), "zone-lists")
    total = counts.agg(F.sum("n")).first()[0] or 0
    centres = stored(counts.join(resolve_zones(counts.select("zones"), lookup), "zones", "left").withColumnsRenamed(
        {"zones": "_zones"}), "zone-centres")
    crowded = F.broadcast(centres.filter(F.col("n") * 1000 >= total).drop("n"))
    others = centres.filter(F.col("n") * 1000 < total).drop("n")
    same = F.col("zones") == F.col("_zones")
    found = waiting.join(crowded, same).unionByName(
        waiting.join(crowded.select("_zones"), same, "left_anti").join(others, same))
    none = {"_zones": F.lit(None).cast(rows.schema["zones"].dataType), "zone_lat": F.lit(None).cast("double"),
            "zone_lon": F.lit(None).cast("double")}
    every = found.unionByName(rows.filter("not _open").withColumns(none))
    return _fill(every, F.col("zone_lat"), F.col("zone_lon")).drop("_open", "_zones", "zone_lat", "zone_lon")


def zone_fill(events: DataFrame, lookup: DataFrame, broadcast_rows: int = LOOKUP_ROWS) -> DataFrame:
    """Fill missing positions from zone centroids and say where each position is from.

    A row without a latitude or longitude takes them from the first of its zones that has a centroid. A lookup
    that is measured to be small is sent to the rows; else rows and zone lists are joined.
    """
    open_row = (F.col("lat").isNull() | F.col("lon").isNull()) & (F.coalesce(F.size("zones"), F.lit(0)) > 0)
    known = unique_lookup(lookup)
    n, size = measure(known)
    if n <= broadcast_rows and size <= LOOKUP_BYTES:
        return _fill_in_place(events, known, max(n, 1), open_row)
    return _fill_joined(events, known, open_row)
