"""Map-ready hazards, rollup and their reports."""

from pyspark.sql import DataFrame, functions as F

from ..functions import severity_level
from ..schemas import HAZARD_COLUMNS
from .zones import zone_fill


def with_level(events: DataFrame) -> DataFrame:
    return events.withColumn("severity_level", severity_level(F.col("source"), F.col("severity")))


def enrich(events: DataFrame, lookup: DataFrame) -> DataFrame:
    """Severity levels and filled positions."""
    return zone_fill(with_level(events), lookup)


def gold_hazards(enriched: DataFrame) -> DataFrame:
    """Events that can be put on a map."""
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return enriched.filter(placed).select(*HAZARD_COLUMNS)


def gold_summary(levelled: DataFrame) -> DataFrame:
    """Count and latest time per source, type and level, over all events."""
    return levelled.groupBy("source", "hazard_type", "severity_level").agg(
        F.count("*").alias("event_count"), F.max("occurred_at").alias("latest_event_at"))


def summary_parts(enriched: DataFrame, part: str) -> DataFrame:
    """The rollup and the coverage of each part of the rows: what is kept to renew them from changed parts alone."""
    return enriched.groupBy(part, "source", "hazard_type", "severity_level").agg(
        F.count("*").alias("event_count"), F.max("occurred_at").alias("latest_event_at"),
        F.count_if(F.col("lat").isNotNull() & F.col("lon").isNotNull()).alias("map_ready"))


def summary_of_parts(parts: DataFrame) -> DataFrame:
    """`gold_summary` from the rollups of all parts, and how many events of each group can be put on a map."""
    return parts.groupBy("source", "hazard_type", "severity_level").agg(
        F.sum("event_count").alias("event_count"), F.max("latest_event_at").alias("latest_event_at"),
        F.sum("map_ready").alias("map_ready"))


def coverage_of_parts(parts: DataFrame) -> DataFrame:
    """`coverage` from the rollups of all parts."""
    zero = F.lit(0).cast("long")
    return parts.agg(F.coalesce(F.sum("event_count"), zero).alias("total"),
                     F.coalesce(F.sum("map_ready"), zero).alias("map_ready"))


def geo_source_counts(hazards: DataFrame) -> DataFrame:
    return hazards.groupBy("geo_source").agg(F.count("*").alias("n"))


def coverage(enriched: DataFrame) -> DataFrame:
    """One row: all events and those that can be put on a map."""
    return enriched.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("lat").isNotNull() & F.col("lon").isNotNull()).alias("map_ready"))


def top_hazards(hazards: DataFrame, n: int = 8) -> DataFrame:
    """Most severe first, then latest, then id."""
    return hazards.orderBy(
        F.desc_nulls_last("severity"), F.desc_nulls_last("occurred_at"), "event_id").limit(n)


def top_groups(counts: DataFrame, n: int = 12, count: str = "event_count") -> DataFrame:
    """Largest groups first; equal counts in key order."""
    keys = [c for c, t in counts.dtypes if c != count and t == "string"]
    return counts.orderBy(F.desc(count), *keys).limit(n)


def topic_counts(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("topic").agg(F.count("*").alias("n"))


def type_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("source", "hazard_type").agg(F.count("*").alias("event_count"))


def row_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def sample_rows(df: DataFrame, columns: list[str], n: int = 5,
                order: list[str] | None = None) -> DataFrame:
    """A few rows to look at; any rows unless an order is given."""
    return (df.orderBy(*order) if order else df).select(*columns).limit(n)
