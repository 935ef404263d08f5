"""What each layer prints about itself after a run, as small DataFrames by name."""

from pyspark.sql import DataFrame, functions as F

from . import gold


def bronze_report(bronze: DataFrame) -> dict[str, DataFrame]:
    return {
        "total": gold.row_total(bronze),
        "topics": gold.topic_counts(bronze),
        "sample": gold.sample_rows(bronze, ["topic", "event_key", "kafka_timestamp"]),
    }


def silver_report(silver: DataFrame) -> dict[str, DataFrame]:
    return {
        "total": gold.row_total(silver),
        "types": gold.top_groups(gold.type_counts(silver)),
        "sample": gold.sample_rows(silver, [
            "source", "event_id", "severity", "lat", "lon", "occurred_at", "title"]),
    }


def gold_report(silver: DataFrame, hazards: DataFrame, summary: DataFrame) -> dict[str, DataFrame]:
    side = [df.select(F.lit(is_ready).alias("ready"))
            for df, is_ready in ((silver, False), (hazards, True))]
    return {
        "coverage": side[0].unionByName(side[1]).agg(
            F.count_if(~F.col("ready")).alias("total"), F.count_if("ready").alias("map_ready")),
        "geo_sources": gold.geo_source_counts(hazards),
        "top_hazards": gold.top_hazards(hazards).select(
            "source", "hazard_type", "severity_level", "geo_source", "lat", "lon", "place"),
        "top_groups": gold.top_groups(summary),
    }
