"""Bus records to typed, gated, newest-only events."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import parse_iso
from ..schemas import EVENT, EVENT_TIMES

# Fixed value: keep-alive messages of the alert feed.
TEST_TYPE = "test message"


def to_bronze(bus: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Decode key and value, keep the bus metadata, stamp the arrival time."""
    return bus.select(
        F.col("key").cast("string").alias("event_key"),
        F.col("value").cast("string").alias("raw_json"),
        "topic", "partition", "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        (F.current_timestamp() if as_of is None else as_of).alias("bronze_ingested_at"),
    )


def parse_events(bronze: DataFrame) -> DataFrame:
    """`raw_json` to canonical columns; bad text or bad fields become NULL.

    The parsed struct goes through a generator, so later filters cannot be pushed
    below it and each text is parsed once.
    """
    parsed = bronze.select(F.inline(F.array(F.from_json("raw_json", EVENT))))
    return parsed.withColumns({name: parse_iso(F.col(name)) for name in EVENT_TIMES})


def quality_gate(events: DataFrame) -> DataFrame:
    """Drop rows without id and keep-alives; an unknown hazard type is dropped too."""
    return events.filter(F.col("event_id").isNotNull() & (F.col("hazard_type") != TEST_TYPE))


def latest_per_key(events: DataFrame, key: str = "event_id", order: list[Column] | None = None,
                   ) -> DataFrame:
    """Newest row per key: `updated_at`, then `ingested_at`, NULLs last.

    The rank-one filter lets Spark cut every task's rows to one per key before the
    shuffle, so a hot key moves one row per task.
    """
    newest = order or [F.desc_nulls_last("updated_at"), F.desc_nulls_last("ingested_at")]
    return _first_in_order(events, key, newest)


def first_seen(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return _first_in_order(rows, key, order)


def new_only(rows: DataFrame, seen: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows whose key has not been seen."""
    return rows.join(seen.select(key), key, "left_anti")


def _first_in_order(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
