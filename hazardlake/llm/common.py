"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import scratch_dir, ship_code

# Bounds of one Arrow batch: texts and binary columns may be long.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session options the operators rely on; safe on a running session."""
    ship_code(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared scratch folder: computed once, and safe when executors go."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within the block Spark removes an action's shuffle files when the action ends, so that only written tables take
    disk from one step to the next. A DataFrame object is to be acted on once in it: a second action on the same one
    would run its shuffles again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """`rows` with `pos`: the place (from 0) of a row among those of its group, by the columns `order`
    (nulls first), which tell any two rows of a group apart.

    The rows are dealt to ranges, so that a group of any size is spread over tasks; the places of a
    range follow from the sizes of the group's runs in the ranges before it.
    """
    ranges = shuffle_partitions(rows.sparkSession)
    placed = written(rows.repartitionByRange(ranges, group, *order).sortWithinPartitions(group, *order)
                     .withColumn("_place", F.monotonically_increasing_id()), name)
    part = F.shiftright("_place", 33)  # the number of the range
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy(F.col(group).alias("_group"), part.alias("_part")).agg(
        F.min("_place").alias("_first"), F.count("*").alias("_n")) \
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    return placed.join(runs, placed[group].eqNullSafe(runs["_group"]) & (part == runs["_part"])).select(
        *rows.columns, (F.col("_place") - F.col("_first") + F.col("_before")).alias("pos"))
