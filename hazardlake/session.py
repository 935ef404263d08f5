"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# A side is broadcast only when it is measured to stay below both bounds.
NARROW_BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the plans rely on; safe on a running session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def build_session(app: str = "hazardlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended options; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    options.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, which may run in any folder; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        target = f"{tempfile.mkdtemp(prefix='code-')}/{package.name}"
        context.addPyFile(shutil.make_archive(target, "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path for written intermediates.

    On a cluster it lies under the shared folder of `spark.checkpoint.dir`; only
    a local master may fall back to the machine's own temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="hazardlake-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the scratch folder: computed once, and safe when executors go."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> Column:
    """Approximate bytes of a row; nested types other than flat arrays count as too big."""
    width = F.lit(0).cast("long")
    for field in df.schema.fields:
        value, dtype = F.col(field.name), field.dataType
        if isinstance(dtype, (T.StringType, T.BinaryType)):
            width += F.coalesce(F.octet_length(value), F.lit(0)) + 16
        elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.NumericType):
            width += F.coalesce(F.size(value), F.lit(0)) * 8 + 16
        elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
            width += BROADCAST_BYTES
        else:
            width += 8
    return width


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes of `df`, in one narrow pass."""
    n, size = df.agg(F.count("*"), F.sum(row_bytes(df))).first()
    return n, size or 0


def fits_broadcast(df: DataFrame, rows: int = NARROW_BROADCAST_ROWS) -> bool:
    """True when `df` is measured to be small enough to send to every executor."""
    if rows <= 0:
        return False
    n, size = measure(df)
    return n <= rows and size <= BROADCAST_BYTES
