"""Versions by key in Spark's own keyed state: each key's newest version is a value in the state store."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Fixed value: the store with which Spark keeps state of its own shape, on disk.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VERSION = T.StructType([T.StructField("version", T.LongType())])


def _processor(version: str, order: tuple[str, ...]) -> StatefulProcessor:
    """Made here, so that it travels to the workers as it is."""

    class NewestVersion(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.newest = handle.getValueState("newest", VERSION)

        def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
            known = self.newest.exists()
            newest = self.newest.get()[0] if known else None
            before = (known, newest)
            # The rows of one key in one micro-batch, in feed order, missing values first.
            for row in sorted(rows, key=lambda r: [(r[c] is not None, r[c]) for c in order]):
                value = row[version]
                kind = "unchanged"
                if newest is None:
                    kind = "new"
                elif value is not None and value > newest:
                    kind = "revised"
                known = True
                if value is not None and (newest is None or value > newest):
                    newest = value
                if kind != "unchanged":
                    yield T.Row(**row.asDict(), kind=kind)
            if (known, newest) != before:
                self.newest.update((newest,))

        def close(self) -> None:
            pass

    return NewestVersion()


def changed_versions(stream: DataFrame, key: str = "event_id", version: str = "updated",
                     order: tuple[str, ...] = ("poll", "file", "position")) -> DataFrame:
    """The rows of a stream that bring a new key or a strictly greater version, with their `kind`.

    The same rows as `detect_changes` tags `new` or `revised`, but the state is Spark's: one value per key in the
    RocksDB state store, checkpointed with the stream, of which a micro-batch reads the keys it names. All rows of
    a key in a micro-batch go to one task, which sorts them; bound the micro-batch, and use
    `publish_changes` where one key may hold a large share of it. Versions are whole numbers. Rows without
    a key are left out.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = stream.filter(F.col(key).isNotNull()).withColumn(version, F.col(version).cast("long"))
    shape = T.StructType([*rows.schema.fields, T.StructField("kind", T.StringType())])
    return rows.groupBy(key).transformWithState(
        statefulProcessor=_processor(version, order), outputStructType=shape, outputMode="Append", timeMode="None")
