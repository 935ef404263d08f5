"""Exact duplicates against a persistent digest index.

The index is a table of text digests, bucketed and sorted by digest, that lies in a folder of
its own and is opened again by later jobs. A batch is reduced to its distinct digests, these are
anti-joined with the index by sort-merge (the index side is neither shuffled nor sorted
anew by more than its appended files) and what is new is appended.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_dir
from .common import prepare, shuffle_partitions, text_or_empty, written

COLUMNS = "digest BINARY, keep_id BIGINT, keep_row BIGINT, group_size BIGINT, batch STRING"


@dataclass
class DigestIndex:
    """An index folder, registered under a name of this session."""

    spark: SparkSession
    path: str
    buckets: int
    name: str

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int | None = None) -> "DigestIndex":
        """Open the index in `path`, or begin one there. The number of buckets is kept with the index: an
        existing one is opened with its own, whatever this session's settings; asking for another is an error."""
        layout = f"{path}/_layout"  # a name that readers of the table pass over
        try:
            kept = spark.read.schema("buckets INT").parquet(layout).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            kept = None
        if kept and buckets and buckets != kept["buckets"]:
            raise ValueError(f"the index in {path} has {kept['buckets']} buckets, not {buckets}")
        buckets = kept["buckets"] if kept else buckets or shuffle_partitions(spark)
        if not kept:
            spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(layout)
        name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {name} ({COLUMNS}) USING parquet CLUSTERED BY (digest) "
                  f"SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")
        return cls(spark, path, buckets, name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        """Forget the name in this session; the index stays in its folder."""
        self.spark.sql(f"DROP TABLE {self.name}")

    def new_only(self, groups: DataFrame) -> DataFrame:
        """The rows of `groups`, unique by digest, that the index does not hold."""
        known = self.table().select("digest").hint("merge")
        return groups.repartition(self.buckets, "digest").join(known, "digest", "left_anti")

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add the new ones of `groups`; one file per bucket."""
        fresh = written(self.new_only(groups), "fresh-digests")
        fresh.withColumn("batch", F.lit(batch)).repartition(self.buckets, "digest") \
            .select("digest", "keep_id", "keep_row", "group_size", "batch") \
            .write.insertInto(self.name)


def digested(docs: DataFrame, row_no: str | None = None) -> DataFrame:
    """(doc_id, row_no, digest): one row per row; SHA-256 of the whole text, null as empty."""
    number = F.col(row_no) if row_no else F.monotonically_increasing_id()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), number.alias("row_no"),
                       text_or_empty().alias("t"))
    return rows.select("doc_id", "row_no", F.unhex(F.sha2("t", 256)).alias("digest"))


def _judged(rows: DataFrame, index: DigestIndex | None) -> DataFrame:
    """Rows (doc_id, row_no, digest) with their group; the batch's new digests are appended."""
    spark = prepare(rows.sparkSession)
    own_index = index is None
    if own_index:
        index = DigestIndex.open(spark, scratch_dir(spark, "digest-index"))
    rows = written(rows, "digests")
    best = F.max(F.struct("doc_id", "row_no")).alias("best")
    groups = rows.groupBy("digest").agg(best, F.count("*").alias("group_size")).select(
        "digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row_no").alias("keep_row"),
        "group_size")
    batch = uuid.uuid4().hex
    index.append(groups, batch)
    # The lookup side is written without buckets, so that both sides of the last join are
    # shuffled and the rows of a very common digest can be split over tasks.
    own = groups.select("digest").repartition(index.buckets, "digest")
    held = written(index.table().hint("merge").join(own, "digest", "left_semi"), "held-digests")
    if own_index:
        index.close()
    return rows.join(held, "digest").withColumn(
        "kept", (F.col("batch") == batch) & (F.col("row_no") == F.col("keep_row")))


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256 (hex).

    Equal texts within the batch keep their row with the largest doc_id. With an `index`, a text
    that it holds already keeps the row recorded there and none of this batch; the batch's new
    digests are appended. Without one, a fresh index is begun in the scratch folder. A null text
    counts as empty; a null doc_id is smaller than any other. Rows that repeat a doc_id with the
    same text count separately and exactly one of them is kept. `group_size` counts the rows
    of the batch that brought the digest. An empty table gives no rows; other columns are ignored.
    """
    return _judged(digested(docs), index).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row of `docs` per text: that with the largest doc_id, all its columns.

    A null text counts as empty. A null doc_id is smaller than any other; of rows that repeat both id and text
    exactly one stays. Extra columns are carried along; an empty table gives no rows.
    """
    mark = "_row_of_exact_dedup"
    marked = written(docs.withColumn(mark, F.monotonically_increasing_id()), "documents")
    kept = _judged(digested(marked, mark), index).filter("kept").select(F.col("row_no").alias(mark))
    return marked.join(kept, mark, "left_semi").select(*docs.columns)
