"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed hash. Words are summed by source and the leading bits of the hash;
the bucket in which a source's budget runs out is found from the running sum, and only
that bucket is divided further, until the last bits. Documents below the threshold are taken,
those above are not: nothing is sorted but a few sums per source. Larger budgets take supersets
of smaller ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import prepare, text_or_empty, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2.0
LEVEL_BITS = 10
LEVELS = 4
HASH_BITS = LEVEL_BITS * LEVELS
WORD = r"[^\x20\x09-\x0D]+"
# Each part is white space and the word behind it; the last may be white space alone.
WORD_ENDS = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"


def document_hash(doc_id: Column) -> Column:
    """The leading bits of a document's MD5, as a long; a null id hashes like an empty text."""
    hexed = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(hexed, 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h): words per document, and its hash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
        document_hash(F.col("doc_id")).alias("h"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
            most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, nulls last, have the weights in turn. A source stops at `most` times
    its size; what is left over is shared by weight among the others. That end state is the level
    L with target = min(L * weight, most * size) whose sum is the budget; sources fill up in the
    order of size / weight, so one running sum over the sources finds L. There is one row per
    source, whatever the number of documents.
    """
    n = len(weights)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % n + 1).cast("int"))
    full = F.col("source_size") * F.lit(most)
    by_fill = Window.orderBy("fill", "place")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = sizes.withColumn("place", place).withColumn("weight", weight) \
        .withColumn("full", full).withColumn("fill", F.col("full") / F.col("weight"))
    # Level if this source and all that fill up later were the open ones.
    level = (F.sum("source_size").over(everything) * F.lit(share)
             - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levelled = ranked.withColumn("level", level)
    # The first source, in this order, that does not fill up sets the level for all that follow.
    open_level = F.min(F.when(F.col("level") < F.col("fill"), F.struct("fill", "place", "level"))) \
        .over(everything)["level"]
    return levelled.withColumn("open_level", open_level).select(
        "source", "source_size",
        F.when(F.col("open_level").isNull(), F.col("full")).otherwise(
            F.least(F.col("open_level") * F.col("weight"), F.col("full"))).alias("target"))


def _bucket(level: int) -> Column:
    return F.shiftright("h", HASH_BITS - LEVEL_BITS * level)


def _boundaries(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source with a budget (source_no, budget): the hash at which it runs out (`edge`), the
    words left for the documents of exactly that hash (`left_over`), and their words (`tied`)."""
    found = budgets.select("source_no", F.col("budget").alias("left_over"), F.lit(0).cast("long").alias("edge"))
    for level in range(1, LEVELS + 1):
        inside = rows if level == 1 else rows.join(
            found.select(F.col("source_no").alias("s"), F.col("edge").alias("e")),
            (F.col("source_no") == F.col("s")) & (_bucket(level - 1) == F.col("e")), "left_semi")
        sums = inside.groupBy("source_no", _bucket(level).alias("bucket")).agg(
            F.sum("size").alias("words"))
        below = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, -1)
        sums = sums.withColumn("below", F.coalesce(F.sum("words").over(below), F.lit(0).cast("long")))
        cut = sums.join(found, "source_no") \
            .filter((F.col("below") <= F.col("left_over")) & (F.col("below") + F.col("words") > F.col("left_over")))
        found = written(cut.select(
            "source_no", F.col("bucket").alias("edge"),
            (F.col("left_over") - F.col("below")).alias("left_over"), F.col("words").alias("tied")),
            f"boundaries-{level}")
    return found


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
        most: float = MOST_COPIES) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, taken.

    `size` counts the words `[^\\x20\\x09-\\x0D]+` of the whole text, null as none; `taken` is how
    many of them the mix takes, repeats counted: whole copies while the target holds one
    of every document of the source, then one more of each document whose hash is below the
    threshold. Documents of exactly that hash share what is left in proportion, rounded down, so a
    source misses its target by less than one word per such document. Nulls are a source of
    their own; rows without words take none; repeated rows count as often as they occur. Equal
    input gives equal output. An empty table gives no rows; other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = written(sized(docs), "sizes")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(per_source, weights, share, most)
    size = F.col("source_size")
    copies = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    plan = plan.withColumn("copies", F.least(copies, F.lit(int(most)))) \
        .withColumn("budget", F.floor(F.col("target") - F.col("copies") * size).cast("long")) \
        .withColumn("source_no", F.xxhash64("source", F.col("source").isNull()))
    plan = written(plan, "targets")
    numbered = rows.withColumn("source_no", F.xxhash64("source", F.col("source").isNull()))
    edges = _boundaries(numbered, plan.filter("budget > 0").select("source_no", "budget"))
    # One verdict per source and leading bucket: the join key of a large source is spread over
    # all its buckets.
    numbered = numbered.withColumn("bucket", _bucket(1))
    ruled = numbered.select("source_no", "bucket").distinct().join(plan, "source_no") \
        .join(edges, "source_no", "left") \
        .select("source_no", "bucket", "source_size", "target", "copies", "edge", "left_over", "tied")
    extra = F.when(F.col("edge").isNull() | (F.col("h") > F.col("edge")), F.lit(0).cast("long")) \
        .when(F.col("h") < F.col("edge"), F.col("size")) \
        .otherwise(F.floor(F.col("left_over").cast("decimal(19,0)") * F.col("size") / F.col("tied")).cast("long"))
    return numbered.join(ruled, ["source_no", "bucket"]).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("copies") * F.col("size") + extra).alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space as it is."""
    return F.array_join(F.slice(F.split(text, WORD_ENDS), 1, n.cast("int")), "")


def repeat_taken(docs: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken whole, then its taken part. Columns of
    `docs`; rows not taken are gone."""
    taken, size = F.col("_taken"), F.col("_size")
    plan = mix(docs).filter("taken > 0").select(
        F.col("doc_id").alias("_id"), F.col("size").alias("_size"), F.col("taken").alias("_taken"),
        F.col("source").alias("_source")).distinct()
    same = docs.doc_id.cast("long").eqNullSafe(F.col("_id")) & docs.source.eqNullSafe(F.col("_source")) \
        & (F.regexp_count(F.coalesce(docs.text, F.lit("")), F.lit(WORD)) == size)
    copies = F.floor(taken / size)
    rest = taken - copies * size
    parts = F.concat(F.array_repeat(size, copies.cast("int")),
                     F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    cut = F.when(F.col("_part") < size, first_words(F.col("text"), F.col("_part"))) \
        .otherwise(F.col("text"))
    return docs.join(plan, same).withColumn("_part", F.explode(parts)).withColumn("text", cut) \
        .select(*docs.columns)
