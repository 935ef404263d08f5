"""SpotSigs fingerprints: content words that follow common-word anchors.

A text is folded to lower-case words between single spaces. Where content follows a common word (the
last of a run of them is the anchor), the anchor and the next two content words are a chain; the
hashes of its different chains are a text's signatures. Likeness is the Jaccard index of two
signature sets, which their lengths alone bound: sets are filed by length parts, and pairs whose
lengths are too far apart are pruned without being compared. `spot_join` finds the classes of near copies.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import prepare, shuffle_partitions, shuffles_dropped, text_or_empty, written
from .spot_join import LEAST, length_part, spot_classes

# Common words of English, German, French and Spanish.
COMMON = tuple((
    "a an and are as at be been but by can did do for from had has have he her his in is it its not of "
    "on or said she that the their there they this to was we were which will with you "
    "als am auch auf aus bei das dem den der des die ein eine einen er es für ich im ist mit nach nicht "
    "sich sie sind und vom von war wie zu zum zur "
    "au aux avec ce ces dans de des du elle en est et il la le les leur mais ou par pas plus pour qui "
    "que sa se ses son sur un une "
    "al como con del el ella esta este fue las lo los más no para pero por su sus una y").split())


def folded(text: Column) -> Column:
    """Lower-case words of letters and digits, each behind one space, and a space at the end."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))


def _one_of(words: list[str]) -> str:
    """A pattern for any of the words, with common beginnings written once."""
    heads = sorted({w[0] for w in words if w})
    branches = [h + _one_of([w[1:] for w in words if w[:1] == h]) for h in heads]
    return (f"(?:{'|'.join(branches)})" + ("?" if "" in words else "")) if branches else ""


def with_signatures(rows: DataFrame, text: str, name: str, common: tuple = COMMON) -> DataFrame:
    """`rows` and a column `name`: the different chain hashes of the column `text`, sorted.

    A chain is an anchor with the next two content words. A text without chains (no anchors, or too
    few words behind them) has the hash of its folded words as its only signature; one without
    words has none.
    """
    word = f"(?:{_one_of(sorted(set(common)))})"
    # The anchor, a word that is not common, any common words, one more that is not. Looking ahead
    # only, since chains overlap.
    chain = rf"(?<= )(?=({word} (?!{word} )[^ ]+ (?:{word} )*+[^ ]+) )"
    chains = F.regexp_extract_all(F.col("_folded"), F.lit(chain), F.lit(1))
    hashes = F.transform(chains, lambda c: F.xxhash64(
        F.substring_index(c, " ", 2), F.substring_index(c, " ", -1)))
    whole = F.trim("_folded")
    found = F.when(F.size("_chains") > 0, F.col("_chains")).when(
        whole != "", F.array(F.xxhash64(whole))).otherwise(F.array().cast("array<bigint>"))
    # Each step is a column of its own, so that none is computed twice.
    return rows.withColumn("_folded", folded(F.col(text))) \
        .withColumn("_chains", F.array_sort(F.array_distinct(hashes))) \
        .withColumn(name, found).drop("_folded", "_chains")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard index of two signature sets, two empty ones being alike. With a bound, sets that lie
    more than one length part apart, or whose lengths keep the index below it, are pruned: 0."""
    both = F.size(F.array_intersect(a, b))
    index = F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(both / (F.size(a) + F.size(b) - both))
    if not least:
        return index
    apart = F.abs(length_part(F.size(a), least) - length_part(F.size(b), least)) > 1
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    return F.when(apart | (small < large * F.lit(least)), 0.0).otherwise(index)


def in_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, text, part, extra): the rows dealt to ranges of ascending doc_id, each of which also
    gets, as extra rows, the first of the following range; the last range gets those of the first.

    The ranges are cut at quantiles of the ids, so that each holds about as many rows; a cut is an id
    of the table, the first of its range. A range is found by a coarse, then a fine step.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    parts = 4 * shuffle_partitions(docs.sparkSession)
    shares = [i / parts for i in range(1, parts)]
    # One id per range: bounded by the number of shuffle partitions.
    least, found = rows.select(key.alias("key")).agg(
        F.min("key"), F.percentile_approx("key", shares, 20 * parts)).first()
    cuts = sorted({c for c in found or [] if c > least})
    if not cuts:
        part, first = F.lit(0), key == F.lit(least)
    else:
        step = max(1, math.isqrt(len(cuts)))
        fine = [cuts[i:i + step] for i in range(0, len(cuts), step)]

        def longs(values):
            return F.array(*[F.lit(v).cast("long") for v in values])

        coarse = F.greatest(F.size(F.filter(longs([f[0] for f in fine]), lambda c: c <= key)), F.lit(1))
        inner = F.element_at(F.array(*map(longs, fine)), coarse)
        part = ((coarse - 1) * step + F.size(F.filter(inner, lambda c: c <= key))).cast("int")
        first = (key == F.lit(least)) | F.array_contains(inner, key)
    place = F.struct(F.col("_part").alias("part"), F.lit(0).alias("extra"))
    again = F.struct(F.pmod(F.col("_part") - 1, F.lit(len(cuts) + 1)).alias("part"), F.lit(1).alias("extra"))
    return rows.withColumns({"_part": part, "_first": F.coalesce(first, F.lit(False))}) \
        .withColumn("at", F.explode(F.when(F.col("_first"), F.array(place, again)).otherwise(F.array(place)))) \
        .select("doc_id", "text", "at.part", "at.extra")


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by the beginning of the following one."""
    n = F.char_length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter), F.substring(following, F.lit(1), quarter))


def fingerprint_documents(docs: DataFrame, common: tuple = COMMON) -> DataFrame:
    """One row per row of `docs`: doc_id, n_chars, edited_sha256, and the signature sets (arrays
    of longs) `own`, `edited` and `following` of the text, its edited text and the next document's.

    Whole texts are read; a null text is empty. Null ids are first in the order, rows of equal id are
    ordered by text, and a single row is its own next. An empty table gives no rows; other
    columns are ignored.
    """
    prepare(docs.sparkSession)
    order = Window.partitionBy("part").orderBy("extra", F.col("doc_id").asc_nulls_first(), "text")
    # The next row's text and signatures are looked up in one pass over a range: one shuffle.
    placed = in_ranges(docs).withColumn("next", F.lead("text").over(order))
    rows = with_signatures(placed, "text", "own", common) \
        .withColumn("following", F.lead("own").over(order)).filter("extra = 0") \
        .withColumn("change", edited(F.col("text"), F.col("next")))
    return with_signatures(rows, "change", "edited", common).select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("change", 256).alias("edited_sha256"), "own", "edited", "following")


def digest(signature_set: Column) -> Column:
    """A short name of a signature set: its length and a digest."""
    return F.concat(F.size(signature_set), F.lit("-"), F.md5(F.array_join(signature_set, ",")))


def with_classes(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The report of `compare` on `docs`, and `class_id`: the smallest doc_id among the documents that are linked, over
    any number of steps, by signature sets whose Jaccard index is `least` or more.

    Equal sets are one class, also empty ones. A class of rows without ids has a null id. See
    `fingerprint_documents` for nulls, ties and repeated rows.
    """
    rows = fingerprint_documents(docs)
    with shuffles_dropped(docs.sparkSession):
        report = written(compare(rows, carried=("own",)).withColumn("row_no", F.monotonically_increasing_id()), "spot-report")
        classes = spot_classes(report, least)
    return report.drop("own", "row_no").join(classes, "fingerprint")


def compare(rows: DataFrame, least: float = 0.0, carried: tuple = ()) -> DataFrame:
    """The columns of a report on the rows of `fingerprint_documents`; see `likeness`."""
    return rows.select(
        *carried,
        "doc_id", "n_chars", "edited_sha256", digest(F.col("own")).alias("fingerprint"),
        digest(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited"), least).alias("near_edited"),
        likeness(F.col("own"), F.col("following"), least).alias("near_next"))
