"""SimHash near-duplicates: fingerprints linked through pivot distance tables.

Reference fingerprints (pivots) are laid over blocks of the 64 bits. The table of a
fingerprint holds its Hamming distances to all of them. One differing bit moves every
distance by at most one, and the distances to the pivots of one block, taken relative to the
distance to the zero pivot, move only when a bit of that block differs. So fingerprints
that differ in few bits agree on the relative distances of most blocks: those are the keys by
which the tables are joined. Pairs whose largest coordinate difference is above the bound are
discarded, survivors are verified bit by bit.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import prepare, text_or_empty, written
from .components import component_roots

SEED = 42
WORDS = 3
MAX_BITS = 2
BLOCK_WIDTHS = (13, 13, 13, 13, 12)
PIVOTS_PER_BLOCK = 15
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash over XXH64 hashes of word shingles, repeats counted; no words: 0."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), SEED)
    counts = np.zeros(64, np.int64)
    n = len(tokens) - words + 1
    for start in range(0, n, SHINGLES_AT_ONCE):
        part = tokens[start:start + SHINGLES_AT_ONCE + words - 1]
        shingles = zip(*(part[i:] for i in range(words)))
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in shingles], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist()))


def fingerprints(docs: DataFrame, words: int = WORDS, row_no: str | None = None) -> DataFrame:
    """(doc_id, row_no, fp): one row per row of `docs`; `fp` holds the unsigned bits as a signed long."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            values = [fingerprint(t, words) for t in batch.column(2).to_pylist()]
            fp = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fp)], ["doc_id", "row_no", "fp"])

    number = F.col(row_no) if row_no else F.monotonically_increasing_id()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), number.alias("row_no"),
                       text_or_empty().alias("t")) \
        .mapInArrow(run, "doc_id long, row_no long, fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def pivots() -> list[list[int]]:
    """Per block of bits its reference fingerprints: row j of a Walsh pattern, where the bit at
    place r (counted from 1) is the parity of `j & r`. Their distances tell any two values of
    the block apart."""
    out, offset = [], 0
    for width in BLOCK_WIDTHS:
        out.append([sum(((j & r).bit_count() & 1) << (offset + r - 1)
                        for r in range(1, width + 1)) for j in range(1, PIVOTS_PER_BLOCK + 1)])
        offset += width
    return out


def pivot_table(fp: Column) -> Column:
    """Distances of a fingerprint to every pivot; the first pivot is zero."""
    flat = [0] + [p for block in pivots() for p in block]
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))) for p in flat])


def _relative(table: Column, block: int) -> Column:
    start = 2 + block * PIVOTS_PER_BLOCK
    return F.transform(F.slice(table, start, PIVOTS_PER_BLOCK), lambda d: d - table[0])


def cell_keys(table: Column) -> Column:
    """One key per choice of blocks that MAX_BITS differing bits cannot all touch."""
    blocks = range(len(BLOCK_WIDTHS))
    chosen = combinations(blocks, len(BLOCK_WIDTHS) - MAX_BITS)
    return F.array(*[F.xxhash64(F.lit(i), *[_relative(table, b) for b in c])
                     for i, c in enumerate(chosen)])


def _links(classes: DataFrame) -> DataFrame:
    """(a, b): links between different fingerprints that connect all that two bits connect.

    Cells of two members are pairs: the coordinate bound, then the exact distance. The members
    of fuller cells meet at shared midpoints instead, one bit from each: a midpoint has at most
    65 members, all within two bits of each other, so linking each to the smallest keeps every
    component, and no cell is ever expanded into pairs.
    """
    keyed = classes.select("fp", pivot_table(F.col("fp")).alias("table")).select(
        "fp", F.explode(cell_keys(F.col("table"))).alias("key"))
    cells = written(keyed.groupBy("key").agg(
        F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .filter("n > 1"), "cells")
    a, b = F.col("a"), F.col("b")
    furthest = F.array_max(F.zip_with(
        pivot_table(a), pivot_table(b), lambda x, y: F.abs(x - y)))
    pairs = cells.filter("n = 2").select("a", "b").distinct() \
        .filter(furthest <= MAX_BITS).filter(F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS)
    crowded = keyed.join(cells.filter("n > 2").select("key"), "key", "left_semi") \
        .select("fp").distinct()
    flips = [0] + [_signed(1 << i) for i in range(64)]
    met = crowded.select("fp", F.explode(F.array(
        *[F.col("fp").bitwiseXOR(F.lit(f)) for f in flips])).alias("middle")) \
        .groupBy("middle").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    return pairs.unionByName(met.select(
        F.explode("fps").alias("a"), F.array_min("fps").alias("b")).filter("a != b")).distinct()


def _components(prints: DataFrame) -> DataFrame:
    """(fp, component_id, keep_row): per fingerprint its component's smallest doc_id, nulls last, and
    the first row that has it."""
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_no")
    classes = prints.groupBy("fp").agg(F.min(row).alias("first"))
    roots = component_roots(_links(classes.select("fp")))
    rooted = written(classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")), "classes")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return rooted.join(least, "root").select(
        "fp", F.col("least.doc_id").alias("component_id"), F.col("least.row_no").alias("keep_row"))


def simhash_components(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints at MAX_BITS or fewer differing bits are linked; `component_id` is the smallest
    doc_id reachable, the document itself included. Texts are read whole; a null text counts as
    empty and, like one without words, has fingerprint zero. A null doc_id takes part in the
    links; a component of only such rows has a null id. Repeated rows are kept. An empty table
    gives no rows; other columns are ignored.
    """
    prints = written(fingerprints(docs, words), "fingerprints")
    return prints.join(_components(prints), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row of `docs` per component of near copies, all its columns: the first with the smallest doc_id.

    Components are those of `simhash_components`. Null doc_ids come after all others; of rows that share
    their doc_id, or that have none, exactly one stays. A null text counts as empty; texts
    without words are alike. An empty table gives no rows; extra columns are carried along.
    """
    mark = "_row_of_simhash"
    marked = written(docs.withColumn(mark, F.monotonically_increasing_id()), "documents")
    prints = written(fingerprints(marked, words, mark), "fingerprints")
    kept = _components(prints).select(F.col("keep_row").alias(mark)).distinct()
    return marked.join(kept, mark, "left_semi").select(*docs.columns)
