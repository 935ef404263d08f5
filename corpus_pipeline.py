"""A corpus from raw documents to packed token sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a DataFrame,
which is written as Parquet and read again as the next one's `docs`. All but the last return the
columns of `documents`, extra ones included.

In every stage a null text counts as empty, whole texts count however long they are, and an empty table gives
no rows. Rows without a doc_id, and rows that repeat one, are rows of their own; where one of several must
stay, null ids come last in `near dedup` and first in `exact dedup`, and exactly one row stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hazardlake.llm import exact, mixing, packing, simhash, toxicity
from hazardlake.llm.common import prepare, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned lexicon does not call toxic."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per text, that with the largest id."""
    return exact.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group of SimHash near copies (operator 1, at its own shingle length and bit distance)."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them; a partly taken one is cut."""
    return mixing.repeat_taken(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all token sequences, with their ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("near dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack_windows)]

# The learned lexicon and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the table `documents`, in order."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
