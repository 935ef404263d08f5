"""Token ids in 64-bit words: a Simple-8b format with escapes and block offsets.

Layout of a shard (little-endian): magic `S8B1`, unsigned 32-bit number of blocks, unsigned 64-bit
number of ids, then per block the first word's place and the first id's place (unsigned 64-bit
each), then the words. A word's top four bits select how many ids of how many bits it holds, lowest
bits first; selector 0 is an escape: the next word is one id as it is. Blocks are coded
independently, so any of them can be decoded alone, all words of a selector at once.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import prepare, shuffle_partitions, text_or_empty, written
from .tokens import encoder

# Fixed values of the coding: (ids per word, bits per id) of selectors 1 to 14; 0 is the escape.
SELECTORS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10),
             (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE_BITS = 60
MAGIC = b"S8B1"
BLOCK_IDS = 1 << 14
SHARD_IDS = 1 << 21
END_ID = 2


# Ids below this are classed by a table.
SMALL = 1 << 16
_LIMITS = np.array([1 << bits for _, bits in SELECTORS], np.uint64)
_SMALL_CLASS = np.searchsorted(_LIMITS, np.arange(SMALL, dtype=np.uint64), "right").astype(np.uint8)


def _choices(ids: np.ndarray) -> np.ndarray:
    """For every place the selector that packs most ids from there on; 0 where one must escape."""
    n = len(ids)
    if n and ids.max() < SMALL:
        widest = _SMALL_CLASS[ids]
    else:
        widest = np.searchsorted(_LIMITS, ids, "right").astype(np.uint8)
    # The narrowest selector that each id fits, then that all of 2, 3, ... ids from a place on fit: windows of a
    # size follow from two overlapping ones of a smaller size.
    choice = np.where(widest < len(SELECTORS), len(SELECTORS), 0).astype(np.int8)
    size = 1
    for index in range(len(SELECTORS) - 2, -1, -1):
        count = SELECTORS[index][0]
        if count > n:
            break
        while size < count:
            step = min(size, count - size)
            widest = np.maximum(widest[:-step], widest[step:])
            size += step
        choice[:n - count + 1][widest <= index] = index + 1
    return choice


def _starts(jump: np.ndarray) -> np.ndarray:
    """The places from 0 on that are reached by jumping; twice as many of them per round."""
    n = len(jump)
    hop = np.minimum(np.arange(n + 1) + np.append(jump, 0), n)
    found = np.zeros(min(n, 1), np.int64)
    while len(found) and found[-1] < n:
        found = np.concatenate([found, hop[found]])
        hop = hop[hop]
    return found[:np.searchsorted(found, n)]


def encode_block(ids: np.ndarray) -> np.ndarray:
    """The 64-bit words of one block."""
    ids = np.asarray(ids, np.uint64)
    choice = _choices(ids)
    counts = np.array([1] + [c for c, _ in SELECTORS])
    at = _starts(counts[choice])
    chosen = choice[at]
    width = np.where(chosen == 0, 2, 1)
    where = np.cumsum(width) - width
    words = np.zeros(int(width.sum()), np.uint64)
    words[where[chosen == 0] + 1] = ids[at[chosen == 0]]
    for selector in np.unique(chosen[chosen > 0]).tolist():
        count, bits = SELECTORS[selector - 1]
        mine = chosen == selector
        values = ids[at[mine][:, None] + np.arange(count)]
        shifts = (np.arange(count) * bits).astype(np.uint64)
        packed = np.bitwise_or.reduce(values << shifts, axis=1)
        words[where[mine]] = packed | np.uint64(selector << 60)
    return words


def decode_block(words: np.ndarray) -> np.ndarray:
    """The ids of one block, as unsigned 64-bit integers."""
    words = np.asarray(words, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int8)
    if (selector == 0).any():  # the word behind an escape is data, whatever its top bits say
        data = np.zeros(len(words), bool)
        for i in np.flatnonzero(selector == 0).tolist():
            if not data[i]:
                data[i + 1] = True
    else:
        data = np.zeros(len(words), bool)
    counts = np.array([1] + [c for c, _ in SELECTORS] + [0])[np.where(data, len(SELECTORS) + 1, selector)]
    start = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(selector[~data]).tolist():
        mine = (selector == s) & ~data
        if s == 0:
            out[start[mine]] = words[np.flatnonzero(mine) + 1]
            continue
        count, bits = SELECTORS[s - 1]
        shifts = (np.arange(count) * bits).astype(np.uint64)
        values = (words[mine][:, None] >> shifts) & np.uint64((1 << bits) - 1)
        out[start[mine][:, None] + np.arange(count)] = values
    return out


def encode_shard(ids: np.ndarray) -> bytes:
    blocks = [encode_block(ids[i:i + BLOCK_IDS]) for i in range(0, len(ids), BLOCK_IDS)]
    sizes = np.array([len(b) for b in blocks], np.uint64)
    index = np.empty((len(blocks), 2), "<u8")
    index[:, 0] = np.cumsum(sizes) - sizes
    index[:, 1] = np.arange(len(blocks)) * BLOCK_IDS
    body = np.concatenate(blocks).astype("<u8").tobytes() if blocks else b""
    return MAGIC + struct.pack("<IQ", len(blocks), len(ids)) + index.tobytes() + body


def decode_shard(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids `first` to `last` (exclusive) of a shard; only the blocks that hold them are decoded."""
    if data[:4] != MAGIC:
        raise ValueError("not a shard of token ids")
    n_blocks, n_ids = struct.unpack_from("<IQ", data, 4)
    last = n_ids if last is None else min(last, n_ids)
    index = np.frombuffer(data, "<u8", 2 * n_blocks, 16).reshape(-1, 2)
    words = np.frombuffer(data, "<u8", offset=16 + 16 * n_blocks)
    ends = np.append(index[1:, 0], len(words)).astype(np.int64)
    out = [np.zeros(0, np.uint64)]
    for b in range(first // BLOCK_IDS, -(-last // BLOCK_IDS) if last > first else 0):
        ids = decode_block(words[int(index[b, 0]):int(ends[b])])
        base = b * BLOCK_IDS
        out.append(ids[max(0, first - base):last - base])
    return np.concatenate(out)


SHARDS = "part int, shard int, doc_ids array<bigint>, doc_tokens array<bigint>, n_tokens bigint, data binary"


def write_shards(docs: DataFrame, path: str, tokenizer: str, partitions: int | None = None) -> None:
    """Encode all `docs` in ascending doc_id order and write the shards to the folder `path`.

    The folder is a Parquet table written by Spark's committer (a lost executor leaves no half
    shard); each row carries one shard in the format above and the documents in it. A document
    lies in one shard, whatever its length. Rows of equal or null doc_id (nulls first) follow
    each other by their text. A null text is empty: just the end id.
    """
    spark = prepare(docs.sparkSession)
    partitions = partitions or shuffle_partitions(spark)

    def run(batches):
        from pyspark import TaskContext
        part, shard = TaskContext.get().partitionId(), 0
        code = encoder(tokenizer, spaces=True)
        ids, parts, total = [], [], 0

        def flush():
            data = encode_shard(np.concatenate(parts) if parts else np.zeros(0, np.uint64))
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([shard], pa.int32()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
                pa.array([total], pa.int64()), pa.array([data], pa.binary())],
                ["part", "shard", "doc_ids", "doc_tokens", "n_tokens", "data"])

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for doc_id, tokens in zip(batch.column(0).to_pylist(), code.encode(texts)):
                ids.append(doc_id)
                parts.append(np.append(tokens, np.uint32(END_ID)))
                total += len(parts[-1])
                if total >= SHARD_IDS:
                    yield flush()
                    ids, parts, total, shard = [], [], 0, shard + 1
        if ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t"))
    rows.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "t") \
        .mapInArrow(run, SHARDS).write.parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, shard, shard_start): ids before each shard, from the counts alone."""
    earlier = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("part", "shard", F.coalesce(
        F.sum("n_tokens").over(earlier), F.lit(0)).cast("long").alias("shard_start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, read back from the shards of `path`."""
    prepare(spark)
    shards = spark.read.schema(SHARDS).parquet(path)

    def run(batches):
        for batch in batches:
            for part, shard, ids, sizes, data in zip(*(batch.column(c).to_pylist() for c in (
                    "part", "shard", "doc_ids", "doc_tokens", "data"))):
                tokens = decode_shard(data).astype("<u4")
                ends = np.cumsum(np.array(sizes, np.int64))
                starts = ends - sizes
                crc = [zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * n, pa.int32()), pa.array([shard] * n, pa.int32()),
                    pa.array(ids, pa.int64()), pa.array(starts), pa.array(sizes, pa.int64()),
                    pa.array(crc, pa.int64())],
                    ["part", "shard", "doc_id", "within", "n_tokens", "ids_crc32"])

    decoded = shards.select("part", "shard", "doc_ids", "doc_tokens", "data").mapInArrow(
        run, "part int, shard int, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint")
    starts = written(shard_starts(shards), "shard-starts")
    return decoded.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
