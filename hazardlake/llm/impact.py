"""Exact top-k by inner product: an impact-ordered index, read score-at-a-time.

The index is cut into shards of a bounded number of integer vectors. A shard has one posting list per
component, cut into segments of nearly equal value: the quantised impact. For a query, all segments of a
shard are ordered by the largest amount they can add to a score, and read from the largest down. What
is known of a vector are the bounds of its parts read so far; what is left is bounded by the parts of both
norms that were not read (Cauchy-Schwarz). Reading stops when few vectors can still be among the best, which
the bounds prove of all others; those few are scored exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import prepare, written

# Components (padded) of a shard's vectors and of a block of queries; values per segment range.
SHARD_CELLS = 1 << 18
BLOCK_CELLS = 1 << 16
LEVELS = 64
# A query's bounds are looked at after each such share of the postings; reading goes on until the
# possible members are this share of a shard at most. Both change the speed only.
ROUNDS = 8
FEW = 1 / 32
# Shards that a block of queries meets first, for bounds on the others.
PILOT = 4
# Shards, or blocks, that one task writes to one file at most, more or less: so many rows are read at once.
AT_ONCE = 8

INDEX = ("shard bigint, n int, width int, rows binary, ids binary, vectors binary, seg_dim binary, seg_low binary, "
         "seg_high binary, seg_size binary, members binary")
BLOCKS = "block bigint, n int, width int, rows binary, ids binary, vectors binary"
HITS = "block bigint, query_row bigint, query_id bigint, row_no bigint, vec_id bigint, score bigint"
NO_ID = -(1 << 63)  # how a null id is held in the arrays


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", scale: int = 1024) -> DataFrame:
    """(row_no, vec_id, vector): floor(scale * x) of every component x, taken as a double. Vectors that are
    null, or hold null or non-finite components, are left out."""
    finite = F.forall(vec, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return vectors.withColumn("_row", F.monotonically_increasing_id()).filter(F.col(vec).isNotNull() & finite).select(
        F.col("_row").alias("row_no"), F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vector"))


class ImpactShard:
    """Some vectors and their postings: per component segments of nearly equal values, with their bounds."""

    def __init__(self, vectors: np.ndarray, segments: tuple | None = None):
        self.vectors = vectors
        self.n, self.width = vectors.shape
        self.norms = (vectors.astype(np.float64) ** 2).sum(axis=1)
        self.dim, self.low, self.high, self.size, self.members = segments or self._segments()
        self.start = np.cumsum(self.size) - self.size

    def _segments(self) -> tuple:
        dims, lows, highs, sizes, members = [], [], [], [], []
        for d in range(self.width):
            values = self.vectors[:, d]
            low, high = int(values.min()), int(values.max())
            step = (high - low) // LEVELS + 1
            order = np.argsort(values, kind="stable")
            ascending = values[order]
            first = np.flatnonzero(np.diff((ascending - low) // step, prepend=-1))
            ends = np.append(first[1:], self.n)
            dims.append(np.full(len(first), d, np.int32))
            lows.append(ascending[first])
            highs.append(ascending[ends - 1])
            sizes.append((ends - first).astype(np.int64))
            members.append(order.astype(np.int32))
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate(x) if x else none for x in (dims, lows, highs, sizes, members))

    def possible(self, query: np.ndarray, k: int, least: float = -np.inf, skip: int = -1) -> tuple[np.ndarray, int]:
        """Places of vectors, among them all that can be one of the `k` of highest score with at least
        `least`, and how many postings were read to know that. The vector at `skip` does not count."""
        n = self.n
        q = query.astype(np.float64)
        q_norm = float((q ** 2).sum())
        slack = 1e-9 * (1.0 + np.sqrt(q_norm * (self.norms.max() if n else 0.0)))
        at_low, at_high = q[self.dim] * self.low, q[self.dim] * self.high
        lo, hi = np.minimum(at_low, at_high), np.maximum(at_low, at_high)
        q2 = q[self.dim] ** 2
        v2 = np.where((self.low <= 0) & (self.high >= 0), 0.0,
                      np.minimum(np.abs(self.low), np.abs(self.high)).astype(np.float64) ** 2)
        order = np.argsort(-np.maximum(np.abs(lo), np.abs(hi)), kind="stable")  # by descending impact
        upto = np.cumsum(self.size[order])
        total = int(upto[-1]) if len(upto) else 0
        sums = np.zeros((4, n))
        others = np.ones(n, bool)
        if skip >= 0:
            others[skip] = False
        done, read = 0, 0
        found = np.flatnonzero(others)
        while done < len(order):
            end = max(done + 1, int(np.searchsorted(upto, read + total / ROUNDS, "right")))
            part, done, read = order[done:end], end, int(upto[end - 1])
            sizes = self.size[part]
            before = np.cumsum(sizes) - sizes
            docs = self.members[np.repeat(self.start[part] - before, sizes) + np.arange(int(sizes.sum()))]
            for total_of, weight in zip(sums, (lo, hi, q2, v2)):
                total_of += np.bincount(docs, np.repeat(weight[part], sizes), n)
            low, high, seen_q, seen_v = sums
            rest = np.sqrt(np.maximum(q_norm - seen_q, 0) * np.maximum(self.norms - seen_v, 0)) + slack
            proven = (low - rest)[others]
            if len(proven) >= k:
                least = max(least, float(np.partition(proven, len(proven) - k)[len(proven) - k]))
            found = np.flatnonzero(others & (high + rest >= least))
            if len(found) <= max(k, n * FEW):
                break
        return found, read


def _fitted(vector: np.ndarray, width: int) -> np.ndarray:
    """Components beyond a vector's own are zero; those beyond `width` meet only zeros."""
    out = np.zeros(width, np.int64)
    out[:min(width, len(vector))] = vector[:width]
    return out


def _matrix(vectors: list) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    return np.array([_fitted(np.array(v, np.int64), width) for v in vectors], np.int64).reshape(len(vectors), width)


def _groups(batches, group: str):
    """(number, row numbers, ids, matrix) per value of the column `group`, by which the rows are sorted."""
    now, rows, ids, vectors = None, [], [], []
    for batch in batches:
        for number, row, vec_id, vector in zip(*(batch.column(c).to_pylist() for c in (
                group, "row_no", "vec_id", "vector"))):
            if number != now and rows:
                yield now, rows, ids, _matrix(vectors)
                rows, ids, vectors = [], [], []
            now = number
            rows.append(row)
            ids.append(NO_ID if vec_id is None else vec_id)
            vectors.append(vector)
    if rows:
        yield now, rows, ids, _matrix(vectors)


def _bytes(values, dtype=np.int64) -> bytes:
    return np.ascontiguousarray(values, dtype).tobytes()


def _packed(values: np.ndarray) -> bytes:
    """Integers in the fewest bytes each (2, 4 or 8) that hold them all."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    return _bytes(values, next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _unpacked(data: bytes, count: int) -> np.ndarray:
    return _array(data, f"<i{len(data) // count}" if count else np.int64)


def _row(schema: str, values: list) -> pa.RecordBatch:
    names, types = zip(*(f.split(" ") for f in schema.split(", ")))
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([v], arrow[t]) for v, t in zip(values, types)], list(names))


def _dealt(rows: DataFrame, cells: int, name: str) -> tuple[DataFrame, int]:
    """`rows` sorted by their group number `name`, and how many groups of about `cells` components there are."""
    total = rows.agg(F.sum(F.greatest(F.size("vector"), F.lit(1)))).first()[0] or 0
    groups = max(1, -(-total // cells))
    numbered = rows.withColumn(name, F.pmod(F.xxhash64("row_no"), F.lit(groups)))
    tasks = max(-(-groups // AT_ONCE), min(groups, rows.sparkSession.sparkContext.defaultParallelism))
    return numbered.repartition(tasks, name).sortWithinPartitions(name, "row_no"), groups


class ImpactIndex:
    """Shards of an index, written as a table: one row per shard."""

    def __init__(self, table: DataFrame, shards: int):
        self.table, self.shards = table, shards

    @classmethod
    def build(cls, vectors: DataFrame) -> "ImpactIndex":
        """Index the rows (row_no, vec_id, vector) of `integer_vectors`."""
        prepare(vectors.sparkSession)
        dealt, shards = _dealt(vectors, SHARD_CELLS, "shard")

        def run(batches):
            for number, rows, ids, matrix in _groups(batches, "shard"):
                s = ImpactShard(matrix)
                yield _row(INDEX, [number, s.n, s.width, _bytes(rows), _bytes(ids), _packed(matrix),
                                   _bytes(s.dim, np.int32), _bytes(s.low), _bytes(s.high), _bytes(s.size),
                                   _packed(s.members)])

        return cls(written(dealt.mapInArrow(run, INDEX), "impact-index"), shards)

    def search(self, queries: DataFrame, k: int, skip_own: bool = False) -> DataFrame:
        """The `k` vectors of highest inner product for every query: query_row, query_id, rank, row_no, vec_id, score.

        `queries` has the columns of `integer_vectors`; with `skip_own`, a query's row number is that of
        an indexed row, which is none of its own candidates. Scores are exact; ties go to smaller ids, null ids
        last, then to smaller row numbers. With fewer than `k` candidates all are returned. Vectors of different
        lengths are compared as if the shorter went on with zeros. Repeated queries are answered each.
        A score that does not fit into 64 bits raises an error. No queries or no vectors give no rows.

        Every block of queries meets every shard once. The first PILOT shards a block meets give bounds for
        the others: the k-th best score found there. What leaves a shard is at most `k` rows a query.
        """
        dealt, _ = _dealt(queries, BLOCK_CELLS, "block")

        def to_blocks(batches):
            for number, rows, ids, matrix in _groups(batches, "block"):
                yield _row(BLOCKS, [number, *matrix.shape, _bytes(rows), _bytes(ids), _packed(matrix)])

        blocks = written(dealt.mapInArrow(to_blocks, BLOCKS), "query-blocks")
        every = F.sequence(F.lit(0).cast("long"), F.lit(self.shards - 1).cast("long"))
        # Blocks begin at different shards.
        met = F.transform(every, lambda s: F.pmod(s + F.col("block"), F.lit(self.shards)))
        hits = written(self._hits(blocks, F.slice(met, 1, PILOT), k, skip_own), "pilot-hits")
        if self.shards > PILOT:
            bounds = _best(hits, k).filter(F.col("rank") == k).groupBy("block").agg(
                F.collect_list(F.struct("query_row", "score")).alias("bounds"))  # one entry per query of the block
            rest = self._hits(blocks.join(bounds, "block", "left"),
                              F.slice(met, PILOT + 1, self.shards), k, skip_own)
            hits = hits.unionByName(rest)
        return _best(hits, k).select("query_row", "query_id", "rank", "row_no", "vec_id", "score")

    def _hits(self, blocks: DataFrame, shards: Column, k: int, skip_own: bool) -> DataFrame:
        """The best of each of the named shards for the queries of each block.

        Blocks repeated by shard, and shards, are far larger than the files that Spark sizes them by: neither is broadcast.
        """
        asked = blocks.withColumn("shard", F.explode(shards)).select("shard", "block", *[
            F.col(c).alias(f"q_{c}") for c in ("n", "width", "rows", "ids", "vectors")],
            *[c for c in ("bounds",) if c in blocks.columns])

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    yield _answers(row, k, skip_own)

        return asked.hint("merge").join(self.table.hint("merge"), "shard").mapInArrow(run, HITS)


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row_no")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _array(data: bytes, dtype=np.int64) -> np.ndarray:
    return np.frombuffer(data, dtype)


def _answers(row: dict, k: int, skip_own: bool) -> pa.RecordBatch:
    """The best vectors of one shard for one block of queries."""
    cells = row["n"] * row["width"]
    vectors = _unpacked(row["vectors"], cells).reshape(row["n"], row["width"]).astype(np.int64)
    shard = ImpactShard(vectors, (_array(row["seg_dim"], np.int32), _array(row["seg_low"]), _array(row["seg_high"]),
                                  _array(row["seg_size"]), _unpacked(row["members"], cells)))
    rows, ids = _array(row["rows"]), _array(row["ids"])
    places = {r: i for i, r in enumerate(rows.tolist())} if skip_own else {}
    bounds = {b["query_row"]: b["score"] for b in row.get("bounds") or []}
    out = [[], [], [], [], [], []]
    queries = _unpacked(row["q_vectors"], row["q_n"] * row["q_width"]).reshape(row["q_n"], row["q_width"])
    longest = np.sqrt(shard.norms.max()) if shard.n else 0.0
    for query_row, query_id, query in zip(_array(row["q_rows"]).tolist(), _array(row["q_ids"]).tolist(), queries):
        q = _fitted(query, shard.width)
        if longest * np.linalg.norm(q.astype(np.float64)) >= 2.0 ** 63:
            raise OverflowError("a score may not fit into 64 bits")
        least = bounds.get(query_row, -np.inf)
        found, _ = shard.possible(q, k, least, places.get(query_row, -1))
        scores = vectors[found] @ q
        first = np.lexsort((rows[found], ids[found], ids[found] == NO_ID, -scores))[:k]
        first = first[scores[first] >= least]
        many = len(first)
        for column, values in zip(out, ([row["block"]] * many, [query_row] * many, [query_id] * many,
                                        rows[found[first]], ids[found[first]], scores[first])):
            column.append(np.asarray(values, np.int64))
    arrays = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
    return pa.RecordBatch.from_arrays(
        [pa.array(a, mask=a == NO_ID) if i in (2, 4) else pa.array(a) for i, a in enumerate(arrays)],
        [f.split(" ")[0] for f in HITS.split(", ")])


def top_k(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the best other vectors for each row whose id `every` divides.

    See `ImpactIndex.search` for ties, lengths and repeated rows. Rows with a null id are candidates, never
    queries; vectors that are null or hold null or non-finite components are neither. Empty vectors
    score zero. An empty table gives no rows; other columns are ignored.
    """
    prepare(vectors.sparkSession)
    rows = written(integer_vectors(vectors), "integer-vectors")
    hits = ImpactIndex.build(rows).search(rows.filter(F.col("vec_id") % every == 0), k, skip_own=True)
    return hits.select("query_id", "rank", "vec_id", "score")
