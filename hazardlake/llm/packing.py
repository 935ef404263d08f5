"""Lexical retrieval packing: windows filled with a seed document and the texts that are nearest to it.

Documents are tokenised once. Every row whose id `SEED_EVERY` divides is a seed, a BM25 query over all rows: each document
is scored for each seed by all ids, wherever they lie, and joins the one that scores it highest. A seed is followed by its texts,
best first; windows are cut from this order, the last text of one continued in the next. No sample, shard or list of
candidates stands between a document and a seed.

Seeds follow each other in a lexical order: by their most frequent id, ids whose documents have the same vocabulary (counted
over all documents) next to each other, then by their rarest vocabulary entries. It decides which seeds' texts meet in a
window, not which texts a seed has. `bm25_neighbours` gives the best texts of each seed as rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import numbered, prepare, shuffle_partitions, shuffles_dropped, text_or_empty, written
from .tokens import _gather, encoder, forget

WINDOW = 4096
END_ID = 2
K1, B = 1.2, 0.75
# Rows whose id this divides are seeds. So many are sent to the tasks at once.
SEED_EVERY = 100
SEEDS_AT_ONCE = 8192
# Ids of more than one in so many seeds are compared as a dense matrix; so many scores, and postings, are held at once.
# Speed and memory only.
DENSE = 16
CELLS = 2 << 20
POSTINGS = 1 << 20
# For the lexical order a task counts so many ids at once; vocabularies are compared by ranges of so many ids. Memory only.
COUNTED_IDS = 2 << 20
PART_IDS = 1024
PIECES = ("row_no bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, "
          "doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")
STORED = "<u2"  # how intermediate tables hold ids; results hold 32 bits
NEAREST = "row_no bigint, doc_id bigint, n bigint, seed bigint, score double"
IDS = "doc_id bigint, row_no bigint, n bigint, common int, sketch array<int>, ids binary"


def _profile(ids: np.ndarray, words: np.ndarray) -> tuple[int, list[int]]:
    """The most frequent id, the smallest of several, and the four highest different ids, from high to low. Marks
    and numbers, which all subjects have, are the most frequent only where there is nothing else."""
    different, counts = _counts(ids)
    of_words = counts * words[different]
    common = different[int((of_words if of_words.any() else counts).argmax())]
    return int(common), different[:-5:-1].tolist()


def token_ids(docs: DataFrame, tokenizer: str, row_no: str | None = None) -> DataFrame:
    """One row per row of `docs`: its ids with the end id (little-endian unsigned 16-bit), their number, the most
    frequent of them (see `_profile`), and the sketch: the four highest different ids, which
    byte-pair merging made last."""
    prepare(docs.sparkSession)

    def run(batches):
        code = encoder(tokenizer, spaces=False)
        if code.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids do not fit into 16 bits")
        words = np.zeros(1 << 16, bool)
        words[[i for t, i in code.tokenizer.get_vocab().items() if t[:1].isalpha()]] = True
        for batch in batches:
            ids = [np.append(i, np.uint32(END_ID)).astype(STORED) for i in code.encode(batch.column(2).to_pylist())]
            common, top = zip(*(_profile(i, words) for i in ids)) if ids else ((), ())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(i) for i in ids], pa.int64()),
                pa.array(common, pa.int32()), pa.array(list(top), pa.list_(pa.int32())),
                pa.array([i.tobytes() for i in ids], pa.binary())],
                ["doc_id", "row_no", "n", "common", "sketch", "ids"])

    number = F.col(row_no) if row_no else F.monotonically_increasing_id()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), number.alias("row_no"),
                       text_or_empty().alias("t")).mapInArrow(run, IDS)


def document_frequencies(tokens: DataFrame) -> DataFrame:
    """(id, df): in how many of all documents an id occurs; added up per task first."""
    def run(batches):
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for data in batch.column(0):
                total[pd.unique(np.frombuffer(data.as_buffer(), STORED))] += 1
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "df"])

    return tokens.select("ids").mapInArrow(run, "id bigint, df bigint").groupBy("id").agg(
        F.sum("df").alias("df"))


def _tallied(documents: Iterable[tuple[int, np.ndarray]]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(part, common, ids, docs): in how many of the documents (common id, ids) with a common id each id occurs, by ranges
    (parts) of ids. A common id comes again after COUNTED_IDS different ids of documents."""
    bounds = np.arange(0, (1 << 16) + 1, PART_IDS)

    def counted():
        for common, several in held.items():
            ids, docs = _counts(np.concatenate(several))
            places = np.searchsorted(ids, bounds)
            for part in np.flatnonzero(np.diff(places)).tolist():
                here = slice(places[part], places[part + 1])
                yield part, common, ids[here], docs[here]

    held: dict[int, list] = {}
    n = 0
    for common, ids in documents:
        different = pd.unique(ids)
        held.setdefault(common, []).append(different)
        n += len(different)
        if n >= COUNTED_IDS:
            yield from counted()
            held, n = {}, 0
    yield from counted()


def vocabularies(tokens: DataFrame) -> DataFrame:
    """(part, common, ids, docs): in how many of all documents with this common id each id occurs, one row per common id and
    range of ids; ids with 16 bits, counts with 64. Counted per task first."""
    schema = "part int, common int, ids binary, docs binary"

    def rows(found):
        found = list(zip(*found))
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[0], pa.int32()), pa.array(found[1], pa.int32()),
                 pa.array([i.astype(STORED).tobytes() for i in found[2]], pa.binary()),
                 pa.array([d.astype("<i8").tobytes() for d in found[3]], pa.binary())], ["part", "common", "ids", "docs"])

    def counted(batches):
        forget()  # the ids are made
        yield from rows(_tallied((c, np.frombuffer(i.as_buffer(), STORED)) for batch in batches
                                 for c, i in zip(batch.column(0).to_pylist(), batch.column(1))))

    def added(batches):
        parts = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for (part, common), same in groupby(parts, key=lambda row: row[:2]):
            total = np.zeros(PART_IDS, np.int64)
            for _, _, ids, docs in same:
                total[np.frombuffer(ids, STORED) - part * PART_IDS] += np.frombuffer(docs, "<i8")
            ids = np.flatnonzero(total)
            yield from rows([(part, common, ids + part * PART_IDS, total[ids])])

    return tokens.select("common", "ids").mapInArrow(counted, schema).repartition("part").sortWithinPartitions(
        "part", "common").mapInArrow(added, schema)


def _chain(groups: dict[int, int], parts: Iterable[tuple], idf: np.ndarray) -> tuple[list[int], list[float]]:
    """The order of `lexical_order` for common ids and their numbers of documents, from rows as `_tallied` gives, sorted by
    part. One part is held at once."""
    most = sorted(groups, key=lambda g: (-groups[g], g))
    at = {g: i for i, g in enumerate(most)}
    alike = np.zeros((len(most), len(most)))
    for part, rows in groupby(parts, key=lambda row: row[0]):
        profiles = np.zeros((len(most), PART_IDS))
        for _, common, ids, docs in rows:
            profiles[at[common], ids.astype(np.int64) - part * PART_IDS] += docs * idf[ids]
        alike += profiles @ profiles.T
    norms = np.sqrt(alike.diagonal())
    norms[norms == 0] = 1.0
    alike /= norms[:, None] * norms
    out, left = [], np.ones(len(most), bool)
    for _ in most:
        now = int(np.where(left, alike[out[-1]], -np.inf).argmax()) if out else 0
        out.append(now)
        left[now] = False
    return [most[i] for i in out], [float(alike[i, j]) for i, j in zip(out, out[1:])]


def lexical_order(sample: list[tuple[int, np.ndarray]], idf: np.ndarray) -> tuple[list[int], list[float]]:
    """The most frequent ids of the documents (common id, ids), all of them, in an order in which ids whose documents
    have similar vocabularies follow each other, from each to the nearest one left; and how similar each is to
    the next."""
    return _chain(Counter(c for c, _ in sample), sorted(_tallied(sample), key=lambda row: row[0]), idf)


def _counts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids, ascending, and how often each occurs."""
    ordered = np.sort(ids, kind="stable")  # by radix, as the ids have 16 bits
    begins = np.ones(len(ordered), bool)
    begins[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(begins)
    return ordered[first], np.append(first[1:], len(ordered)) - first


def _runs(bounds: np.ndarray, chosen: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """The sizes of the chosen runs, and of each column these runs, one after the other."""
    first, end = bounds[chosen], bounds[chosen + 1]
    places = list(zip(first.tolist(), end.tolist()))
    return [end - first, *(np.concatenate([c[a:b] for a, b in places] or [c[:0]]) for c in columns)]


class Bm25Shard:
    """Inverted index of some documents: postings by token id, with their BM25 weights, and by document."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean_length: float):
        sizes = np.array([len(i) for i in ids], np.int64)
        counted = [_counts(i) for i in ids]
        self.idf, self.n = idf, len(ids)
        self.doc_first = np.concatenate([[0], np.cumsum([len(t) for t, _ in counted])])
        self.doc_term = np.concatenate([t for t, _ in counted])
        tf = np.concatenate([c for _, c in counted]).astype(np.float32)
        del counted
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(self.doc_first))
        self.doc_weight = idf[self.doc_term] * (K1 + 1)
        self.doc_weight *= tf / (tf + (K1 * (1 - B + B * sizes / mean_length))[doc])
        by_term = np.argsort(self.doc_term, kind="stable")  # by radix
        self.weight, self.doc = self.doc_weight[by_term], doc[by_term]
        bounds = np.searchsorted(self.doc_term[by_term], np.arange(len(idf) + 1))
        self.first = bounds

    def _added(self, terms: np.ndarray) -> np.ndarray:
        _, doc, weight = _runs(self.first, terms, self.doc, self.weight)
        return np.bincount(doc, weights=weight, minlength=self.n)

    def scores(self, query: np.ndarray) -> np.ndarray:
        """BM25 of every document for the different ids of `query`."""
        return self._added(pd.unique(query).astype(np.int64))


def _bm25(ids: list[np.ndarray], idf: np.ndarray, mean_length: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, id and BM25 weight of each different id of some documents."""
    counted = [_counts(i) for i in ids]
    doc = np.repeat(np.arange(len(ids)), [len(t) for t, _ in counted])
    term = np.concatenate([t for t, _ in counted]).astype(np.int64)
    tf = np.concatenate([c for _, c in counted])
    sizes = np.array([len(i) for i in ids])
    return doc, term, idf[term] * (K1 + 1) * tf / (tf + (K1 * (1 - B + B * sizes / mean_length))[doc])


class Seeds:
    """Some seeds, by their different ids; finds for documents the seed of the highest score: BM25 of the document for the
    seed's different ids, over the root of their number, so that long seeds do not win every text.

    Ids that many seeds have are a dense matrix, the others postings: every id counts for every seed."""

    def __init__(self, terms: list[np.ndarray]):
        self.n = len(terms)
        sizes = np.array([len(t) for t in terms], np.int64)
        term, seed = np.concatenate([*terms, np.zeros(0, STORED)]).astype(np.int64), np.repeat(np.arange(self.n), sizes)
        self.scale = np.maximum(sizes, 1).astype(np.float32) ** -0.5
        counts = np.bincount(term, minlength=1 << 16)
        dense = counts * DENSE > self.n
        self.column = np.where(dense, np.cumsum(dense) - 1, -1)
        self.matrix = np.zeros((int(dense.sum()), self.n), np.float32)
        held = dense[term]
        self.matrix[self.column[term[held]], seed[held]] = self.scale[seed[held]]
        by_term = np.flatnonzero(~held)[np.argsort(term[~held], kind="stable")]
        self.sizes = np.where(dense, 0, counts)
        self.first, self.seed = np.cumsum(self.sizes) - self.sizes, seed[by_term].astype(np.int32)

    def scores(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """Scores of `n` documents (rows) for all seeds."""
        column = self.column[term]
        held = column >= 0
        weights = np.zeros((n, len(self.matrix)), np.float32)
        weights[doc[held], column[held]] = weight[held]
        out = weights @ self.matrix
        sizes, weight = self.sizes[term], weight.astype(np.float32)
        upto = np.cumsum(sizes)
        cuts = np.searchsorted(upto, np.arange(POSTINGS, upto[-1] if len(upto) else 0, POSTINGS), "right")
        for some in np.split(np.arange(len(term)), cuts):
            seed = _gather(self.seed, self.first[term[some]], sizes[some])
            np.add.at(out.reshape(-1), np.repeat(doc[some] * self.n, sizes[some]) + seed,
                      np.repeat(weight[some], sizes[some]) * self.scale[seed])
        return out

    def nearest(self, ids: list[np.ndarray], idf: np.ndarray, mean_length: float) -> tuple[np.ndarray, np.ndarray]:
        """For each document the seed of the highest score, the first of equal ones, and this score."""
        at_once, seed, best = max(1, CELLS // self.n), [], []
        for some in (ids[a:a + at_once] for a in range(0, len(ids), at_once)):
            scores = self.scores(*_bm25(some, idf, mean_length), len(some))
            best.append(scores.max(1))
            seed.append((scores >= best[-1][:, None] * np.float32(1 - 1e-6)).argmax(1))  # equal but for rounding
        return np.concatenate(seed), np.concatenate(best)


def _seeds(tokens: DataFrame, order: list[int]) -> DataFrame:
    """(row_no, terms, pos): rows whose id `SEED_EVERY` divides, their different ids, and their places in the lexical order,
    given as the order of all common ids. Where there is no such row, the first row is the seed."""
    at = {common: place for place, common in enumerate(order)}
    asked = tokens.filter(F.col("doc_id") % SEED_EVERY == 0)
    if asked.isEmpty():
        asked = tokens.orderBy("row_no").limit(1)

    def run(batches):
        for batch in batches:
            terms = [pd.unique(np.frombuffer(i.as_buffer(), STORED)).tobytes() for i in batch.column(4)]
            places = pa.array([at[c] for c in batch.column(0).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([places, *batch.columns[1:4], pa.array(terms, pa.binary())],
                                             ["place", "sketch", "doc_id", "row_no", "terms"])

    placed = asked.select("common", "sketch", "doc_id", "row_no", "ids").mapInArrow(
        run, "place int, sketch array<int>, doc_id bigint, row_no bigint, terms binary")
    return numbered(placed.withColumn("all", F.lit(0)), "all", ["place", "sketch", "doc_id", "row_no"], "seeds").select(
        "row_no", "terms", "pos")


def nearest_seeds(tokens: DataFrame, idf: np.ndarray, mean_length: float, order: list[int]) -> DataFrame:
    """(row_no, doc_id, n, seed, score): for each row the place of the seed that scores it highest of all, the first of
    equal ones; a seed has itself. Every row meets every seed; at most SEEDS_AT_ONCE of these are sent to the tasks at
    once, as different ids."""
    seeds = written(_seeds(tokens, order), "placed-seeds")

    def scored(first: int) -> DataFrame:
        some = seeds.filter(F.col("pos").between(first, first + SEEDS_AT_ONCE - 1)).orderBy("pos").collect()
        own = {r["row_no"]: r["pos"] for r in some}
        terms = [bytes(r["terms"]) for r in some]

        def run(batches):
            forget()  # the ids are made; their memory is wanted for the seeds
            table = Seeds([np.frombuffer(t, STORED) for t in terms])
            for batch in batches:
                rows = batch.column(0).to_pylist()
                if not rows:
                    continue
                seed, score = table.nearest([np.frombuffer(i.as_buffer(), STORED) for i in batch.column(3)], idf, mean_length)
                seed, score = seed + first, np.round(score.astype(float), 3)
                for n, row in enumerate(rows):
                    if row in own:
                        seed[n], score[n] = own[row], np.inf
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(seed), pa.array(score)],
                                                 ["row_no", "doc_id", "n", "seed", "score"])

        return tokens.select("row_no", "doc_id", "n", "ids").mapInArrow(run, NEAREST)

    every = [scored(first) for first in range(0, max(1, seeds.count()), SEEDS_AT_ONCE)]
    best = F.max(F.struct("score", (-F.col("seed")).alias("before"))).alias("best")
    return reduce(DataFrame.unionByName, every).groupBy("row_no", "doc_id", "n").agg(best).select(
        "row_no", "doc_id", "n", (-F.col("best.before")).alias("seed"), F.col("best.score").alias("score"))


def cut(first: int, size: int, total: int, window: int) -> list[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the pieces of `size` ids at place `first` of `total`: sequences are windows,
    but for the last ids, which go into sequences of powers of two, which need no padding."""
    whole, left = divmod(total, window)
    out, start = [], 0
    while start < size:
        at = first + start
        sequence, offset, room = at // window, at % window, window
        if sequence == whole:
            rooms = [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
            while offset >= rooms[0]:
                sequence, offset, rooms = sequence + 1, offset - rooms[0], rooms[1:]
            room = rooms[0]
        length = min(size - start, room - offset)
        out.append((start, length, sequence, offset))
        start += length
    return out


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, row_no: str | None = None) -> DataFrame:
    """One row per piece: row_no, doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    ids (little-endian unsigned 32-bit).

    Each row of `docs`, whole, followed by the end id: every id lies in exactly one piece. A
    sequence has `window` ids, or a power of two of them. A null text is empty: just the end id.
    Null ids, repeated rows and equal texts are packed like any others (`row_no` tells rows apart); rows with a null id
    are no seeds. A seed's texts follow it by score (to three decimals), then doc_id, then row. An empty table gives
    no rows; other columns are ignored.

    Counts of vocabulary size for each common id, the different ids of SEEDS_AT_ONCE seeds and the
    sums of ranges are the only things sent to the driver at once. Only numbers are sorted; ids are joined to their places.
    """
    prepare(docs.sparkSession)
    tokens = written(token_ids(docs, tokenizer, row_no), "token-ids")
    idf, mean_length, lexical = _learned(tokens)
    order = ["seed", F.desc("score"), "doc_id", "row_no"]
    ranked = nearest_seeds(tokens, idf, mean_length, lexical).repartitionByRange(
        shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order).select("row_no", "n")

    def summed(batches):
        from pyspark import TaskContext
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            ends = total + np.cumsum(n)
            total = int(ends[-1]) if len(n) else total
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(ends - n),
                                              pa.array(ends)], ["row_no", "part", "first", "end"])

    places = written(ranked.mapInArrow(summed, "row_no bigint, part int, first bigint, end bigint"), "places")
    ends = {r["part"]: r["end"] for r in places.groupBy("part").agg(F.max("end").alias("end")).collect()}
    before, total = {}, 0
    for part in sorted(ends):
        before[part], total = total, total + ends[part]

    def run(batches):
        for batch in batches:
            out = []
            for row, doc_id, data, part, first in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(data, STORED).astype("<u4")
                for start, length, sequence, offset in cut(before[part] + first, len(ids), total, window):
                    piece = ids[start:start + length].tobytes()
                    out.append((row, doc_id, start, length, zlib.crc32(piece), len(ids), sequence, offset, piece))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.binary() if k == 8 else pa.int64()) for k, c in enumerate(zip(*out))],
                    [f.split(" ")[0] for f in PIECES.split(", ")])

    return tokens.join(places, "row_no").select("row_no", "doc_id", "ids", "part", "first").mapInArrow(run, PIECES)


def _idf(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.log1p((n_docs - df + 0.5) / (df + 0.5))


def _learned(tokens: DataFrame) -> tuple[np.ndarray, float, list[int]]:
    """Inverse document frequencies by id, the mean length, and the lexical order of all common ids; over all documents."""
    n_docs, n_tokens = tokens.agg(F.count("*"), F.sum("n")).first()
    groups = {r["common"]: r["count"] for r in tokens.groupBy("common").count().collect()}
    with shuffles_dropped(tokens.sparkSession):
        counted = written(vocabularies(tokens), "vocabularies")

    def parts():
        for r in counted.orderBy("part", "common").toLocalIterator():
            yield r["part"], r["common"], np.frombuffer(r["ids"], STORED), np.frombuffer(r["docs"], "<i8")

    df = np.zeros(1 << 16)
    for _, _, ids, docs in parts():
        df[ids] += docs
    idf = _idf(df, n_docs)
    return idf, (n_tokens or 0) / max(1, n_docs), _chain(groups, parts(), idf)[0]


def _statistics(tokens: DataFrame) -> tuple[np.ndarray, float, int, int]:
    """Inverse document frequencies by id, the mean length, the number of documents and of all ids."""
    n_docs, n_tokens = tokens.agg(F.count("*"), F.sum("n")).first()
    counted = document_frequencies(tokens).toPandas()
    df = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1)
    df[counted["id"].to_numpy(np.int64)] = counted["df"].to_numpy()
    return _idf(df, n_docs), (n_tokens or 0) / max(1, n_docs), n_docs, n_tokens or 0


INDEX = "shard bigint, rows binary, doc_ids binary, sizes binary, ids binary"
NEIGHBOURS = "query_row bigint, query_id bigint, row_no bigint, doc_id bigint, score double"
NO_ID = -(1 << 63)
SEARCH_TOKENS = 1 << 20
BLOCK_QUERIES = 256


def _gathered(rows: DataFrame, by: str) -> DataFrame:
    """One row per value of `by`: row numbers, document ids (NO_ID for null), sizes, and all ids end to end."""
    def run(batches):
        now, parts = None, []

        def flush():
            rows, docs, ids = zip(*parts)
            return pa.RecordBatch.from_arrays([
                pa.array([now], pa.int64()), pa.array([np.array(rows, np.int64).tobytes()], pa.binary()),
                pa.array([np.array(docs, np.int64).tobytes()], pa.binary()),
                pa.array([np.array([len(i) // 2 for i in ids], np.int64).tobytes()], pa.binary()),
                pa.array([b"".join(ids)], pa.binary())], ["shard", "rows", "doc_ids", "sizes", "ids"])

        for batch in batches:
            for number, row, doc_id, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if parts and number != now:
                    yield flush()
                    parts = []
                now = number
                parts.append((row, NO_ID if doc_id is None else doc_id, ids))
        if parts:
            yield flush()

    return rows.select(by, "row_no", "doc_id", "ids").repartition(by).sortWithinPartitions(by, "row_no").mapInArrow(run, INDEX)


def bm25_neighbours(docs: DataFrame, tokenizer: str, k: int = 10, every: int = 100) -> DataFrame:
    """query_row, query_id, rank, row_no, doc_id, score: the `k` other documents of highest BM25 for each row whose id
    `every` divides, exactly and over all rows.

    Every block of queries meets every shard; what leaves a shard is at most `k` rows a query. Ties go to smaller
    row numbers. A null text is empty; rows with a null id are candidates, never queries; repeated rows are
    documents of their own. An empty table gives no rows; other columns are ignored.
    """
    prepare(docs.sparkSession)
    tokens = written(token_ids(docs, tokenizer), "token-ids")
    idf, mean_length, _, n_tokens = _statistics(tokens)
    shards = max(1, -(-n_tokens // SEARCH_TOKENS))
    index = written(_gathered(tokens.withColumn("s", F.pmod(F.xxhash64("row_no"), F.lit(shards))), "s"), "bm25-index")
    asked = tokens.filter(F.col("doc_id") % every == 0)
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    queries = _gathered(asked.withColumn("b", F.pmod(F.xxhash64("row_no"), F.lit(blocks))), "b").select(
        *[F.col(c).alias(f"q_{c}") for c in ("rows", "doc_ids", "sizes", "ids")],
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))

    def run(batches):
        def parts(row, prefix):
            sizes = np.frombuffer(row[prefix + "sizes"], np.int64)
            texts = np.split(np.frombuffer(row[prefix + "ids"], STORED), np.cumsum(sizes)[:-1])
            return np.frombuffer(row[prefix + "rows"], np.int64), np.frombuffer(row[prefix + "doc_ids"], np.int64), texts

        for batch in batches:
            for row in batch.to_pylist():
                rows, ids, texts = parts(row, "")
                shard, out = Bm25Shard(texts, idf, mean_length), [[] for _ in range(5)]
                for query_row, query_id, query in zip(*parts(row, "q_")):
                    scores = np.where(rows == query_row, -1.0, shard.scores(query))
                    best = np.lexsort((rows, -scores))[:k]
                    best = best[scores[best] >= 0]
                    for column, values in zip(out, (np.full(len(best), query_row), np.full(len(best), query_id),
                                                    rows[best], ids[best], scores[best])):
                        column.append(values)
                arrays = [np.concatenate(c) for c in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, mask=a == NO_ID) if i == 3 else pa.array(a) for i, a in enumerate(arrays)],
                    [f.split(" ")[0] for f in NEIGHBOURS.split(", ")])

    hits = queries.join(index, "shard").mapInArrow(run, NEIGHBOURS)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "row_no")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_row", "query_id", "rank", "row_no", "doc_id", "score")
