"""Ranking by meaning within a radius, with bounds that spare comparisons.

Questions and rows meet in blocks (see `blocks`). The rows of a block are split into parts by the signs of a few fixed
projections of their vectors, and each part into rings by the angle to its centre. From a question's angle to the
centre follows the best cosine that any member of a ring can have. The rings of best promise are compared first; the
k-th cosine found there rules out, without a doubt, every ring whose best possible cosine is below it. No row per
question and ring, and none per pair, leaves a block.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import haversine_km
from ..session import stored
from .blocks import both_sides, in_blocks, inner, places, vectors_of, within
from .radius import DEFAULT_RADIUS_KM

# A block is split into as many parts as it takes for one to hold about so many rows.
PART_ROWS = 32
RING_DEGREES = 10
MOST_BITS = 12
# The first comparisons take the rings of best promise, up to so many times k rows.
FIRST = 8
SLACK = 1e-9
# So many bounds, of questions and rings, are held at once.
BOUNDS_AT_ONCE = 1 << 20


def _rings(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The order in which the vectors lie ring by ring, the rings' first places and the end, each ring's unit centre
    (of its part), and the least and the greatest cosine of a member to it."""
    n, width = vectors.shape
    rng, part = random.Random(17), np.zeros(n, np.int64)
    for bit in range(min(MOST_BITS, max(n // PART_ROWS, 1).bit_length() - 1)):
        plane = np.array([rng.gauss(0, 1) for _ in range(width)])
        part |= (vectors @ plane >= 0).astype(np.int64) << bit
    kinds, part = np.unique(part, return_inverse=True)
    centres = np.zeros((len(kinds), width))
    np.add.at(centres, part, vectors)
    sizes = np.sqrt(np.einsum("ij,ij->i", centres, centres))[:, None]
    centres = np.divide(centres, sizes, out=np.zeros_like(centres), where=sizes > 0)
    cosine = np.einsum("ij,ij->i", vectors, centres[part])
    ring = np.floor(np.degrees(np.arccos(np.clip(cosine, -1, 1))) / RING_DEGREES).astype(np.int64)
    order = np.lexsort((ring, part))
    change = np.flatnonzero((np.diff(part[order]) != 0) | (np.diff(ring[order]) != 0)) + 1
    first = np.concatenate([[0], change])
    return (order, np.append(first, n), centres[part[order[first]]],
            np.minimum.reduceat(cosine[order], first), np.maximum.reduceat(cosine[order], first))


def _best_possible(to_centre: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
    """The greatest cosine to a question that a member of a ring can have: that of the difference of the angles to
    the ring's nearer edge, 1 inside the ring."""
    edge = np.where(to_centre > greatest, greatest, least)
    sine = np.sqrt(np.maximum(1 - to_centre * to_centre, 0)) * np.sqrt(np.maximum(1 - edge * edge, 0))
    inside = (to_centre >= least) & (to_centre <= greatest)
    return np.where(inside, 1.0, to_centre * edge + sine) + SLACK


def _found(questions: pa.RecordBatch, rows: pa.RecordBatch) -> Iterator[tuple]:
    """(question, row, similarity, compared): places in the block of pairs within the radius, among which are each question's
    `_k` best; and how many pairs were compared for them."""
    k, radius = questions.column("_k").to_numpy(), questions.column("_r").to_numpy()
    width = max(int(b.column("_size").to_numpy().max()) for b in (questions, rows))
    q, h = vectors_of(questions, width), vectors_of(rows, width)
    order, bounds, centres, least, greatest = _rings(h)
    h, sizes = h[order], np.diff(bounds)
    q_place, h_place = places(questions), tuple(c[order] for c in places(rows))
    step = max(1, BOUNDS_AT_ONCE // len(sizes))
    for first in range(0, len(q), step):
        part = slice(first, first + step)
        asked, reach, most = q[part], radius[part], k[part]
        at = tuple(c[part] for c in q_place)

        def compare(chosen: np.ndarray, kth: np.ndarray) -> tuple[np.ndarray, ...]:
            """Pairs of the questions with the members of their chosen rings, within the radius and not below `kth`."""
            out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
            for ring in np.flatnonzero(chosen.any(axis=0)):
                a, band = np.flatnonzero(chosen[:, ring]), slice(bounds[ring], bounds[ring + 1])
                about = asked[a] @ h[band].T
                near = (about >= kth[a, None] - SLACK) & within(
                    tuple(c[a] for c in at), reach[a], tuple(c[band] for c in h_place))
                i, j = np.nonzero(near)
                out.append((a[i], j + bounds[ring], inner(asked[a[i]], h[band][j])))
            return tuple(np.concatenate(c) for c in zip(*out))

        promise = _best_possible(asked @ centres.T, least, greatest)
        by_promise = np.argsort(-promise, axis=1, kind="stable")
        before = np.cumsum(sizes[by_promise], axis=1) - sizes[by_promise]
        early = np.zeros(promise.shape, bool)
        np.put_along_axis(early, by_promise, before < FIRST * most[:, None], axis=1)
        a, b, similarity = compare(early, np.full(len(asked), -np.inf))
        # Each question's k-th cosine so far.
        kth, ranked = np.full(len(asked), -np.inf), np.lexsort((-similarity, a))
        n = np.arange(len(ranked)) - np.searchsorted(a[ranked], np.arange(len(asked)))[a[ranked]]
        last = ranked[n == most[a[ranked]] - 1]
        kth[a[last]] = similarity[last]
        late = ~early & (promise >= kth[:, None])
        more = compare(late, kth)
        a, b, similarity = (np.concatenate(c) for c in zip((a, b, similarity), more))
        # Rows of a block are in the order of their ids, by which ties go.
        ranked = np.lexsort((order[b], -similarity, a))
        n = np.arange(len(ranked)) - np.searchsorted(a[ranked], np.arange(len(asked)))[a[ranked]]
        kept = ranked[n < most[a[ranked]]]
        yield a[kept] + first, order[b[kept]], similarity[kept], int(((early | late) @ sizes).sum())


def _by_rings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs; and for each block a row without ids that counts its comparisons and all its pairs."""
    names = ["qid", "_qlat", "_qlon", "event_id", "_lat", "_lon", "similarity", "_compared", "_all"]
    for questions, rows in both_sides(batches):
        compared = 0
        for a, b, similarity, n in _found(questions, rows):
            compared += n
            a, b, none = pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([
                *[questions.column(c).take(a) for c in ("qid", "_lat", "_lon")],
                *[rows.column(c).take(b) for c in ("event_id", "_lat", "_lon")], pa.array(similarity), none, none], names)
        empty = [pa.nulls(1, c.type) for c in (*[questions.column(c) for c in ("qid", "_lat", "_lon")],
                                               *[rows.column(c) for c in ("event_id", "_lat", "_lon")])]
        yield pa.RecordBatch.from_arrays([
            *empty, pa.nulls(1, pa.float64()), pa.array([compared]), pa.array([len(questions) * len(rows)])], names)


def ball_pairs(questions: DataFrame, hazards: DataFrame, k: int, radius_km: float | None = None) -> tuple[DataFrame, int, int]:
    """((qid, event_id, distance_km, similarity), compared, all): pairs among which are the k of greatest cosine
    within each question's radius; how many rows were compared with questions for that, and how many lie in
    the cells that the questions touch.

    `questions` has qid, lat, lon, qvec and, unless given, radius_km; `hazards` has event_id, lat, lon and
    vec, all vectors being unit vectors of one length or zero. Rows without a position or vector take no part.
    """
    radius = F.col("radius_km") if radius_km is None and "radius_km" in questions.columns else F.lit(
        float(radius_km if radius_km is not None else DEFAULT_RADIUS_KM))
    blocks = in_blocks(questions.filter("qvec is not null"), hazards.filter("vec is not null"), F.lit(k), radius)
    ids = {f.name: f.dataType for f in blocks.schema.fields}
    double, whole = T.DoubleType(), T.LongType()
    schema = T.StructType([T.StructField(c, t) for c, t in (
        ("qid", ids["qid"]), ("_qlat", double), ("_qlon", double), ("event_id", ids["event_id"]), ("_lat", double),
        ("_lon", double), ("similarity", double), ("_compared", whole), ("_all", whole))])
    found = stored(blocks.mapInArrow(_by_rings, schema), "ball-pairs")
    compared, every = found.agg(F.sum("_compared"), F.sum("_all")).first()
    distance = haversine_km(F.col("_qlat"), F.col("_qlon"), F.col("_lat"), F.col("_lon"))
    pairs = found.filter("_all is null").select("qid", "event_id", distance.alias("distance_km"), "similarity")
    return pairs, compared or 0, every or 0
