"""Prefix trie of conversations: ternary search trees per range shard, merged at their boundaries.

Turns are dictionary-encoded; a conversation is the sequence of its turns' ids. Different sequences are sorted,
dealt to ranges and cut into shards of bounded size. A shard inserts its sequences into a ternary search tree,
medians first, so that every level's search tree is balanced, and one traversal adds up members, leaves and savings.
Only nodes on the way to a shard's first or last sequence can also lie in other shards: these boundary nodes
are merged by their prefix, and their subtrees' sums follow by pointer doubling.

Sequences are taken in windows of WINDOW turns. A longer conversation goes on in the next window under
the node it has reached, so no row holds more than a window's ids.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import numbered, prepare, shuffle_partitions, written

WINDOW = 256
SHARD_TURNS = 1 << 18
HEAD = 5  # the most turns a conversation takes over from the first of its hundred
CHUNK_IDS = 4096
ROOT = b""
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODES = ("key binary, parent_key binary, prefix binary, depth bigint, conv_id bigint, parent_conv_id bigint, chars bigint, "
         "n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, ends string")


class TernaryTree:
    """A trie of id sequences: per level a binary search tree of ids, whose middle child leads one level down.
    Node 0 stands for the empty sequence."""

    def __init__(self):
        self.ids, self.low, self.equal, self.high, self.chars = [None], [-1], [-1], [-1], [0]
        self.ending = [-1]  # the number of the sequence that ends in a node

    def _new(self, turn: int, chars: int) -> int:
        for column, value in ((self.ids, turn), (self.low, -1), (self.equal, -1), (self.high, -1),
                              (self.chars, chars), (self.ending, -1)):
            column.append(value)
        return len(self.ids) - 1

    def insert(self, turns: list[int], chars: list[int], number: int) -> None:
        node = 0
        for turn, size in zip(turns, chars):
            at = self.equal[node]
            if at < 0:
                at = self.equal[node] = self._new(turn, size)
            while self.ids[at] != turn:
                side = self.low if turn < self.ids[at] else self.high
                if side[at] < 0:
                    side[at] = self._new(turn, size)
                at = side[at]
            node = at
        self.ending[node] = number

    @classmethod
    def of_sorted(cls, turns: list, chars: list) -> "TernaryTree":
        """Sorted, different sequences, inserted medians first."""
        tree, todo = cls(), [(0, len(turns))]
        while todo:
            first, end = todo.pop()
            if first < end:
                middle = (first + end) // 2
                tree.insert(turns[middle], chars[middle], middle)
                todo += [(first, middle), (middle + 1, end)]
        return tree

    def path(self, turns: list[int]) -> list[int]:
        """The nodes on the way to a sequence, node 0 first."""
        out = [0]
        for turn in turns:
            at = self.equal[out[-1]]
            while self.ids[at] != turn:
                at = self.low[at] if turn < self.ids[at] else self.high[at]
            out.append(at)
        return out

    def traverse(self) -> list[tuple[int, int, int]]:
        """(node, parent, depth) of all nodes, each after its parent."""
        out, todo = [(0, -1, 0)], [(self.equal[0], 0, 1)]
        while todo:
            node, parent, depth = todo.pop()
            if node >= 0:
                out.append((node, parent, depth))
                todo += [(self.low[node], parent, depth), (self.high[node], parent, depth),
                         (self.equal[node], node, depth + 1)]
        return out


def _path_keys(prefix: bytes, turns: list[int]) -> list[bytes]:
    """A name for every node on the way to a sequence, that of its prefix first."""
    digest = hashlib.sha256(prefix)
    out = [digest.digest()]
    for turn in turns:
        digest.update(turn.to_bytes(8, "little", signed=True))
        out.append(digest.digest())
    return out


def shard_nodes(prefix: bytes, depth: int, rows: list[dict], first: bool, last: bool) -> dict:
    """Columns of the trie nodes of some sorted sequences (ids, chars, n, conv_id, ends, and, where the
    sequence goes on in the next window, children, leaves, saved) under the node `prefix` of depth `depth`.

    Boundary nodes have a key and sums without themselves; `first` and `last` say that the first or last
    sequence may share nodes with another shard. Node 0 is always a boundary node.
    """
    turns = [r["ids"] for r in rows]
    tree = TernaryTree.of_sorted(turns, [r["chars"] for r in rows])
    keys = {0: _path_keys(prefix, [])[0]}
    for wanted, ids in ((first, turns[0]), (last, turns[-1])):
        if wanted:
            keys.update(zip(tree.path(ids), _path_keys(prefix, ids)))
    size = len(tree.ids)
    n, children, leaves, saved, least = [0] * size, [0] * size, [0] * size, [0] * size, [None] * size
    order = tree.traverse()
    for node, parent, _ in reversed(order):
        if tree.ending[node] >= 0:
            row = rows[tree.ending[node]]
            n[node] += row["n"]
            least[node] = row["conv_id"] if least[node] is None else min(least[node], row["conv_id"])
            children[node] += row["children"] or 0
            leaves[node] += row["leaves"] or 0
            saved[node] += row["saved"] or 0
        if node not in keys:
            leaves[node] += not children[node]
            saved[node] += (n[node] - 1) * tree.chars[node]
        if parent >= 0:
            n[parent] += n[node]
            least[parent] = least[node] if least[parent] is None else min(least[parent], least[node])
            if node not in keys:
                children[parent] += 1
                leaves[parent] += leaves[node]
                saved[parent] += saved[node]
    out = {f.split(" ")[0]: [] for f in NODES.split(", ")}
    for node, parent, below in order:
        top = keys.get(parent)
        ends = rows[tree.ending[node]]["ends"] if tree.ending[node] >= 0 else None
        for column, value in zip(out.values(), (
                keys.get(node), top, prefix if node == 0 else None, depth + below, least[node],
                None if top is not None or parent < 0 else least[parent], tree.chars[node], n[node],
                children[node], leaves[node], saved[node], ends)):
            column.append(value)
    return out


SEQUENCE = ("prefix", "ids", "chars", "n", "conv_id", "ends", "children", "leaves", "saved")


def _window_nodes(sequences: DataFrame, depth: int, shard_turns: int) -> DataFrame:
    """Trie nodes of one window, per shard, from its different sequences; see `shard_nodes`."""
    schema = pa.schema([(c, {"binary": pa.binary(), "bigint": pa.int64(), "string": pa.string()}[t])
                        for c, t in (f.split(" ") for f in NODES.split(", "))])

    def shards(batches):
        """(sequences of one prefix, first, last): a task's sorted rows cut at prefixes and at `shard_turns`."""
        rows, total, first = [], 0, True
        for batch in batches:
            for row in batch.to_pylist():
                cut = rows and row["prefix"] != rows[0]["prefix"]
                if cut or total >= shard_turns:
                    yield rows, first, not cut
                    rows, total, first = [], 0, not cut
                rows.append(row)
                total += len(row["ids"]) + 1
        if rows:
            yield rows, first, True

    def run(batches):
        for rows, first, last in shards(batches):
            columns = shard_nodes(rows[0]["prefix"], depth, rows, first, last)
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

    return sequences.select(*SEQUENCE).repartitionByRange(
        shuffle_partitions(sequences.sparkSession), "prefix", "ids").sortWithinPartitions("prefix", "ids") \
        .mapInArrow(run, NODES)


def _merged(boundary: DataFrame) -> DataFrame:
    """Boundary nodes of all shards, one row per prefix, with whole sums over their subtrees."""
    nodes = boundary.groupBy("key").agg(
        *[F.min(c).alias(c) for c in ("parent_key", "prefix", "depth", "conv_id")], F.max("chars").alias("chars"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")], F.max("ends").alias("ends"))
    below = nodes.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more")).filter("key is not null")
    nodes = written(nodes.join(below, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).withColumns({
            "n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
            "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("chars")}).drop("more"), "trie-boundary")
    # After i rounds a node has the sums of the 2 ** i levels below it and points as many levels up.
    now = nodes.select("key", F.col("parent_key").alias("up"), "n_leaves", "saved")
    while not now.filter("up is not null").isEmpty():
        lower = now.filter("up is not null").groupBy(F.col("up").alias("key")).agg(
            F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        further = now.select(F.col("key").alias("up"), F.col("up").alias("next"))
        now = written(now.join(lower, "key", "left").join(further, "up", "left").select(
            "key", F.col("next").alias("up"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), "trie-sums")
    return written(nodes.drop("n_leaves", "saved").join(now.drop("up"), "key"), "trie-boundary")


def _ends(members: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of each key's conv_ids, ascending and comma-joined.

    The ids are sorted in ranges and joined in parts there; a key's parts are hashed one after the other, as
    the hash asks for, but never held together.
    """
    def join_parts(batches):
        from pyspark import TaskContext
        part, number, key, ids = TaskContext.get().partitionId(), 0, None, []

        def flush():
            return pa.RecordBatch.from_arrays([
                pa.array([key], pa.binary()), pa.array([part], pa.int32()), pa.array([number], pa.int64()),
                pa.array([",".join(map(str, ids))])], ["key", "part", "number", "joined"])

        for batch in batches:
            for k, conv in zip(*(batch.column(i).to_pylist() for i in range(2))):
                if ids and (k != key or len(ids) >= CHUNK_IDS):
                    yield flush()
                    ids, number = [], number + 1
                key = k
                ids.append(conv)
        if ids:
            yield flush()

    def hash_parts(batches):
        key, digest = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])],
                                              ["key", "ends"])

        for batch in batches:
            for k, joined in zip(*(batch.column(c).to_pylist() for c in ("key", "joined"))):
                if digest is not None and k == key:
                    digest.update(b"," + joined.encode())
                    continue
                if digest is not None:
                    yield done()
                key, digest = k, hashlib.sha256(joined.encode())
        if digest is not None:
            yield done()

    sorted_ids = members.select("key", "conv_id").repartitionByRange(
        shuffle_partitions(members.sparkSession), "key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = sorted_ids.mapInArrow(join_parts, "key binary, part int, number bigint, joined string")
    return parts.repartition("key").sortWithinPartitions("key", "part", "number").mapInArrow(
        hash_parts, "key binary, ends string")


def encode_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_id, chars): every turn's place in its conversation (from 0), the dictionary number
    of its role and text, and its text's code points.

    Turns are in the order of `turn`, nulls first; those of equal number in the order of the SHA-256 of
    their content. Null roles and texts are empty. Rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = written(conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        content.alias("content"), F.char_length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row_no")), "turns")
    dictionary = written(turns.groupBy("content").agg(F.max("chars").alias("chars")).withColumn(
        "turn_id", F.monotonically_increasing_id()), "turn-dictionary")
    placed = numbered(turns.drop("chars"), "conv_id", ["turn", "content", "row_no"], "turn-order")
    return placed.join(dictionary, "content").select("conv_id", "pos", "turn_id", "chars")


def _shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % 6


def rebuild(turns: DataFrame, window: int = WINDOW) -> DataFrame:
    """(conv_id, window, ids, chars, more): the rebuilt conversations in windows of turns.

    A conversation begins with the first h turns of the one whose id is the next lower multiple of a hundred (h from
    the CRC-32 of its own id) and goes on with its own turns after its first h. One without any turns has one
    empty window. `more` says that another window follows.
    """
    conv = F.col("conv_id")
    h = _shared_turns(conv)
    heads = turns.filter((conv % 100 == 0) & (F.col("pos") < HEAD)).groupBy(conv.alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "turn_id", "chars"))).alias("head"))  # HEAD entries at most
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own")).withColumn("base", conv - conv % 100) \
        .join(heads, "base", "left").select("conv_id", "own", F.slice(
            F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), h.cast("int")).alias("head")) \
        .withColumn("size", F.size("head") + F.greatest(F.col("own") - h, F.lit(0)))
    convs = written(convs, "rebuilt-heads")
    first = convs.select("conv_id", "size", F.explode("head").alias("t")).select(
        "conv_id", "size", "t.pos", "t.turn_id", "t.chars")
    own = turns.filter(F.col("pos") >= h).join(
        convs.select("conv_id", "size", F.size("head").alias("k")), "conv_id").select(
        "conv_id", "size", (F.col("pos") - h + F.col("k")).alias("pos"), "turn_id", "chars")
    placed = first.unionByName(own)
    listed = placed.groupBy("conv_id", F.floor(F.col("pos") / window).alias("window")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "turn_id", "chars"))).alias("t"), F.max("size").alias("size"))
    listed = listed.select("conv_id", "window", F.transform("t", lambda t: t["turn_id"]).alias("ids"),
                           F.transform("t", lambda t: t["chars"]).alias("chars"),
                           (F.col("size") > (F.col("window") + 1) * window).alias("more"))
    none = F.array().cast("array<bigint>")
    return listed.unionByName(convs.filter("size = 0").select(
        "conv_id", F.lit(0).cast("long").alias("window"), none.alias("ids"), none.alias("chars"), F.lit(False).alias("more")))


def trie_nodes(conversations: DataFrame, window: int = WINDOW, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    A node is a different sequence of first turns (role and text); the root has none. Its members are the
    conversations that begin with it, `conv_id` is the smallest. Leaves and savings are summed over the subtree;
    savings are code points of a node's last text, for every member but one. See `encode_turns` for nulls,
    ties and repeated rows. An empty table, or one without any conv_id, gives no rows; other columns are ignored.
    """
    prepare(conversations.sparkSession)
    turns = written(encode_turns(conversations), "encoded-turns")
    windows = written(rebuild(turns, window), "rebuilt-windows")
    last = windows.agg(F.max("window")).first()[0]
    levels, going = [], None
    for w in range((last or 0) + 1):
        rows = windows.filter(F.col("window") == w)
        if going is None:
            rows = rows.withColumn("prefix", F.lit(ROOT))
        else:
            rows = rows.join(going.filter("more").select("conv_id", F.col("key").alias("prefix")), "conv_id")
        rows = going = written(rows.withColumn("key", F.unhex(F.sha2(F.concat(
            F.hex("prefix"), F.lit(":"), F.array_join("ids", ",")), 256))), "window-keys")
        found = rows.groupBy("key").agg(
            *[F.first(c).alias(c) for c in ("prefix", "ids", "chars")], F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
        ends = _ends(rows.filter("not more"))
        levels.append(written(found.join(ends, "key", "left"), "window-sequences"))
    none = "key binary, children bigint, leaves bigint, saved bigint"
    extra, out = conversations.sparkSession.createDataFrame([], none), []
    for w in reversed(range(len(levels))):
        sequences = levels[w].join(extra, "key", "left")
        nodes = written(_window_nodes(sequences, w * window, shard_turns), "trie-shards")
        merged = _merged(nodes.filter("key is not null"))
        if w:  # the node of a prefix is known in the window before; its first member is the first of all
            tops = levels[w - 1].select(F.col("key").alias("prefix"), F.col("conv_id").alias("first"))
            merged = written(merged.join(tops, "prefix", "left").withColumn(
                "conv_id", F.coalesce("first", "conv_id")).drop("first"), "trie-boundary")
            extra = merged.filter("prefix is not null").select(
                F.col("prefix").alias("key"), F.col("n_children").alias("children"),
                F.col("n_leaves").alias("leaves"), "saved")
        parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
        shared = merged if not w else merged.filter("prefix is null")
        inner = nodes.filter("key is null")
        below = inner.drop("parent_conv_id").filter("parent_key is not null").unionByName(
            shared.filter("parent_key is not null"), allowMissingColumns=True)
        parts = [inner.filter("parent_key is null"),
                 below.join(parents, "parent_key").withColumnRenamed("above", "parent_conv_id"),
                 shared.filter("parent_key is null").withColumn("parent_conv_id", F.lit(None).cast("long"))]
        out += [p.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias(
            "saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")) for p in parts]
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole
