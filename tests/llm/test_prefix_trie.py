"""Prefix trie against a dictionary of all prefixes."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hazardlake.llm import prefix_trie

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
            if d:
                children[whole[:d - 1]].add(whole[:d])
        ends[whole].append(c)
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    return Counter((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
                    leaves[node], saved[node], hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
                   for node, convs in members.items())


def check(df, **options):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert Counter(map(tuple, prefix_trie.trie_nodes(df, **options).collect())) == brute(rows)


@pytest.mark.parametrize("options", [{}, {"window": 2, "shard_turns": 6}])
def test_whole_table(spark, options):
    check(spark.read.parquet(f"{SF}/conversations.parquet"), **options)


def crowd(seed=1):
    """Few different turns, so that prefixes are shared; some long conversations, one repeated by many."""
    rng = random.Random(seed)
    rows = []
    for c in list(range(0, 60)) + list(range(100, 160)) + [205, 299, 300]:
        turns = [("user", "hot"), ("assistant", "x\U0001f600y")] if c % 3 else []
        turns += [(rng.choice(("user", "assistant")), rng.choice("abc") * rng.randrange(3)) for _ in range(rng.randrange(9))]
        if c % 5 == 0:
            turns = [("user", "same"), ("assistant", "again"), ("user", "end"), ("assistant", "bye")]
        if c in (13, 14, 100):
            turns = [("user", "long")] * (40 if c == 100 else 23)
        rows += [(c, t, *turn) for t, turn in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"window": 3, "shard_turns": 10}, {"window": 1, "shard_turns": 1}, {"window": 4}])
def test_crowd(spark, options):
    check(spark.createDataFrame(crowd(), SCHEMA), **options)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "nobody's"), (1, None, None, None), (1, 0, "", None), (1, 0, "user", "x"), (1, 0, "user", "x"),
            (2, 5, "user", ""), (-100, 0, "a", "b"), (-101, 0, "c", "d"), (-199, 3, "c", "d"), (-199, None, "c", "long " * 20000),
            (9, 0, "user", "only"), (10 ** 12, 0, "user", "far"), (10 ** 12 + 7, 1, "user", "far")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("pos", "turn_id", "chars", "key", "ids", "n", "size", "content", "window", "row_no"):
        df = df.withColumn(name, F.lit("clash"))
    check(df)
    check(df, window=1, shard_turns=2)


def test_empty_table(spark):
    assert prefix_trie.trie_nodes(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie.trie_nodes(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).collect() == []


def test_tree_is_balanced():
    turns = sorted([i, i % 7] for i in range(1023))
    tree = prefix_trie.TernaryTree.of_sorted(turns, turns)

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.low[node]), height(tree.high[node]))

    assert height(tree.equal[0]) == 10
    assert len(tree.traverse()) == len(tree.ids) == 1 + 2 * 1023
