import hashlib
import re

import pytest

from hazardlake.llm import spot_join, spotsigs as P
from hazardlake.llm.spot_join import length_part


def chains(text):
    words = re.findall(r"[^\W_]+", text.lower())
    common = set(P.COMMON)
    content = [i for i, w in enumerate(words) if w not in common]
    out = {(words[i - 1], words[i], words[j]) for i, j in zip(content, content[1:])
           if i and words[i - 1] in common}
    return out or ({tuple(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(df):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    expect = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        q = len(text) // 4
        edited = text[:len(text) - q] + following[:q]
        own, other = chains(text), chains(following)
        expect.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), str(len(own)),
                       round(jaccard(own, chains(edited)), 9), round(jaccard(own, other), 9)))
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"].split("-")[0],
            round(r["near_edited"], 9), round(r["near_next"], 9))
           for r in P.compare(P.fingerprint_documents(df)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expect))


def test_whole_table(documents):
    check(documents)


def test_odd_rows(odd):
    check(odd)


def test_empty_table(none):
    assert P.fingerprint_documents(none).collect() == []


def test_single_row(frame):
    check(frame([(7, "the cat sat on the mat with a hat")]))


def test_many_ranges(frame):
    check(frame([(i * i % 101, f"the word{i} and thing{i % 5} of stuff") for i in range(101)]))


def test_equal_texts_have_equal_fingerprints(frame):
    rows = P.compare(P.fingerprint_documents(frame([(1, "the a b"), (2, "x"), (3, "the a b")]))).collect()
    by_id = {r["doc_id"]: r["fingerprint"] for r in rows}
    assert by_id[1] == by_id[3] != by_id[2]


@pytest.mark.parametrize("least", [0.0, 0.5, 0.8])
def test_pruning_only_drops_what_length_rules_out(spark, least):
    from pyspark.sql import functions as F
    sets = [list(range(n)) for n in (0, 1, 2, 4, 5, 9, 10, 50)]
    df = spark.createDataFrame([(a, b) for a in sets for b in sets], "a array<bigint>, b array<bigint>")
    for r in df.select("a", "b", P.likeness(F.col("a"), F.col("b"), least).alias("x"),
                       length_part(F.size("a"), least or .5).alias("p"),
                       length_part(F.size("b"), least or .5).alias("q")).collect():
        true = jaccard(set(r["a"]), set(r["b"]))
        assert abs(r["x"] - true) < 1e-12 or r["x"] == 0.0 and true < least
        if true >= (least or .5):
            assert abs(r["p"] - r["q"]) <= 1


def test_runs_without_python_and_shuffles_texts_once(documents):
    from tests.helpers import plan_of
    plan = plan_of(P.compare(P.fingerprint_documents(documents)))
    classes = plan_of(P.with_classes(documents))
    assert "Python" not in classes and "Arrow" not in classes
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("\n(") and plan.count("Arguments: hashpartitioning") == 1


def check_classes(df, sets_of=chains):
    """Classes by flooding over all pairs of different sets."""
    rows = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    sets = [frozenset(sets_of(t)) for _, t in rows]
    left, root = set(sets), {}
    while left:
        todo = [left.pop()]
        group = []
        while todo:
            now = todo.pop()
            group.append(now)
            near = [o for o in left if 5 * min(len(now), len(o)) >= 4 * max(len(now), len(o)) and 5 * len(now & o) >= 4 * len(now | o)]
            left.difference_update(near)
            todo += near
        ids = [i for (i, _), s in zip(rows, sets) if s in group and i is not None]
        root.update({s: min(ids, default=None) for s in group})
    got = P.with_classes(df).collect()
    assert sorted(map(repr, ((r["doc_id"], r["class_id"]) for r in got))) == sorted(
        map(repr, ((i, root[s]) for (i, _), s in zip(rows, sets))))
    return len(set(root.values()))


def test_classes_of_the_whole_table(documents):
    check_classes(documents)


def test_classes_of_odd_rows(odd, none):
    check_classes(odd)
    assert P.with_classes(none).collect() == []


@pytest.mark.parametrize("small,hubs,levels", [(16, 4, 5), (2, 1, 6)])
def test_classes_of_crowds(frame, monkeypatch, small, hubs, levels):
    """Groups of near copies, a template with its own words in every text, and texts of few signatures."""
    import random
    monkeypatch.setattr(spot_join, "SMALL", small)
    monkeypatch.setattr(spot_join, "HUBS", hubs)
    monkeypatch.setattr(spot_join, "LEVELS", levels)
    rng = random.Random(small)

    def text(words):
        return " ".join(f"the {w} of more{w}" for w in words)

    rows = []
    for group in range(4):
        base = [f"g{group}x{i}" for i in range(30)]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 6])):
                words[rng.randrange(30)] = f"new{rng.randrange(10 ** 6)}"
            rows.append(text(words))
    rows += [text([f"tpl{i}" for i in range(20)] + [f"own{n}x{i}" for i in range(rng.choice([3, 5, 8]))]) for n in range(40)]
    rows += [text([f"few{i}" for i in range(n)]) for n in range(1, 9) for _ in range(2)] + ["the same text", "", "   "]
    rng.shuffle(rows)
    assert 40 < check_classes(frame(list(enumerate(rows)))) < 120


def test_sketches_refuse_no_alike_pair(spark):
    """Pairs of sets around the bound, of 1 to 600 signatures: all alike ones stay, few of the others."""
    import random
    from pyspark.sql import functions as F
    rng = random.Random(5)
    rows = []
    for n in [1, 2, 5, 9, 10, 40, 200, 600] * 12:
        base = [rng.getrandbits(64) - (1 << 63) for _ in range(n)]
        gone = rng.choice([0, 1, n // 9, n // 8, n // 4, n // 2])
        other = base[gone:] + [rng.getrandbits(64) - (1 << 63) for _ in range(rng.choice([0, gone, n // 5]))]
        rows.append((base, other, rng.choice([0, 1, n // 10])))
    # `alone` signatures of the first set stand outside of its tail.
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>, alone int")

    def with_sketch(df, name, alone):
        return df.withColumns({"tail": F.col(name), "alone": alone, "n": F.size(name) + alone}).withColumn(
            f"sketch_{name}", spot_join._sketch()).drop("tail", "n", "alone")

    both = with_sketch(df.withColumn("own", F.col("alone")), "a", F.col("own"))
    both = with_sketch(both, "b", F.lit(0)).withColumn("kept", spot_join._may_be_alike("sketch_a", "sketch_b", 0.8))
    kept_apart = apart = 0
    for r in both.select("a", "b", "own", "kept").collect():
        a, b = set(r["a"]), set(r["b"])
        alike = 5 * len(a & b) >= 4 * (len(a | b) + r["own"])
        assert r["kept"] or not alike
        apart += not alike
        kept_apart += r["kept"] and not alike
    assert apart > 30 and kept_apart < apart / 3
