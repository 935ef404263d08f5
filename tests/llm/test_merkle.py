"""Merkle manifest against trees built level by level in plain Python."""
import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hazardlake.llm import merkle

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        doc_id, source, lang, n, text = row
        leaf = H(*map(field, row))
        told = leaf
        if doc_id is not None and n is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
            told = H(*map(field, (doc_id, source, lang, n + 1, text)))
        groups[lang].append((doc_id is not None, doc_id or 0, leaf, told, doc_id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels([r[2] for r in sorted(groups[g])]) for g in order]
    top = levels([t[-1][0] for t in trees])
    out = Counter()
    for number, (g, tree) in enumerate(zip(order, trees)):
        for place, (_, _, leaf, told, doc_id) in enumerate(sorted(groups[g])):
            folded, siblings = told, []
            for above, at in ((tree, place), (top, number)):
                for level in above[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    siblings.append(other)
                    folded = H(other, folded) if at & 1 else H(folded, other)
                    at //= 2
            root = top[-1][0]
            out[doc_id, leaf, tree[-1][0], root, H(*siblings), folded, folded == root] += 1
    return out


def check(df, step=merkle.STEP):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert Counter(map(tuple, merkle.verify_documents(df, step).collect())) == brute(rows)


@pytest.mark.parametrize("step", [1, merkle.STEP])
def test_whole_table(documents, step):
    check(documents, step)


def test_odd_rows(odd):
    check(odd, 1)
    check(odd.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "é").when(F.col("doc_id") % 3 == 1, "z"))
          .withColumn("n_chars", F.when(F.col("doc_id") > 2, F.col("doc_id")))
          .withColumns({c: F.lit("clash") for c in ("pos", "tree", "leaf", "other", "digest", "up", "round", "order", "group")}), 2)


def test_hot_group_and_repeated_rows(spark, frame):
    """One group with nearly all rows, a third of them one row repeated."""
    rows = [(i, f"text {i}") for i in range(300)] + [(7, "the same row")] * 150
    docs = frame(rows).withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "lang", F.when(F.col("doc_id") == 5, "b").otherwise("a"))
    check(docs, 2)
    check(docs)


def test_one_row_and_none(frame, none):
    check(frame([(7, "alone")]))
    assert merkle.verify_documents(none).collect() == []


def test_tampered_leaves_fail(documents):
    rows = merkle.verify_documents(documents).collect()
    told = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0]
    assert told and {r["verified"] for r in told} == {False}
    assert {r["verified"] for r in rows if r not in told} == {True}


def test_claims(spark, documents):
    """Any leaf at any place may be claimed; only the right one comes to the root."""
    manifest = merkle.build_manifest(documents)
    rows = manifest.leaves.select("tree", "pos", "leaf", "row_no").collect()
    wrong = [(i, r["tree"], r["pos"], bytes(32)) for i, r in enumerate(rows[:5])]
    right = [(i + 5, r["tree"], r["pos"], r["leaf"]) for i, r in enumerate(rows[:5])]
    claims = spark.createDataFrame(wrong + right, "row_no long, tree long, pos long, claimed binary")
    got = {r["row_no"]: r["folded"] == manifest.root for r in merkle.climb(manifest, claims).collect()}
    assert got == {i: i >= 5 for i in range(10)}
