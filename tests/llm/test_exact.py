import hashlib
from collections import Counter

import pytest

from hazardlake.llm import exact


def check(df):
    rows = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    size = Counter(t for _, t in rows)
    best = {}
    for i, t in rows:
        if t not in best or best[t] is None or (i is not None and i > best[t]):
            best[t] = i
    got = exact.exact_dedup(df).collect()
    expect = Counter((i, best[t], size[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == expect
    kept = [r for r in got if r["kept"]]
    assert Counter(r["text_sha256"] for r in kept) == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in size})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_whole_table(documents):
    check(documents)


def test_odd_rows(odd):
    check(odd)


def test_empty_table(none):
    assert exact.exact_dedup(none).collect() == []


def test_index_lasts(spark, frame, root):
    path = f"{root}/index"
    first = exact.DigestIndex.open(spark, path, 4)
    assert {r["doc_id"]: r["kept"] for r in exact.exact_dedup(frame([(1, "a"), (2, "b"), (3, "a")]), first).collect()} \
        == {1: False, 2: True, 3: True}
    again = exact.DigestIndex.open(spark, path, 4)
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact.exact_dedup(frame([(9, "a"), (8, "c")]), again).collect()}
    assert got == {9: (3, False), 8: (8, True)}
    assert exact.DigestIndex.open(spark, path, 4).table().count() == 3


def test_index_keeps_its_buckets(spark, frame, root):
    """Jobs with other settings find every digest again; another number of buckets is refused."""
    path = f"{root}/index"
    docs = frame([(i, f"text {i}") for i in range(200)])
    exact.exact_dedup(docs, exact.DigestIndex.open(spark, path, 4)).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        again = exact.DigestIndex.open(spark, path)
        assert again.buckets == 4
        assert not any(r["kept"] for r in exact.exact_dedup(docs, again).collect())
        assert again.table().count() == again.table().select("digest").distinct().count() == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    with pytest.raises(ValueError, match="4 buckets"):
        exact.DigestIndex.open(spark, path, 8)


def test_index_side_is_not_shuffled(spark, frame, root):
    from tests.helpers import plan_of
    index = exact.DigestIndex.open(spark, f"{root}/index", 4)
    exact.exact_dedup(frame([(1, "a")]), index).collect()
    groups = frame([(2, "b")]).selectExpr("unhex(sha2(text, 256)) digest", "doc_id keep_id")
    plan = plan_of(index.new_only(groups))
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange") <= 2 * plan.count("hashpartitioning")


def test_keep_one(odd):
    kept = exact.keep_one(odd)
    assert kept.columns == odd.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({r["text"] or "" for r in odd.collect()})
    assert {r["doc_id"] for r in kept.filter("text like 'alpha%'").collect()} == {8}
