import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

from hazardlake.llm import mixing as M


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Rounds of sharing: those above their limit stop, the excess is shared by weight."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(order)}
    budget, full = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        left = budget - sum(2 * sizes[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        target = {s: Fraction(2 * sizes[s]) if s in full else left * weight[s] / share for s in order}
        over = {s for s in order if target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over


def brute_taken(rows, target):
    out = defaultdict(list)
    by_source = defaultdict(list)
    for doc_id, text, source in rows:
        digest = hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()
        by_source[source].append((int(digest[:10], 16), doc_id, words(text)))
    for source, docs in by_source.items():
        total = sum(n for _, _, n in docs)
        copies = min(2, int(target[source] // total)) if total else 0
        left = int(target[source] - copies * total)
        for h in sorted({d[0] for d in docs}):
            tied = [d for d in docs if d[0] == h]
            n = sum(d[2] for d in tied)
            for _, doc_id, size in tied:
                out[(doc_id, source, size)].append(copies * size + (size if n <= left else size * left // n))
            left = max(0, left - n)
    return {k: sorted(v) for k, v in out.items()}


def check(df):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in df.select("doc_id", "text", "source").collect()]
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += words(text)
    target = brute_targets(sizes)
    got = M.mix(df).collect()
    assert all(abs(r["target"] - target[r["source"]]) < 1e-6 * max(1, target[r["source"]])
               and r["source_size"] == sizes[r["source"]] and r["taken"] <= 2 * r["size"] for r in got)
    found = defaultdict(list)
    for r in got:
        found[(r["doc_id"], r["source"], r["size"])].append(r["taken"])
    assert {k: sorted(v) for k, v in found.items()} == brute_taken(rows, target)
    for source in sizes:
        taken = sum(r["taken"] for r in got if r["source"] == source)
        assert 0 <= target[source] - taken < 1 + sum(r["source"] == source for r in got)
    return {source: target[source] / sizes[source] for source in sizes if sizes[source]}


def test_whole_table(documents):
    check(documents)


def test_odd_rows(odd):
    check(odd)


def test_sources_of_all_sizes(frame):
    rng = random.Random(2)
    sources = ["a", "B", "é", "", None, "zz", "big", "\U0001f600"]
    rows = [(i, "w " * rng.randrange(1, 60), rng.choices(sources, [1, 5, 2, 9, 3, 1, 200, 1])[0]) for i in range(400)]
    rows += [(1000, "", "empty"), (1001, None, "empty")]
    ratios = check(frame(rows))
    assert max(ratios.values()) == 2 and min(ratios.values()) < 2


def test_repeated_ids_share(frame):
    check(frame([(1, "a b c d e", "x")] * 9 + [(2, "a b c", "y")] * 2))


def test_empty_table(none):
    assert M.mix(none).collect() == []
    assert M.repeat_taken(none).collect() == []


def test_reruns_agree(documents):
    assert sorted(M.mix(documents).collect()) == sorted(M.mix(documents.repartition(5)).collect())


def test_repeat_taken(documents, odd):
    for df in (documents, odd):
        expect = defaultdict(int)
        for r in M.mix(df).collect():
            expect[r["doc_id"]] += r["taken"]
        got = defaultdict(int)
        rows = M.repeat_taken(df)
        assert rows.columns == df.columns
        texts = defaultdict(set)
        for r in df.collect():
            texts[r["doc_id"]].add(r["text"] or "")
        for r in rows.collect():
            got[r["doc_id"]] += words(r["text"])
            assert any(t.startswith(r["text"]) for t in texts[r["doc_id"]])
        assert got == {k: v for k, v in expect.items() if v}


def test_native(documents):
    from tests.helpers import plan_of
    plan = plan_of(M.mix(documents))
    assert "Python" not in plan and "Arrow" not in plan
