import random
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from hazardlake.llm import simhash
from hazardlake.llm.components import component_roots


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """{row index: smallest id} by flooding over all pairs; ids may repeat or be None."""
    left, out = set(range(len(pairs))), {}
    while left:
        todo, group = [left.pop()], []
        while todo:
            i = todo.pop()
            group.append(i)
            near = [j for j in left if (pairs[i][1] ^ pairs[j][1]).bit_count() <= 2]
            left.difference_update(near)
            todo += near
        ids = [pairs[i][0] for i in group if pairs[i][0] is not None]
        out.update({i: min(ids, default=None) for i in group})
    return out


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    pairs = [(i, brute_fingerprint(t)) for i, t in rows]
    root = brute_components(pairs)
    expect = Counter((i, f"{fp:016x}", root[n]) for n, (i, fp) in enumerate(pairs))
    assert Counter(map(tuple, simhash.simhash_components(df).collect())) == expect


def test_whole_table(documents):
    check(documents)


def test_odd_rows(odd):
    check(odd)


def test_empty_table(none):
    assert simhash.simhash_components(none).collect() == []


def test_chunked_fingerprint(monkeypatch, documents):
    text = documents.filter("length(text) > 5000").first()["text"]
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text)


def test_links_are_complete(spark):
    """Planted neighbours, chains and a dense crowd, against all pairs."""
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for fp in list(fps[:100]):
        for _ in range(3):
            fp ^= 1 << rng.randrange(64)
            fp ^= 1 << rng.randrange(64) if rng.random() < .5 else 0
            fps.append(fp)
    crowd = rng.getrandbits(64)
    fps += [crowd ^ sum(1 << b for b in rng.sample(range(12), rng.randrange(5))) for _ in range(150)]
    fps = sorted(set(fps))
    signed = [simhash._signed(f) for f in fps]
    classes = spark.createDataFrame([(f, i) for i, f in enumerate(signed)], "fp long, first_id long")
    links = simhash._links(classes).collect()
    assert all(((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2 for a, b in links)
    roots = {r["node"]: r["root"] for r in component_roots(simhash._links(classes)).collect()}
    expect = brute_components(list(zip(signed, fps)))
    assert {f: roots.get(f, f) for f in signed} == {signed[i]: m for i, m in expect.items()}


def test_pivot_coordinates(spark):
    """A coordinate never differs by more than the fingerprints do; blocks are told apart."""
    rng = random.Random(3)
    a = [rng.getrandbits(64) for _ in range(50)]
    b = [x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for x in a]
    df = spark.createDataFrame([(simhash._signed(x), simhash._signed(y)) for x, y in zip(a, b)], "a long, b long")
    rows = df.select(simhash.pivot_table(F.col("a")).alias("x"), simhash.pivot_table(F.col("b")).alias("y")).collect()
    for (x, y), p, q in zip(rows, a, b):
        assert max(abs(u - v) for u, v in zip(x, y)) <= (p ^ q).bit_count()
    values = spark.range(1 << 13).select(F.col("id").alias("fp"), F.xxhash64(
        simhash._relative(simhash.pivot_table(F.col("id")), 0)).alias("k"))
    assert values.select("k").distinct().count() == 1 << 13


def test_keep_one(frame):
    a = "one two three four five six seven eight nine ten"
    kept = simhash.keep_one(frame([(5, a), (3, a), (9, "quite another text of words"), (4, None)]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 9]


def test_keep_one_of_rows_without_or_with_repeated_ids(frame):
    a, b = "one two three four five six", "another text of quite other words"
    kept = simhash.keep_one(frame([(None, a), (7, a), (7, a), (None, b), (None, b), (None, "")])).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == [(0, ""), (0, b), (7, a)]
