"""Packing and Simple-8b: round trips, and ids against the tokenizer called on whole texts."""
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hazardlake.llm import packing, simple8b
from hazardlake.llm.tokens import PieceEncoder

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["", " ", "  a", "a  b", "a \n b", "a\n b c", " lead", "trail ", "don't I'll 's x's", "a  b", "\x1c! x",
          "!\x1c x y", "<|endoftext|> and <|endoftext|>x", "é ́a", "ΑΣ Σ ΣΑΣ", "İstanbul", "1 23 456",
          "a\t\tb \r\n c", "\U0001f600 \U0001f600", "x" * 5000, "tab\t x", "a  b c"]


def whole(path, texts):
    t = Tokenizer.from_file(path)
    return [e.ids + [2] for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path,spaces", [(WORD, False), (BYTE, True)])
def test_pieces_equal_whole_texts(documents, path, spaces):
    texts = TRICKY + [r["text"] for r in documents.collect()]
    rng = random.Random(1)
    alphabet = " \n\t ab'sS.!9é \x1c"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(500)]
    code = PieceEncoder(path, spaces)
    for _ in range(2):  # the second time from memory
        assert [i.tolist() + [2] for i in code.encode(texts)] == whole(path, texts)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_packing(df):
    rows = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    ids = defaultdict(list)
    for (i, t), tokens in zip(rows, whole(WORD, [t for _, t in rows])):
        ids[i].append(tokens)
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in packing.pack(df, WORD).collect():
        docs[p["row_no"]].append(p)
        sequences[p["sequence_id"]].append(p)
        got = np.frombuffer(p["ids"], "<u4")
        assert len(got) == p["length"] > 0 and crc(got) == p["ids_crc32"]
    found = defaultdict(list)
    for pieces in docs.values():
        pieces.sort(key=lambda p: p["start"])
        joined = [x for p in pieces for x in np.frombuffer(p["ids"], "<u4").tolist()]
        assert [p["start"] for p in pieces] == np.cumsum([0] + [p["length"] for p in pieces])[:-1].tolist()
        assert {p["doc_tokens"] for p in pieces} == {len(joined)}
        found[pieces[0]["doc_id"]].append(joined)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in ids.items()}
    for pieces in sequences.values():
        pieces.sort(key=lambda p: p["offset"])
        ends = np.cumsum([p["length"] for p in pieces]).tolist()
        assert [p["offset"] for p in pieces] == [0] + ends[:-1]
        assert ends[-1] <= 4096 and ends[-1].bit_count() == 1


def test_packing_whole_table(documents):
    check_packing(documents)


def test_packing_odd_rows(odd):
    check_packing(odd)


def test_packing_empty_table(none):
    assert packing.pack(none, WORD).collect() == []


def test_scores_are_bm25():
    rng = np.random.default_rng(0)
    ids = [rng.integers(0, 50, rng.integers(1, 40)).astype(np.uint32) for _ in range(30)]
    idf, mean = rng.random(50), 17.0
    shard = packing.Bm25Shard(ids, idf, mean)
    for query in ids[:5]:
        expect = []
        for doc in ids:
            total = 0.0
            for term in set(query.tolist()):
                tf = (doc == term).sum()
                total += idf[term] * tf * 2.2 / (tf + 1.2 * (.25 + .75 * len(doc) / mean))
            expect.append(total)
        assert np.allclose(shard.scores(query), expect)


def test_seeds_score_by_all_ids(monkeypatch):
    """Dense ids and postings together give the scores of the definition; the first of equal seeds wins."""
    rng = np.random.default_rng(1)
    ids = [(rng.integers(0, 40, 100) ** 2).astype(np.uint16) for _ in range(60)]
    idf, seeds = rng.random(2000), [np.unique(i) for i in [*ids[:20], ids[0], ids[0][:1]]]
    shard = packing.Bm25Shard(ids, idf, 90.0)
    expect = np.array([shard.scores(s) / len(s) ** .5 for s in seeds]).T
    for dense, cells in ((1, 1), (2, 200), (16, 1 << 20)):
        monkeypatch.setattr(packing, "DENSE", dense)
        monkeypatch.setattr(packing, "CELLS", cells)
        table = packing.Seeds(seeds)
        assert np.allclose(table.scores(*packing._bm25(ids, idf, 90.0), len(ids)), expect, rtol=1e-5)
        seed, best = table.nearest(ids, idf, 90.0)
        assert np.allclose(best, expect.max(1), rtol=1e-5) and np.allclose(expect[range(60), seed], best, rtol=1e-5)
        assert (seed != 20).all()


def test_neighbours_share_windows(frame):
    """Texts of two vocabularies, mixed: windows hold one kind, but for one in which the kinds meet."""
    rng = np.random.default_rng(1)
    words = ["red blue green black white".split(), "one two three four five".split()]
    kind = dict(zip(range(0, 1000, 10), rng.permutation([0, 1] * 50).tolist()))
    assert {kind[n] for n in range(0, 1000, 100)} == {0, 1}
    df = frame([(n, " ".join(rng.choice(words[k], 400))) for n, k in kind.items()])
    kinds = defaultdict(set)
    for p in packing.pack(df, WORD, window=1024).collect():
        kinds[p["sequence_id"]].add(kind[p["doc_id"]])
    assert len(kinds) > 30 and sum(len(k) > 1 for k in kinds.values()) <= 1


def brute_bm25(ids, queries):
    """Scores of all documents for each query, from the definition."""
    n, mean = len(ids), np.mean([len(i) for i in ids])
    df = np.zeros(1 << 16)
    for i in ids:
        df[np.unique(i)] += 1
    out = []
    for q in queries:
        mask = np.zeros(1 << 16, bool)
        mask[q] = True
        scores = []
        for doc in ids:
            terms, tf = np.unique(doc, return_counts=True)
            hit = mask[terms]
            idf = np.log1p((n - df[terms[hit]] + .5) / (df[terms[hit]] + .5))
            scores.append(float((idf * tf[hit] * 2.2 / (tf[hit] + 1.2 * (.25 + .75 * len(doc) / mean))).sum()))
        out.append(np.array(scores))
    return out


def check_neighbours(df, every, monkeypatch, tokens):
    monkeypatch.setattr(packing, "SEARCH_TOKENS", tokens)
    monkeypatch.setattr(packing, "BLOCK_QUERIES", 3)
    rows = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    ids = [np.array(i) for i in whole(WORD, [t for _, t in rows])]
    asked = [n for n, (i, _) in enumerate(rows) if i is not None and i % every == 0]
    expect = defaultdict(list)
    for n, scores in zip(asked, brute_bm25(ids, [ids[n] for n in asked])):
        expect[rows[n][0]].append(sorted(np.round(np.delete(scores, n), 8))[::-1][:10])
    got = defaultdict(lambda: defaultdict(list))
    for r in packing.bm25_neighbours(df, WORD, 10, every).collect():
        got[r["query_id"]][r["query_row"]].append((r["rank"], r["score"]))
    found = {q: [[round(s, 8) for _, s in sorted(hits)] for hits in each.values()] for q, each in got.items()}
    assert {q: sorted(v) for q, v in found.items()} == {q: sorted(list(map(float, x)) for x in v) for q, v in expect.items()}


def test_search_of_all_shards(documents, monkeypatch):
    check_neighbours(documents, 40, monkeypatch, 20_000)


def test_search_of_odd_rows(odd, none, monkeypatch):
    check_neighbours(odd, 1, monkeypatch, 1 << 20)
    assert packing.bm25_neighbours(none, WORD).collect() == []


@pytest.mark.parametrize("sf, every, at_once", [("sf0.001", 10, 3), ("sf0.001", 40, 8192), ("sf0.01", 100, 8192)])
def test_texts_follow_their_best_seed(spark, monkeypatch, sf, every, at_once):
    """In the packed order each text stands behind the seed that scores it highest of all seeds, and those of one seed
    by descending score, whatever number of seeds is sent at once."""
    monkeypatch.setattr(packing, "SEED_EVERY", every)
    monkeypatch.setattr(packing, "SEEDS_AT_ONCE", at_once)
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    ids = [np.array(i) for i in whole(WORD, [t for _, t in rows])]
    at = {i: n for n, (i, _) in enumerate(rows)}
    asked = [i for i, _ in rows if i % every == 0]
    scores = {i: x / len(np.unique(ids[at[i]])) ** .5 for i, x in zip(asked, brute_bm25(ids, [ids[at[i]] for i in asked]))}
    best = np.max(list(scores.values()), axis=0)
    order = [p["doc_id"] for p in sorted((p for p in packing.pack(docs, WORD).collect() if p["start"] == 0),
                                         key=lambda p: (p["sequence_id"], p["offset"]))]
    assert sorted(order) == sorted(at) and order[0] in scores
    for doc_id in order:
        if doc_id in scores:
            seed, last = doc_id, np.inf
            continue
        score = scores[seed][at[doc_id]]
        assert score >= best[at[doc_id]] - 1e-3 and score <= last + 2e-3
        last = score


def test_no_row_is_a_seed(frame):
    """Ids that 100 does not divide, and null ids: the first row is the seed."""
    check_packing(frame([(1, "alpha beta"), (None, "beta gamma"), (3, None), (7, "alpha " * 9000)]))


def test_cuts():
    for total in (1, 7, 16, 20, 23, 32):
        places = [(q, o + k) for first, size in ((0, total // 3), (total // 3, total - total // 3))
                  for _, n, q, o in packing.cut(first, size, total, 8) for k in range(n)]
        rooms = [8] * (total // 8) + [b for b in (4, 2, 1) if total % 8 & b]
        assert places == [(q, o) for q, room in enumerate(rooms) for o in range(room)]


def test_lexical_order():
    # Two languages, each with two most frequent words: those of one language follow each other.
    idf = np.ones(100)
    sample = [(c, np.array([c, 50 * (c % 2) + 10 + i % 7, 50 * (c % 2) + 20])) for i in range(40) for c in (1, 2, 3, 4)]
    order, links = packing.lexical_order(sample, idf)
    assert [c % 2 for c in order] in ([1, 1, 0, 0], [0, 0, 1, 1]) and links[1] < min(links[0], links[2])


def test_document_frequencies(documents):
    tokens = packing.token_ids(documents, WORD)
    got = {r["id"]: r["df"] for r in packing.document_frequencies(tokens).collect()}
    expect = defaultdict(int)
    for ids in whole(WORD, [r["text"] for r in documents.collect()]):
        for i in set(ids):
            expect[i] += 1
    assert got == expect


@pytest.mark.parametrize("seed", range(6))
def test_coding_round_trip(seed):
    rng = np.random.default_rng(seed)
    top = [1, 60, 3, 20, 64, 16][seed]
    ids = np.concatenate([rng.integers(0, 1 << int(rng.integers(1, top + 1)) if top < 64 else 1 << 63, 50, dtype=np.uint64)
                          for _ in range(900)])
    if top == 64:
        ids[::7] |= np.uint64(1 << 63)
        ids[3::11] = 5
    data = simple8b.encode_shard(ids)
    assert (simple8b.decode_shard(data) == ids).all()
    for a, b in ((0, 1), (16383, 16385), (20000, 40000), (len(ids) - 1, len(ids)), (5, 5)):
        assert (simple8b.decode_shard(data, a, b) == ids[a:b]).all()
    assert len(simple8b.decode_shard(simple8b.encode_shard(ids[:0]))) == 0
    if top == 1:
        assert len(data) < len(ids) / 7 + 200


def test_greedy_words():
    assert len(simple8b.encode_block(np.zeros(60, np.uint64))) == 1
    assert len(simple8b.encode_block(np.full(61, 40000, np.uint64))) == 21
    assert len(simple8b.encode_block(np.array([1 << 60], np.uint64))) == 2


def check_simple8b(spark, df, root):
    rows = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    expect, start = [], 0
    for (i, _), ids in zip(rows, whole(BYTE, [t for _, t in rows])):
        expect.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    simple8b.write_shards(df, f"{root}/shards", BYTE)
    got = [tuple(r) for r in simple8b.read_documents(spark, f"{root}/shards").collect()]
    assert sorted(got, key=lambda r: r[1]) == expect


def test_simple8b_whole_table(spark, documents, root, monkeypatch):
    monkeypatch.setattr(simple8b, "SHARD_IDS", 20000)
    check_simple8b(spark, documents, root)


def test_simple8b_odd_rows(spark, odd, root):
    check_simple8b(spark, odd, root)


def test_simple8b_empty_table(spark, none, root):
    simple8b.write_shards(none, f"{root}/shards", BYTE)
    assert simple8b.read_documents(spark, f"{root}/shards").collect() == []


@pytest.mark.parametrize("path,spaces", [(WORD, False), (BYTE, True)])
def test_added_tokens_in_texts(documents, path, spaces):
    """Ids of texts that hold added tokens, against the tokenizer as it comes."""
    end, start = "<|endoftext|>", "<|startoftext|>"
    texts = [f"end {end} next", end, end + end, f"a{end}b", f"{end}  x \n", f"x  {end}", f"{start}{end} y", f"É{end}́ x",
             f" {end}\n\n{end}.", "<|ENDOFTEXT|> x", "<|endoftext |>", f"<|{end}|>", f"ΑΣ{end}Σ it's"]
    texts += TRICKY + [r["text"] for r in documents.collect()]
    rng = random.Random(2)
    parts = [end, start, " ", "\n", "a", "b c", "'s", ".", "9", "é", "Σ", "\x01", "<|", "|>"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]
    untouched = Tokenizer.from_file(path)
    expect = [e.ids for e in untouched.encode_batch(texts, add_special_tokens=False)]
    code = PieceEncoder(path, spaces)
    for _ in range(2):  # the second time from memory
        assert [i.tolist() for i in code.encode(texts)] == expect


def test_lines_cut_at_once(documents, monkeypatch):
    """Texts are cut by lines in one go, also among texts that are not, and each different piece is looked up once."""
    texts = [r["text"] for r in documents.limit(200).collect()]
    odd = ["", "\n", "a\n\nb. c,\n", "Straße, ÉTÉ. ça\nx", "é x. y", "<|endoftext|> a", "Σ ΑΣ. x", "ΟΔΟΣ", "a.b, c", "ÿ ÷ ×", "don't",
           "the end.\x00 x", "İ x. y", "'s Is'", "word 12 3a b4, c"]
    code = PieceEncoder(WORD, False)
    looked = []
    places = code._places
    monkeypatch.setattr(code, "_places", lambda pieces: looked.append(pieces) or places(pieces))
    mixed = odd + texts + odd
    for _ in range(2):
        assert [i.tolist() + [2] for i in code.encode(mixed)] == whole(WORD, mixed)
    by_lines = max(looked, key=len)
    assert len(by_lines) == len(set(by_lines))
    assert code.encode([]) == []


def test_lexical_order_of_all_documents(frame, monkeypatch):
    """Every common id has its place, however many there are, and every document counts."""
    many = [(c, np.array([c, 600 + c % 3, 700 + c])) for c in range(400)]
    order, _ = packing.lexical_order(many, np.ones(2000))
    assert sorted(order) == list(range(400)) and order[0] == 0
    monkeypatch.setattr(packing, "COUNTED_IDS", 50)
    words = "red blue green black white one two three four five".split()
    df = frame([(i, " ".join([words[i % 9]] * 3 + [words[9 - i % 4], words[i % 7]])) for i in range(90)])
    tokens = packing.token_ids(df, WORD)
    rows = [(r["common"], np.frombuffer(r["ids"], packing.STORED)) for r in tokens.collect()]
    idf, mean, order = packing._learned(tokens)
    expect, mean_length, _, _ = packing._statistics(tokens)
    assert np.array_equal(idf[:len(expect)], expect) and mean == mean_length
    assert order == packing.lexical_order(rows, idf)[0] and set(order) == {c for c, _ in rows}
    got = {(r["common"], i): n for r in packing.vocabularies(tokens).collect()
           for i, n in zip(np.frombuffer(r["ids"], packing.STORED).tolist(), np.frombuffer(r["docs"], "<i8").tolist())}
    counts = defaultdict(int)
    for c, ids in rows:
        for i in set(ids.tolist()):
            counts[c, i] += 1
    assert got == counts


def test_postings_added_in_lots(monkeypatch):
    rng = np.random.default_rng(3)
    ids = [(rng.integers(0, 40, 100) ** 2).astype(np.uint16) for _ in range(60)]
    idf, table = rng.random(2000), packing.Seeds([np.unique(i) for i in ids[:20]])
    whole_lot = table.scores(*packing._bm25(ids, idf, 90.0), len(ids))
    monkeypatch.setattr(packing, "DENSE", 1)
    for lot in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(packing, "POSTINGS", lot)
        sparse = packing.Seeds([np.unique(i) for i in ids[:20]])
        assert np.allclose(sparse.scores(*packing._bm25(ids, idf, 90.0), len(ids)), whole_lot, rtol=1e-5)
