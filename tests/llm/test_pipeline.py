"""The pipeline's stages in a row, each against what its operator says about its own input."""
from collections import Counter

import corpus_pipeline as P
from hazardlake.llm import exact, mixing, simhash, toxicity
from hazardlake.llm.common import table

SF = "/root/testdata/sf0.001"


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages(spark, documents):
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact dedup", "near dedup", "mixing", "packing"]
    labels = table(spark, SF, "labels")
    docs, kept = documents, []
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == documents.columns
        out = out.persist()
        kept.append((docs, out))
        docs = out
    (d0, d1), (_, d2), (_, d3), (_, d4), (_, d5) = kept
    verdict = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(d0, labels).collect()}
    assert ids(d1) == Counter(i for i, v in verdict.items() if not v)
    assert ids(d2) == Counter(r["doc_id"] for r in exact.exact_dedup(d1).collect() if r["kept"])
    assert ids(d3) == Counter(set(r["component_id"] for r in simhash.simhash_components(d2).collect()))
    taken = Counter({r["doc_id"]: r["taken"] for r in mixing.mix(d3).collect() if r["taken"]})
    words = Counter()
    for r in d4.collect():
        words[r["doc_id"]] += len(r["text"].encode().split())
    assert words == taken
    assert ids(d4).keys() == ids(d5).keys()
    assert sum(r["length"] for r in d5.collect()) == sum(
        n for _, n in {(r["row_no"], r["doc_tokens"]) for r in d5.collect()})


def test_run(spark):
    rows = P.run(spark, SF)
    assert rows.count() > 100 and {"doc_id", "sequence_id", "offset", "ids"} <= set(rows.columns)


def test_odd_rows(spark, odd):
    docs = odd
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() > 0


def test_empty_table(spark, none):
    for _, stage in P.STAGES:
        assert stage(spark, none, SF).count() == 0
