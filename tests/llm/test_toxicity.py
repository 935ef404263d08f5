import zlib

from pyspark.sql import functions as F

from hazardlake.llm import toxicity as X


def test_whole_table(spark):
    sf = "/root/testdata/sf0.1"  # smaller tables hold too few labelled rows to learn from
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in X.score_toxicity(docs, labels).collect()}
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    tested = [i for i in truth if rows[i]["held_out"]]
    assert all(rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= .5) for r in rows.values())
    right = sum(rows[i]["predicted"] == truth[i] for i in tested) / len(tested)
    pos = [rows[i]["score"] for i in tested if truth[i]]
    neg = [rows[i]["score"] for i in tested if not truth[i]]
    auc = sum((p > n) + .5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert right > .98 and auc > .94  # some of its labels follow no wording


def test_odd_rows(odd, spark):
    labels = spark.createDataFrame([(None, 1), (1, None), (1, 1), (2, 0), (2, 0), (5, 7)], "doc_id bigint, toxic int")
    assert X.score_toxicity(odd, labels).count() == odd.count()


def test_empty_tables(none, odd, spark):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert X.score_toxicity(none, labels).collect() == []
    assert {r["score"] < .01 for r in X.score_toxicity(odd, labels).collect()} == {True}


def test_folding():
    assert X.fold("You 1D10T!") == " you idiot "
    assert X.fold("ѕtuріd m0r0n") == " stupid moron "
    assert X.fold("привет мир") == " привет мир "
    assert X.fold("room 101, 3 cats!! (wow!)") == " room cats wow "
    assert X.fold("ｆｕｌｌ wıdth") == " full wıdth "
    assert X.fold("") == "  "


def test_scores():
    lexicon = X.Lexicon({" idiot ": 3.0, " trash ": 2.0, " tra": 0.5})
    clean = lexicon.score("a walk in the park")
    assert lexicon.score("") == clean
    assert lexicon.score("the trash can is full") == clean
    assert lexicon.score("you are trash") > clean
    assert lexicon.score("such an 1diot") > lexicon.score("you are trash")
    assert lexicon.score("idiot " + "word " * 5000) < lexicon.score("idiot " + "word " * 5)
    assert lexicon.features("traffic") == X.Lexicon({" traffic ": 0.5}).features("traffic")
    assert lexicon.features("trash idiots")[0] < lexicon.features("trash idiot")[0]


def test_labels_are_not_inputs(spark, frame):
    """Held-out labels change nothing; nor does a row's own source."""
    texts = [(i, ("vile " if i % 4 == 0 else "nice ") + f"word{i % 7} text") for i in range(400)]
    docs = frame(texts)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in texts], "doc_id bigint, toxic int")
    out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    flipped = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = X.score_toxicity(docs, labels).collect()
    assert sorted(a) == sorted(X.score_toxicity(docs.withColumn("source", F.lit("q")), flipped).collect())
    assert all(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in a)


def test_training_rows_are_bounded(spark, frame):
    docs = frame([(i, "x") for i in range(300)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id bigint, toxic int")
    assert X.training_rows(docs, labels, 50).count() == 50


def test_matching_equals_a_plain_search(spark):
    """Weights of the hits, by trying every entry and phrase at every place."""
    import math
    import random
    rng = random.Random(7)
    lexicon = X.Lexicon({" ab ": 2.0, " ab": .5, " abc": 1.5, " c ": 1.0, " ba ": .25, " b c ": 3.0},
                        ("c ab", "abcd ab", "ab b", "b c", "no such"))
    texts = ["", "ab", "c ab ab", "abcd ab abcd"] + [" ".join(
        "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(40))) for _ in range(400)]
    for text in texts:
        folded = X.fold(text)
        excused = [(i, i + len(X.fold(p)) - 1) for p in lexicon.exceptions for i in range(len(folded)) if folded.startswith(X.fold(p), i)]
        total = 0.0
        for i in range(len(folded)):
            hits = [w for e, w in lexicon.weights.items() if folded.startswith(e, i)]
            if hits and not any(a <= i < b for a, b in excused):
                total += max(hits)
        a, b = lexicon.features(text)
        assert math.isclose(a, math.log1p(total), abs_tol=1e-12)
        assert math.isclose(b, math.log1p(100 * total / (folded.count(" ") or 1)), abs_tol=1e-12)
        assert len(list(X._outside(list(range(30)), sorted(excused)))) == sum(not any(a <= i < b for a, b in excused) for i in range(30))


def test_harmless_phrases_are_learned(spark, frame):
    """A toxic word that, beside one other word, is found in clean rows only."""
    texts = [(i, f"vile word{i % 7} text" if i % 2 == 0 else f"vile cheese word{i % 5}" if i % 4 == 1 else f"nice word{i % 7} text")
             for i in range(800)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i, _ in texts], "doc_id bigint, toxic int")
    lexicon = X.learn(frame(texts), labels)
    assert " vile " in lexicon.weights and "vile cheese" in lexicon.exceptions
    assert lexicon.features("some vile cheese here")[0] == 0 < lexicon.features("some vile man here")[0]
    assert lexicon.phrases("a vile man, vile") == {"a vile", "vile man", "man vile"}
