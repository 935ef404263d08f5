import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def frame(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture
def odd(frame):
    """Nulls, empty and long texts, repeated rows, and columns with clashing names."""
    long = " ".join(f"word{i % 997} and more of it." for i in range(20000))
    rows = [(1, "alpha beta gamma delta"), (1, "alpha beta gamma delta"), (None, "no id at all here"),
            (None, None), (2, ""), (3, None), (4, "   \n\t "), (5, long), (6, long + " end"),
            (7, "\U0001f600 ünïcode \x1c text\x85here"), (8, "alpha beta gamma delta"), (9, "x")]
    from pyspark.sql import functions as F
    clash = ("row_no", "digest", "fp", "key", "h", "size", "ids", "t", "n", "id", "score", "table", "kept",
             "source_no", "bucket", "next_id", "spans", "part")
    return frame(rows).withColumns({c: F.lit("clash") for c in clash})


@pytest.fixture
def none(frame):
    return frame([])
