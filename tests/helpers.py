"""Small helpers shared by the tests."""

import math

from pyspark.sql import functions as F


def rows(df, *order):
    """Rows as tuples, sorted."""
    data = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(data, key=lambda r: tuple((v is not None, str(v)) for v in r))


def column(spark, values, dtype, expr):
    """Results of a column function over literal values, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]


def haversine(lat1, lon1, lat2, lon2):
    lat1, lon1, lat2, lon2 = map(math.radians, (lat1, lon1, lat2, lon2))
    h = (math.sin((lat2 - lat1) / 2) ** 2
         + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2)
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def plan_of(df):
    """The physical plan in full."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
