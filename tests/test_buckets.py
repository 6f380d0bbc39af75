from pyspark.sql import functions as F

from cityscan.functions.buckets import AGE_ELSE, bucketize
from cityscan.operators.buckets import bucket_count

AGES = [None, -1, 0, 17, 18, 24, 25, 64, 65]
EXPECTED = {
    None: AGE_ELSE, -1: "0-17 Children", 0: "0-17 Children", 17: "0-17 Children",
    18: "18-24 Young Adults", 24: "18-24 Young Adults", 25: "25-64 Adults",
    64: "25-64 Adults", 65: "65+ Elderly",
}


def _ages(spark):
    return spark.createDataFrame([(a,) for a in AGES], "age int")


def test_bucket_boundaries_native_and_udf(spark):
    df = _ages(spark)
    native = {r.age: r.g for r in df.select("age", bucketize("age").alias("g")).collect()}
    assert native == EXPECTED
    from cityscan.operators.buckets import bucket_udf

    udf = {r.age: r.g for r in df.select("age", bucket_udf()(F.col("age")).alias("g")).collect()}
    assert udf == EXPECTED


def test_null_label_option(spark):
    df = _ages(spark)
    got = {r.age: r.g for r in df.select("age", bucketize("age", null_label="unknown").alias("g")).collect()}
    assert got[None] == "unknown" and got[65] == "65+ Elderly"


def test_bucket_count_filter_is_case_sensitive_substring(spark):
    rows = [("AGGRAVATED ASSAULT", 30), ("aggravated assault", 30), ("X AGGRAVATED ASSAULT Y", 70),
            (None, 30), ("ASSAULT", 30)]
    df = spark.createDataFrame(rows, "desc string, age int")
    for engine in ("native", "udf"):
        out = {r["Age_Group"]: r["count"] for r in
               bucket_count(df, "age", text_col="desc", contains="AGGRAVATED ASSAULT", engine=engine).collect()}
        assert out == {"25-64 Adults": 1, "65+ Elderly": 1}


def test_bucket_count_orders_by_count_desc(spark):
    df = spark.createDataFrame([(a,) for a in [1, 2, 3, 20, 30, 31]], "age int")
    out = [(r[0], r[1]) for r in bucket_count(df, "age").collect()]
    assert [c for _, c in out] == sorted([c for _, c in out], reverse=True)
    assert sum(c for _, c in out) == 6
