from cityscan.functions.stats import safe_corr
from cityscan.operators.zones import correlation, extremes


def test_corr_null_modes(spark):
    rows = [(1.0, 2.0), (2.0, 4.1), (3.0, None), (None, 1.0), (4.0, 7.9)]
    df = spark.createDataFrame(rows, "x double, y double")
    skip = df.agg(safe_corr("x", "y", "skip").alias("c")).first().c
    ref = df.agg({"x": "count"}).first()  # noqa: F841
    import numpy as np

    xs, ys = np.array([1.0, 2.0, 4.0]), np.array([2.0, 4.1, 7.9])
    assert abs(skip - np.corrcoef(xs, ys)[0, 1]) < 1e-12
    zero = df.agg(safe_corr("x", "y", "zero").alias("c")).first().c
    xz = np.array([1.0, 2.0, 3.0, 0.0, 4.0]); yz = np.array([2.0, 4.1, 0.0, 1.0, 7.9])
    assert abs(zero - np.corrcoef(xz, yz)[0, 1]) < 1e-12
    assert abs(zero - df.stat.corr("x", "y")) < 1e-12 or df.stat.corr("x", "y") != df.stat.corr("x", "y")


def test_corr_constant_and_single_row_give_null(spark):
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert correlation(const, "x", "y").first()[0] is None
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert correlation(one, "x", "y").first()[0] is None


def test_extremes_nulls_fill_low_end_and_union_all(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 1.0), (4, 9.0)], "k int, v double")
    low_high = [r.k for r in extremes(df, "v", 2, tie_cols=["k"]).collect()]
    assert sorted(low_high[:2]) == [1, 3] and sorted(low_high[2:]) == [2, 4]
    # fewer groups than 2k: rows repeat (UNION ALL)
    assert extremes(df, "v", 3, tie_cols=["k"]).count() == 6
    skip_nulls = [r.k for r in extremes(df, "v", 1, tie_cols=["k"], nulls_first_low=False).collect()]
    assert skip_nulls == [3, 4]
