import datetime as dt

from pyspark.sql import functions as F

from cityscan.functions.clean import money_to_int, parse_ts, valid_coords, year_in


def test_parse_ts_tolerant(spark):
    rows = [("2020 Jan 05 01:30:00 PM",), ("2020 Jan 05 01:30:00 AM",), ("2021 Mar 01 12:00:00 AM",),
            ("2021 Mar 01 12:00:00 PM",), ("x",), ("",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [r.t for r in df.select(parse_ts("s").alias("t")).collect()]
    assert got[:4] == [dt.datetime(2020, 1, 5, 13, 30), dt.datetime(2020, 1, 5, 1, 30),
                       dt.datetime(2021, 3, 1, 0, 0), dt.datetime(2021, 3, 1, 12, 0)]
    assert got[4:] == [None, None, None]


def test_money_to_int(spark):
    df = spark.createDataFrame([("$52,806",), ("N/A",), ("",), (None,)], "m string")
    assert [r.v for r in df.select(money_to_int("m").alias("v")).collect()] == [52806, None, None, None]


def test_valid_coords(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, 2.0), (None, 2.0), (1.0, 0.0), (float("nan"), 1.0)],
                               "lon double, lat double")
    assert df.where(valid_coords("lon", "lat")).count() == 1
    assert df.where(valid_coords("lon", "lat", drop_zero=False)).count() == 3


def test_year_in_matches_isin_and_pushes_down(spark, tmp_path):
    from conftest import formatted_plan

    ts = [dt.datetime(y, m, 1) for y in (2019, 2020, 2021, 2022) for m in (1, 12)]
    spark.createDataFrame([(t,) for t in ts], "ts timestamp").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    a = sorted(r.ts for r in df.where(year_in("ts", [2020, 2021])).collect())
    b = sorted(r.ts for r in df.where(F.year("ts").isin(2020, 2021)).collect())
    assert a == b and len(a) == 4
    plan = formatted_plan(df.where(year_in("ts", [2020, 2021])))
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan


def test_year_in_parses_text_once(spark):
    df = spark.createDataFrame([("2020 Jan 05 01:30:00 PM",), ("2022 Jan 05 01:30:00 PM",), (None,)], "t string")
    out = df.where(year_in(parse_ts("t"), [2020, 2021]))
    assert out.count() == 1
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") == 1
