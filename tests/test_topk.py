from cityscan.operators.topk import topk_share
from cityscan.plans.sql import topk_share_sql


def _events(spark):
    rows = ([(2020, "A")] * 5 + [(2020, "B")] * 3 + [(2020, "C")] * 3 + [(2020, None)] * 4 + [(2020, "D")]
            + [(2021, "A")] * 2 + [(2021, "X")] * 2)
    return spark.createDataFrame(rows, "Year int, Vict_Descent string")


def _lookup(spark):
    return spark.createDataFrame([("A", "Alpha"), ("B", "Beta"), ("C", "Gamma"), ("D", "Delta")],
                                 "Vict_Descent string, Vict_Descent_Full string")


def test_rank_before_lookup_and_deterministic_ties(spark):
    out = topk_share(_events(spark), "Year", "Vict_Descent", 3, _lookup(spark), "Vict_Descent",
                     "Vict_Descent_Full", out_label="Vict_Descent_Full").collect()
    got = [(r.Year, r.Vict_Descent_Full, r["count"], r.percent, r["rank"]) for r in out]
    # 2020: A=5, NULL=4, then B/C tie at 3 -> B (smaller key) is rank 3; NULL is unmapped and vanishes
    # 2021: A and X tie at 2 -> A first; X unmapped -> one row only
    assert got == [(2021, "Alpha", 2, "50.00", 1), (2020, "Alpha", 5, "31.25", 1), (2020, "Beta", 3, "18.75", 3)]


def test_dataframe_equals_sql(spark):
    df = topk_share(_events(spark), "Year", "Vict_Descent", 3, _lookup(spark), "Vict_Descent",
                    "Vict_Descent_Full", out_label="Vict_Descent_Full", out_count="Number_of_Victims")
    sq = topk_share_sql(spark, _events(spark), _lookup(spark), 3)
    cols = ["Year", "Vict_Descent_Full", "Number_of_Victims", "percent", "rank"]
    assert [tuple(r) for r in df.select(cols).collect()] == [tuple(r) for r in sq.select(cols).collect()]


def test_share_text_has_thousands_separator(spark):
    rows = [(2020, "A")] * 3
    df = spark.createDataFrame(rows, "Year int, Vict_Descent string")
    out = topk_share(df, "Year", "Vict_Descent", 1).first()
    assert out.percent == "100.00" and out.share_pct == 100.0


def test_rank_is_cut_before_the_shuffle(spark):
    for df in (topk_share(_events(spark), "Year", "Vict_Descent", 3),
               topk_share_sql(spark, _events(spark), _lookup(spark), 3)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "Partial" in plan
