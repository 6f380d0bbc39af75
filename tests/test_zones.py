import pytest
from pyspark.sql import functions as F

from cityscan.operators.zones import zone_counts, zone_income, zone_rollup


def _zones(spark):
    return spark.createDataFrame(
        [(1, "90001", 10, 2, "A"), (2, "9a", 5, 3, "A"), (3, None, 5, 3, "B"), (4, "90004", 0, 4, "C"),
         (5, "90005", 7, 1, "D")],
        "zone int, ZCTA20 string, POP20 bigint, HOUSING20 bigint, COMM string")


def _income(spark, extra=()):
    rows = [(90001, "$52,806"), (90004, "N/A"), (90005, "$1,000")] + list(extra)
    return spark.createDataFrame(rows, "zip int, income string")


def test_zone_income_tolerant_keys_and_money(spark):
    out = {r.zone: r.Income_per_block for r in
           zone_income(_zones(spark), _income(spark), "ZCTA20", "zip", "income", "HOUSING20").collect()}
    assert out == {1: 2 * 52806, 4: None, 5: 1000}  # '9a' and NULL zips drop, N/A income is NULL


def test_zone_income_rejects_repeated_zip(spark):
    out = zone_income(_zones(spark), _income(spark, [(90001, "$1")]), "ZCTA20", "zip", "income", "HOUSING20")
    with pytest.raises(Exception, match="repeated zip code 90001"):
        out.collect()
    # a repeat of a zip no zone uses is harmless, and zones are never duplicated
    ok = zone_income(_zones(spark), _income(spark, [(99999, "$1"), (99999, "$2")]), "ZCTA20", "zip", "income",
                     "HOUSING20")
    assert sorted(r.zone for r in ok.collect()) == [1, 4, 5]


def test_rollup_ratios_zero_population_and_counts(spark):
    blocks = zone_income(_zones(spark), _income(spark), "ZCTA20", "zip", "income", "HOUSING20")
    hits = spark.createDataFrame([(1,), (1,), (4,), (5,)], "zone int")
    per = zone_counts(hits, blocks, "zone", ["COMM", "POP20", "Income_per_block"])
    got = {r.zone: r.crime_count for r in per.collect()}
    assert got == {1: 2, 4: 1, 5: 1}
    roll = {r.COMM: r for r in zone_rollup(per, "COMM", "POP20", "crime_count", "Income_per_block").collect()}
    assert roll["C"].crimes_per_person is None and roll["C"].income_per_capita is None  # population 0
    assert roll["A"].crimes_per_person == 0.2 and roll["A"].income_per_capita == 2 * 52806 / 10
    assert roll["D"].total_income == 1000


def test_a_zone_listed_twice_counts_once(spark):
    import pytest

    from cityscan.operators.zones import unique_zones, zone_counts

    zones = spark.createDataFrame([(1, "A", 10), (1, "A", 10), (2, "B", 5), (None, "C", 1)], "zone int, COMM string, POP20 int")
    hits = spark.createDataFrame([(1,), (1,), (1,)], "zone int")
    one = unique_zones(zones, "zone")
    assert sorted(r.zone for r in one.collect()) == [1, 2]
    got = sorted(tuple(r) for r in zone_counts(hits, one, "zone", ["COMM", "POP20"], keep_empty_zones=True).collect())
    assert got == [(1, "A", 10, 3), (2, "B", 5, 0)]
    assert zone_counts(hits, one, "zone", ["COMM"]).count() == 1
    clash = zones.unionByName(spark.createDataFrame([(2, "B", 6)], "zone int, COMM string, POP20 int"))
    with pytest.raises(Exception, match="conflicting rows"):
        unique_zones(clash, "zone").collect()


def test_extremes_reads_its_input_once(spark):
    from conftest import plan_text

    from cityscan.operators.zones import extremes

    rows = [(i, float(v) if v is not None else None) for i, v in enumerate([5, 3, None, 9, 1, 7, None, 3, 2, 8])]
    df = spark.createDataFrame(rows, "k int, v double").repartition(3)
    got = extremes(df, "v", 3, ["k"])
    low = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))[:3]
    high = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))[:3]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(low + high, key=str)
    last = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))[:2]
    assert sorted(map(tuple, extremes(df, "v", 2, ["k"], nulls_first_low=False).collect())) == sorted(last + sorted(rows, key=lambda r: -(r[1] or 0))[:2])
    assert extremes(df, "v", 20).count() == 20 and extremes(df.limit(0), "v", 3).count() == 0
    plan = plan_text(got)
    assert plan.count("RoundRobin") <= 2 and "WindowGroupLimit" in plan  # the final and the initial plan name it once each
