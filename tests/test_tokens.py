import pytest

from conftest import plan_text
from cityscan.operators.tokens import token_counts, with_lookup
from cityscan.sources.csv import codes_from_lines


def _data(spark):
    df = spark.createDataFrame([("a  b ",), ("",), (None,), ("a",), ("c zz",)], "codes string")
    lookup = codes_from_lines(spark.createDataFrame([("a Alpha, first",), ("b Beta",), ("c",), ("q Unused",)],
                                                    "value string"))
    return df, lookup


def test_token_counts_drop_empty_tokens(spark):
    df, _ = _data(spark)
    got = {r.token: r["count"] for r in token_counts(df, "codes").collect()}
    assert got == {"a": 2, "b": 1, "c": 1, "zz": 1}


def test_code_line_without_description_is_null(spark):
    _, lookup = _data(spark)
    got = {r.Mocode: r.Description for r in lookup.collect()}
    assert got == {"a": "Alpha, first", "b": "Beta", "c": None, "q": "Unused"}


@pytest.mark.parametrize("strategy,op", [("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin"),
                                         ("broadcast", "BroadcastHashJoin"), ("auto", "BroadcastHashJoin")])
def test_join_strategies_agree_and_plan(spark, strategy, op):
    df, lookup = _data(spark)
    out = with_lookup(token_counts(df, "codes"), lookup, "token", "Mocode", "Description", strategy=strategy)
    rows = [tuple(r) for r in out.collect()]
    assert rows == [("a", "Alpha, first", 2), ("b", "Beta", 1), ("c", None, 1)]
    assert op in plan_text(out)


def test_nested_loop_strategy_is_refused(spark):
    df, lookup = _data(spark)
    with pytest.raises(ValueError):
        with_lookup(token_counts(df, "codes"), lookup, "token", "Mocode", "Description", strategy="nl")


def test_separator_is_literal_text(spark):
    df = spark.createDataFrame([("ab|cd|ab",), ("a.b",)], "t string")
    assert {r.token: r["count"] for r in token_counts(df, "t", sep="|").collect()} == {"ab": 2, "cd": 1, "a.b": 1}
    assert {r.token: r["count"] for r in token_counts(df, "t", sep=".").collect()} == {"ab|cd|ab": 1, "a": 1, "b": 1}


def test_broadcast_that_is_not_honoured_warns(spark):
    import warnings

    counts = token_counts(spark.createDataFrame([("a b",)], "t string"), "t")
    codes = spark.createDataFrame([("a", "first")], "c string, d string")
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        out = with_lookup(counts, codes, "token", "c", "d", strategy="broadcast", broadcast_max_bytes=1)
    assert any("exceeds broadcast_max_bytes" in str(w.message) for w in said)
    assert [tuple(r) for r in out.collect()] == [("a", "first", 1)]


def test_bucketed_tables_join_without_a_shuffle(spark):
    import __spark_entry__ as E
    from conftest import SF0001, plan_text

    df = E.queries()["token_join_bucketed"](spark, SF0001)
    want = E.queries()["token_join_merge"](spark, SF0001).collect()
    assert df.collect() == want
    plan = plan_text(df)
    below = plan[plan.index("SortMergeJoin"):]
    below = below[: below.index("== Initial Plan ==")] if "== Initial Plan ==" in below else below
    assert "Exchange" not in below
