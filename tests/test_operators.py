import pytest
from pyspark.sql import functions as F

from countypanel.operators import filters, joins, reshape
from tests.helpers import frame, plan, values

KEYS = ["k", "y"]


def test_fan_out_left_join_equals_left_join(spark):
    left = frame(spark, "k string, y long, a double", ("a", 1, 1.0), ("a", 1, 2.0), ("b", 1, 3.0), ("c", 2, 4.0))
    right = frame(spark, "k string, y long, b double", ("a", 1, 10.0), ("a", 1, 10.0), ("a", 1, None), ("b", 1, 20.0), ("z", 9, 1.0))
    got = joins.fan_out_left_join(left, right, KEYS)
    want = left.join(right, KEYS, "left")
    assert got.columns == want.columns
    assert values(got, "k", "y", "a", "b") == values(want, "k", "y", "a", "b")
    assert got.count() == 2 * 3 + 1 + 1


def test_hot_keys_of_the_right_side_are_spread_over_one_join(spark):
    left = spark.range(1000).selectExpr("cast(id as string) as k", "id as y", "id * 1.0D as a")
    right = spark.range(90000).selectExpr("if(id % 3 = 0, '7', cast(id % 900 as string)) as k", "if(id % 2 = 0, 0, id) as b")
    right = right.withColumn("y", F.col("k").cast("long"))
    want = left.join(right, KEYS, "left")
    df = joins.fan_out_left_join(left, right, KEYS, rows_per_task=500)
    assert df.columns == want.columns and df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty()
    assert "Union" not in plan(df) and "_salt" in plan(df)
    plain = joins.fan_out_left_join(left, right, KEYS, rows_per_task=100_000)
    assert plain.count() == want.count() and "_salt" not in plan(plain)


def test_fan_out_left_join_keeps_null_keys(spark):
    left = frame(spark, "k string, y long", (None, 1), ("a", None))
    right = frame(spark, "k string, y long, b double", (None, 1, 5.0), ("a", None, 6.0), ("a", None, 7.0))
    assert values(joins.fan_out_left_join(left, right, KEYS), "k", "b") == values(left.join(right, KEYS, "left"), "k", "b")


def _interval_frames(spark):
    points = frame(spark, "v long", (-3,), (0,), (4,), (5,), (9,), (10,), (100,), (None,))
    spans = frame(
        spark, "name string, lo long, hi long",
        ("neg", -5, -1), ("low", 0, 4), ("mid", 5, 9), ("wide", 2, 60), ("one", 100, 100), ("bad", 8, 7), ("open", None, 3),
    )
    return points, spans


def test_range_lookup_has_one_form(spark):
    points, spans = _interval_frames(spark)
    got = joins.range_lookup(points, F.col("v"), spans, "lo", "hi")
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    assert values(got, "v", "name") == [
        (-3, "neg"), (0, "low"), (10, "wide"), (100, "one"), (4, "low"), (4, "wide"), (5, "mid"), (5, "wide"), (9, "mid"), (9, "wide"), (None, None),
    ]
    assert values(joins.range_lookup(points, F.col("v"), spans.limit(0), "lo", "hi"), "name") == [(None,)] * 8


def test_range_lookup_of_dates_and_times(spark):
    days = spark.sql("SELECT * FROM VALUES (DATE'2020-01-01'), (DATE'2020-02-29'), (DATE'1969-12-31') AS t(d)")
    spans = spark.sql("SELECT 'leap' AS name, TIMESTAMP'2020-02-01' AS lo, TIMESTAMP'2020-02-29' AS hi UNION ALL SELECT 'all', TIMESTAMP'0002-01-01', TIMESTAMP'9999-12-31'")
    got = joins.range_lookup(days, F.col("d"), spans, "lo", "hi")
    assert sorted((str(r["d"]), r["name"]) for r in got.collect()) == [
        ("1969-12-31", "all"), ("2020-01-01", "all"), ("2020-02-29", "all"), ("2020-02-29", "leap")]
    with pytest.raises(TypeError, match="bucketed"):
        joins.range_lookup(days, F.col("d").cast("string"), spans, "lo", "hi")


def test_lookup_and_semi_join(spark):
    df = frame(spark, "k string, a long", ("a", 1), ("b", 2), (None, 3))
    table = frame(spark, "k string, b long", ("a", 7))
    assert values(joins.lookup(df, table, "k"), "a", "b") == [(1, 7), (2, None), (3, None)]
    assert values(joins.present_in(df, table, "k"), "a") == [(1,)]


def test_latest_per_key_forms_agree(spark):
    df = frame(
        spark, "k string, y long, a string, b long",
        ("x", 1, "p", 1), ("x", 2, "q", None), ("x", 2, "q", 5), ("w", None, "z", 1), ("w", 0, None, 2), (None, 1, "n", 1), (None, 1, "o", 0),
    )
    got = reshape.latest_per_key(df, ["k"], ["y"])
    assert got.columns == df.columns
    expected = values(got, *df.columns)
    assert expected == values(reshape.latest_per_key_window(df, ["k"], ["y"]), *df.columns)
    assert set(expected) == {("x", 2, "q", 5), ("w", 0, None, 2), (None, 1, "o", 0)}


def test_pivot_takes_first_present_value_and_keeps_all_columns(spark):
    df = frame(
        spark, "k string, code string, v double, s string",
        ("a", "03", None, "s1"), ("a", "03", 5.0, "s2"), ("a", "03", 4.0, "s3"), ("a", "99", 1.0, "s4"), ("b", "04", 2.0, "s5"),
    )
    got = reshape.pivot_measures(df, ["k"], "code", "v", {"03": "rate", "04": "level", "06": "force"}, "s")
    assert values(got, "k", "rate", "level", "force") == [("a", 5.0, None, None), ("b", None, 2.0, None)]


def test_aliases_depend_on_columns_not_values(spark):
    df = frame(spark, "B string, A string", ("x", None))
    got = reshape.resolve_aliases(df, {"t": ["A", "B"], "u": ["B"], "v": ["C"]}, {"v": "double"})
    assert got.dtypes == [("t", "string"), ("u", "string"), ("v", "double")]
    assert values(got, "t", "u", "v") == [(None, "x", None)]


def test_union_fills_missing_columns(spark):
    a, b = frame(spark, "k string, a long", ("x", 1)), frame(spark, "b long, k string", (2, "y"))
    assert values(reshape.union_all([a, b]), "k", "a", "b") == [("x", 1, None), ("y", None, 2)]


def test_year_window_and_state_totals(spark):
    df = frame(spark, "county_fips string, year long", ("01000", 2017), ("01001", 2016), ("01001", 2017), ("01001", 2023))
    assert values(filters.year_window(df, 2017, 2022), "county_fips") == [("01000",), ("01001",)]
    assert filters.year_window(df, 2017).count() == 3
    assert filters.drop_state_totals(df).count() == 3
    assert filters.with_all(frame(spark, "a long, b long", (1, None), (1, 2)), ["a", "b"]).count() == 1


def test_all_people_rows(spark):
    df = frame(spark, "agecat string, sexcat string, iprcat string", ("0", "0", "0"), ("1", "0", "0"), ("0", "0", "3"))
    assert filters.all_people_rows(df).count() == 1
