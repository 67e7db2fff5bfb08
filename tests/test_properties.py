"""Operators against brute force and pandas on random rows."""

import json
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from countypanel.functions import scalars as x
from countypanel.operators import joins, quality, reshape
from countypanel.operators.quality import Check
from countypanel.plans import analysis, metrics, raw
from countypanel.sources import json_matrix
from tests.helpers import frame, plan, values

NUMBERS = [
    "1", "01", "-1", "+2.5", " 3 ", "1e3", "1E-2", ".5", "5.", "", " ", "N/A", "(D)", "-", "1,000", "1_000", "1 2",
    "12abc", "abc12", "1d", "1f", "2.5D", "--1", "1.2.3", "-666666666", "999999999999999999999", "$5", "5%",
    "NaN", "nan", " NAN ", "-nan", "Infinity", "-inf", "inf",
]


def test_to_numeric_agrees_with_pandas(spark):
    got = frame(spark, "t string", *[(n,) for n in NUMBERS]).select("t", x.to_numeric(F.col("t")).alias("v")).collect()
    want = pd.to_numeric(pd.Series([n.strip() for n in NUMBERS]), errors="coerce")
    for row, expected in zip(got, want):
        assert (row["v"] is None and np.isnan(expected)) or row["v"] == pytest.approx(expected, rel=1e-15), row["t"]


def test_zfill_agrees_with_python(spark):
    codes = ["", "1", "12", "123", "1234", "00", "abc"]
    got = frame(spark, "c string", *[(c,) for c in codes]).select(x.zfill(F.col("c"), 3).alias("z")).collect()
    assert [r["z"] for r in got] == [c.zfill(3) for c in codes]


@pytest.mark.parametrize("seed", [1, 2])
def test_range_lookup_against_brute_force(spark, seed):
    rng = random.Random(seed)
    points = [rng.randint(-50, 150) for _ in range(200)]
    spans = [(f"s{i}", lo, lo + rng.randint(-2, 40)) for i, lo in enumerate(rng.randint(-60, 140) for _ in range(30))]
    want = [(p, n) for p in points for n in ([n for n, lo, hi in spans if lo <= p <= hi] or [None])]
    df = frame(spark, "v long", *[(p,) for p in points])
    intervals = frame(spark, "name string, lo long, hi long", *spans)
    got = joins.range_lookup(df, F.col("v"), intervals, "lo", "hi")
    assert values(got, "v", "name") == sorted(want, key=repr)


def test_range_lookup_of_many_wide_nested_and_empty_intervals(spark):
    rng = random.Random(9)
    wide = 3_000_000_000
    spans = [(f"s{i}", i, i + wide) for i in range(1001)]
    spans += [(f"n{i}", 500 + i, 500 + i + rng.choice([0, 1, 10, 10**6, 10**12])) for i in range(50)] + [("point", 7, 7), ("half", 0.25, 0.5)]
    points = [-1.0, 0.0, 0.3, 7.0, 500.0, 1000.0, float(wide), float(wide + 1000), float(wide + 1001), 1e13]
    want = [(p, n) for p in points for n in ([n for n, lo, hi in spans if lo <= p <= hi] or [None])]
    intervals = frame(spark, "name string, lo double, hi double", *[(n, float(lo), float(hi)) for n, lo, hi in spans])
    got = joins.range_lookup(frame(spark, "v double", *[(p,) for p in points]), F.col("v"), intervals, "lo", "hi")
    assert values(got, "v", "name") == sorted(want, key=repr)


def _found(spark, kind, points, spans):
    df, intervals = frame(spark, f"v {kind}", *[(p,) for p in points]), frame(spark, f"lo {kind}, hi {kind}", *spans)
    return values(joins.range_lookup(df, F.col("v"), intervals, "lo", "hi"), "v", "lo", "hi")


def _listed(points, spans):
    return sorted(((p, *s) for p in points for s in ([s for s in spans if s[0] <= p <= s[1]] or [(None, None)])), key=repr)


def test_range_lookup_at_the_edges_of_every_power_of_two(spark):
    rng, least, most = random.Random(4), -(2**63), 2**63 - 1
    spans = []
    for k in range(63):
        for width in {2**k - 1, 2**k, 2**k + 1}:
            for lo in (2**k - 1, 0, -(2**k), -3, rng.randint(least, most)):
                spans.append((lo, min(lo + width, most)))
    spans += [(least, most), (least, -1), (-1, most), (0, most), (least, least), (most, most)]
    edges = {x + d for s in spans for x in s for d in (-1, 0, 1)} | {(a + b) // 2 for a, b in spans} | {2**49 + 5, 2**50 - 3}
    points = [p for p in sorted(edges) if least <= p <= most]
    points = points[::5] + [2**49 + 5, 2**50 - 3, least, most, -1, 0]
    assert _found(spark, "long", points, spans) == _listed(points, spans)
    for span in ((2**49 - 1, 2**50), (2**52 - 1, 2**53), (least, most), (-5, 2**62)):  # one level alone
        near = [span[0], span[0] + 6, (span[0] + span[1]) // 2, span[1] - 3, span[1], 0]
        assert _found(spark, "long", near, [span]) == _listed(near, [span])


def test_range_lookup_of_fractions_at_every_scale(spark):
    rng, spans = random.Random(6), []
    for k in (-1074, -1070, -1022, -600, -52, -3, -1, 0, 1, 5, 52, 53, 54, 63, 64, 200, 1000):
        for width in (2.0**k, 2.0**k * 0.999, 2.0**k * 1.001):
            spans += [(lo, lo + width) for lo in (0.0, -width / 2, 2.0**k - width, 0.1, rng.uniform(-1, 1) * 2.0 ** min(k + 3, 1000))]
    spans += [(-1e308, 1e308), (float("-inf"), float("inf")), (0.5, float("inf")), (0.25, 0.25), (-0.0, 0.0), (2.0**53 - 0.5, 2.0**54 + 2)]
    points = sorted({x for s in spans for x in (*s, s[0] / 2 + s[1] / 2) if x == x})[::3] + [0.0, 0.1, 5e-324, -5e-324, 1e308]
    assert _found(spark, "double", points, spans) == _listed(points, spans)


def test_range_lookup_across_cells_with_repeats_nulls_and_nan(spark):
    nan, inf = float("nan"), float("inf")
    points = [*range(0, 3000, 7), *[500.5] * 900, *[-0.0, 0.0] * 3, None, None, nan, inf, -inf]
    points = [p if p is None else float(p) for p in points]
    spans = [(0.0, 0.0), (-0.0, -0.0), (500.5, 500.5), (500.25, 501.0), (-inf, inf), (nan, nan), (2.0, nan), (2999.0, inf), (9.0, 8.0), (None, 5.0), (1.0, None)]
    spans += [(7.0 * i, 7.0 * i + 2.0 ** (i % 12)) for i in range(0, 400, 9)]

    def below(a, b):  # as Spark compares: NaN above all
        return b != b or a == a and a <= b

    want = []
    for p in points:
        hits = [s for s in spans if None not in (p, *s) and below(s[0], s[1]) and below(s[0], p) and below(p, s[1])]
        want += [(p, *s) for s in hits or [(None, None)]]

    def counted(rows):
        return Counter(tuple("0.0" if x == 0 else repr(x) for x in r) for r in rows)

    df = spark.createDataFrame([(p,) for p in points], "v double")
    got = joins.range_lookup(df, F.col("v"), spark.createDataFrame(spans, "lo double, hi double"), "lo", "hi")
    assert counted(tuple(r) for r in got.collect()) == counted(want)


def test_range_lookup_joins_once_and_deals_the_values_of_wide_intervals_out(spark):
    df = spark.range(40_000).selectExpr("if(id % 4 = 0, 77, id * id) as v")
    intervals = spark.range(40).selectExpr("id", "id * 10 as lo", "id * 10 + if(id % 2 = 0, 3000000000, id) as hi")
    got = joins.range_lookup(df, F.col("v"), intervals, "lo", "hi")
    assert plan(got).count("Join") == 1 and "HashAggregate" not in plan(got)  # no value is looked up apart, no match joined again
    cuts = joins._cuts(df.select(F.col("v").cast("double")))
    cells = [r["count"] for r in joins._cell(df, F.col("v").cast("double"), cuts, "c").groupBy("c").count().collect()]
    assert sorted(cells)[-1] - 10_000 < 1000 and sorted(cells)[-2] < 1000 and len(cells) > 100


def test_range_lookup_lists_no_value_once_per_width(spark):
    df = spark.range(3000).selectExpr("id", "id / 64 as v")
    intervals = spark.range(200).selectExpr("id as k", "id * 0.7D as lo", "id * 0.7D + pow(2D, -(id % 20)) * (1 + id % 3) as hi")
    got = joins.range_lookup(df, F.col("v"), intervals, "lo", "hi")
    want = df.join(intervals, F.col("v").between(F.col("lo"), F.col("hi")), "left")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert plan(got).count("Generate ") == 1  # of the intervals alone


@pytest.mark.parametrize("seed", [3, 4])
def test_fan_out_join_against_plain_left_join(spark, seed):
    rng = random.Random(seed)

    def key():
        return (rng.choice("aaaaaabcde"), rng.choice([1, 2, 3, None]))

    left = frame(spark, "k string, y long, a long", *[(*key(), i) for i in range(60)])
    right = frame(spark, "k string, y long, b long", *[(*key(), rng.choice([None, 1, 2])) for _ in range(40)])
    for rows_per_task in (1, 2, 100):
        got = joins.fan_out_left_join(left, right, ["k", "y"], rows_per_task)
        assert values(got, "k", "y", "a", "b") == values(left.join(right, ["k", "y"], "left"), "k", "y", "a", "b")


def test_pivot_against_pandas(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice("abc"), rng.choice(["03", "04", "06", "09"]), rng.choice([None, 1.0, 2.0, 3.0]), f"s{i:03}")
        for i in range(60)
    ]
    measures = {"03": "rate", "04": "level", "06": "force"}
    got = reshape.pivot_measures(
        frame(spark, "k string, code string, v double, s string", *rows), ["k"], "code", "v", measures, "s"
    ).toPandas().set_index("k").sort_index()
    table = pd.DataFrame(rows, columns=["k", "code", "v", "s"]).dropna(subset=["v"])
    want = table.pivot_table(index="k", columns="code", values="v", aggfunc="first").rename(columns=measures)
    pd.testing.assert_frame_equal(got[list(measures.values())], want[list(measures.values())], check_names=False)


def test_latest_row_against_pandas(spark):
    rng = random.Random(6)
    rows = [(rng.choice("abcdef"), rng.choice([None, 2017, 2018, 2019]), i) for i in range(80)]
    got = reshape.latest_per_key(frame(spark, "k string, y long, i long", *rows), ["k"], ["y"])
    table = pd.DataFrame(rows, columns=["k", "y", "i"]).sort_values(["y", "i"], na_position="first")
    want = table.groupby("k").tail(1)
    assert values(got, "k", "i") == sorted(zip(want["k"], want["i"]), key=repr)


def test_mean_trend_against_pandas(spark):
    rng = random.Random(7)
    rows = [
        (rng.choice([2017, 2018, None]), rng.choice(["Trump1", "Biden", None]), rng.choice([None, 0.1, 0.25, 0.4]))
        for _ in range(100)
    ] + [(2020, "Biden", None)]
    df = frame(spark, "year long, era_name string, pct_uninsured double", *rows)
    got = analysis.mean_trend(df, ["year", "era_name"], ["pct_uninsured"]).toPandas()
    want = pd.DataFrame(rows, columns=df.columns).groupby(["year", "era_name"])["pct_uninsured"].mean() * 100
    got = got.set_index(["year", "era_name"])["pct_uninsured"].sort_index()
    pd.testing.assert_series_equal(got, want.sort_index(), check_index_type=False)


def test_metrics_by_parts_equal_one_direct_aggregation(panel):
    joined = panel.fact.join(panel.dim_county, "county_fips", "left").join(panel.dim_year, "year", "left")
    for dims in (["census_region"], ["era_name", "is_rural"], ["year"], ["state_abbr", "policy_event_label"]):
        direct = joined.groupBy(*dims).agg(
            F.try_divide(F.sum("n_uninsured"), F.sum("sahie_total_population")).alias("weighted_avg_pct_uninsured"),
            F.avg("median_household_income").alias("avg_median_household_income"),
        )
        got = metrics.metric(panel.fact, direct.columns[-2:], dims, panel.dim_county, panel.dim_year)
        assert values(got, *direct.columns) == values(direct, *direct.columns)


def test_numerators_add_up_over_any_slice(panel):
    totals = []
    for dim in ("census_region", "expansion_status", "era_name", "county_name"):
        parts = metrics.evaluate(
            panel.fact, [metrics.Metric("m", "n_uninsured"), metrics.METRICS["weighted_avg_pct_uninsured"]], [dim],
            [metrics.Dimension(panel.dim_county, "county_fips"), metrics.Dimension(panel.dim_year, "year")],
        )
        assert parts.count() == parts.select(dim).distinct().count()
        joined = panel.fact.join(panel.dim_county, "county_fips").join(panel.dim_year, "year")
        totals.append(joined.groupBy(dim).agg(F.sum("n_uninsured").alias("n")).agg(F.sum("n")).first()[0])
    assert len(set(totals)) == 1


def test_fact_has_the_rows_of_its_spine(panel):
    assert panel.fact.count() == panel.stg_sahie.count()


def test_json_rows_and_payloads_agree_with_python(spark, tmp_path):
    rng = random.Random(8)
    alphabet = ['"', "\\", "]", "[", ",", "é", "\n", "\t", " ", "x", "1", "{", "}"]

    def cell():
        return None if rng.random() < 0.1 else "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 8)))

    want = []
    for year in (2017, 2018, 2019):
        names = ["A", "B", "C"]
        rng.shuffle(names)
        rows = [[cell() for _ in names] for _ in range(50)]
        want += [(r[names.index("A")], r[names.index("B")], year) for r in rows]
        lines = [json.dumps(r, ensure_ascii=rng.random() < 0.5) for r in [names, *rows]]
        for kind, text in (("rows", "[" + ",\n".join(lines) + "]"), ("payload", "[" + ",".join(lines) + "]")):
            folder = tmp_path / kind / f"year={year}"
            folder.mkdir(parents=True)
            (folder / "reply.json").write_text(text)
    for read, kind in ((json_matrix.read_row_lines, "rows"), (json_matrix.read_payload_lines, "payload")):
        df = read(spark, str(tmp_path / kind), ["A", "B"], [2017, 2018, 2019])
        assert values(df, "A", "B", "year") == sorted(want, key=repr)


def test_bls_against_pandas(spark):
    rng = random.Random(9)
    places = [f"CN{s:02}{c:03}00000000" for s in (1, 2) for c in (0, 1, 3)]
    series = [
        (f"L{i:03}", rng.choice("FFFA"), rng.choice(places), rng.choice(["03", "04", "05", "06"])) for i in range(60)
    ]
    data = [
        (rng.choice(series)[0], str(rng.randint(2014, 2026)), rng.choice(["M13", "M13", "M01"]), rng.choice(["1", "2.5", "-", "7"]))
        for _ in range(600)
    ]
    data = list({(s, y, p): (s, y, p, v) for s, y, p, v in data}.values())
    got = raw.bls_raw(
        frame(spark, "series_id string, area_type_code string, area_code string, measure_code string", *series),
        frame(spark, "series_id string, year string, period string, value string", *data),
    )
    s = pd.DataFrame(series, columns=["series_id", "type", "area", "code"])
    s = s[(s.type == "F") & s.code.isin(["03", "04", "06"])]
    d = pd.DataFrame(data, columns=["series_id", "year", "period", "value"]).astype({"year": int})
    d = d[(d.period == "M13") & d.year.between(2016, 2024)].merge(s, on="series_id")
    d["value"] = pd.to_numeric(d["value"], errors="coerce")
    d["county_fips"] = d.area.str[2:7]
    wide = d.dropna(subset=["value"]).sort_values("series_id").pivot_table(
        index=["county_fips", "year"], columns="code", values="value", aggfunc="first"
    )
    want = [
        (*key, *[None if np.isnan(row[c]) else float(row[c]) for c in ("03", "04", "06")]) for key, row in wide.iterrows()
    ]
    assert values(got, "county_fips", "year", *raw.BLS_MEASURES.values()) == sorted(want, key=repr)


def test_report_counts_equal_failing_rows(spark):
    rng = random.Random(10)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, -1.0, 0.5, 2.0]), rng.choice([None, 1.0])) for _ in range(50)]
    df = frame(spark, "k string, v double, w double", *rows)
    checks = [
        Check("not_null", "k"), Check("not_null", "v", where="w is not null"), Check("unique", "k"), Check("unique", "v"),
        Check("accepted_values", "k", values=("a", "b")), Check("between", "v", low=0, high=1),
        Check("part_of_whole", "v", parent_column="w"),
    ]
    got = [(r["check_name"], r["column_name"], r["failing_rows"]) for r in quality.check_table("t", df, checks, {}).collect()]
    want = {
        ("not_null", "k", sum(k is None for k, _, _ in rows)),
        ("not_null", "v", sum(v is None and w is not None for _, v, w in rows)),
        ("unique", "k", quality.unique(df, "k").count()),
        ("unique", "v", quality.unique(df, "v").count()),
        ("accepted_values", "k", sum(k == "c" for k, _, _ in rows)),
        ("between", "v", sum(v is not None and not 0 <= v <= 1 for _, v, _ in rows)),
        ("part_of_whole", "v", sum(v is not None and (v < 0 or (w is not None and v > w)) for _, v, w in rows)),
    }
    assert set(got) == want
