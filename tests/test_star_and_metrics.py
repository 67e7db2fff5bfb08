import pytest
from pyspark.sql import functions as F

from countypanel import schemas
from countypanel.operators.quality import unique
from countypanel.plans import analysis, extensions, metrics, star
from tests.helpers import plan, values
from tests.panel_rows import Panel, acs, ahrq, bls, sahie


@pytest.fixture(scope="module")
def two_counties(spark):
    """An expansion county (Alaska) that got worse and another (Alabama) that hardly changed."""
    rows = [sahie("02020", y, nui=10.0, nic=90.0) for y in range(2017, 2021)]
    rows += [sahie("02020", y, nui=30.0, nic=70.0) for y in (2021, 2022)]
    rows += [sahie("01001", y, nui=20.0, nic=180.0) for y in range(2017, 2023)]
    rows += [sahie("04001", 2018)]
    return Panel(
        spark,
        sahie=rows,
        bls=[bls("02020", y, level=4.0, force=80.0) for y in range(2017, 2025)],
        acs=[acs("02020", y) for y in range(2016, 2023)] + [acs("01001", 2017, poor=None)],
        ahrq=[ahrq("02020", 2018, rucc=2.0), ahrq("02020", 2019, rucc=7.0)],
    )


def test_contracts(two_counties):
    assert schemas.schema_drift(two_counties.dim_county, schemas.DIM_COUNTY) == []
    assert schemas.schema_drift(two_counties.dim_year, schemas.DIM_YEAR) == []
    assert schemas.schema_drift(two_counties.fact, schemas.FACT) == []


def test_fact_keeps_the_spine(two_counties):
    assert two_counties.fact.count() == two_counties.stg_sahie.count() == 13
    got = values(two_counties.fact.filter("year = 2017"), "county_fips", "labor_force_level", "poverty_universe", "total_mds")
    assert got == [("01001", None, 100.0, None), ("02020", 80.0, 100.0, None)]


def test_latest_rurality_wins(two_counties):
    assert values(two_counties.dim_county, "county_fips", "rural_urban_code_2013", "is_rural") == [
        ("01001", None, None), ("02020", 7, True), ("04001", None, None),
    ]


def test_unknown_state_keeps_null_labels(spark):
    panel = Panel(spark, sahie=[sahie("72001", 2017)])
    row = panel.dim_county.first()
    assert row["state_name"] is None and row["is_expansion_state"] is None and row["expansion_status"] is None


def test_renamed_county_has_a_row_per_name(spark):
    panel = Panel(spark, sahie=[sahie("01001", 2017, name="Old"), sahie("01001", 2018, name="New")])
    assert panel.dim_county.count() == 2
    assert values(unique(panel.dim_county, "county_fips"), "county_fips", "n_rows") == [("01001", 2)]
    latest = star.dim_county(panel.stg_sahie, panel.stg_ahrq, panel.states, panel.expansion, latest_name=True)
    assert values(latest, "county_fips", "county_name") == [("01001", "New")]
    assert star.star_join(panel.fact, panel.dim_county, panel.dim_year).count() == 4


def test_renaming_leaves_era_rates_alone(spark):
    rows = [sahie("01001", 2017, name="Old"), sahie("01001", 2021, nui=40.0, nic=60.0, name="New")]
    panel = Panel(spark, sahie=rows)
    got = analysis.era_change_summary(panel.fact, panel.dim_county, panel.dim_year)
    assert values(got, "county_fips", "trump1_pct_uninsured", "biden_pct_uninsured") == [("01001", 0.1, 0.4)]


def test_duplicate_health_rows_fan_out(spark):
    panel = Panel(
        spark, sahie=[sahie("01001", 2017), sahie("01001", 2018)],
        ahrq=[ahrq("01001", 2017, mds=1.0), ahrq("01001", 2017, mds=2.0), ahrq("01001", 2017, mds=2.0)],
    )
    assert values(panel.fact, "year", "total_mds") == [(2017, 1.0), (2017, 2.0), (2017, 2.0), (2018, None)]
    assert unique(panel.fact, "county_year_key").count() == 1


def test_fact_without_health_files(spark):
    panel = Panel(spark, sahie=[sahie("01001", 2017)], acs=[acs("01001", 2017)])
    assert values(panel.fact, "n_uninsured", "total_mds", "hpsa_primary_care") == [(10.0, None, None)]
    assert "Union" not in plan(panel.fact)


def test_year_dimension(two_counties):
    rows = {r["year"]: r for r in two_counties.dim_year.collect()}
    assert sorted(rows) == list(range(2017, 2026))
    assert [rows[y]["era_name"] for y in (2017, 2020, 2021, 2024, 2025)] == ["Trump1", "Trump1", "Biden", "Biden", "Trump2"]
    assert rows[2022]["policy_event_label"] is None and rows[2025]["president"] == "Trump"
    assert 2026 not in rows


def test_ratio_metric_ignores_county_size_bias(two_counties):
    t = two_counties
    got = metrics.metric(t.fact, ["weighted_avg_pct_uninsured"], ["era_name"], t.dim_county, t.dim_year)
    assert dict(values(got, "era_name", "weighted_avg_pct_uninsured")) == {"Trump1": 130 / 1300, "Biden": 100 / 600}


def test_numerator_and_denominator_skip_nulls_apart(two_counties):
    t = two_counties
    got = metrics.metric(t.fact, ["weighted_avg_poverty_rate"], ["year"], t.dim_county, t.dim_year, where={"year": 2017})
    assert values(got, "year", "weighted_avg_poverty_rate") == [(2017, 20.0 / 200.0)]


def test_zero_and_missing_denominators_give_null(spark):
    panel = Panel(spark, sahie=[sahie("01001", 2017, nui=0.0, nic=0.0), sahie("02020", 2017, nui=None)])
    got = metrics.metric(panel.fact, ["weighted_avg_pct_uninsured", "avg_median_household_income"], ["county_fips"])
    assert values(got, "county_fips", "weighted_avg_pct_uninsured", "avg_median_household_income") == [
        ("01001", None, None), ("02020", None, None),
    ]


def test_all_metrics_total_and_unknown_dimension(two_counties):
    t = two_counties
    total = metrics.metric(t.fact, list(metrics.METRICS), (), t.dim_county, t.dim_year)
    row = total.first()
    assert total.count() == 1
    assert row["weighted_avg_pct_hs_plus"] == (30.0 * 7) / (50.0 * 7)
    assert row["weighted_avg_mds_rate_per_100k"] == 300.0
    assert row["avg_dist_trauma_center_miles"] == 12.0 and row["avg_dist_obstetrics_miles"] is None
    with pytest.raises(ValueError, match="no_such"):
        metrics.metric(t.fact, ["weighted_avg_pct_uninsured"], ["no_such"], t.dim_county, t.dim_year)


def test_slices_add_up_to_the_total(two_counties):
    t = two_counties
    parts = t.fact.join(t.dim_county, "county_fips").groupBy("census_region").agg(F.sum("n_uninsured").alias("n"))
    assert parts.agg(F.sum("n")).first()[0] == t.fact.agg(F.sum("n_uninsured")).first()[0]


def test_metric_joins_only_what_it_needs(two_counties):
    t = two_counties
    by_year = metrics.metric(t.fact, ["weighted_avg_pct_uninsured"], ["year"], t.dim_county, t.dim_year)
    assert "state_name" not in plan(by_year) and "president" not in plan(by_year)


def test_era_change(two_counties):
    t = two_counties
    got = analysis.era_change_summary(t.fact, t.dim_county, t.dim_year)
    rows = got.collect()
    assert [r["county_fips"] for r in rows] == ["02020", "01001"]
    assert [r["uninsurance_trajectory"] for r in rows] == ["deteriorated", "stable"]
    assert rows[0]["trump1_pct_uninsured"] == 0.1 and rows[0]["biden_pct_uninsured"] == 0.3
    assert rows[0]["change_poverty_rate"] == 0.0 and rows[1]["change_poverty_rate"] is None
    assert "TakeOrderedAndProject" in plan(got)


def test_suppressed_years_leave_all_sums(spark):
    rows = [sahie("01001", 2017), sahie("01001", 2018, nui=None), sahie("01001", 2021)]
    panel = Panel(spark, sahie=rows, acs=[acs("01001", 2017, poor=10.0), acs("01001", 2018, poor=90.0), acs("01001", 2021)])
    got = analysis.era_change_summary(panel.fact, panel.dim_county, panel.dim_year)
    assert values(got, "trump1_poverty_rate") == [(0.1,)]


def test_change_is_one_aggregation_of_the_fact(spark, tmp_path):
    panel = Panel(spark, sahie=[sahie("01001", 2017), sahie("01001", 2021)])
    panel.fact.write.parquet(str(tmp_path / "fact"))
    fct = spark.read.parquet(str(tmp_path / "fact"))
    assert plan(analysis.era_change_summary(fct, panel.dim_county, panel.dim_year)).count("FileScan") == 1


def test_metrics_never_shuffle_the_fact_at_its_own_grain(spark, tmp_path):
    panel = Panel(spark, sahie=[sahie("01001", 2017), sahie("01001", 2021)])
    tables = {}
    for name, df in (("fact", panel.fact), ("county", panel.dim_county), ("year", panel.dim_year)):
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    for dims, where in ((["census_region", "era_name"], None), (["state_abbr", "year"], None), (["year"], {"era_name": "Biden", "census_region": "South"})):
        text = plan(metrics.metric(tables["fact"], list(metrics.METRICS), dims, tables["county"], tables["year"], where))
        assert text.count("Exchange hashpartitioning") == 1 and "hashpartitioning(county_fips" not in text


def test_trends_and_map(two_counties):
    t = two_counties
    trends = analysis.county_year_trends(t.fact, t.dim_county, t.dim_year)
    assert trends.columns[0] == "county_fips" and len(trends.columns) == 17
    era = analysis.trend_by_era(trends, ["pct_uninsured", "median_household_income"])
    by_year = {r["year"]: r for r in era.collect()}
    assert by_year[2021]["pct_uninsured"] == pytest.approx(20.0)
    assert by_year[2021]["median_household_income"] == 50000.0
    both = analysis.trend_by_both(trends, ["pct_uninsured"]).filter("year = 2021")
    assert values(both, "group", "pct_uninsured") == [("Biden / expanded", 30.0), ("Biden / not_expanded", 10.0)]
    slice_ = analysis.map_slice(trends, 2021, "poverty_rate")
    assert values(slice_, "county_fips", "display_value", "era_label") == [("02020", 20.0, "Biden")]
    assert [r["year"] for r in analysis.available_years(trends).collect()] == list(range(2017, 2023))
    ordered = [r["era_name"] for r in analysis.era_ordered(era).collect()]
    assert ordered == ["Trump1"] * 4 + ["Biden"] * 2


def test_trend_sorts_nothing(two_counties):
    t = two_counties
    text = plan(analysis.trend_by_era(analysis.county_year_trends(t.fact, t.dim_county, t.dim_year)))
    assert "rangepartitioning" not in text
    shown = analysis.county_year_trends(t.fact, t.dim_county, t.dim_year, ordered=True)
    keys = [(r["county_fips"], r["year"]) for r in shown.select("county_fips", "year").collect()]
    assert keys == sorted(keys) and len(keys) == 13


def test_all_null_group_keeps_a_null_mean_and_null_keys_are_left_out(spark):
    panel = Panel(spark, sahie=[sahie("72001", 2017), sahie("01001", 2018, nui=None)])
    trends = analysis.county_year_trends(panel.fact, panel.dim_county, panel.dim_year)
    got = analysis.trend_by_expansion(trends, ["pct_uninsured"])
    assert values(got, "year", "expansion_status", "pct_uninsured") == [(2018, "not_expanded", None)]


@pytest.mark.parametrize("year, era", [(2016, "pre-era"), (2017, "Trump1"), (2024, "Biden"), (2027, "Trump2"), (2028, "pre-era")])
def test_era_of_year(spark, year, era):
    assert spark.range(1).select(analysis.era_of_year(F.lit(year))).first()[0] == era


def test_extensions(two_counties):
    t = two_counties
    exposure = extensions.expansion_exposure(t.fact, t.dim_county)
    assert values(exposure.filter("year = 2018"), "county_fips", "years_since_expansion", "expansion_phase") == [
        ("01001", None, "never"), ("02020", 3, "post"), ("04001", 4, "post"),
    ]
    did = extensions.diff_in_diff(t.fact, t.dim_county, t.dim_year).collect()[0]
    assert did["outcome"] == "weighted_avg_pct_uninsured"
    assert did["diff_in_diff"] == pytest.approx((0.3 - 50 / 500) - 0.0)
    change = extensions.year_change(t.fact, t.dim_county, t.dim_year, 2020, 2021)
    assert [r["county_fips"] for r in change.collect()] == ["02020", "01001"]
    trends = analysis.county_year_trends(t.fact, t.dim_county, t.dim_year)
    assert extensions.county_series(trends, "02020").count() == 6


@pytest.mark.parametrize("years, phase", [(None, "never"), (-1, "pre"), (0, "adoption"), (1, "adoption"), (2, "post")])
def test_expansion_phase(spark, years, phase):
    assert spark.range(1).select(extensions.expansion_phase(F.lit(years).cast("long"))).first()[0] == phase
