import pytest
from pyspark.sql import functions as F

from countypanel import schemas
from countypanel.plans import conform, raw
from tests.helpers import frame, plan, values
from tests.panel_rows import Panel, acs, ahrq, bls, sahie


def test_sahie_raw_types_and_codes(spark):
    columns = ", ".join(f"{c} string" for c in raw.SAHIE_COLUMNS) + ", year long"
    row = ("1001", "Autauga", "9.5", "N/A", "12", "2017", "0", "0", "0", "01", "001", 2017)
    df = raw.sahie_raw(frame(spark, columns, row))
    assert schemas.schema_drift(df, schemas.RAW_SAHIE) == []
    assert values(df, "geoid", "pctui_pt", "nui_pt", "nic_pt") == [("01001", 9.5, None, 12.0)]


def acs_payload(spark, *rows):
    columns = ", ".join(f"{c} string" for c in raw.ACS_COLUMNS) + ", year long"
    return frame(spark, columns, *rows)


def test_acs_raw_rates_and_sentinels(spark):
    df = raw.acs_raw(
        acs_payload(
            spark,
            ("A", "-666666666", "5", "20", "10", "4", "1", "0", "0", "1", "3", 2017),
            ("B", "50000", "x", "20", "0", "4", None, "8", "2", "01", "005", 2017),
        )
    )
    assert schemas.schema_drift(df, schemas.RAW_ACS) == []
    got = values(
        df, "county_fips", "state_fips", "median_household_income", "poverty_rate", "pct_bachelors_plus",
        "pct_hs_plus", "pct_severe_rent_burden",
    )
    assert got == [
        ("01003", "01", None, 0.25, 0.1, 0.5, None),
        ("01005", "01", 50000.0, None, None, None, 0.25),
    ]


SERIES = "series_id string, area_type_code string, area_code string, measure_code string"
DATA = "series_id string, year string, period string, value string"


def series(spark):
    area = "CN0100300000000"
    return frame(
        spark, SERIES, ("r", "F", area, "03"), ("l", "F", area, "04"), ("f", "F", area, "06"), ("x", "F", area, "05"),
        ("s", "A", "ST0100000000000", "03"), ("l2", "F", area, "04"), ("only", "F", "CN0100500000000", "04"),
    )


def test_bls_raw_filters_pivots_and_prefers_lowest_series(spark):
    data = frame(
        spark, DATA,
        ("r", "2017", "M13", "4.5"), ("r", "2017", "M01", "9"), ("r", "2015", "M13", "8"), ("l", "2017", "M13", "-"),
        ("l2", "2017", "M13", "7"), ("l", "2018", "M13", "3"), ("l2", "2018", "M13", "2"), ("f", "2018", "M13", "50"),
        ("x", "2017", "M13", "1"), ("s", "2017", "M13", "1"), ("unknown", "2017", "M13", "1"), ("only", "2017", "M13", "6"),
    )
    df = raw.bls_raw(series(spark), data)
    assert schemas.schema_drift(df, schemas.RAW_BLS) == []
    assert values(df, "county_fips", "year", "unemployment_rate", "unemployment_level", "labor_force_level") == [
        ("01003", 2017, 4.5, 7.0, None),
        ("01003", 2018, None, 3.0, 50.0),
        ("01005", 2017, None, 6.0, None),
    ]
    staged = conform.stg_bls(df)
    assert values(staged, "county_fips", "year") == [("01003", 2017)]


def test_bls_raw_of_nothing_is_empty_and_typed(spark):
    df = raw.bls_raw(series(spark), frame(spark, DATA))
    assert df.count() == 0 and schemas.schema_drift(df, schemas.RAW_BLS) == []


def test_bls_raw_filters_by_series_before_it_shuffles(spark):
    text = plan(raw.bls_raw(series(spark), frame(spark, DATA, ("r", "2017", "M13", "4.5"))))
    assert text.index("Exchange hashpartitioning(county_fips") < text.index("Join")  # printed from the result down
    assert "SortAggregate" not in text and "Exchange hashpartitioning(series_id" not in text


def test_sahie_edges(spark):
    panel = Panel(
        spark,
        sahie=[sahie("1001", 2017), sahie("01000", 2017), sahie("01003", 2016), sahie("01005", 2022, nui=None, pct=None),
               sahie(None, 2017, name="none"), sahie("01007", 2023)],
    )
    assert schemas.schema_drift(panel.stg_sahie, schemas.STG_SAHIE) == []
    assert values(panel.stg_sahie, "county_fips", "state_fips", "year", "pct_uninsured", "n_uninsured", "sahie_total_population") == [
        ("01001", "01", 2017, 0.1, 10.0, 100.0),
        ("01005", "01", 2022, None, None, None),
    ]


def test_text_numbers_are_tried_not_forced(spark):
    columns = "geoid string, name string, pctui_pt string, nui_pt string, nic_pt string, year long"
    df = conform.stg_sahie(frame(spark, columns, ("01001", "A", "N/A", "bad", "5", 2018)))
    assert values(df, "pct_uninsured", "n_uninsured", "n_insured") == [(None, None, 5.0)]


def test_bls_edges(spark):
    panel = Panel(spark, bls=[bls("01001", 2024), bls("01000", 2020), bls("01003", 2025), bls("01005", 2020, rate=None)])
    assert schemas.schema_drift(panel.stg_bls, schemas.STG_BLS) == []
    assert values(panel.stg_bls, "county_fips", "year") == [("01001", 2024)]


def test_acs_edges(spark):
    panel = Panel(spark, acs=[acs("01001", 2017, median_household_income=-666666666.0), acs("01000", 2020), acs("01001", 2023)])
    assert schemas.schema_drift(panel.stg_acs, schemas.STG_ACS) == []
    assert values(panel.stg_acs, "county_fips", "median_household_income") == [("01001", None)]


def test_ahrq_edges(spark):
    panel = Panel(
        spark,
        ahrq=[ahrq("1001", 2017), ahrq("01003", 2016), ahrq("01005", 2030, rucc=0.0), ahrq("01000", 2018, rucc=10.0),
              ahrq(None, 2018), ahrq("01007", 2018, rucc=None), ahrq("01009", None)],
    )
    assert schemas.schema_drift(panel.stg_ahrq, schemas.STG_AHRQ) == []
    assert values(panel.stg_ahrq, "county_fips", "rural_urban_code_2013", "is_rural") == [
        ("01000", 10, True), ("01001", 5, True), ("01005", 0, None), ("01007", None, None),
    ]


def test_strict_year_cast_fails_on_garbage(spark):
    columns = "geoid string, name string, pctui_pt string, nui_pt string, nic_pt string, year string"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform.stg_sahie(frame(spark, columns, ("01001", "A", "1", "1", "1", "20x7"))).collect()


def test_staging_prunes_columns_and_pushes_the_year(spark, tmp_path):
    rows = [sahie("01001", y) for y in range(2015, 2024)]
    from countypanel.sources.reference_data import local_table

    local_table(spark, rows, schemas.RAW_SAHIE).write.parquet(str(tmp_path / "raw"))
    df = conform.stg_sahie(spark.read.parquet(str(tmp_path / "raw"))).select("county_fips", "n_uninsured")
    text = plan(df)
    assert "GreaterThanOrEqual(year,2017)" in text and "LessThanOrEqual(year,2022)" in text
    assert "ReadSchema: struct<geoid:string,nui_pt:double,year:bigint>" in text
    assert "Exchange" not in text


def test_schema_drift_reports_differences(spark):
    df = spark.range(1).select(F.lit("a").alias("era_name"), F.lit(1).alias("extra"))
    drift = schemas.schema_drift(df, schemas.SEED_ERAS)
    assert "unexpected extra int" in drift and "missing start_year bigint" in drift
    with pytest.raises(ValueError, match="policy_eras"):
        schemas.assert_schema(df, schemas.SEED_ERAS, "policy_eras")
