"""Column contracts of every table, as StructTypes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(), "boolean": T.BooleanType()}


def _schema(columns: str) -> T.StructType:
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_SAHIE = _schema(
    "geoid string, name string, pctui_pt double, nui_pt double, nic_pt double, time string, "
    "agecat string, sexcat string, iprcat string, state string, county string, year long"
)
RAW_BLS = _schema(
    "county_fips string, state_fips string, county_fips_within_state string, year long, "
    "unemployment_rate double, unemployment_level double, labor_force_level double"
)
RAW_ACS = _schema(
    "name string, median_household_income double, n_below_poverty double, poverty_universe double, "
    "edu_universe double, edu_hs_diploma double, edu_bachelors double, renters_total double, "
    "renters_severe_burden double, state string, county string, year long, county_fips string, "
    "state_fips string, poverty_rate double, pct_bachelors_plus double, pct_hs_plus double, "
    "pct_severe_rent_burden double"
)
RAW_AHRQ = _schema(
    "county_fips string, year long, pct_uninsured_under65 double, median_hh_income double, "
    "pct_below_poverty double, pct_unemployed double, pct_hs_graduate double, pct_bachelors double, "
    "total_population double, dist_trauma_center_miles double, dist_obstetrics_miles double, "
    "mds_rate_per_100k double, total_mds double, hpsa_primary_care double, "
    "rural_urban_code_2013 double, rural_urban_code_2023 double"
)

SEED_STATES = _schema(
    "state_fips string, state_name string, state_abbr string, census_region string, census_division string"
)
SEED_EXPANSION = _schema(
    "state_fips string, state_name string, state_abbr string, expansion_status string, expansion_year long"
)
SEED_ERAS = _schema(
    "era_name string, president string, start_year long, end_year long, color_hex string"
)

STG_SAHIE = _schema(
    "county_year_key string, county_fips string, state_fips string, county_name string, year long, "
    "pct_uninsured double, n_uninsured double, n_insured double, sahie_total_population double"
)
STG_BLS = _schema(
    "county_year_key string, county_fips string, state_fips string, year long, "
    "unemployment_rate double, unemployment_level double, labor_force_level double"
)
STG_ACS = _schema(
    "county_year_key string, county_fips string, state_fips string, year long, "
    "median_household_income double, poverty_rate double, n_below_poverty double, "
    "poverty_universe double, pct_bachelors_plus double, pct_hs_plus double, edu_bachelors double, "
    "edu_hs_diploma double, edu_universe double, pct_severe_rent_burden double, "
    "renters_severe_burden double, renters_total double"
)
STG_AHRQ = _schema(
    "county_year_key string, county_fips string, year long, pct_uninsured_under65 double, "
    "dist_trauma_center_miles double, dist_obstetrics_miles double, mds_rate_per_100k double, "
    "total_mds double, total_population double, hpsa_primary_care long, rural_urban_code_2013 long, "
    "is_rural boolean"
)

DIM_COUNTY = _schema(
    "county_fips string, county_name string, state_fips string, state_name string, state_abbr string, "
    "census_region string, census_division string, expansion_status string, expansion_year long, "
    "is_expansion_state boolean, rural_urban_code_2013 long, is_rural boolean"
)
DIM_YEAR = _schema(
    "year long, era_name string, president string, era_color_hex string, policy_event_label string"
)
FACT = _schema(
    "county_year_key string, county_fips string, year long, n_uninsured double, n_insured double, "
    "sahie_total_population double, unemployment_level double, labor_force_level double, "
    "n_below_poverty double, poverty_universe double, edu_bachelors double, edu_hs_diploma double, "
    "edu_universe double, renters_severe_burden double, renters_total double, "
    "median_household_income double, total_mds double, total_population double, "
    "dist_trauma_center_miles double, dist_obstetrics_miles double, hpsa_primary_care long"
)


def schema_drift(df: DataFrame, expected: T.StructType) -> list[str]:
    """Differences in column names, order or types; an empty list means the contract holds."""
    want = [(f.name, f.dataType.simpleString()) for f in expected]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    drift = [f"missing {n} {t}" for n, t in want if (n, t) not in have]
    drift += [f"unexpected {n} {t}" for n, t in have if (n, t) not in want]
    if not drift and want != have:
        drift.append("column order differs")
    return drift


def assert_schema(df: DataFrame, expected: T.StructType, table: str) -> DataFrame:
    drift = schema_drift(df, expected)
    if drift:
        raise ValueError(f"{table}: " + "; ".join(drift))
    return df


def check_types(tables: Mapping[str, DataFrame], expected: Mapping[str, T.StructType]) -> DataFrame:
    """The columns that break their table's contract: missing, unexpected or of another type, with the table's number of rows.

    Types are known without a scan, and rows are counted only of tables with such a column.
    """
    failing = []
    for name, contract in expected.items():
        want = {f.name: f.dataType.simpleString() for f in contract}
        have = dict(tables[name].dtypes)
        wrong = [(c, want.get(c), have.get(c)) for c in sorted({*want, *have}) if want.get(c) != have.get(c)]
        if wrong:
            lines = F.array(*[
                F.struct(*[F.lit(x).cast("string").alias(n) for n, x in zip(("table_name", "column_name", "expected_type", "found_type"), (name, *line))])
                for line in wrong
            ])
            counted = tables[name].agg(F.count(F.lit(1)).alias("n_rows"))
            failing.append(counted.select(F.inline(lines), "n_rows").select("table_name", "column_name", "expected_type", "found_type", "n_rows"))
    if failing:
        return reduce(DataFrame.unionByName, failing)
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame([], "table_name string, column_name string, expected_type string, found_type string, n_rows long")
