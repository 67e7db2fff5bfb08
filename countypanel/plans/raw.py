"""Landed sources to raw tables."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from countypanel.functions.scalars import (
    area_county,
    area_state,
    negative_to_null,
    safe_ratio,
    to_numeric,
    to_year,
    zfill,
)
from countypanel.operators.reshape import lower_names, pivot_measures
from countypanel.sources.delimited import ScanLog, list_files, read_drifting_csv

# Estimate years fetched per source.
SAHIE_YEARS = list(range(2016, 2023))
ACS_YEARS = list(range(2016, 2023))
BLS_YEARS = list(range(2016, 2025))

# Columns of the insurance payload.
SAHIE_COLUMNS = [
    "GEOID", "NAME", "PCTUI_PT", "NUI_PT", "NIC_PT",
    "time", "AGECAT", "SEXCAT", "IPRCAT", "state", "county",
]

# Census variable and its column name.
ACS_VARIABLES = {
    "B19013_001E": "median_household_income",
    "B17001_002E": "n_below_poverty",
    "B17001_001E": "poverty_universe",
    "B15003_001E": "edu_universe",
    "B15003_017E": "edu_hs_diploma",
    "B15003_022E": "edu_bachelors",
    "B25070_001E": "renters_total",
    "B25070_010E": "renters_severe_burden",
}
ACS_COLUMNS = ["NAME", *ACS_VARIABLES, "state", "county"]

# County area type, annual-average period, and measure codes with their names.
BLS_COUNTY_AREA = "F"
BLS_ANNUAL = "M13"
BLS_MEASURES = {
    "03": "unemployment_rate",
    "04": "unemployment_level",
    "06": "labor_force_level",
}

# Names under which each variable occurs in the yearly health files.
AHRQ_ALIASES = {
    "county_fips": ["COUNTYFIPS", "FIPSCODE"],
    "year": ["YEAR"],
    "pct_uninsured_under65": ["SAHIE_PCT_UNINSURED64", "ACS_PCT_UNINSURED", "ACS_PCT_UNINSURED_BELOW64"],
    "median_hh_income": ["ACS_MEDIAN_HH_INC"],
    "pct_below_poverty": ["SAIPE_PCT_POV"],
    "pct_unemployed": ["ACS_PCT_UNEMPLOY"],
    "pct_hs_graduate": ["ACS_PCT_HS_GRADUATE"],
    "pct_bachelors": ["ACS_PCT_BACHELOR_DGR"],
    "total_population": ["ACS_TOT_POP_WT"],
    "dist_trauma_center_miles": ["POS_MEDIAN_DIST_TRAUMA"],
    "dist_obstetrics_miles": ["POS_MEDIAN_DIST_OBSTETRICS"],
    "mds_rate_per_100k": ["AHRF_MDS_RATE"],
    "total_mds": ["AHRF_TOT_MDS"],
    "hpsa_primary_care": ["AHRF_HPSA_PRIM"],
    "rural_urban_code_2013": ["AHRF_USDA_RUCC_2013"],
    "rural_urban_code_2023": ["AHRF_USDA_RUCC_2023"],
}
AHRQ_FILES = r"/clh_[^/]*_county[^/]*\.csv(/|$)"


def sahie_raw(payloads: DataFrame) -> DataFrame:
    """Insurance estimates: numbers from text, five-digit county code, lower-case names."""
    df = lower_names(payloads)
    return df.withColumns(
        {
            **{c: to_numeric(F.col(c)) for c in ("pctui_pt", "nui_pt", "nic_pt")},
            "geoid": zfill(F.col("geoid"), 5),
            "year": F.col("year").cast("long"),
        }
    )


def acs_raw(payloads: DataFrame) -> DataFrame:
    """Poverty, income, education and housing counts with four derived shares."""
    df = lower_names(payloads.withColumnsRenamed(ACS_VARIABLES))
    df = df.withColumns(
        {
            **{c: negative_to_null(to_numeric(F.col(c))) for c in ACS_VARIABLES.values()},
            "year": F.col("year").cast("long"),
            "county_fips": F.concat(zfill(F.col("state"), 2), zfill(F.col("county"), 3)),
            "state_fips": zfill(F.col("state"), 2),
        }
    )
    return df.withColumns(acs_shares())


def acs_shares() -> dict[str, Column]:
    """Shares of each universe; null where the universe is zero."""
    hs_plus = F.col("edu_hs_diploma") + F.col("edu_bachelors")
    return {
        "poverty_rate": safe_ratio(F.col("n_below_poverty"), F.col("poverty_universe")),
        "pct_bachelors_plus": safe_ratio(F.col("edu_bachelors"), F.col("edu_universe")),
        "pct_hs_plus": safe_ratio(hs_plus, F.col("edu_universe")),
        "pct_severe_rent_burden": safe_ratio(F.col("renters_severe_burden"), F.col("renters_total")),
    }


def county_series(series: DataFrame) -> DataFrame:
    """County-level series of the wanted measures with their place codes."""
    wanted = (F.col("area_type_code") == BLS_COUNTY_AREA) & F.col("measure_code").isin(*BLS_MEASURES)
    state, county = area_state(F.col("area_code")), area_county(F.col("area_code"))
    return series.filter(wanted).select(
        "series_id",
        "measure_code",
        F.concat(state, county).alias("county_fips"),
        state.alias("state_fips"),
        county.alias("county_fips_within_state"),
    )


def annual_values(data: DataFrame, years: Sequence[int] = tuple(BLS_YEARS)) -> DataFrame:
    """Annual averages of the wanted years, still as text."""
    return data.filter(
        (F.col("period") == BLS_ANNUAL) & F.col("year").try_cast("int").isin(*years)
    ).select("series_id", F.col("year").cast("long").alias("year"), "value")


def bls_raw(series: DataFrame, data: DataFrame, years: Sequence[int] = tuple(BLS_YEARS)) -> DataFrame:
    """Unemployment rate, unemployed and labor force side by side per county and year.

    Observations of other series are left out by the join with the wanted series, which is small next to them, before
    anything is shuffled for the aggregation. Among several series of one county and measure the lowest series id
    counts; of repeated observations of one series and year, which the source should not have, the lowest value.
    """
    ranks = Window.partitionBy("county_fips", "measure_code").orderBy("series_id")
    wanted = county_series(series).withColumn("series_rank", F.dense_rank().over(ranks))
    observed = annual_values(data, years).withColumn("value", to_numeric(F.col("value"))).filter(F.col("value").isNotNull())
    index = ["county_fips", "state_fips", "county_fips_within_state", "year"]
    reduced = observed.join(wanted, "series_id").groupBy(*index, "measure_code", "series_rank").agg(F.min("value").alias("value"))
    return pivot_measures(reduced, index, "measure_code", "value", BLS_MEASURES, "series_rank")


def ahrq_raw(resolved: DataFrame) -> DataFrame:
    """Health-infrastructure variables as numbers; all columns exist whatever the files held."""
    numbers = [c for c in AHRQ_ALIASES if c not in ("county_fips", "year")]
    return resolved.select(
        zfill(F.trim("county_fips"), 5).alias("county_fips"),
        to_year(F.col("year")).alias("year"),
        *[to_numeric(F.col(c)).alias(c) for c in numbers],
    )


def load_ahrq(
    spark: SparkSession, folder: str, skip_unreadable: bool = False, log: ScanLog | None = None
) -> DataFrame | None:
    """Every yearly file under a folder; None, with a warning, when none is usable.

    A file that cannot be read is an error, or with ``skip_unreadable`` left out with a warning.
    """
    files = list_files(spark, folder, AHRQ_FILES)
    resolved = read_drifting_csv(spark, files, AHRQ_ALIASES, skip_unreadable, log) if files else None
    if resolved is None:
        warnings.warn(f"{folder}: no usable yearly health file")
        return None
    return ahrq_raw(resolved)
