"""Raw tables to staging: padded codes, strict types, the study window, and no state totals.

Each plan is a projection and a filter, so the year window and the column list reach the scan and nothing
is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countypanel import schemas
from countypanel.functions.scalars import (
    fips_pad,
    rural_flag,
    sentinel_to_null,
    state_part,
    surrogate_key,
    whole_code,
)
from countypanel.operators.filters import drop_state_totals, year_window

# Study window per source, inclusive; None leaves it open.
SAHIE_WINDOW = (2017, 2022)
BLS_WINDOW = (2017, 2024)
ACS_WINDOW = (2017, 2022)
AHRQ_WINDOW = (2017, None)


def _year() -> Column:
    return F.col("year").cast("long")


def _staged(df: DataFrame, schema) -> DataFrame:
    """Add the row key and put the columns in contract order."""
    keyed = df.withColumn("county_year_key", surrogate_key("county_fips", "year"))
    return keyed.select(*schema.names)


def stg_sahie(raw: DataFrame) -> DataFrame:
    """Uninsured and insured people per county and year; suppressed values stay null."""
    fips = fips_pad(F.col("geoid"), 5)
    uninsured, insured = F.col("nui_pt").try_cast("double"), F.col("nic_pt").try_cast("double")
    df = raw.filter(F.col("geoid").isNotNull()).select(
        fips.alias("county_fips"),
        state_part(fips).alias("state_fips"),
        F.col("name").alias("county_name"),
        _year().alias("year"),
        (F.col("pctui_pt").try_cast("double") / 100.0).alias("pct_uninsured"),
        uninsured.alias("n_uninsured"),
        insured.alias("n_insured"),
        (uninsured + insured).alias("sahie_total_population"),
    )
    return _staged(drop_state_totals(year_window(df, *SAHIE_WINDOW)), schemas.STG_SAHIE)


def stg_bls(raw: DataFrame) -> DataFrame:
    """Unemployment per county and year; rows without a rate are left out."""
    known = raw.filter(F.col("county_fips").isNotNull() & F.col("unemployment_rate").isNotNull())
    df = known.select(
        fips_pad(F.col("county_fips"), 5).alias("county_fips"),
        fips_pad(F.col("state_fips"), 2).alias("state_fips"),
        _year().alias("year"),
        *[F.col(c).cast("double") for c in ("unemployment_rate", "unemployment_level", "labor_force_level")],
    )
    return _staged(drop_state_totals(year_window(df, *BLS_WINDOW)), schemas.STG_BLS)


def stg_acs(raw: DataFrame) -> DataFrame:
    """Poverty, income, education and rent burden per county and year."""
    doubles = [f.name for f in schemas.STG_ACS if f.dataType.simpleString() == "double"]
    df = raw.filter(F.col("county_fips").isNotNull()).select(
        "county_fips",
        "state_fips",
        _year().alias("year"),
        *[F.col(c).cast("double").alias(c) for c in doubles],
    )
    df = df.withColumn("median_household_income", sentinel_to_null(F.col("median_household_income")))
    return _staged(drop_state_totals(year_window(df, *ACS_WINDOW)), schemas.STG_ACS)


def stg_ahrq(raw: DataFrame) -> DataFrame:
    """Healthcare access and rurality per county and year; state rows are kept."""
    measures = [
        "pct_uninsured_under65", "dist_trauma_center_miles", "dist_obstetrics_miles",
        "mds_rate_per_100k", "total_mds", "total_population",
    ]
    df = raw.filter(F.col("county_fips").isNotNull()).select(
        fips_pad(F.col("county_fips"), 5).alias("county_fips"),
        _year().alias("year"),
        *[F.col(c).cast("double").alias(c) for c in measures],
        whole_code(F.col("hpsa_primary_care")).alias("hpsa_primary_care"),
        whole_code(F.col("rural_urban_code_2013")).alias("rural_urban_code_2013"),
    )
    df = df.withColumn("is_rural", rural_flag(F.col("rural_urban_code_2013")))
    return _staged(year_window(df, *AHRQ_WINDOW), schemas.STG_AHRQ)
