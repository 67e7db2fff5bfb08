"""Star schema: county and year dimensions, and the county-year fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countypanel import schemas
from countypanel.functions.scalars import POLICY_EVENTS, expansion_flag, label_of, surrogate_key
from countypanel.operators.joins import fan_out_left_join, lookup, range_lookup
from countypanel.operators.reshape import latest_per_key

# Calendar years of the study.
FIRST_YEAR, LAST_YEAR = 2017, 2025

GRAIN = ["county_fips", "year"]


def expansion_lookup(expansion: DataFrame) -> DataFrame:
    """Expansion status per state; the flag is set before any join, so unknown states stay null."""
    return expansion.select(
        "state_fips",
        "expansion_status",
        F.col("expansion_year").try_cast("long").alias("expansion_year"),
        expansion_flag(F.col("expansion_status")).alias("is_expansion_state"),
    )


def distinct_counties(stg_sahie: DataFrame, latest_name: bool = False) -> DataFrame:
    """Counties of the spine. A renamed county has one row per name unless only the latest is wanted."""
    columns = ["county_fips", "state_fips", "county_name"]
    if not latest_name:
        return stg_sahie.select(*columns).distinct()
    dated = stg_sahie.select(*columns, "year")
    return latest_per_key(dated, ["county_fips"], ["year"]).select(*columns)


def dim_county(
    stg_sahie: DataFrame,
    stg_ahrq: DataFrame,
    states: DataFrame,
    expansion: DataFrame,
    latest_name: bool = False,
) -> DataFrame:
    """Geography, Medicaid expansion and latest rurality per county."""
    rurality = latest_per_key(
        stg_ahrq.select("county_fips", "year", "rural_urban_code_2013", "is_rural"), ["county_fips"], ["year"]
    ).drop("year")
    counties = distinct_counties(stg_sahie, latest_name)
    located = lookup(lookup(counties, states, "state_fips"), expansion_lookup(expansion), "state_fips")
    return lookup(located, rurality, "county_fips").select(*schemas.DIM_COUNTY.names)


def year_spine(spark: SparkSession, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    return spark.range(first, last + 1, 1, 1).withColumnRenamed("id", "year")


def dim_year(spark: SparkSession, eras: DataFrame) -> DataFrame:
    """Era, president and policy event of every study year; years outside all eras keep nulls."""
    years = range_lookup(year_spine(spark), F.col("year"), eras, "start_year", "end_year")
    return years.select(
        "year",
        "era_name",
        "president",
        F.col("color_hex").alias("era_color_hex"),
        label_of(F.col("year"), POLICY_EVENTS).alias("policy_event_label"),
    )


def fact(stg_sahie: DataFrame, stg_bls: DataFrame, stg_acs: DataFrame, stg_ahrq: DataFrame) -> DataFrame:
    """Numerators and denominators per county and year, led by the insurance spine.

    All inputs are joined on (county_fips, year), so each is shuffled once at most. Unemployment has one
    row per county-year by construction and the ACS by contract, which the unique check enforces. The
    health files may repeat a county-year; their copies fan out.
    """
    wanted = schemas.FACT.names

    def measures(df: DataFrame) -> DataFrame:
        return df.select(*GRAIN, *[c for c in df.columns if c in wanted and c not in (*GRAIN, "county_year_key")])

    joined = (
        measures(stg_sahie)
        .join(measures(stg_bls), GRAIN, "left")
        .join(measures(stg_acs), GRAIN, "left")
    )
    joined = fan_out_left_join(joined, measures(stg_ahrq), GRAIN)
    return joined.withColumn("county_year_key", surrogate_key(*GRAIN)).select(*wanted)


def star_join(fct: DataFrame, county: DataFrame, year: DataFrame) -> DataFrame:
    """Fact with both dimensions; rows of an unknown county or year vanish."""
    return fct.join(year, "year").join(county, "county_fips")
