"""Analyses that are described for this panel only by name; the definitions are this package's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countypanel.functions.ratios import sum_when
from countypanel.functions.scalars import safe_ratio
from countypanel.plans.analysis import county_changes, largest_changes
from countypanel.plans.metrics import METRICS, metric

OUTCOMES = [
    "weighted_avg_pct_uninsured",
    "weighted_avg_unemployment_rate",
    "weighted_avg_poverty_rate",
    "weighted_avg_pct_severe_rent_burden",
]


def expansion_phase(years_since: Column) -> Column:
    return (
        F.when(years_since.isNull(), "never")
        .when(years_since < 0, "pre")
        .when(years_since <= 1, "adoption")
        .otherwise("post")
    )


def expansion_exposure(fct: DataFrame, county: DataFrame) -> DataFrame:
    """Years since Medicaid expansion and its phase for every county-year."""
    years = F.col("year") - F.col("expansion_year")
    exposed = fct.select("county_fips", "year").join(
        county.select("county_fips", "expansion_status", "expansion_year"), "county_fips"
    )
    return exposed.select(
        "county_fips", "year", "expansion_status", "expansion_year",
        years.alias("years_since_expansion"), expansion_phase(years).alias("expansion_phase"),
    )


def era_by_expansion(fct: DataFrame, county: DataFrame, year: DataFrame) -> DataFrame:
    names = OUTCOMES + ["weighted_avg_pct_bachelors_plus", "weighted_avg_pct_hs_plus"]
    return metric(fct, names, ["era_name", "expansion_status"], county, year)


def diff_in_diff(
    fct: DataFrame, county: DataFrame, year: DataFrame, before: str = "Trump1", after: str = "Biden"
) -> DataFrame:
    """Change among expansion states minus change among the others, one row per outcome.

    The fact is summed per county and era first; one conditional aggregation then gives all four cells.
    """
    metrics = [METRICS[n] for n in OUTCOMES]
    parts = {name: column for m in metrics for name, column in m.parts().items()}
    per_county = (
        fct.join(year.select("year", "era_name"), "year")
        .filter(F.col("era_name").isin(before, after))
        .groupBy("county_fips", "era_name")
        .agg(*[column.alias(name) for name, column in parts.items()])
        .join(county.select("county_fips", "is_expansion_state"), "county_fips")
    )

    def cell(name: str, treated: bool, era: str) -> Column:
        inside = (F.col("is_expansion_state") == treated) & (F.col("era_name") == era)
        top, bottom = [sum_when(inside, F.col(f"`{p}`")) for p in METRICS[name].parts()]
        return safe_ratio(top, bottom)

    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("outcome"),
                cell(name, True, before).alias("expanded_before"),
                cell(name, True, after).alias("expanded_after"),
                cell(name, False, before).alias("other_before"),
                cell(name, False, after).alias("other_after"),
            )
            for name in OUTCOMES
        ]
    )
    cells = per_county.agg(rows.alias("rows")).select(F.inline("rows"))
    change = (F.col("expanded_after") - F.col("expanded_before")) - (F.col("other_after") - F.col("other_before"))
    return cells.withColumn("diff_in_diff", change)


def county_series(trends: DataFrame, county_fips: str) -> DataFrame:
    """All years of one county."""
    return trends.filter(F.col("county_fips") == county_fips).orderBy("year")


def unemployment_correlation(trends: DataFrame) -> DataFrame:
    """Correlation of unemployment with uninsurance by era and expansion status."""
    return trends.groupBy("era_name", "expansion_status").agg(
        F.corr("unemployment_rate", "pct_uninsured").alias("correlation"),
        F.count_if(F.col("unemployment_rate").isNotNull() & F.col("pct_uninsured").isNotNull()).alias("n_pairs"),
    )


def year_change(
    fct: DataFrame, county: DataFrame, year: DataFrame, before: int, after: int, limit: int = 50
) -> DataFrame:
    """Counties whose uninsurance worsened most between two years."""
    changes = county_changes(fct, county, year, "year", before, after, ("before", "after"))
    return largest_changes(changes, "change_pct_uninsured", "county_fips", limit)
