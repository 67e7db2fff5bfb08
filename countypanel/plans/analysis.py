"""Questions asked of the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countypanel.functions.ratios import sum_when
from countypanel.functions.scalars import rank_in, safe_ratio, span_of, trajectory_class
from countypanel.plans.star import star_join
from countypanel.sources.reference_data import ERA_ORDER, ERA_SPANS

# Panel measures, and those shown as percentages.
TREND_MEASURES = [
    "pct_uninsured", "unemployment_rate", "poverty_rate",
    "median_household_income", "pct_bachelors_plus", "pct_severe_rent_burden",
]
PERCENT_MEASURES = {
    "pct_uninsured", "unemployment_rate", "poverty_rate", "pct_bachelors_plus", "pct_severe_rent_burden",
}


def period_change(
    df: DataFrame,
    entity: str,
    before: Column,
    after: Column,
    ratios: Mapping[str, tuple[str, str]],
    labels: tuple[str, str] = ("before", "after"),
) -> DataFrame:
    """Ratios of sums per entity in two periods, and their difference.

    Both periods come out of one conditional aggregation. Entities seen in only one period are left out.
    """
    periods = dict(zip(labels, (before, after)))
    sums = [
        sum_when(inside, F.expr(expr)).alias(f"_{label}_{name}_{part}")
        for label, inside in periods.items()
        for name, pair in ratios.items()
        for part, expr in zip("nd", pair)
    ]
    seen = [F.count_if(inside).alias(f"_{label}_rows") for label, inside in periods.items()]
    both = F.lit(True)
    for label in labels:
        both = both & (F.col(f"_{label}_rows") > 0)
    totals = df.filter(before | after).groupBy(entity).agg(*sums, *seen).filter(both)

    columns: list[Column] = [F.col(entity)]
    for name in ratios:
        first, last = [
            safe_ratio(F.col(f"_{label}_{name}_n"), F.col(f"_{label}_{name}_d")) for label in labels
        ]
        columns += [
            first.alias(f"{labels[0]}_{name}"),
            last.alias(f"{labels[1]}_{name}"),
            (last - first).alias(f"change_{name}"),
        ]
    return totals.select(*columns)


def largest_changes(df: DataFrame, change: str, tiebreak: str, limit: int) -> DataFrame:
    """The top of a ranking; Spark keeps ``limit`` rows per task and merges those."""
    return df.orderBy(F.col(change).desc_nulls_last(), F.col(tiebreak).asc()).limit(limit)


ERA_RATIOS = {
    "pct_uninsured": ("n_uninsured", "sahie_total_population"),
    "poverty_rate": ("n_below_poverty", "poverty_universe"),
}


def county_labels(county: DataFrame) -> DataFrame:
    """One label row per county, whichever of several names it carries."""
    return county.groupBy("county_fips").agg(
        F.min("county_name").alias("county_name"),
        F.min("state_abbr").alias("state_abbr"),
        F.min("is_expansion_state").alias("is_expansion_state"),
    )


def county_changes(
    fct: DataFrame, county: DataFrame, year: DataFrame, column: str, before: object, after: object,
    labels: tuple[str, str],
) -> DataFrame:
    """Change of each county between two values of a year attribute, such as two eras.

    The fact is reduced to one row per county before the county labels are joined, so only that small
    result meets the dimension; several names of a county would scale both sums of a ratio alike.
    """
    known = fct.filter(F.col("n_uninsured").isNotNull())
    dated = known.join(year.select("year", *([] if column == "year" else [column])), "year")
    changes = period_change(
        dated, "county_fips", F.col(column) == before, F.col(column) == after, ERA_RATIOS, labels
    )
    joined = changes.join(county_labels(county), "county_fips")
    return joined.select(
        "county_fips", "county_name", "state_abbr", "is_expansion_state",
        *[c for c in changes.columns if c != "county_fips"],
        trajectory_class(F.col("change_pct_uninsured")).alias("uninsurance_trajectory"),
    )


def era_change_summary(
    fct: DataFrame, county: DataFrame, year: DataFrame,
    before: str = "Trump1", after: str = "Biden", limit: int = 50,
) -> DataFrame:
    """Counties whose uninsurance worsened most between two eras, worst first."""
    changes = county_changes(fct, county, year, "era_name", before, after, (before.lower(), after.lower()))
    return largest_changes(changes, "change_pct_uninsured", "county_fips", limit)


def county_year_trends(fct: DataFrame, county: DataFrame, year: DataFrame, ordered: bool = False) -> DataFrame:
    """Rates, labels and policy event of every county-year; sorted only to be shown as it is."""
    df = star_join(fct, county, year).select(
        "county_fips", "county_name", "state_abbr", "state_name", "census_region",
        "is_expansion_state", "expansion_status", "year", "era_name", "era_color_hex",
        safe_ratio(F.col("n_uninsured"), F.col("sahie_total_population")).alias("pct_uninsured"),
        safe_ratio(F.col("unemployment_level"), F.col("labor_force_level")).alias("unemployment_rate"),
        safe_ratio(F.col("n_below_poverty"), F.col("poverty_universe")).alias("poverty_rate"),
        "median_household_income",
        safe_ratio(F.col("edu_bachelors"), F.col("edu_universe")).alias("pct_bachelors_plus"),
        safe_ratio(F.col("renters_severe_burden"), F.col("renters_total")).alias("pct_severe_rent_burden"),
        "policy_event_label",
    )
    return df.orderBy("county_fips", "year") if ordered else df


def to_pct(df: DataFrame, columns: Sequence[str] = tuple(TREND_MEASURES)) -> DataFrame:
    """Shares among the columns as percentages; other measures stay as they are."""
    shares = [c for c in columns if c in PERCENT_MEASURES]
    return df.withColumns({c: F.col(c) * 100 for c in shares}) if shares else df


def mean_trend(
    trends: DataFrame, keys: Sequence[str], measures: Sequence[str] = tuple(TREND_MEASURES)
) -> DataFrame:
    """Unweighted mean of the county rates per group, in display units.

    Rows with a missing key are left out; a group whose rates are all missing keeps a null mean.
    """
    means = trends.dropna(subset=list(keys)).groupBy(*keys).agg(*[F.avg(m).alias(m) for m in measures])
    return to_pct(means, measures)


def trend_by_era(trends: DataFrame, measures: Sequence[str] = tuple(TREND_MEASURES)) -> DataFrame:
    return mean_trend(trends, ["year", "era_name"], measures)


def trend_by_expansion(trends: DataFrame, measures: Sequence[str] = tuple(TREND_MEASURES)) -> DataFrame:
    return mean_trend(trends, ["year", "expansion_status"], measures)


def trend_by_both(trends: DataFrame, measures: Sequence[str] = tuple(TREND_MEASURES)) -> DataFrame:
    df = mean_trend(trends, ["year", "era_name", "expansion_status"], measures)
    return df.withColumn("group", F.concat("era_name", F.lit(" / "), "expansion_status"))


#: The ways to split trends by era and expansion status.
TREND_GROUPINGS = (("year", "era_name"), ("year", "expansion_status"), ("year", "era_name", "expansion_status"))


def trend_all_groupings(
    trends: DataFrame, measures: Sequence[str] = tuple(TREND_MEASURES), groupings: Sequence[Sequence[str]] = TREND_GROUPINGS
) -> DataFrame:
    """The trends of several groupings from one pass over the county rates, with the keys that a row is grouped by.

    Every rate is listed once per grouping and folded on the map side, so one shuffle moves the groups alone. As in
    ``mean_trend``, rows with a missing key don't count in the groupings by that key.
    """
    keys = list(dict.fromkeys(k for grouping in groupings for k in grouping))
    sets = [[F.col(k) for k in grouping] for grouping in groupings]
    means = trends.groupingSets(sets, *keys).agg(*[F.avg(m).alias(m) for m in measures], *[F.grouping(k).alias(f"_{k}") for k in keys])
    complete = F.lit(True)
    for k in keys:
        complete = complete & ((F.col(f"_{k}") == 1) | F.col(k).isNotNull())
    named = F.concat_ws(", ", *[F.when(F.col(f"_{k}") == 0, k) for k in keys]).alias("grouped_by")
    return to_pct(means.filter(complete).select(named, *keys, *measures), measures)


def era_spans(eras: DataFrame) -> list[tuple[str, int, int]]:
    """Name, first and last year of the eras of a lookup table, of which there are a handful."""
    rows = eras.filter("start_year <= end_year").select("era_name", "start_year", "end_year").orderBy("start_year", "era_name").collect()
    return [tuple(r) for r in rows]


def era_of_year(year: Column, spans: Sequence[tuple[str, int, int]] = ERA_SPANS) -> Column:
    """Era that a year lies in, by default of the eras shipped with the package."""
    return span_of(year, spans, "pre-era")


def era_ordered(df: DataFrame, names: Sequence[str] = ERA_ORDER) -> DataFrame:
    """Rows in the order of the eras, then by year."""
    return df.withColumn("era_order", rank_in(F.col("era_name"), names)).orderBy("era_order", "year")


def map_slice(trends: DataFrame, year: int, measure: str, spans: Sequence[tuple[str, int, int]] = ERA_SPANS) -> DataFrame:
    """Display value of one measure for every county that has it in one year."""
    one = trends.filter(F.col("year") == year).dropna(subset=[measure])
    return to_pct(one, [measure]).select(
        "county_fips", "county_name", "state_abbr",
        F.col(measure).alias("display_value"), era_of_year(F.col("year"), spans).alias("era_label"),
    )


def available_years(trends: DataFrame) -> DataFrame:
    return trends.select("year").dropna().distinct().orderBy("year")
