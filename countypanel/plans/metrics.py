"""Named metrics over any slice of the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countypanel.functions.scalars import safe_ratio


@dataclass(frozen=True)
class Metric:
    """A ratio of sums, or the plain mean of ``numerator`` when there is no denominator."""

    name: str
    numerator: str
    denominator: str | None = None
    scale: float = 1.0

    def parts(self) -> dict[str, Column]:
        """Sums that add up over any split of the rows, by name."""
        if self.denominator is None:
            return {
                f"sum({self.numerator})": F.sum(F.expr(self.numerator)),
                f"count({self.numerator})": F.count(F.expr(self.numerator)),
            }
        return {f"sum({e})": F.sum(F.expr(e)) for e in (self.numerator, self.denominator)}

    def value(self) -> Column:
        """The metric of a group of rows."""
        top, bottom = self.parts().values()
        ratio = safe_ratio(top, bottom)
        return (ratio if self.scale == 1.0 else ratio * F.lit(self.scale)).alias(self.name)


# Metric names with what they divide or average.
METRICS = {
    m.name: m
    for m in (
        Metric("weighted_avg_pct_uninsured", "n_uninsured", "sahie_total_population"),
        Metric("weighted_avg_unemployment_rate", "unemployment_level", "labor_force_level"),
        Metric("weighted_avg_poverty_rate", "n_below_poverty", "poverty_universe"),
        Metric("weighted_avg_pct_bachelors_plus", "edu_bachelors", "edu_universe"),
        Metric("weighted_avg_pct_hs_plus", "edu_hs_diploma + edu_bachelors", "edu_universe"),
        Metric("weighted_avg_pct_severe_rent_burden", "renters_severe_burden", "renters_total"),
        Metric("avg_median_household_income", "median_household_income"),
        Metric("weighted_avg_mds_rate_per_100k", "total_mds", "total_population", 100000.0),
        Metric("avg_dist_trauma_center_miles", "dist_trauma_center_miles"),
        Metric("avg_dist_obstetrics_miles", "dist_obstetrics_miles"),
    )
}


@dataclass(frozen=True)
class Dimension:
    """A table joined many-to-one on ``key``, only when one of its columns is asked for."""

    table: DataFrame
    key: str


def evaluate(
    fct: DataFrame,
    metrics: Sequence[Metric],
    dims: Sequence[str] = (),
    dimensions: Sequence[Dimension] = (),
    where: Mapping[str, Any | Sequence[Any]] | None = None,
) -> DataFrame:
    """Metrics grouped by ``dims``, restricted to rows whose columns equal the values in ``where``.

    Dimensions are filtered before they are joined, a filtered one by an inner join. The fact then goes straight to the asked
    groups: the map side folds it to a few rows per task, and only those are shuffled. Dimensions that Spark can
    broadcast leave the fact where it was read.
    """
    where = where or {}
    asked = list(dict.fromkeys([*dims, *where]))
    joined_dims = [
        (d, [c for c in asked if c in d.table.columns and c not in fct.columns]) for d in dimensions
    ]
    joined_dims = [(d, columns) for d, columns in joined_dims if columns]
    unknown = set(asked) - set(fct.columns) - {c for _, columns in joined_dims for c in columns}
    if unknown:
        raise ValueError(f"unknown dimensions: {sorted(unknown)}")

    def restricted(df: DataFrame) -> DataFrame:
        for column, value in where.items():
            if column in df.columns:
                df = df.filter(F.col(column).isin(*value) if isinstance(value, (list, tuple, set)) else F.col(column) == value)
        return df

    sliced = restricted(fct)
    for dimension, columns in joined_dims:
        table = restricted(dimension.table.select(dimension.key, *columns))
        sliced = sliced.join(table, dimension.key, "inner" if set(columns) & set(where) else "left")
    return sliced.groupBy(*dims).agg(*[m.value() for m in metrics])


def metric(
    fct: DataFrame,
    names: Sequence[str],
    dims: Sequence[str] = (),
    county: DataFrame | None = None,
    year: DataFrame | None = None,
    where: Mapping[str, Any | Sequence[Any]] | None = None,
) -> DataFrame:
    """Metrics of the county panel by any column of its dimensions."""
    tables = [(county, "county_fips"), (year, "year")]
    dimensions = [Dimension(table, key) for table, key in tables if table is not None]
    return evaluate(fct, [METRICS[n] for n in names], dims, dimensions, where)
