"""Row filters shared by the conforming steps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countypanel.functions.scalars import is_state_total


def year_window(df: DataFrame, first: int, last: int | None = None, column: str = "year") -> DataFrame:
    """Keep the inclusive range; without ``last`` the range is open. Prunes partitions stored by year."""
    year = F.col(column)
    return df.filter(year >= first if last is None else year.between(first, last))


def drop_state_totals(df: DataFrame, fips: str = "county_fips") -> DataFrame:
    return df.filter(~is_state_total(F.col(fips)))


def all_people_rows(df: DataFrame) -> DataFrame:
    """Keep the all-ages, both-sexes, all-incomes estimate of each county."""
    return df.filter((F.col("agecat") == "0") & (F.col("sexcat") == "0") & (F.col("iprcat") == "0"))


def with_all(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows whose named columns are all present."""
    return df.dropna(how="any", subset=list(columns))
