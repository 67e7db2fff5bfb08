"""The data checks of every table: 22 not_null, 9 unique, 3 accepted_values, 2 relationships, 3 between
and one cross-column invariant."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame

from countypanel.operators.quality import Check
from countypanel.sources.reference_data import ERA_ORDER


def _not_null(*columns: str) -> list[Check]:
    return [Check("not_null", c) for c in columns]


def era_names(eras: DataFrame) -> list[str]:
    """Names in a table of eras, of which there are a handful."""
    return sorted(r["era_name"] for r in eras.select("era_name").distinct().collect() if r["era_name"] is not None)


# What each column has to satisfy.
CHECKS: dict[str, list[Check]] = {
    "stg_sahie": [
        *_not_null("county_year_key", "county_fips", "state_fips", "year"),
        Check("unique", "county_year_key"),
        Check("accepted_values", "year", values=tuple(range(2017, 2023))),
        Check("between", "pct_uninsured", low=0, high=1, where="pct_uninsured is not null"),
    ],
    "stg_bls": [
        *_not_null("county_year_key", "county_fips", "state_fips", "year", "unemployment_rate"),
        Check("unique", "county_year_key"),
        Check("between", "unemployment_rate", low=0, high=60),
    ],
    "stg_acs": [
        *_not_null("county_year_key", "county_fips"),
        Check("unique", "county_year_key"),
        Check("between", "poverty_rate", low=0, high=1, where="poverty_rate is not null"),
    ],
    "stg_ahrq": [Check("not_null", "county_fips", where="county_fips is not null")],
    "dim_county": [
        *_not_null("county_fips", "state_fips", "is_expansion_state"),
        Check("unique", "county_fips"),
    ],
    "dim_year": [
        *_not_null("year"),
        Check("unique", "year"),
        Check("accepted_values", "era_name", values=tuple(ERA_ORDER), where="era_name is not null"),
    ],
    "fct_county_year": [
        *_not_null("county_year_key", "county_fips", "year"),
        Check("unique", "county_year_key"),
        Check("relationships", "county_fips", parent="dim_county", parent_column="county_fips"),
        Check("relationships", "year", parent="dim_year", parent_column="year"),
        Check("part_of_whole", "n_uninsured", parent_column="sahie_total_population"),
    ],
    "state_fips_lookup": [*_not_null("state_fips"), Check("unique", "state_fips")],
    "policy_eras": [*_not_null("era_name"), Check("unique", "era_name")],
    "medicaid_expansion_status": [
        *_not_null("state_fips"),
        Check("unique", "state_fips"),
        Check("accepted_values", "expansion_status", values=("expanded", "not_expanded")),
    ],
}


def checks(eras: Sequence[str]) -> dict[str, list[Check]]:
    """The checks with these era names as the accepted ones."""

    def own(check: Check) -> Check:
        return replace(check, values=tuple(eras)) if (check.kind, check.column) == ("accepted_values", "era_name") else check

    return {table: [own(check) for check in rules] for table, rules in CHECKS.items()}
