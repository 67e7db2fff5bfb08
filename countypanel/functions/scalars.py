"""Scalar Column helpers for codes, numbers and labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marker the Census uses for "not available".
CENSUS_MISSING = -666666666.0

# County part of a code that stands for a whole state.
STATE_TOTAL = "000"

# Policy event of a year.
POLICY_EVENTS = {
    2019: "ACA individual mandate penalty repealed",
    2020: "COVID-19: continuous coverage requirement (Mar)",
    2021: "American Rescue Plan ACA subsidy expansion",
    2023: "Medicaid unwinding begins (Apr)",
    2024: "Medicaid unwinding ends (Jun); enrollment drops",
    2025: "Trump2 Medicaid work requirements / DOGE cuts",
}


def fips_pad(code: Column, width: int) -> Column:
    """Zero-padded code of exactly ``width`` characters; longer input is cut on the right."""
    return F.lpad(code.cast("string"), width, "0")


def zfill(code: Column, width: int) -> Column:
    """Zero-padded code of at least ``width`` characters; longer input stays whole."""
    text = code.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def state_part(county_fips: Column) -> Column:
    return F.left(county_fips, F.lit(2))


def county_part(county_fips: Column) -> Column:
    return F.right(county_fips, F.lit(3))


def area_state(area_code: Column) -> Column:
    """State code inside ``CN`` + state(2) + county(3) + padding."""
    return F.substring(area_code, 3, 2)


def area_county(area_code: Column) -> Column:
    return F.substring(area_code, 5, 3)


def is_state_total(county_fips: Column) -> Column:
    return county_part(county_fips) == STATE_TOTAL


def to_numeric(text: Column) -> Column:
    """Double from text, null where the text is no number; ``NaN`` in any spelling is none.

    The JVM also reads Java literals such as ``1d`` as numbers; those are refused here. Infinity stays.
    """
    trimmed = F.trim(text)
    return F.when(~trimmed.rlike("(?i)[0-9.][df]$|nan$"), trimmed.try_cast("double"))


def to_year(text: Column) -> Column:
    """Whole year from text that may be written ``2017`` or ``2017.0``."""
    return to_numeric(text).try_cast("long")


def negative_to_null(value: Column) -> Column:
    return F.when(value >= 0, value)


def sentinel_to_null(value: Column, sentinel: float = CENSUS_MISSING) -> Column:
    return F.nullif(value, F.lit(sentinel))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is null for a zero or null denominator."""
    return F.try_divide(numerator, denominator)


def whole_code(value: Column) -> Column:
    """Integer code held in a double."""
    return F.round(value).cast("long")


def surrogate_key(*parts: str | Column) -> Column:
    """md5 over the parts joined by ``-``; null parts keep their place."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit("<null>")) for c in columns]))


def rural_flag(rucc: Column) -> Column:
    """Non-metro (4 and above) against metro (1-3); null for anything else."""
    return F.when(rucc >= 4, True).when(rucc.between(1, 3), False)


def expansion_flag(status: Column) -> Column:
    return F.when(status == "expanded", True).otherwise(False)


def label_of(value: Column, labels: Mapping[int, str]) -> Column:
    """Label of an integer; null where none is defined."""
    pairs = [F.lit(x) for key, label in labels.items() for x in (key, label)]
    return F.try_element_at(F.create_map(*pairs), value.cast("int"))


def trajectory_class(change: Column, threshold: float = 0.01) -> Column:
    """Direction of a change; a null change counts as stable."""
    return (
        F.when(change > threshold, "deteriorated")
        .when(change < -threshold, "improved")
        .otherwise("stable")
    )


def span_of(value: Column, spans: Iterable[tuple[str, int, int]], default: str) -> Column:
    """Name of the first inclusive span holding the value."""
    named = [F.when(value.between(lo, hi), F.lit(name)) for name, lo, hi in spans]
    return F.coalesce(*named, F.lit(default))


def rank_in(value: Column, order: Iterable[str]) -> Column:
    """1-based place in a fixed category order, 0 for unknown values."""
    return F.array_position(F.array(*[F.lit(o) for o in order]), value)
