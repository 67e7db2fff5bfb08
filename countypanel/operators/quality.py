"""Data checks. Each check selects the rows that break it; a report counts them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countypanel.operators.reshape import union_all
from countypanel.schemas import _schema
from countypanel.sources.reference_data import local_table


@dataclass(frozen=True)
class Check:
    """One rule on one column; ``where`` narrows it to some rows."""

    kind: str
    column: str
    values: tuple[Any, ...] = ()
    low: float | None = None
    high: float | None = None
    parent: str | None = None
    parent_column: str | None = None
    where: str | None = None


def _breaks(check: Check) -> Column:
    """True on the rows that break a row-level check; a null value breaks only ``not_null``."""
    value = F.col(check.column)
    if check.kind == "not_null":
        broken = value.isNull()
    elif check.kind == "accepted_values":
        broken = ~value.isin(*check.values)
    elif check.kind == "between":
        broken = ~value.between(check.low, check.high)
    elif check.kind == "part_of_whole":
        whole = F.col(check.parent_column)
        broken = (value < 0) | (whole < 0) | (value > whole)
    else:
        raise ValueError(f"not a row-level check: {check.kind}")
    broken = F.coalesce(broken, F.lit(False))
    return broken & F.coalesce(F.expr(check.where), F.lit(False)) if check.where else broken


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    return df.filter(_breaks(check))


def not_null(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    return failing_rows(df, Check("not_null", column, where=where))


def accepted_values(df: DataFrame, column: str, values: Sequence[Any], where: str | None = None) -> DataFrame:
    return failing_rows(df, Check("accepted_values", column, values=tuple(values), where=where))


def between(df: DataFrame, column: str, low: float, high: float, where: str | None = None) -> DataFrame:
    return failing_rows(df, Check("between", column, low=low, high=high, where=where))


def part_of_whole(df: DataFrame, part: str, whole: str) -> DataFrame:
    """Rows where a part is negative, its whole is negative, or the part exceeds the whole."""
    return failing_rows(df, Check("part_of_whole", part, parent_column=whole))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null keys that occur more than once, with their number of rows."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter("n_rows > 1")


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null child keys that the parent lacks, with their number of rows.

    Keys are counted before the anti join, so a hot key enters it as one row.
    """
    counted = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(parent_column).alias(column))
    return counted.join(known, column, "left_anti")


#: Kinds of checks that look at keys, not at rows by themselves.
KEY_CHECKS = ("unique", "relationships")


_LINES = _schema("number long, table_name string, check_name string, column_name string")


def _entries(name: str, df: DataFrame, numbered: Sequence[tuple[int, str, Check]]) -> DataFrame | None:
    """What a table tells the checks, from one scan: the keys they look at, and a mark for every row that breaks one.

    number: of the check. key: as text, null for a mark. is_parent: it comes from the table that a key must be in.
    """
    told: list[Column] = []

    def entry(number: int, key: Column, is_parent: bool, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(number).cast("long").alias("number"), key.cast("string").alias("key"), F.lit(is_parent).alias("is_parent")))

    for number, table, check in numbered:
        if table == name:
            column = F.col(check.column)
            if check.kind in KEY_CHECKS:
                told.append(entry(number, column, False, column.isNotNull()))
            else:
                told.append(entry(number, F.lit(None), False, _breaks(check)))
        if check.kind == "relationships" and check.parent == name:
            column = F.col(check.parent_column)
            told.append(entry(number, column, True, column.isNotNull()))
    return df.select(F.inline(F.array_compact(F.array(*told)))) if told else None


def run_checks(tables: Mapping[str, DataFrame], checks: Mapping[str, Sequence[Check]]) -> DataFrame:
    """Report over many tables: one row per check with the number of rows (or of repeated keys) that break it.

    Every table is read once, as a table with checks and as the parent of others. Its keys and its broken rows become
    entries, which one aggregation counts on the map side; what is shuffled is a number, a key and two counts. A repeated key is then one entry with a
    count over one, a missing parent one without the parent's mark. Row-level checks shuffle a count per task.
    """
    numbered = [(n, table, check) for n, (table, check) in enumerate((t, c) for t, rules in checks.items() for c in rules)]
    parts = [part for name, df in tables.items() if (part := _entries(name, df, numbered)) is not None]
    named = [(n, table, check.kind, check.column) for n, table, check in numbered]
    own = F.count_if(~F.col("is_parent")).alias("n_rows")
    counted = union_all(parts).groupBy("number", "key").agg(own, F.bool_or("is_parent").alias("has_parent"))

    def of(kind: str) -> Column:
        return F.col("number").isin(*[n for n, _, check in numbered if check.kind == kind])

    broken = F.when(of("unique"), (F.col("n_rows") > 1).cast("long")).when(of("relationships") & F.col("has_parent"), F.lit(0)).otherwise(F.col("n_rows"))
    failing = counted.groupBy("number").agg(F.sum(broken).alias("failing_rows"))
    lines = local_table(failing.sparkSession, named, _LINES)
    found = lines.join(failing, "number", "left")
    return found.select("table_name", "check_name", "column_name", F.coalesce("failing_rows", F.lit(0)).cast("long").alias("failing_rows"))


def check_table(table: str, df: DataFrame, checks: Sequence[Check], parents: Mapping[str, DataFrame]) -> DataFrame:
    """Report of one table."""
    needed = {check.parent for check in checks if check.kind == "relationships"}
    return run_checks({**{name: parents[name] for name in needed}, table: df}, {table: checks})
