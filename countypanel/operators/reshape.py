"""Pivots, latest-row selection, renames and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pivot_measures(
    df: DataFrame,
    index: Sequence[str],
    code: str,
    value: str,
    measures: Mapping[str, str],
    order: str | Column,
) -> DataFrame:
    """One column per measure code: the first non-null value in ``order``.

    Conditional aggregates need one shuffle and reduce on the map side; every measure gets a column even
    where no row carries its code.
    """
    position = F.col(order) if isinstance(order, str) else order
    columns = [
        F.min_by(value, F.when((F.col(code) == key) & F.col(value).isNotNull(), position)).alias(name)
        for key, name in measures.items()
    ]
    return df.groupBy(*index).agg(*columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the greatest ``order`` per key; remaining columns break ties, nulls come last.

    A maximum over one struct is merged on the map side, so a hot key ships one row per task.
    """
    ranked = list(order) + [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_best"))
    return best.select(*keys, "_best.*").select(*df.columns)


def latest_per_key_window(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The same rows through ``row_number() = 1``, which Spark limits per task before the shuffle."""
    ranked = list(order) + [c for c in df.columns if c not in keys and c not in order]
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in ranked])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing from one frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def resolve_aliases(
    df: DataFrame, aliases: Mapping[str, Sequence[str]], types: Mapping[str, str] | None = None
) -> DataFrame:
    """Pick for each target the first alias that is a column of this frame.

    The choice depends on the columns alone, never on the values; absent targets become null columns.
    """
    types = types or {}
    present = {c.strip(): c for c in df.columns}

    def pick(target: str, names: Sequence[str]) -> Column:
        found = next((present[n] for n in names if n in present), None)
        source = F.col(f"`{found}`") if found is not None else F.lit(None)
        return source.cast(types.get(target, "string")).alias(target)

    return df.select(*[pick(target, names) for target, names in aliases.items()])
