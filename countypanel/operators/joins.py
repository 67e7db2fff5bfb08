"""Joins, each written so that a repeated key does not land in one task.

No join here carries a broadcast hint: literal lookups have an exact size, and for everything else Spark
compares the size with ``spark.sql.autoBroadcastJoinThreshold``, again at run time under AQE.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lookup(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Many-to-one left join; rows without a match get nulls."""
    return df.join(table, key, "left")


def _ordered(c: Column, kind: T.DataType) -> Column:
    """A column as a double that never falls where the column, in the order in which Spark compares it, doesn't; zero has one sign."""
    return (F.unix_micros(c.cast("timestamp")) if isinstance(kind, (T.DateType, T.TimestampType)) else c).cast("double") + F.lit(0.0)


#: Rows that a cell of the range join holds on average; few rows make FEW_CELLS smaller ones, so that tasks share the intervals.
CELL_ROWS, FEW_CELLS, MOST_CELLS = 1024, 256, 50_000
#: Rows of the sample for each cell.
PICKED_FROM = 8
#: Intervals times cells from which on a range join sorts both sides, as an estimate before the run doesn't see how often they are listed.
LISTED_ROWS = 1_000_000


def _cuts(values: DataFrame) -> list[float]:
    """Where the cells of doubles end, so that each has about as many rows; a value of more rows than that has its own cell."""
    rows = values.count()
    cells = min(MOST_CELLS, max(rows // CELL_ROWS, min(rows, FEW_CELLS)))
    if cells < 2:
        return []
    picked = values.sample(min(1.0, cells * PICKED_FROM / rows), seed=7).toPandas().iloc[:, 0].to_numpy()
    picked = np.sort(picked[~np.isnan(picked)])
    picked = picked[:: max(1, len(picked) // cells)]
    cuts, times = np.unique(picked, return_counts=True)
    cuts = np.unique(np.concatenate([cuts, np.nextafter(cuts[times > 1], np.inf)]))
    return cuts[np.isfinite(cuts)].tolist()


def _cell(df: DataFrame, value: Column, cuts: list[float], name: str) -> DataFrame:
    """df with the number of the cell of a double; null for null, and NaN lies above all cells, as Spark compares it."""
    if not cuts:
        return df.withColumn(name, F.when(value.isNotNull(), 0))
    search = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol=name, outputCol=f"{name}_found", handleInvalid="keep")
    found = search.transform(df.withColumn(name, F.coalesce(value, F.lit(0.0))))
    return found.withColumn(name, F.when(value.isNotNull(), F.col(f"{name}_found").cast("int"))).drop(f"{name}_found")


def range_lookup(df: DataFrame, value: Column, intervals: DataFrame, start: str, end: str) -> DataFrame:
    """Left range join: every interval with start <= value <= end, inclusive; nulls where there is none.

    The values are cut into cells of about as many rows each, the cuts being picked from a sample of them. A row lies in one
    cell, an interval is listed in every cell from that of its start to that of its end, and one equi-join on the cell takes all.
    So a row is shuffled once, a match never. An interval is listed beyond its first and last cell only in cells whose rows all match it,
    and a row meets no other intervals in vain than those that start or end in its own cell. So there is never a nested
    loop. Cells only propose: the comparison itself is of the columns as they are. Planning counts the values and reads
    the sample, PICKED_FROM numbers a cell.

    Intervals that are null or end before they start match nothing. Values and bounds are numbers, dates or timestamps.
    """
    types = [df.select(value).schema[0].dataType, intervals.schema[start].dataType, intervals.schema[end].dataType]
    if not (all(isinstance(t, T.NumericType) for t in types) or all(isinstance(t, (T.DateType, T.TimestampType)) for t in types)):
        raise TypeError(f"numbers, dates and timestamps have an order that can be bucketed, not {[t.simpleString() for t in types]}")
    v, lo, hi = (_ordered(F.col(c), t) for c, t in zip(("_value", start, end), types, strict=True))
    rows, valid = df.withColumn("_value", value), intervals.filter(F.col(start) <= F.col(end))
    cuts = _cuts(rows.select(v.alias("_value")).filter("_value IS NOT NULL"))
    ends = _cell(_cell(valid, lo, cuts, "_first"), hi, cuts, "_last")
    listed = ends.withColumn("_cell", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")
    few = LISTED_ROWS // (len(cuts) + 2)
    if valid.limit(few + 1).count() > few:
        listed = listed.hint("merge")
    inside = F.col("_value").between(F.col(start), F.col(end))
    found = _cell(rows, v, cuts, "_own").join(listed, (F.col("_own") == F.col("_cell")) & inside, "left")
    return found.drop("_value", "_own", "_cell")


def present_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Semi join: rows whose key occurs on the other side."""
    return df.join(other.select(key), key, "left_semi")


def fan_out_left_join(left: DataFrame, right: DataFrame, keys: list[str], rows_per_task: int = 100_000) -> DataFrame:
    """Left join that keeps every copy when ``right`` repeats a key, also so often that one task couldn't take them.

    Spark splits a hot key of the left side by itself, but never one of the right side of a left join. Planning therefore counts
    the keys of ``right``. Without a key of over ``rows_per_task`` rows this is the plain join. Else the rows of such a key are
    spread over as many salts as it needs, the left rows of the key are repeated once per salt, and one join takes
    all. A left row of a split key has a match for sure, so where a salt has none its null row is dropped. Equal rows of ``right``, which
    no hash could tell apart, are counted before the join and listed again after it, at most ``rows_per_task`` from one row.
    """
    counted = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > rows_per_task)
    if counted.isEmpty():
        return left.join(right, keys, "left")
    hot = counted.select(*keys, F.ceil(F.col("_rows") / rows_per_task).alias("_salts"))
    copies = right.groupBy(*right.columns).agg(F.count(F.lit(1)).alias("_copies"))
    parts = copies.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / rows_per_task))))
    parts = parts.withColumn("_copies", F.least(F.lit(rows_per_task), F.col("_copies") - F.col("_part") * rows_per_task))
    spread = F.pmod(F.pmod(F.xxhash64(*right.columns), F.col("_salts")) + F.col("_part"), F.col("_salts"))
    salted = parts.join(hot, keys, "left").withColumn("_salt", F.coalesce(spread, F.lit(0))).drop("_salts", "_part")
    asked = left.join(hot, keys, "left")
    asked = asked.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1)))
    joined = asked.join(salted, [*keys, "_salt"], "left").filter("_salts IS NULL OR _copies IS NOT NULL")
    listed = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("_copies", F.lit(1)).cast("long"))))
    return listed.drop("_salts", "_salt", "_copies", "_copy")
