"""Named tables: layers, replacement writes, and sources that may be missing."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countypanel.sources.reference_data import local_table

DEFAULT_LAYER = "main"


def layer_name(custom: str | None = None, default: str = DEFAULT_LAYER) -> str:
    """Database of a layer: the custom name as given, else the default."""
    return default if custom is None else custom.strip()


def table_name(name: str, layer: str | None = None) -> str:
    return f"{layer_name(layer)}.{name}"


def _counted(df: DataFrame, partition_by: tuple[str, ...]) -> tuple[DataFrame, Observation]:
    """The rows to write, counted on the way.

    A partitioned write is rebalanced first: small partitions end up in one file each, and a partition
    that holds much of the table is split over several tasks.
    """
    spread = df.hint("rebalance", *partition_by) if partition_by else df
    written = Observation()
    return spread.observe(written, F.count(F.lit(1)).alias("n_rows")), written


#: Property of a table's view that names the version it shows.
VERSION = "countypanel.version"


def replace_table(
    df: DataFrame,
    name: str,
    layer: str | None = None,
    partition_by: tuple[str, ...] = (),
    accept: Callable[[DataFrame, DataFrame], None] | None = None,
) -> int:
    """Replace a table and return its number of rows.

    The table is a view of its current version. A new version is written straight to the place where it stays, its rows
    counted on the way, and one statement then points the view to it, so a reader finds the old rows or the new ones at any time. The version
    before stays until the next replacement, for readers that have begun; older ones, and what broken runs have left, are dropped then.
    Statements don't grow with the partitions. One writer per table at a time.
    ``accept`` may refuse the new rows, given the old and the new table, by raising an error.
    """
    spark, target = df.sparkSession, table_name(name, layer)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer_name(layer)}")
    before = current_version(spark, name, layer)
    version = f"{target}__v{uuid.uuid4().hex}"
    spark.createDataFrame([], df.schema).write.partitionBy(*partition_by).saveAsTable(version)
    counted, written = _counted(df.select(*spark.table(version).columns), partition_by)
    counted.write.insertInto(version)
    if accept is not None and spark.catalog.tableExists(target):
        accept(spark.table(target), spark.table(version))
    if before is None and spark.catalog.tableExists(target):
        spark.sql(f"DROP TABLE {target}")  # a plain table, as other programs write it
    columns = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {target} TBLPROPERTIES ('{VERSION}' = '{version}') AS SELECT {columns} FROM {version}")
    _drop_versions(spark, name, layer, {version, before})
    return written.get["n_rows"]


def replace_partitions(df: DataFrame, name: str, layer: str | None = None, partition_by: tuple[str, ...] = ("year",)) -> int:
    """Replace only the partitions that ``df`` has rows of, keep the others, and return the number of rows written.

    The files of a partition are swapped when all of them are written. A reader that has begun on one of these
    partitions has to begin again; the other partitions are not touched. A table that doesn't exist is created.
    """
    spark = df.sparkSession
    version = current_version(spark, name, layer)
    if version is None:
        return replace_table(df, name, layer, partition_by)
    stored = spark.table(version)
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {version}").collect()}
    if "# Partition Information" not in described or tuple(stored.columns[-len(partition_by):]) != partition_by:
        raise ValueError(f"{table_name(name, layer)} is not stored by {list(partition_by)}")
    if sorted(stored.dtypes) != sorted(df.dtypes):
        raise ValueError(f"{table_name(name, layer)} has the columns {stored.dtypes}, not {df.dtypes}")
    counted, written = _counted(df.select(*stored.columns), partition_by)
    files = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    files.parquet(described["Location"])
    spark.sql(f"ALTER TABLE {version} RECOVER PARTITIONS")
    spark.catalog.refreshTable(version)
    return written.get["n_rows"]


def current_version(spark: SparkSession, name: str, layer: str | None = None) -> str | None:
    """The stored table that a replaced table shows; None where there is none."""
    target = table_name(name, layer)
    if not spark.catalog.tableExists(target):
        return None
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {target}").collect()}.get(VERSION)


def versions(spark: SparkSession, name: str, layer: str | None = None) -> set[str]:
    listed = spark.sql(f"SHOW TABLES IN {layer_name(layer)} LIKE '{name}__v*'").collect()
    return {table_name(r["tableName"], layer) for r in listed if re.fullmatch(re.escape(name.lower()) + "__v[0-9a-f]{32}", r["tableName"].lower())}


def drop_table(spark: SparkSession, name: str, layer: str | None = None) -> None:
    """Drop a replaced table and all its versions."""
    if spark.catalog.databaseExists(layer_name(layer)):
        spark.sql(f"DROP VIEW IF EXISTS {table_name(name, layer)}")
        _drop_versions(spark, name, layer, set())


def _drop_versions(spark: SparkSession, name: str, layer: str | None, keep: set[str | None]) -> None:
    for version in versions(spark, name, layer) - keep:
        spark.sql(f"DROP TABLE IF EXISTS {version}")


def write_files(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """Replace a Parquet folder and return its number of rows."""
    counted, written = _counted(df, partition_by)
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return written.get["n_rows"]


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, known as such while planning, so joins with it fold away."""
    return local_table(spark, [], schema)


def table_or_empty(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The table if it exists, else no rows with the columns its readers expect."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return empty_table(spark, schema)
