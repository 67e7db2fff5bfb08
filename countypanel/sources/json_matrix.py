"""Landed JSON tables of the form ``[[name, ...], [value, ...], ...]``, one folder ``year=YYYY`` per year."""

from __future__ import annotations

import json
import re
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countypanel.operators.reshape import union_all
from countypanel.sources.delimited import list_files
from countypanel.sources.headers import first_lines

STRICT = {"mode": "FAILFAST"}


def landed_files(spark: SparkSession, root: str, years: Sequence[int]) -> list[str]:
    """Files of the wanted years. A missing year is reported; no year at all is an error."""
    by_year: dict[int, list[str]] = {}
    for file in list_files(spark, root, r"/year=\d{4}/"):
        by_year.setdefault(int(re.search(r"/year=(\d{4})/", file).group(1)), []).append(file)
    for year in years:
        if year not in by_year:
            warnings.warn(f"{root}: nothing landed for {year}")
    files = [file for year in years for file in by_year.get(year, [])]
    if not files:
        raise FileNotFoundError(f"{root}: nothing landed for any of {list(years)}")
    return files


def _with_year(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.col("year").cast("long"))


def read_payload_lines(
    spark: SparkSession, root: str, columns: Sequence[str], years: Sequence[int]
) -> DataFrame:
    """Files where each line is a whole payload, such as one state of one year.

    Values are taken by name from the payload's own header, so column order may differ between payloads.
    """
    files = landed_files(spark, root, years)
    matrix = F.from_json("value", "array<array<string>>", STRICT)
    payloads = spark.read.option("basePath", root).text(files).filter(F.length(F.trim("value")) > 0)
    rows = payloads.select("year", matrix.alias("m")).select(
        "year", F.get("m", F.lit(0)).alias("header"), F.explode(F.slice("m", F.lit(2), F.size("m"))).alias("row")
    )
    picked = [
        F.get("row", F.array_position("header", F.lit(c)).cast("int") - 1).alias(c) for c in columns
    ]
    return _with_year(rows.select(*picked, "year"))


def _row_text(line: Column) -> Column:
    """The inner array of a line, without the brackets and comma of the outer array."""
    opened = F.when(line.startswith("[["), F.substr(line, F.lit(2))).otherwise(line)
    ends = F.when(opened.endswith("]]") | opened.endswith("],"), 1).otherwise(0)
    return F.left(opened, F.length(opened) - ends)


def _header_names(line: str, file: str) -> tuple[str, ...]:
    names, end = json.JSONDecoder().raw_decode(line, 1)
    if line[end:].strip() not in ("", ",", "]"):
        raise ValueError(f"{file}: more than one row on a line; use read_payload_lines")
    return tuple(names)


def read_row_lines(
    spark: SparkSession, root: str, columns: Sequence[str], years: Sequence[int]
) -> DataFrame:
    """Files written one row per line, header first, as the Census service replies.

    A file splits over tasks like any text file. All headers are read by one job while planning, and files that share
    a header become one scan with fixed positions.
    """
    files = landed_files(spark, root, years)

    lines, errors = first_lines(spark, files)
    if errors:
        raise ValueError(f"unreadable: {errors}")
    headers = [_header_names(lines[file].strip() or "[[]]", file) for file in files]
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, names in zip(files, headers):
        groups.setdefault(names, []).append(file)

    def scan(names: tuple[str, ...], members: list[str]) -> DataFrame:
        lines = spark.read.option("basePath", root).text(members).select("year", F.trim("value").alias("line"))
        rows = lines.filter(~F.col("line").isin("", "[", "]")).select(
            "*", F.from_json(_row_text(F.col("line")), "array<string>", STRICT).alias("row")
        )
        same = F.col("row") == F.array(*[F.lit(n) for n in names])
        body = rows.filter(
            F.when(~F.col("line").startswith("[["), True)
            .when(same, False)
            .otherwise(F.raise_error(F.lit("a file holds payloads with different headers")).cast("boolean"))
        )
        picked = [
            (F.get("row", F.lit(names.index(c))) if c in names else F.lit(None).cast("string")).alias(c)
            for c in columns
        ]
        return _with_year(body.select(*picked, "year"))

    return union_all([scan(names, members) for names, members in groups.items()])
