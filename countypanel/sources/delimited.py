"""Delimited text: padded tab-separated files and per-year CSV files whose columns drift."""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countypanel.operators.reshape import resolve_aliases, union_all
from countypanel.sources.headers import column_names, first_lines, spread_files

MALFORMED = "_malformed"


def _is_malformed(scanned: DataFrame) -> Column:
    """Names a column of the file too, since Spark reads no file for the malformed lines alone."""
    first = F.coalesce(F.col(f"`{scanned.columns[0]}`"), F.lit(""))
    return F.coalesce(F.length(F.concat(F.col(MALFORMED), first)), F.lit(0)) > 0


class ScanLog:
    """Lines that scans set aside, by source; counted while the scan runs for whatever reads it."""

    def __init__(self) -> None:
        self._watched: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, source: str) -> DataFrame:
        """df, its malformed lines counted on the way."""
        lines = Observation()
        self._watched.append((source, lines))
        return df.observe(lines, F.count_if(_is_malformed(df)).alias("n_lines"))

    def take(self) -> dict[str, int]:
        """Lines set aside per source since the last call, where there are any. The scans must have run."""
        counts: dict[str, int] = {}
        for source, lines in self._watched:
            try:
                counts[source] = counts.get(source, 0) + lines.get["n_lines"]
            except Py4JJavaError:  # the result didn't need this scan, so it hasn't run
                continue
        self._watched = []
        return {source: n for source, n in counts.items() if n}

    def forget(self) -> None:
        """Drops what is watched; for scans that have not run."""
        self._watched = []


def _scan(spark: SparkSession, files: Sequence[str], names: Sequence[str], sep: str) -> DataFrame:
    """All-text columns, and the whole line where it has too few or too many fields or an open quote."""
    fields = [T.StructField(n, T.StringType()) for n in (*names, MALFORMED)]
    return (
        spark.read.schema(T.StructType(fields))
        .option("sep", sep)
        .option("header", True)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)  # or a line is only parsed up to the last wanted field, and counts as whole
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(list(files))
    )


def _well_formed(scanned: DataFrame, log: ScanLog | None, source: str) -> DataFrame:
    watched = scanned if log is None else log.watch(scanned, source)
    return watched.filter(~_is_malformed(scanned)).drop(MALFORMED)


def _tsv(spark: SparkSession, path: str) -> DataFrame:
    files = list_files(spark, path)
    if not files:
        raise FileNotFoundError(f"{path}: no file")
    lines, errors = first_lines(spark, files[:1])
    if errors:
        raise ValueError(f"no header in {path}: {errors}")
    return _scan(spark, [path], column_names(lines[files[0]], "\t"), "\t")


def read_padded_tsv(spark: SparkSession, path: str, log: ScanLog | None = None) -> DataFrame:
    """All-text tab-separated scan; padding around names and values is stripped while parsing.

    Lines with too few or too many fields, or with a quote that doesn't close, are set aside and counted in ``log``.
    """
    return _well_formed(_tsv(spark, path), log, path)


def malformed_tsv_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``read_padded_tsv`` sets aside."""
    scanned = _tsv(spark, path)
    return scanned.filter(_is_malformed(scanned)).select(F.col(MALFORMED).alias("line"))


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> list[str]:
    """Data files under a folder, at any depth, or under a glob, sorted; ``pattern`` is searched for in the whole path."""
    try:
        files = spark.read.option("recursiveFileLookup", True).text(path).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = []
    return sorted(f for f in map(unquote, files) if pattern is None or re.search(pattern, f, re.IGNORECASE))


def group_by_header(
    spark: SparkSession, files: Sequence[str], skip_unreadable: bool = False
) -> tuple[dict[tuple[str, ...], list[str]], list[str]]:
    """Files that share a header, and the files that could not be read; all headers are read by one job."""
    lines, errors = first_lines(spark, files)
    errors |= {file: "the file is empty" for file, line in lines.items() if not line.strip()}
    for file in sorted(errors):
        if not skip_unreadable:
            raise ValueError(f"no header in {file}: {errors[file]}")
        warnings.warn(f"skipped unreadable file {file}: {errors[file]}")
    return spread_files({f: lines[f] for f in files if f not in errors}), sorted(errors)


def read_drifting_csv(
    spark: SparkSession,
    files: Sequence[str],
    aliases: Mapping[str, Sequence[str]],
    skip_unreadable: bool = False,
    log: ScanLog | None = None,
) -> DataFrame | None:
    """Text columns of all files under their target names; None when no file can be used.

    Files with the same header become one scan, so the plan grows with the number of layouts and not
    with the number of files. Malformed lines are set aside and counted in ``log``.
    """
    groups, _ = group_by_header(spark, files, skip_unreadable)
    wanted = {name for names in aliases.values() for name in names}
    usable = []
    for header, members in groups.items():
        if wanted & set(header):
            usable.append(resolve_aliases(_well_formed(_scan(spark, members, header, ","), log, "yearly CSV files"), aliases))
        else:
            warnings.warn(f"no known column in {len(members)} file(s) such as {members[0]}")
    return union_all(usable) if usable else None
