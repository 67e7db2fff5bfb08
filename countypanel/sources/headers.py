"""First lines of many files, found in one job."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

FILES_PER_TASK = 200
_FIELDS = "file string, line string, error string, known boolean"
#: More than any file, so that a scan never splits one, and two never share a task.
_WHOLE_FILE = str(1 << 42)


def _opener() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Opens files where a task runs. Built here so that workers needn't have this package."""

    def first_line(file: str) -> str:
        from pyarrow import fs

        uri = re.sub("^file:/+", "file:///", file)
        system, path = fs.FileSystem.from_uri(quote(uri, safe="/:=@+,;~!$&'()*"))
        with system.open_input_stream(path, compression="detect", buffer_size=1 << 16) as stream:
            for line in io.TextIOWrapper(stream, "utf-8-sig"):
                if line.strip():
                    return line.rstrip("\r\n")
        return ""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file in batch.column(0).to_pylist():
                try:
                    rows.append((file, first_line(file), None, True))
                except pa.ArrowInvalid as error:  # a kind of store that only Spark reads
                    rows.append((file, None, str(error), False))
                except (OSError, UnicodeDecodeError, pa.ArrowException) as error:
                    rows.append((file, None, f"{type(error).__name__}: {error}", True))
            kinds = [pa.string(), pa.string(), pa.string(), pa.bool_()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["file", "line", "error", "known"])

    return opened


def _scanner() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first line that isn't blank; the rest of the file is not asked for."""
        for batch in batches:
            for at, line in enumerate(batch.column(0).to_pylist()):
                if line.strip():
                    yield batch.slice(at, 1)
                    return

    return scanned


def _uri(file: str) -> str:
    """Spark writes the start of a local path in two ways."""
    return re.sub("^file:/+", "file:///", file)


def _by_scan(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """Through Spark's own reader: a task per file, which ends after its first lines."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", _WHOLE_FILE)
    session.conf.set("spark.sql.files.openCostInBytes", _WHOLE_FILE)
    session.conf.set("spark.sql.files.ignoreCorruptFiles", "true")
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    lines = session.read.text(list(files)).select("value", "_metadata.file_path")
    return {_uri(unquote(r["file_path"])): r["value"] for r in lines.mapInArrow(_scanner(), "value string, file_path string").collect()}


def first_lines(spark: SparkSession, files: Sequence[str]) -> tuple[dict[str, str], dict[str, str]]:
    """The first line of each file that isn't blank, '' where there is none, and what went wrong with the other files.

    Ranges of files are the partitions of one job, whose tasks open each file and read its first block. Files in a store that
    only Spark's readers know are scanned, in one more job, by tasks that stop after the first line.
    """
    if not files:
        return {}, {}
    listed = spark.createDataFrame([(f,) for f in files], "file string")
    tasks = min(-(-len(files) // FILES_PER_TASK), spark.sparkContext.defaultParallelism)
    found = listed.coalesce(tasks).mapInArrow(_opener(), _FIELDS).collect()
    lines = {r["file"]: r["line"] for r in found if r["line"] is not None}
    errors = {r["file"]: r["error"] for r in found if r["known"] and r["line"] is None}
    rest = [r["file"] for r in found if not r["known"]]
    if rest:
        try:
            scanned = _by_scan(spark, rest)
            lines |= {file: scanned.get(_uri(file), "") for file in rest}
        except AnalysisException:  # some are missing
            for file in rest:
                try:
                    lines[file] = _by_scan(spark, [file]).get(_uri(file), "")
                except AnalysisException as error:
                    errors[file] = str(error)
    return lines, errors


def column_names(line: str, sep: str = ",") -> tuple[str, ...]:
    """Names in a header line, trimmed; a blank one is named by its position, and one that occurs again gets its position added."""
    names = [name.strip() for name in next(csv.reader([line], delimiter=sep))] if line.strip() else []
    lower = [n.lower() for n in names]
    return tuple(f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names))


def spread_files(lines: dict[str, str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Files that share their column names."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in lines.items():
        groups.setdefault(column_names(line, sep), []).append(file)
    return groups
