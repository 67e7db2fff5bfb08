"""What the operators share: reading tables, storing intermediate ones, size-checked broadcasts."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def share_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did, if it isn't installed for them."""
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if top not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [top, known]))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local,")) and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"llm-{application}-")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Gives back to the system what a worker has freed: it lives on between tasks and would keep the memory of its largest."""
    gc.enable()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, a task's function over batches, after which the worker gives back to the system what the task has freed."""

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """df, marked for broadcasting if it has at most max_rows rows; beyond that Spark shuffles the join.

    df should be cheap to count, like a stored table; its rows must have a bounded width.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def text_of(column: str = "text") -> F.Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows that no model learns from: crc32 of the id as text, modulo 5, is zero."""
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def fold(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """doc_id, text, fold and label (int) of at most max_rows labelled rows, none of them held out.

    The bound keeps training independent of the corpus; ids are picked by a hash. Ids that are
    null or have contradicting labels are left out, and of several rows of an id the first by the hash of its text counts.
    """
    ids = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other").drop("other")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(ids), "doc_id")
    one = rows.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    return one.select("doc_id", F.col("first.text").alias("text"), "label", fold().alias("fold"))
