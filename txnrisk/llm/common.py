"""Helpers that the corpus operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.session import scratch

#: A word of the contracts: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package, and give them small batches.

    On a cluster the package is installed on the executors or passed as
    ``--py-files``. Documents are long, so the default of 10,000 rows per Arrow
    batch would hold much of them twice, in the JVM and in Python; a setting
    of the user's own stays.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "1000")
    environment = spark.sparkContext.environment
    if _ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, environment.get("PYTHONPATH")]))
    return spark


def staged(frame: DataFrame, label: str) -> DataFrame:
    """The same rows, written to the shared folder and read again.

    Cuts lineage, and later steps survive the loss of any executor.
    """
    spark = frame.sparkSession
    path = scratch(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that one holds about ``limit`` bytes of ``column`` or a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        first = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += size
        if first < len(sizes):
            yield batch.slice(first)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as Python strings, null as the empty text."""
    return [text or "" for text in batch.column(column).to_pylist()]


def word_count(text):
    """Number of words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh_names(frame: DataFrame, *names: str) -> list[str]:
    """The names, each changed where ``frame`` has such a column already."""
    taken, out = {column.lower() for column in frame.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
