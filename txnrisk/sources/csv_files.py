"""Daily CSV files: scan, write, and load-once bookkeeping."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnrisk.schemas import LEDGER_SCHEMA, RAW_COLUMNS, RAW_SCHEMA

log = logging.getLogger(__name__)

# Fixed value: the business date is part of a daily file's name.
BUSINESS_DATE_PATTERN = r"(?:transactions_|business_date=)(\d{4}-\d{2}-\d{2})"
SEED_NOTE = "present before the first load"

# What a failed job raises, depending on where in Spark it fails.
_JOB_ERRORS = (PySparkException, Py4JJavaError)


def _reader(spark: SparkSession, recursive: bool = True):
    return (spark.read.schema(RAW_SCHEMA).option("header", True)
            # The header is checked against the schema, not ignored.
            .option("enforceSchema", False).option("mode", "FAILFAST")
            .option("recursiveFileLookup", recursive))


def business_date(path: Column) -> Column:
    return F.to_date(F.nullif(F.regexp_extract(path, BUSINESS_DATE_PATTERN, 1), F.lit("")))


def _with_origin(df: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    return df.select(*RAW_COLUMNS, path.alias("file_path"), business_date(path).alias("business_date"))


def scan_csv(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """All rows of the CSV files below ``folder``, with their file and date."""
    return _with_origin(_reader(spark, recursive).option("pathGlobFilter", "*.csv").csv(folder))


def scan_business_date(spark: SparkSession, folder: str, date: str) -> DataFrame:
    """Rows of one business date: of its folder as ``write_daily_csv`` makes it, or else of ``transactions_<date>.csv``.

    No other date's files are opened.
    """
    own = f"{folder}/business_date={date}"
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
    if location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location):
        return _with_origin(_reader(spark).option("pathGlobFilter", "*.csv").csv(own))
    return _with_origin(_reader(spark).option("pathGlobFilter", f"transactions_{date}.csv").csv(folder))


def write_daily_csv(raw: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """CSV with a header, one folder per business date.

    The rebalance splits a date too large for one file and packs small ones.
    """
    stamped = raw.select(
        *[F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias(c)
          if c == "TransactionDate" else c for c in RAW_COLUMNS],
        F.to_date("TransactionDate").alias("business_date"))
    (stamped.hint("rebalance", "business_date").write.mode(mode).partitionBy("business_date")
     .option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(folder))


def list_files(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """Paths below ``folder``; the contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
            .option("recursiveFileLookup", recursive).load(folder)
            .select(F.col("path").alias("file_path")))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The load ledger, empty before the first load."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except PySparkException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def pending_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files the ledger does not list, by path."""
    return files.join(ledger.select("file_path"), "file_path", "left_anti")


def _record(entries: DataFrame, path: str) -> None:
    entries.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER_SCHEMA]).write.mode("append").parquet(path)


def seed_ledger(spark: SparkSession, folder: str, ledger_path: str) -> DataFrame:
    """Mark the files now present as loaded without loading them."""
    fresh = pending_files(list_files(spark, folder), read_ledger(spark, ledger_path))
    _record(fresh.select("file_path", F.lit(None).alias("rows_loaded"), F.current_timestamp().alias("loaded_at"),
                         F.lit(None).alias("load_id"), F.lit(SEED_NOTE).alias("note")), ledger_path)
    return read_ledger(spark, ledger_path)


def _load(spark: SparkSession, paths: Sequence[str], landing: str, ledger_path: str) -> None:
    load_id = uuid.uuid4().hex
    target = f"{landing}/load_id={load_id}"
    _with_origin(_reader(spark).csv(list(paths))).write.mode("overwrite").parquet(target)
    counts = spark.read.parquet(target).groupBy("file_path").agg(F.count("*").alias("rows_loaded"))
    # The ledger row makes the load visible; without it the folder is ignored.
    _record(spark.read.format("binaryFile").load(list(paths)).select(F.col("path").alias("file_path"))
            .join(counts, "file_path", "left")
            .select("file_path", F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"),
                    F.current_timestamp().alias("loaded_at"), F.lit(load_id).alias("load_id"),
                    F.lit(None).alias("note")), ledger_path)


def load_pending(spark: SparkSession, folder: str, landing: str, ledger_path: str, on_error: str = "raise") -> list:
    """Append the files not yet loaded to ``landing``; returns those that failed.

    All pending files load as one batch. With ``on_error="skip"`` a batch that
    fails is repeated file by file, so only the bad files stay pending.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError(f"on_error must be 'raise' or 'skip', not {on_error!r}")
    pending = pending_files(list_files(spark, folder), read_ledger(spark, ledger_path))
    paths = sorted(row.file_path for row in pending.collect())
    if not paths:
        return []
    try:
        _load(spark, paths, landing, ledger_path)
        return []
    except _JOB_ERRORS:
        if on_error == "raise":
            raise
    failed = []
    for path in paths:
        try:
            _load(spark, [path], landing, ledger_path)
        except _JOB_ERRORS as error:
            log.warning("%s not loaded: %s", path, str(error).splitlines()[0])
            failed.append(path)
    return failed


def read_landing(spark: SparkSession, landing: str, ledger_path: str) -> DataFrame:
    """Landed rows of the loads the ledger has recorded."""
    committed = read_ledger(spark, ledger_path).select("load_id").distinct()
    return spark.read.parquet(landing).join(committed, "load_id", "left_semi")
