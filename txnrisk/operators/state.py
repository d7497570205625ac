"""Incremental state: high-water marks, affected keys and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnrisk.operators.skew import join_salted
from txnrisk.session import scratch

# Fixed value: the mark of a table that holds nothing yet.
FLOOR = "1900-01-01"

# A day with so many files below that size is written anew instead of given one more.
MOST_SMALL_FILES, SMALL_FILE = 8, 16 << 20


def watermark(state: DataFrame, ts: str) -> DataFrame:
    """One row: the latest ``ts`` of the state, or the floor when empty."""
    floor = F.lit(FLOOR).cast(state.schema[ts].dataType)
    return state.agg(F.coalesce(F.max(ts), floor).alias("watermark"))


def new_rows(df: DataFrame, ts: str, state: DataFrame | None, state_ts: str | None = None) -> DataFrame:
    """Rows later than the state's high-water mark; all rows without a state.

    The mark stays a scalar subquery, evaluated once and pushed to the scan; on
    a table partitioned by day it prunes the partitions as well.
    """
    if state is None:
        return df
    mark = watermark(state, state_ts or ts).scalar()
    rows = df.filter(F.col(ts) > mark)
    return rows.filter(F.col("event_date") >= F.to_date(mark)) if "event_date" in df.columns else rows


def affected(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def history_of(df: DataFrame, keys: DataFrame, key: str, heavy: Sequence = (),
               spread: str = "transaction_id") -> DataFrame:
    """All rows of the given keys; rows of heavy ones are joined in parts."""
    return join_salted(df, keys.select(key).distinct(), key, spread, heavy=heavy, how="left_semi")


def upsert(state: DataFrame | None, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State rows whose key is not in the batch, and the batch."""
    if state is None:
        return batch
    return state.join(batch.select(*keys), list(keys), "left_anti").unionByName(batch)


def replace_keys(state: DataFrame | None, keys: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """State rows of other keys, and ``rows``, all there is now of ``keys``.

    Unlike an upsert this drops a key that has no rows any more.
    """
    return rows if state is None else state.join(keys.select(key).distinct(), key, "left_anti").unionByName(rows)


def append(state: DataFrame | None, batch: DataFrame) -> DataFrame:
    return batch if state is None else state.unionByName(batch)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as a table folder and read it back."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_event_date(df: DataFrame, ts: str = "transaction_date") -> DataFrame:
    return df.withColumn("event_date", F.to_date(ts))


def write_by_day(df: DataFrame, path: str, mode: str = "overwrite", partition: str = "event_date") -> None:
    """Write one folder per day. The rebalance gives each day few files and
    splits a day too large for one task."""
    df.hint("rebalance", partition).write.mode(mode).partitionBy(partition).parquet(path)


def upsert_partitions(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                      partition: str = "event_date", days: Sequence | None = None, staged: bool = False,
                      stored: DataFrame | None = None, holding: Sequence | None = None) -> list:
    """Keyed upsert into a partitioned table that rewrites touched days only.

    Touched are the days of the batch and the days that hold an older row of
    one of its keys. Finding the latter reads the key column of the table,
    unless the caller knows the touched ``days``. ``staged`` says that the batch
    comes straight from a written table and need not be written once more;
    ``stored`` names the only keys of the batch that the table may hold, so that
    few re-sent rows do not make the whole days shuffle, and ``holding`` the only
    days that may hold them: to others the batch is added, which costs what it
    holds and not what the day holds. Returns the touched days.
    """
    staged_batch = batch if staged else write_table(batch, scratch(spark, "upsert-batch"))
    state = spark.read.schema(batch.schema).parquet(path)
    if days is None:
        older = history_by_keys(state.select(*keys, partition), staged_batch, keys).select(partition)
        days = [r[0] for r in staged_batch.select(partition).union(older).distinct().collect()]
    if not days:
        return []
    rewritten, added = to_rewrite(spark, path, days, holding, partition)
    if rewritten:
        touched = state.filter(F.col(partition).isin(rewritten))
        replaced = staged_batch if stored is None else stored
        kept = touched.join(replaced.select(*keys), list(keys), "left_anti")
        fresh = staged_batch.filter(F.coalesce(~F.col(partition).isin(added), F.lit(True))) if added else staged_batch
        overwrite_days(spark, path, kept.unionByName(fresh), rewritten, partition)
    if added:
        write_by_day(staged_batch.filter(F.col(partition).isin(added)), path, "append", partition)
    return sorted(days)


def to_rewrite(spark: SparkSession, path: str, days: Sequence, holding: Sequence | None = None,
               partition: str = "event_date") -> tuple[list, list]:
    """``days`` in two lists: to write anew, and to add rows to.

    Written anew are the days ``holding`` rows that go (all, if not given), those without a date, and those with many small files.
    """
    def crowded(day) -> bool:
        return sum(size < SMALL_FILE for size in _files(spark, f"{path}/{partition}={day}").values()) >= MOST_SMALL_FILES

    rewritten = [day for day in days if holding is None or day is None or day in holding or crowded(day)]
    return rewritten, [day for day in days if day not in rewritten]


def overwrite_days(spark: SparkSession, path: str, rows: DataFrame, days: Sequence, partition: str = "event_date") -> None:
    """Make ``rows`` all there is of ``days`` in the table at ``path``, in few files a day; other days stay as they are.

    ``rows`` may read the table itself: a dynamic overwrite writes beside it and swaps the days in once all are written.
    """
    folders = [f"{path}/{partition}={day}" for day in days]
    held = [_files(spark, folder) for folder in folders]
    (rows.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))
    # A day without rows must end up empty, which a dynamic overwrite cannot express: its files are still those from before.
    for folder, files in zip(folders, held):
        if files and files == _files(spark, folder):
            _drop_partition(spark, folder)


def history_by_keys(df: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(batch.select(*keys).distinct(), list(keys), "left_semi")


def _files(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names of the files in a folder, whose writer gives each a new one, and their sizes; none if it is not there."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {found.getPath().getName(): found.getLen() for found in system.listStatus(location)} if system.exists(location) else {}


def _drop_partition(spark: SparkSession, path: str) -> None:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)
