"""Incremental pull from a relational landing table over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def pull_options(url: str, table: str, ts_column: str, since: str | None, partition_column: str, lower: str,
                 upper: str, partitions: int) -> dict[str, str]:
    """Reader options: the filter runs in the database, the range is split
    over ``partitions`` connections."""
    source = table if since is None else f"(select * from {table} where {ts_column} > '{since}') pulled"
    return {"url": url, "dbtable": source, "partitionColumn": partition_column, "lowerBound": lower,
            "upperBound": upper, "numPartitions": str(partitions), "fetchsize": "10000"}


def pull(spark: SparkSession, *, properties: Mapping[str, str] | None = None, **options) -> DataFrame:
    """Rows of the landing table later than ``since``; see :func:`pull_options`.

    Needs the database's JDBC driver on the class path.
    """
    return spark.read.format("jdbc").options(**pull_options(**options), **(properties or {})).load()
