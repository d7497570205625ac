"""Declarative data-quality checks, a report and a gate.

All row-level checks of a table run in a single aggregate over one scan; each
uniqueness or relationship check adds one grouped pass over its key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    """One declared check; declaring needs no session."""

    kind: str
    column: str
    arguments: tuple = ()

    @property
    def row_level(self) -> bool:
        return self.kind not in ("unique", "relationships")

    def failing(self) -> Column:
        """True for the rows a row-level check rejects."""
        column = F.col(self.column) if self.kind != "expression_is_true" else F.expr(self.column)
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "accepted_values":
            return ~column.isin(list(self.arguments))
        if self.kind == "expression_is_true":
            return ~column
        if self.kind == "accepted_range":
            low, high = self.arguments
            below = F.lit(False) if low is None else column < low
            return below if high is None else below | (column > high)
        raise ValueError(f"{self.kind} is not a row-level check")


def not_null(column: str) -> Check:
    return Check("not_null", column)


def unique(column: str) -> Check:
    """Fails on every value that occurs more than once; NULL is ignored."""
    return Check("unique", column)


def accepted_values(column: str, values: Sequence) -> Check:
    """NULL passes."""
    return Check("accepted_values", column, tuple(values))


def accepted_range(column: str, low=None, high=None) -> Check:
    """Both bounds inclusive, either may be missing; NULL passes."""
    return Check("accepted_range", column, (low, high))


def expression(sql: str) -> Check:
    """Fails on rows where the expression is false; NULL passes."""
    return Check("expression_is_true", sql)


def relationship(column: str, parent: str, parent_column: str) -> Check:
    """Fails on rows whose non-NULL value is missing from the parent table."""
    return Check("relationships", column, (parent, parent_column))


def duplicates(df: DataFrame, column: str) -> DataFrame:
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("copies"))
            .filter(F.col("copies") > 1))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values without a parent and their row counts; counted before the join,
    so a frequent value is one row in it."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("row_count"))
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return counted.join(keys, column, "left_anti")


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows a row-level check rejects."""
    return df.filter(check.failing())


def _row_level(name: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counts = df.agg(*[F.count_if(c.failing()).alias(f"_{i}") for i, c in enumerate(checks)])
    results = F.array(*[
        F.struct(F.lit(name).alias("table_name"), F.lit(c.column).alias("column_name"),
                 F.lit(c.kind).alias("check_name"), F.col(f"_{i}").alias("failures"))
        for i, c in enumerate(checks)])
    return counts.select(F.inline(results))


def _result(name: str, check: Check, counted: DataFrame, failures: Column) -> DataFrame:
    return counted.agg(failures.alias("failures")).select(
        F.lit(name).alias("table_name"), F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"), "failures")


def report(tables: Mapping[str, DataFrame], checks: Mapping[str, Sequence[Check]]) -> DataFrame:
    """One row per check: table_name, column_name, check_name, failures."""
    parts = []
    for name, declared in checks.items():
        df = tables[name]
        row_level = [c for c in declared if c.row_level]
        if row_level:
            parts.append(_row_level(name, df, row_level))
        for check in declared:
            if check.kind == "unique":
                parts.append(_result(name, check, duplicates(df, check.column), F.count("*")))
            elif check.kind == "relationships":
                parent, parent_column = check.arguments
                missing = orphans(df, check.column, tables[parent], parent_column)
                parts.append(_result(name, check, missing, F.coalesce(F.sum("row_count"), F.lit(0))))
    return reduce(DataFrame.unionByName, parts)


class QualityError(RuntimeError):
    """Raised by the gate; carries the failed checks."""

    def __init__(self, failed):
        self.failed = failed
        listed = "; ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures}" for r in failed)
        super().__init__(f"{len(failed)} data-quality checks failed: {listed}")


def gate(result: DataFrame) -> int:
    """Raise when a check failed; return the number of checks otherwise.

    The report holds one row per declared check, which is all that is fetched.
    """
    return judged(result.collect())


def judged(rows: Sequence) -> int:
    """What ``gate`` does, of the fetched rows of one report or more."""
    failed = [r for r in rows if r.failures]
    if failed:
        raise QualityError(failed)
    return len(rows)
