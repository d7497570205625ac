"""Versioned (type 2) dimensions and the as-of lookup into them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnrisk.operators.skew import neighbour, slice_for, split_heavy
from txnrisk.functions.timing import slice_index
from txnrisk.schemas import SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO


def version_id(key: str, valid_from: str = VALID_FROM) -> Column:
    return F.md5(F.concat_ws("|", F.col(key), F.col(valid_from).cast("string")))


def scd2_apply(state: DataFrame | None, current: DataFrame, key: str, check_cols: Sequence[str],
               effective_ts: Column) -> DataFrame:
    """The version table after a snapshot of ``current`` at ``effective_ts``.

    A key seen for the first time opens a version; one whose checked columns
    changed (NULL-safe) has its open version closed and a new one opened; an
    unchanged or vanished key keeps its open version. A version opened at the
    very same instant is replaced, so repeating a run leaves no empty version.
    """
    columns = [SCD_ID, key, *check_cols, VALID_FROM, VALID_TO, UPDATED_AT]

    def opened(rows: DataFrame) -> DataFrame:
        started = rows.select(key, *check_cols, effective_ts.alias(VALID_FROM))
        return (started
                .withColumn(VALID_TO, F.lit(None).cast(started.schema[VALID_FROM].dataType))
                .withColumn(UPDATED_AT, F.col(VALID_FROM))
                .withColumn(SCD_ID, version_id(key))
                .select(*columns))

    if state is None:
        return opened(current)

    fresh = opened(current)
    is_open = F.col(VALID_TO).isNull()
    # Both sides hold one row per key, so the join cannot fan out.
    pairs = (state.filter(is_open).select(F.col(key).alias("_key"), F.struct(*columns).alias("_old"))
             .join(fresh.select(F.col(key).alias("_key"), F.struct(*columns).alias("_new")), "_key", "full_outer"))
    checked_old = F.struct(*[F.col(f"_old.{c}") for c in check_cols])
    checked_new = F.struct(*[F.col(f"_new.{c}") for c in check_cols])
    closed = F.struct(*[
        F.col(f"_new.{VALID_FROM}").alias(c) if c in (VALID_TO, UPDATED_AT) else F.col(f"_old.{c}").alias(c)
        for c in columns])
    versions = (F.when(F.col("_new").isNull(), F.array("_old"))
                .when(F.col("_old").isNull(), F.array("_new"))
                .when(checked_old.eqNullSafe(checked_new), F.array("_old"))
                .when(F.col(f"_old.{VALID_FROM}") == F.col(f"_new.{VALID_FROM}"), F.array("_new"))
                .otherwise(F.array(closed, F.col("_new"))))
    after = pairs.select(F.inline(versions))
    return state.filter(~is_open).select(*columns).unionByName(after)


def scd2_from_events(df: DataFrame, key: str, ts: str, check_cols: Sequence[str], tie: str, *,
                     heavy: Sequence = (), hours: int = 1) -> DataFrame:
    """Versions in event time: each is valid from the row that introduced it.

    Where several rows of a key share a timestamp the last one (by ``tie``)
    counts, so that no version has zero length.
    """
    rows = df.select(key, ts, tie, *check_cols).filter(F.col(key).isNotNull())
    return split_heavy(rows, key, heavy, lambda part: _versions(part, key, ts, check_cols, tie, (), hours),
                       lambda part: _versions(part, key, ts, check_cols, tie, heavy, hours))


def _versions(rows: DataFrame, key: str, ts: str, check_cols: Sequence[str], tie: str, heavy: Sequence,
              hours: int) -> DataFrame:
    if heavy:
        rows = rows.withColumn("_slice", slice_index(F.col(ts), hours))
    by_key = Window.partitionBy(key, *(["_slice"] if heavy else [])).orderBy(ts, tie)
    settled = (rows.withColumn("_next_ts", F.lead(ts).over(by_key))
               .filter(F.col("_next_ts").isNull() | (F.col("_next_ts") != F.col(ts))).drop("_next_ts", "_slice"))

    checked = F.struct(*check_cols)
    compared = neighbour(settled, key, [ts, tie], checked, "_before", heavy=heavy, hours=hours)
    changes = (compared.filter(F.col("_before").isNull() | ~checked.eqNullSafe(F.col("_before")))
               .drop("_before").withColumnRenamed(ts, VALID_FROM))
    ended = neighbour(changes, key, [VALID_FROM, tie], F.struct(F.col(VALID_FROM).alias("at")), "_after",
                      back=False, heavy=heavy, hours=hours)
    return (ended.withColumn(VALID_TO, F.col("_after.at"))
            .withColumn(SCD_ID, version_id(key))
            .select(SCD_ID, key, *check_cols, VALID_FROM, VALID_TO))


def current_rows(versions: DataFrame) -> DataFrame:
    return versions.filter(F.col(VALID_TO).isNull()).drop(VALID_TO, SCD_ID, UPDATED_AT)


def asof_join(df: DataFrame, versions: DataFrame, key: str, ts: str, tie: str, cols: dict[str, str], *,
              heavy: Sequence = (), hours: int = 1) -> DataFrame:
    """Left join each row to the version of its key valid at ``ts``.

    ``cols`` maps version columns to output names; ``tie`` is a non-NULL row
    id. A version holds from its start (inclusive) to its end (exclusive), an
    open one for ever; versions of a key must not overlap. Rows and versions
    are merged on the time line and each row takes the last version before it,
    so the cost is one sort however many versions a key has. Versions carry a
    NULL ``tie`` and so sort before the rows of their instant; the resulting
    partitioning and order by (key, ts, tie) serve later windows as they are.
    """
    version = F.struct(F.col(VALID_TO).alias("_until"), *[F.col(c).alias(out) for c, out in cols.items()])
    starts = versions.filter(F.col(key).isNotNull()).select(
        key, F.col(VALID_FROM).alias(ts), F.lit(False).alias("_is_row"), version.alias("_version"))
    rows = df.withColumn("_is_row", F.lit(True))
    parts = [key]
    if heavy:
        # A version of a heavy key is repeated in each slice it reaches into:
        # one copy per version and one per slice boundary it spans.
        latest = df.agg(F.max(ts)).scalar()
        first_slice = slice_index(F.col(ts), hours)
        last_slice = slice_index(F.least(F.coalesce(F.col("_version._until"), latest), latest), hours)
        hot = F.col(key).isin(list(heavy))
        starts = (starts.filter(~hot | (F.col(ts) <= latest))
                  .withColumn("_slice", F.explode(
                      F.when(hot, F.sequence(first_slice, F.greatest(first_slice, last_slice)))
                      .otherwise(F.array(F.lit(0))))))
        rows = rows.withColumn("_slice", slice_for(key, F.col(ts), heavy, hours))
        parts = [key, "_slice"]
    timeline = Window.partitionBy(*parts).orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    merged = (rows.unionByName(starts, allowMissingColumns=True)
              .withColumn("_version", F.last("_version", ignorenulls=True).over(timeline))
              .filter(F.col("_is_row")))
    valid = F.col("_version._until").isNull() | (F.col(ts) < F.col("_version._until"))
    return merged.select(
        *df.columns, *[F.when(valid, F.col(f"_version.{out}")).alias(out) for out in cols.values()])
