"""Keeping one very frequent key from ending up in one task.

Ordinary keys are handled with a plain hash partition on the key. A *heavy* key
(one user, device or merchant with millions of rows) is cut along the time
line: its rows are partitioned by (key, slice), and a single carry row per
slice brings in what the earlier slices know. No row is dropped or capped; the
list of heavy keys only decides how rows are spread, never the result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnrisk.functions.timing import slice_index

# A key is heavy once it holds this share of what a task gets on average...
HEAVY_SHARE = 0.25
# ... but a task sorts so many rows in no time, however few its neighbours have.
FEW_ROWS = 250_000
# Counters of a sketch at most; Spark allows no more.
MOST_COUNTERS = 1_000_000


def heavy_keys_by(df: DataFrame, keys: Sequence[str], min_rows: int | None = None) -> dict[str, list]:
    """For each key column, its values with about ``min_rows`` rows or more.

    By default that is ``HEAVY_SHARE`` of the rows per shuffle partition (at
    least ``FEW_ROWS``), so the number of such values is bounded by the number
    of partitions over that share, and none is left out. One pass over those
    columns with a frequent-items sketch each, whose counters are 16 times that
    bound; no more values than it come back to the driver.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(MOST_COUNTERS // 16, max(4096, int(partitions / HEAVY_SHARE)))
    sketches = [F.expr(f"approx_top_k(`{key}`, {most}, {most * 16})").alias(f"_{i}") for i, key in enumerate(keys)]
    found = df.select(*keys).agg(F.count("*").alias("_rows"), *sketches).first()
    least = max(FEW_ROWS, found["_rows"] * HEAVY_SHARE / partitions) if min_rows is None else min_rows
    return {key: sorted(item["item"] for item in found[f"_{i}"] or []
                        if item["item"] is not None and item["count"] >= least) for i, key in enumerate(keys)}


def heavy_keys(df: DataFrame, key: str, min_rows: int | None = None) -> list:
    return heavy_keys_by(df, [key], min_rows)[key]


def slice_for(key: str, at: Column, heavy: Sequence, hours: int) -> Column:
    """Slice number for rows of heavy keys, 0 for all others."""
    return F.when(F.col(key).isin(list(heavy)), slice_index(at, hours)).otherwise(F.lit(0))


def split_heavy(df: DataFrame, key: str, heavy: Sequence, plain: Callable[[DataFrame], DataFrame],
                sliced: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``plain`` over the ordinary keys' rows and ``sliced`` over the heavy ones'.

    Ordinary rows keep one partitioning by key through all steps of ``plain``.
    """
    if not heavy:
        return plain(df)
    hot = F.col(key).isin(list(heavy))
    return plain(df.filter(~hot | F.col(key).isNull())).unionByName(sliced(df.filter(hot)))


def neighbour(df: DataFrame, key: str, order: Sequence[str], value: Column, out: str, *,
              back: bool = True, heavy: Sequence = (), hours: int = 1) -> DataFrame:
    """Add ``out``: ``value`` (a struct) of the key's previous row, or of the next.

    ``order`` starts with the timestamp column and must be a total order.
    """
    shift = F.lag if back else F.lead
    if not heavy:
        return df.withColumn(out, shift(value).over(Window.partitionBy(key).orderBy(*order)))

    rows = (df.withColumn("_slice", slice_for(key, F.col(order[0]), heavy, hours))
            .withColumn("_value", value))
    nearest = F.max_by if back else F.min_by
    edges = (rows.filter(F.col(key).isin(list(heavy)))
             .groupBy(key, "_slice").agg(nearest("_value", F.struct(*order)).alias("_value")))
    target = (F.lead if back else F.lag)("_slice").over(Window.partitionBy(key).orderBy("_slice"))
    carried = (edges.withColumn("_slice", target).filter(F.col("_slice").isNotNull())
               .withColumn("_place", F.lit(0 if back else 2)))
    within = Window.partitionBy(key, "_slice").orderBy("_place", *order)
    return (rows.withColumn("_place", F.lit(1))
            .unionByName(carried, allowMissingColumns=True)
            .withColumn(out, shift("_value").over(within))
            .filter(F.col("_place") == 1)
            .drop("_slice", "_value", "_place"))


def join_salted(left: DataFrame, right: DataFrame, key: str | Sequence[str], spread: str, *,
                heavy: Sequence = (), how: str = "left", salts: int | None = None) -> DataFrame:
    """Equi-join on ``key`` whose heavy keys are spread over ``salts`` tasks.

    By default over as many as a shuffle has partitions, 64 at least: a key
    that holds a third of the rows is then spread over all tasks. With several key columns the heavy values are those of the first. Only the
    right-hand rows of the heavy keys are repeated per salt.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not heavy:
        return left.join(right, keys, how)
    salts = salts or max(64, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = F.col(keys[0]).isin(list(heavy))
    salted_left = left.withColumn(
        "_salt", F.when(hot, F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_right = right.withColumn("_salt", F.explode(F.when(hot, every).otherwise(F.array(F.lit(0)))))
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")


def trailing_totals(df: DataFrame, key: str, ts: str, windows: dict, measures: dict[str, Column], *,
                    include_current: bool = True, heavy: Sequence = (), hours: int = 1) -> DataFrame:
    """Sums over each key's last ``window``, in linear time.

    For every window name ``w`` and measure ``m`` adds ``{m}_{w}``: the sum of
    ``m`` over the key's rows with time in [t - window, t], or [t - window, t)
    without the current instant. A moving RANGE frame would re-add its whole
    frame for every row; here each row enters the running sum once and leaves
    it through one narrow expiry row per window.
    """
    names = list(windows)
    stages = ["in", *names]

    def slot(stage: str, measure: str) -> str:
        return f"_{stage}_{measure}"

    rows = df.withColumns({
        "_at": F.col(ts), "_real": F.lit(True),
        **{slot("in", m): expr for m, expr in measures.items()}})
    moves = rows
    for name in names:
        leaving = df.select(
            key, (F.col(ts) + F.lit(windows[name])).alias("_at"),
            *[expr.alias(slot(name, m)) for m, expr in measures.items()])
        moves = moves.unionByName(leaving, allowMissingColumns=True)

    slots = [slot(s, m) for s in stages for m in measures]
    parts = [key]
    if heavy:
        moves = moves.withColumn("_slice", slice_for(key, F.col("_at"), heavy, hours))
        parts = [key, "_slice"]
        so_far = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        net = (moves.filter(F.col(key).isin(list(heavy))).groupBy(key, "_slice")
               .agg(*[F.sum(c).alias(c) for c in slots]))
        carried = net.select(
            key, "_slice",
            F.lit("0001-01-01").cast(df.schema[ts].dataType).alias("_at"),
            *[F.sum(c).over(so_far).alias(c) for c in slots])
        moves = moves.unionByName(carried, allowMissingColumns=True)

    partition = ", ".join(f"`{p}`" for p in parts)
    before = (f"over (partition by {partition} order by `_at` range between unbounded preceding "
              "and interval '0 00:00:00.000001' day to second preceding)")
    upto = (f"over (partition by {partition} order by `_at` range between unbounded preceding "
            "and current row)")
    entered = upto if include_current else before
    totals = {
        f"{m}_{name}": F.expr(f"coalesce(sum(`{slot('in', m)}`) {entered}, 0)"
                              f" - coalesce(sum(`{slot(name, m)}`) {before}, 0)")
        for name in names for m in measures}
    helpers = ["_at", "_real", *slots, *(["_slice"] if heavy else [])]
    return moves.withColumns(totals).filter(F.col("_real")).drop(*helpers)


def sums_before(rows: DataFrame, moves: DataFrame, key: str | Sequence[str], at: str, measures: dict[str, Column], *,
                heavy: Sequence = (), hours: int = 1, sparse: bool = False) -> DataFrame:
    """``rows`` with the sum of each measure over the moves of their key strictly before ``at``; 0 where there is none.

    ``moves`` has the key columns, ``at`` and what the measures are made of,
    under names that ``rows`` does not have. Rows and moves merge on the time
    line; without heavy keys the measures are evaluated after the shuffle, so
    that it stays narrow. Heavy values are those of the first key column. With
    ``sparse``, for moves many of whose keys have no rows, those are left out
    before anything is summed; the result is the same.
    """
    keys = [key] if isinstance(key, str) else list(key)
    line = rows.withColumn("_real", F.lit(True)).unionByName(moves, allowMissingColumns=True)
    parts = list(keys)
    if heavy:
        line = line.withColumn("_slice", slice_for(keys[0], F.col(at), heavy, hours))
        parts.append("_slice")
    # With heavy keys the union below is dealt anew anyway.
    dealt = line if heavy else line.repartition(*parts)
    if sparse:
        whole = Window.partitionBy(*parts).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        dealt = dealt.withColumn("_asked", F.max("_real").over(whole)).filter(F.col("_asked")).drop("_asked")
    measured = dealt.withColumns(measures)
    if heavy:
        so_far = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        net = (line.filter(F.col(keys[0]).isin(list(heavy))).withColumns(measures).groupBy(*parts)
               .agg(*[F.sum(m).alias(m) for m in measures]))
        carried = net.select(*parts, F.lit("0001-01-01").cast(rows.schema[at].dataType).alias(at),
                             *[F.sum(m).over(so_far).alias(m) for m in measures])
        measured = measured.unionByName(carried, allowMissingColumns=True)
    by = ", ".join(f"`{p}`" for p in parts)
    before = (f"over (partition by {by} order by `{at}` range between unbounded preceding "
              "and interval '0 00:00:00.000001' day to second preceding)")
    sums = {f"_sum_{m}": F.expr(f"coalesce(sum(`{m}`) {before}, 0)") for m in measures}
    summed = measured.withColumns(sums).filter(F.col("_real"))
    return summed.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col(f"`_sum_{m}`").alias(m) for m in measures])
