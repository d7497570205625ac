"""The daily run: raw rows in, every layer table brought up to date.

Order: bronze, its checks, fact, version tables, current tables, their checks,
baselines, features, scores, daily KPIs, their checks. A failed check stops the
run before anything downstream of it changes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from txnrisk.operators import clean, state
from txnrisk.operators.baselines import MERCHANT_WINDOW_DAYS, USER_WINDOW_DAYS
from txnrisk.operators.clean import latest_per_key
from txnrisk.operators.dims import DEVICE_CHECK, USER_CHECK, devices_latest, users_latest
from txnrisk.operators.features import build_features
from txnrisk.operators.incremental import bounded_context, device_firsts, extend_versions, late_users, user_points
from txnrisk.operators.kpi import daily_kpi
from txnrisk.operators.partials import baseline_from_partials, merchant_days, merchant_risk_from_partials, user_days
from txnrisk.operators.quality import gate, judged, report, unique
from txnrisk.operators.scd2 import current_rows, scd2_apply, scd2_from_events
from txnrisk.operators.scoring import score
from txnrisk.operators.skew import heavy_keys_by
from txnrisk.plans.contracts import contract_report
from txnrisk.session import scratch, side_by_side
from txnrisk.sources.tables import LayerStore


@dataclass(frozen=True)
class RunReport:
    days: tuple
    checks: int


def _existing(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except PySparkException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _by_day(store: LayerStore, layer: str, name: str, batch: DataFrame, days: list, stored: DataFrame | None = None,
            holding: list | None = None) -> DataFrame:
    """Upsert a written table into one partitioned by day, of which ``days`` are touched; returns the table.

    ``stored``: the ids of the batch that the table may hold, and ``holding``: the days that may hold them, if known.
    """
    path = store.path(layer, name)
    dated = batch if "event_date" in batch.columns else state.with_event_date(batch)
    if _existing(store.spark, path, dated.schema) is None:
        state.write_by_day(dated, path)
    else:
        state.upsert_partitions(store.spark, path, dated, ["transaction_id"], days=days, staged=True, stored=stored,
                                holding=holding)
    return store.spark.read.schema(dated.schema).parquet(path)


def _days_of(*frames: DataFrame | None) -> list:
    """Days of the rows of all frames, in order."""
    dates = [frame.select("event_date") for frame in frames if frame is not None]
    return sorted(row[0] for row in reduce(DataFrame.union, dates).distinct().collect()) if dates else []


def run_pipeline(store: LayerStore, raw: DataFrame, as_of: str, *, effective_ts=None, on_bad: str = "raise",
                 country_history: str = "event_time", check_all_days: bool = False) -> RunReport:
    """One daily run over the newly landed rows ``raw``.

    ``raw`` holds the rows landed since the last run, late and re-sent ones
    included, however old; they are upserted by transaction id, so a repeated
    run changes nothing. What the run leaves is what a rebuild over all rows
    would give: baselines and risk of every key that got, lost or moved rows or
    whose window left some behind, and the features of every row whose history
    changed. (Scores keep the baselines of the run that computed them.)
    ``country_history`` picks what the location check looks into: versions in
    event time, or the run-time snapshots (``"snapshot"``). Transaction tables
    are checked on the days the run touched, or with ``check_all_days`` whole;
    that no id occurs twice is checked over all days for the ids of the run.
    """
    if country_history not in ("event_time", "snapshot"):
        raise ValueError(f"country_history must be 'event_time' or 'snapshot', not {country_history!r}")
    spark = store.spark
    stamp = F.lit(as_of).cast("timestamp")

    # Used by every later step, so it is written once rather than recomputed.
    batch = state.write_table(state.with_event_date(clean.clean(clean_dates(raw), on_bad)), scratch(spark, "batch"))
    located = _located(store, batch)
    # Days that may hold rows of the batch's ids; None before the first run.
    holding = None if located is None else _days_of(located)
    _, replaced = side_by_side(spark, [partial(_note_days, store, batch, located),
                                       partial(_replaced, store, batch, located, holding)])
    days = sorted({*_days_of(batch), *(holding or [])})
    if not days:
        return RunReport((), 0)

    def touched(table: DataFrame, days: list) -> DataFrame:
        return table if check_all_days else table.filter(F.col("event_date").isin(days))

    bronze = _by_day(store, "bronze", "transactions", batch, days, located, holding)
    checks = gate(contract_report({"bronze_transactions": touched(bronze, days)}))

    fact = _by_day(store, "silver", "fact", batch, days, located, holding)
    # Before the places the ids have left are forgotten, and for those noted as well, so that a repeated run mends them.
    left = None if holding is None else sorted({*holding, *_days_of(replaced)})
    # Elsewhere than on these days the ids of the batch do not occur; their other ids are counted rather than joined away.
    ids = fact.filter(F.col("event_date").isin(days)).select("transaction_id")

    def settled() -> dict[str, DataFrame]:
        sums = _day_partials(store, fact, batch, sorted({*days, *(left or [])}), left)
        _settle(store, batch, located)
        return sums

    def affected(key: str) -> DataFrame:
        """Keys with rows in the batch or replaced by it."""
        keys = state.affected(batch, key)
        keys = keys if replaced is None else keys.union(replaced.select(key)).distinct()
        return state.write_table(keys, scratch(spark, f"keys-{key}"))

    sums, passed, heavy, of_users, of_devices, of_merchants = side_by_side(spark, [
        settled, lambda: gate(report({"fact_all_days": ids}, {"fact_all_days": [unique("transaction_id")]})),
        partial(heavy_keys_by, fact, ["user_id", "merchant_id", "device_id"]),
        *[partial(affected, key) for key in ("user_id", "device_id", "merchant_id")]])
    checks += passed

    def snapshots() -> tuple[DataFrame, list]:
        """The users' versions, and the results of the checks."""
        _snapshots(store, fact, batch, replaced, {"user_id": of_users, "device_id": of_devices}, heavy, effective_ts, as_of)
        users, users_current, devices, devices_current = side_by_side(spark, [
            partial(store.merged, *table) for name in ("users", "devices")
            for table in (("snapshots", name), ("silver", f"{name}_current"))])
        return users, checked({
            "fact": touched(fact, days), "users_current": users_current, "devices_current": devices_current,
            "users_versions": users, "devices_versions": devices},
            {"fact"}, {"users_current", "devices_current"}, {"users_versions", "devices_versions"})

    def checked(tables: dict[str, DataFrame], *groups: set[str]) -> list:
        """Results of the checks of each group of tables."""
        found = side_by_side(spark, [lambda group=group: contract_report(tables, group).collect() for group in groups])
        return [row for rows in found for row in rows]

    def measured(name: str, key: str, keys: DataFrame, measure, window: int) -> tuple[DataFrame, DataFrame]:
        """Keys of the batch and those whose window left some rows behind, with what there is of them now."""
        behind = _left_behind(store, sums[key], as_of, window)
        if behind is not None:
            keys = state.write_table(keys.union(behind.select(key)).distinct(), scratch(spark, f"affected-{name}"))
        return keys, state.write_table(measure(sums[key], as_of, window, keys, stamp), scratch(spark, name))

    # Beside the snapshots and their checks, what later steps put into tables is made in scratch folders.
    (users, found), baselines, risks, touching = side_by_side(spark, [
        snapshots,
        partial(measured, "user_baseline", "user_id", of_users, baseline_from_partials, USER_WINDOW_DAYS),
        partial(measured, "merchant_risk", "merchant_id", of_merchants, merchant_risk_from_partials, MERCHANT_WINDOW_DAYS),
        partial(_touching, store, fact, batch, replaced, of_users, heavy["user_id"])])
    checks += judged(found)

    def refreshed(name: str, key: str, keys: DataFrame, rows: DataFrame) -> DataFrame:
        store.replace(keys, rows, "gold", name, [key])
        return store.merged("gold", name)

    baseline, risk, versions = side_by_side(spark, [
        partial(refreshed, "user_baseline", "user_id", *baselines),
        partial(refreshed, "merchant_risk", "merchant_id", *risks),
        partial(_versions, store, fact, touching, heavy["user_id"])])

    rows, stored = _features(store, fact, batch, located, replaced, touching, versions if country_history == "event_time" else users,
                             baseline, risk, heavy, country_history)
    held = None if stored is None else sorted({*left, *_days_of(stored)})
    days = sorted({*_days_of(batch, replaced, rows)})

    def scored() -> list:
        scores = _by_day(store, "gold", "scores", score(rows), days, stored, held)
        counted = daily_kpi(scores.filter(F.col("event_date").isin(days)), updated_at=stamp)
        kpis = store.publish(state.upsert(
            _without_days(store.read("gold", "daily_kpi"), days), counted, ["date_key"]), "gold", "daily_kpi")
        return checked({"scores": touched(scores, days), "daily_kpi": kpis}, {"scores", "daily_kpi"})

    def featured() -> list:
        features = _by_day(store, "gold", "features", rows, days, stored, held)
        return checked({"features": touched(features, days)}, {"features"})

    # The points change only now, as the rows above read the old ones.
    _, *found = side_by_side(spark, [
        partial(_renew_points, store, fact, batch, touching, heavy["user_id"]),
        partial(checked, {"user_baseline": baseline, "merchant_risk": risk}, {"user_baseline", "merchant_risk"}),
        featured, scored])
    checks += judged([row for rows in found for row in rows])
    store.publish(spark.range(1).select(F.lit(as_of).cast("date").alias("as_of")), "state", "last_run")
    for name in ("replaced", "rows_to_write"):
        noted = store.read("state", name)
        if noted is not None:
            store.publish(noted.limit(0), "state", name)
    return RunReport(tuple(days), checks)


def _located(store: LayerStore, batch: DataFrame) -> DataFrame | None:
    """``(transaction_id, event_date)``: days on which ids of the batch may be stored; None before the first run.

    Read from the table of all ids' days, of which only the buckets of these
    ids are opened.
    """
    ids = batch.select("transaction_id")
    fact = _existing(store.spark, store.path("silver", "fact"), batch.schema)
    known = store.read(*_DAYS, ids)
    if known is None and fact is not None:  # a store from before this table
        bronze = _existing(store.spark, store.path("bronze", "transactions"), batch.schema)
        held = [table.select("transaction_id", "event_date") for table in (fact, bronze) if table is not None]
        store.publish(reduce(DataFrame.union, held).distinct(), *_DAYS, keys=["transaction_id"])
        known = store.read(*_DAYS, ids)
    return None if known is None else state.write_table(known, scratch(store.spark, "located"))


def _note_days(store: LayerStore, batch: DataFrame, located: DataFrame | None) -> None:
    """Note the batch's own days in the table of all ids' days.

    This is done before any other table changes, so that a run that dies leaves no row that cannot be found.
    """
    places = batch.select("transaction_id", "event_date")
    if located is None:
        store.publish(places, *_DAYS, keys=["transaction_id"])
        return
    news = places.join(located, ["transaction_id", "event_date"], "left_anti")
    both = state.write_table(located.unionByName(news), scratch(store.spark, "days"))
    store.replace(batch.select("transaction_id"), both, *_DAYS, ["transaction_id"])


#: Where the days of all ids are kept.
_DAYS = ("state", "id_days")


def _settle(store: LayerStore, batch: DataFrame, located: DataFrame | None) -> None:
    """Forget the days that ids of the batch have left, now that their rows are gone from there."""
    if located is None:
        return
    places = batch.select("transaction_id", "event_date")
    moved = located.join(places, ["transaction_id", "event_date"], "left_anti").select("transaction_id").distinct()
    if not moved.isEmpty():
        store.replace(moved, state.history_by_keys(places, moved, ["transaction_id"]), *_DAYS, ["transaction_id"])


def _replaced(store: LayerStore, batch: DataFrame, located: DataFrame | None, days: list | None) -> DataFrame | None:
    """Id, keys and day of the stored rows that the batch replaces; None before the first run.

    Noted before any table changes, with what a run that died has left noted:
    by now its rows may have moved away from keys and days that still count them.
    """
    columns = ["transaction_id", "user_id", "merchant_id", "device_id", "event_date"]
    fact = _existing(store.spark, store.path("silver", "fact"), batch.schema)
    if fact is None or located is None:
        return None
    rows = state.history_by_keys(fact.filter(F.col("event_date").isin(days)).select(*columns), located, ["transaction_id"])
    noted = store.read("state", "replaced")
    return store.publish((rows if noted is None else rows.unionByName(noted, allowMissingColumns=True)).distinct(), "state", "replaced")


def _day_partials(store: LayerStore, fact: DataFrame, batch: DataFrame, days: list, left: list | None) -> dict[str, DataFrame]:
    """Partials per key, brought up to date for ``days``; of the whole fact until that has been done once to the end.

    On ``left``, the days that rows of the batch may have been on, they are made anew.
    Elsewhere all rows of the batch are new, and their partials join the others.
    """
    complete = store.read("state", "day_partials") is not None

    def made(name: str, make) -> DataFrame:
        path, rows = store.path("state", name), make(fact)
        if complete:
            anew, added = state.to_rewrite(store.spark, path, days, left)
            if anew:
                state.overwrite_days(store.spark, path, make(fact.filter(F.col("event_date").isin(anew))), anew)
            if added:
                state.write_by_day(make(batch.filter(F.col("event_date").isin(added))).select(*rows.columns), path, "append")
        else:
            state.write_by_day(rows, path)
        return store.spark.read.schema(rows.schema).parquet(path)

    of_users, of_merchants = side_by_side(store.spark, [partial(made, "user_days", user_days),
                                                        partial(made, "merchant_days", merchant_days)])
    if not complete:
        store.publish(store.spark.range(1), "state", "day_partials")
    return {"user_id": of_users, "merchant_id": of_merchants}


def _left_behind(store: LayerStore, partials: DataFrame, as_of: str, window_days: int) -> DataFrame | None:
    """Partials of the days between the window of the last run and that of this one."""
    last = store.read("state", "last_run")
    if last is None:
        return None
    before, now = F.date_sub(last.agg(F.max("as_of")).scalar(), window_days), F.date_sub(F.lit(as_of).cast("date"), window_days)
    return partials.filter((F.col("event_date") >= F.least(before, now)) & (F.col("event_date") < F.greatest(before, now)))


def _snapshots(store, fact, batch, replaced, affected: dict[str, DataFrame], heavy, effective_ts, as_of) -> None:
    """Bring the version tables and the tables of current rows up to date for the keys concerned.

    A table keeps the latest row of every key. The latest of a key is the later
    of that and the batch's, unless the batch has replaced or taken away the
    row kept: only such keys are looked up in the fact.
    """
    effective = F.lit(as_of).cast(fact.schema["transaction_date"].dataType) if effective_ts is None else effective_ts

    def renewed(name: str, key: str, latest, checked: list) -> None:
        keys = affected[key]
        columns = ["transaction_id", "transaction_date", "user_id", "device_id", "billing_country", "payment_method",
                   "device_type"]
        kept = store.read("state", f"{name}_latest", keys)
        rows = fact.select(*columns)
        if kept is not None:
            lost = state.write_table(kept.join(replaced, [key, "transaction_id"], "left_semi").select(key),
                                     scratch(store.spark, f"lost-{name}"))
            rows = kept.unionByName(batch.select(*columns)).join(lost, key, "left_anti")
            if not lost.isEmpty():
                rows = rows.unionByName(state.history_of(fact.select(*columns), lost, key, heavy[key]))
        last = state.write_table(
            latest_per_key(rows.filter(F.col(key).isNotNull()), [key], ["transaction_date", "transaction_id"]),
            scratch(store.spark, f"latest-{name}"))
        current = latest(last.join(keys, key, "left_semi"))
        versions = scd2_apply(store.read("snapshots", name, keys), current, key, checked, effective)
        versions = state.write_table(versions, scratch(store.spark, f"versions-{name}"))
        store.replace(keys, last, "state", f"{name}_latest", [key])
        store.replace(keys, versions, "snapshots", name, [key])
        store.replace(keys, current_rows(versions), "silver", f"{name}_current", [key])

    side_by_side(store.spark, [partial(renewed, "users", "user_id", users_latest, USER_CHECK),
                               partial(renewed, "devices", "device_id", devices_latest, DEVICE_CHECK)])


@dataclass(frozen=True)
class _Touching:
    """What a run needs of the users it touches, written aside before any of the state tables changes."""

    users: DataFrame
    gone: DataFrame
    forced: DataFrame | None
    late: DataFrame
    history: DataFrame
    in_order: DataFrame
    points: DataFrame
    firsts: DataFrame
    versions: DataFrame


#: Country versions and the columns they are made of.
_VERSIONS = ("silver", "country_versions")
_VERSIONING = ("user_id", "transaction_date", ["billing_country"], "transaction_id")


def _touching(store, fact, batch, replaced, affected, heavy_users) -> _Touching | None:
    """In-order users, to be extended from state, and late ones, to be recomputed from history, with the versions of
    both; None on the first run, when the batch is the history."""
    if store.read("state", "user_points") is None:
        return None
    spark = store.spark
    forced = store.read("state", "rows_to_write")  # those a run that died had still to write
    gone = replaced.select("user_id")
    gone = gone if forced is None else gone.union(forced.select("user_id"))
    users = affected if forced is None else state.write_table(
        affected.union(forced.select("user_id")).distinct(), scratch(spark, "touched-users"))
    points, firsts, held = (store.read(*table, users) for table in (
        ("state", "user_points"), ("state", "device_firsts"), _VERSIONS))
    late = state.write_table(late_users(batch, points, gone), scratch(spark, "late"))
    # Without a late user the fact is read for the last hour only.
    history = fact.filter(F.lit(False)) if late.isEmpty() else state.history_of(fact, late, "user_id", heavy_users)
    in_order = batch.join(late, "user_id", "left_anti")
    versions = state.write_table(
        extend_versions(held.join(late, "user_id", "left_anti"), in_order, *_VERSIONING, heavy=heavy_users)
        .unionByName(scd2_from_events(history, *_VERSIONING, heavy=heavy_users)), scratch(spark, "versions"))
    return _Touching(users, gone, forced, late, history, in_order, points, firsts, versions)


def _versions(store, fact, touching, heavy_users) -> DataFrame:
    """Bring the country versions up to date; those of the users touched."""
    if touching is None:
        return store.publish(scd2_from_events(fact, *_VERSIONING, heavy=heavy_users), *_VERSIONS, keys=["user_id"])
    store.replace(touching.users, touching.versions, *_VERSIONS, ["user_id"])
    return touching.versions


def _features(store, fact, batch, located, replaced, touching, used, baseline, risk, heavy,
              country_history) -> tuple[DataFrame, DataFrame | None]:
    """Feature rows of the batch and of rows whose history it changed, noted as to be written.

    Of late users those rows are written that are new or differ from what is stored.
    The second table has the ids that may be stored and the days of their rows; None if that is not known.
    """
    spark = store.spark
    common = {"heavy_users": heavy["user_id"], "heavy_merchants": heavy["merchant_id"]}
    if touching is None:
        rows = build_features(fact.drop("event_date"), used, baseline, risk, **common)
        return state.write_table(state.with_event_date(rows), scratch(spark, "features")), None

    context = bounded_context(fact, touching.in_order, touching.points, heavy=heavy["user_id"])
    extended = build_features(context, used, baseline, risk, new_flag="_new", device_firsts=touching.firsts, **common)
    recomputed = state.with_event_date(build_features(touching.history.drop("event_date"), used, baseline, risk, **common))
    # Of all other ids of the batch no row is stored anywhere.
    ids = located.select("transaction_id")
    ids = (ids if touching.forced is None else ids.union(touching.forced.select("transaction_id"))).distinct()
    known = state.write_table(ids.withColumn("_known", F.lit(True)), scratch(spark, "known"))
    written = _changed(store, recomputed, batch, replaced, touching.late, known, country_history)
    extended = state.with_event_date(extended).join(known, "transaction_id", "left").withColumnRenamed("_known", "_stored")
    marked = state.write_table(extended.unionByName(written), scratch(spark, "features"))
    rows, stored = marked.drop("_stored"), marked.filter("_stored").select("transaction_id", "event_date")
    store.publish(rows.select("transaction_id", "user_id"), "state", "rows_to_write")
    return rows, stored.unionByName(located.select("transaction_id", "event_date"))


def _renew_points(store, fact, batch, touching, heavy_users) -> None:
    """Bring last points and first device uses up to date. Rows of any age only add to them; where a row was taken away, history tells."""
    spark = store.spark
    if touching is None:
        store.publish(device_firsts(fact), "state", "device_firsts", keys=["user_id"])
        store.publish(user_points(fact), "state", "user_points", keys=["user_id"])
        return
    lost = state.write_table(touching.gone.distinct(), scratch(spark, "lost"))
    moved = batch.join(lost, "user_id", "left_anti")
    if not lost.isEmpty():
        moved = moved.unionByName(state.history_of(fact, lost, "user_id", heavy_users).select(*batch.columns))

    def renewed(name: str, held: DataFrame, measure) -> None:
        rows = measure(held.join(lost, "user_id", "left_anti").unionByName(moved, allowMissingColumns=True))
        store.replace(touching.users, state.write_table(rows, scratch(spark, name)), "state", name, ["user_id"])

    side_by_side(spark, [
        partial(renewed, "user_points", touching.points, user_points),
        partial(renewed, "device_firsts", touching.firsts.withColumnRenamed("first_seen_at", "transaction_date"), device_firsts)])


def _changed(store, recomputed, batch, replaced, late, known, country_history) -> DataFrame:
    """Rows of ``recomputed`` to write: new ones, those ``known`` by id to be written, and those whose history reads
    otherwise now; with ``_stored``, whether a row of the id may be stored.

    Nothing before the first day on which a late user got or lost a row can have changed.
    """
    moved = batch.select("user_id", "event_date").unionByName(replaced.select("user_id", "event_date"))
    first = moved.join(late, "user_id", "left_semi").agg(F.min("event_date")).scalar()
    stored = _existing(store.spark, store.path("gold", "features"), recomputed.schema)
    if stored is None:  # the first run died before it wrote any
        return recomputed.withColumn("_stored", F.lit(True))
    from_history = ["velocity_1hr", "impossible_travel_flag", "new_device_flag",
                    *(["location_mismatch_flag"] if country_history == "event_time" else [])]
    held = (stored.filter(F.col("event_date") >= first).join(late, "user_id", "left_semi")
            .select("transaction_id", F.struct(*from_history).alias("_held")))
    differs = (F.col("event_date") >= first) & ~F.struct(*from_history).eqNullSafe(F.col("_held"))
    return (recomputed.join(held, "transaction_id", "left").join(known, "transaction_id", "left")
            .filter(F.col("_known") | differs)
            .withColumn("_stored", F.col("_known") | F.col("_held").isNotNull())
            .drop("_held", "_known"))


def clean_dates(raw: DataFrame) -> DataFrame:
    """The raw rows with their date comparable to the table's."""
    if raw.schema["TransactionDate"].dataType.typeName().startswith("timestamp"):
        return raw
    return raw.withColumn("TransactionDate", F.col("TransactionDate").try_cast("timestamp"))


def _without_days(kpis: DataFrame | None, days: list) -> DataFrame | None:
    """KPI rows of other days: a touched day may have lost all its rows."""
    return None if kpis is None else kpis.filter(~F.col("date_key").isin(days))
