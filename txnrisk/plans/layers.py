"""Layer tables built from one data folder, shared by the registered queries.

Each is computed by Spark from the whole input, written to the shared folder
the first time a query of the session asks for it, and read from there after
that: the medallion layout, and it cuts the lineage at a written table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from txnrisk.operators.baselines import merchant_risk, user_baseline
from txnrisk.operators.clean import clean
from txnrisk.operators.dims import DEVICE_CHECK, USER_CHECK, devices_latest, users_latest
from txnrisk.operators.features import build_features
from txnrisk.operators.partials import merchant_days, user_days
from txnrisk.operators.point_in_time import features_point_in_time as known_before
from txnrisk.operators.scd2 import scd2_apply, scd2_from_events
from txnrisk.operators.scoring import with_scores
from txnrisk.operators.skew import heavy_keys_by
from txnrisk.operators.state import with_event_date, write_by_day
from txnrisk.plans.pipeline import run_pipeline
from txnrisk.session import scratch
from txnrisk.sources.csv_files import write_daily_csv
from txnrisk.sources.events import read_raw
from txnrisk.sources.tables import LayerStore

# Anchors of the trailing windows; both reach back to 2024-01-11, so that the
# filters really drop rows of the January data.
USER_AS_OF = "2024-02-10"
MERCHANT_AS_OF = "2024-04-10"
KEPT = ["transaction_amount", "payment_method", "device_type", "billing_country"]

# Rows of a file that arrives, so that no task writes or reads a whole micro-batch.
FILE_ROWS = 250_000

_built: dict[tuple[str, str, str], tuple] = {}
_heavy: dict[tuple[str, str], dict[str, list]] = {}


def _layer(spark: SparkSession, folder: str, name: str, make: Callable[[], DataFrame],
           by_day: bool = False) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder, name)
    if key in _built:
        path, schema = _built[key]
        try:
            return spark.read.schema(schema).parquet(path)
        except PySparkException:
            pass  # the shared folder was cleared: build it again
    df, path = make(), scratch(spark, name)
    if by_day:
        df = df if "event_date" in df.columns else with_event_date(df)
        write_by_day(df, path)
    else:
        df.write.parquet(path)
    _built[key] = (path, df.schema)
    return spark.read.schema(df.schema).parquet(path)


def arriving(spark: SparkSession, folder: str, batches: int = 4,
             layer: Callable[[SparkSession, str], DataFrame] | None = None) -> DataFrame:
    """A layer, the fact if none is given, as a stream of ``batches`` micro-batches that each hold rows of all times.

    Copies of a raw row's id come in different micro-batches. A micro-batch is one file of a small layer, and as many
    of ``FILE_ROWS`` rows as it takes of a larger one; any of the files may come together, as they are dealt by hash.
    """
    layer = layer or fact
    key = (spark.sparkContext.applicationId, folder, f"arriving-{layer.__name__}")
    if key not in _built:
        path, rows = scratch(spark, "arriving"), layer(spark, folder).drop("event_date")
        files = max(1, -(-rows.count() // (FILE_ROWS * batches)))
        dealt_by = ["transaction_id"] if "transaction_id" in rows.columns else rows.columns
        part = F.pmod(F.xxhash64(*dealt_by), F.lit(batches * files)).cast("int")
        rows.repartitionById(batches * files, part).write.option("maxRecordsPerFile", 0).parquet(path)
        _built[key] = (path, rows.schema, files)
    path, schema, files = _built[key]
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def landed_csv(spark: SparkSession, folder: str) -> str:
    """Folder of the raw rows as daily CSV files."""
    key = (spark.sparkContext.applicationId, folder, "landed_csv")
    if key not in _built:
        path = scratch(spark, "csv")
        write_daily_csv(raw(spark, folder), path)
        _built[key] = (path, None)
    return _built[key][0]


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return read_raw(spark, folder)


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return _layer(spark, folder, "fact", lambda: clean(raw(spark, folder)), by_day=True)


def first_batch(spark: SparkSession, folder: str) -> DataFrame:
    return _layer(spark, folder, "first_batch", lambda: clean(raw(spark, folder).filter(early())))


def second_batch(spark: SparkSession, folder: str) -> DataFrame:
    return _layer(spark, folder, "second_batch", lambda: clean(raw(spark, folder).filter(~early())))


def heavy(spark: SparkSession, folder: str, key: str) -> list:
    """Keys of the fact that need slicing or salting; a bounded list."""
    known = (spark.sparkContext.applicationId, folder)
    if known not in _heavy:
        _heavy[known] = heavy_keys_by(fact(spark, folder), ["user_id", "device_id", "merchant_id"])
    return _heavy[known][key]


def baseline(spark: SparkSession, folder: str) -> DataFrame:
    return _layer(spark, folder, "baseline", lambda: user_baseline(fact(spark, folder), USER_AS_OF))


def user_day_partials(spark: SparkSession, folder: str) -> DataFrame:
    return _layer(spark, folder, "user_days", lambda: user_days(fact(spark, folder)), by_day=True)


def merchant_day_partials(spark: SparkSession, folder: str) -> DataFrame:
    return _layer(spark, folder, "merchant_days", lambda: merchant_days(fact(spark, folder)), by_day=True)


def risk(spark: SparkSession, folder: str) -> DataFrame:
    return _layer(spark, folder, "risk", lambda: merchant_risk(fact(spark, folder), MERCHANT_AS_OF))


def country_versions(spark: SparkSession, folder: str) -> DataFrame:
    return _layer(spark, folder, "country_versions", lambda: scd2_from_events(
        fact(spark, folder), "user_id", "transaction_date", ["billing_country"], "transaction_id",
        heavy=heavy(spark, folder, "user_id")))


def two_snapshots(spark: SparkSession, folder: str, latest, key: str, columns) -> DataFrame:
    """Snapshot of the first batch in mid-January, of all rows at its end."""
    times = [F.lit(t).cast("timestamp_ntz") for t in ("2024-01-16", "2024-01-31")]
    held = scd2_apply(None, latest(first_batch(spark, folder)), key, columns, times[0])
    return scd2_apply(held, latest(fact(spark, folder)), key, columns, times[1])


def users_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return _layer(spark, folder, "users_snapshots", lambda: two_snapshots(
        spark, folder, users_latest, "user_id", USER_CHECK))


def devices_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return _layer(spark, folder, "devices_snapshots", lambda: two_snapshots(
        spark, folder, devices_latest, "device_id", DEVICE_CHECK))


def features(spark: SparkSession, folder: str, new_ids: DataFrame | None = None, keep=(),
             rows: DataFrame | None = None) -> DataFrame:
    """The feature plan itself, over the layer tables; ``rows`` limits the context to some users' history."""
    return build_features(
        fact(spark, folder) if rows is None else rows, country_versions(spark, folder), baseline(spark, folder), risk(spark, folder),
        new_ids=new_ids, keep=keep, heavy_users=heavy(spark, folder, "user_id"),
        heavy_merchants=heavy(spark, folder, "merchant_id"))


def features_point_in_time(spark: SparkSession, folder: str) -> DataFrame:
    """Features as known just before each transaction, for training."""
    return _layer(spark, folder, "features_point_in_time", lambda: known_before(
        fact(spark, folder), country_versions(spark, folder), heavy_users=heavy(spark, folder, "user_id"),
        heavy_merchants=heavy(spark, folder, "merchant_id")))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Features, score and the fact columns the dashboard measures use."""
    return _layer(spark, folder, "scored", lambda: with_scores(features(spark, folder, keep=KEPT)),
                  by_day=True)


def run_batches(spark: SparkSession, folder: str) -> list[tuple[str, DataFrame]]:
    """Raw rows of three daily runs and their dates: early rows, then late ones in two parts.

    The last run also re-sends all early transactions of one user, from long
    before, as another user's at another merchant, a day later.
    """
    rows, cut = raw(spark, folder), F.lit("2024-01-24").cast("timestamp_ntz")
    resent = rows.filter(early() & (F.col("UserID") == "U000003")).withColumns({
        "UserID": F.lit("U000004"), "MerchantID": F.lit("M00001"),
        "TransactionAmount": F.abs("TransactionAmount") + 5,
        "TransactionDate": F.col("TransactionDate") + F.expr("interval 1 day")})
    return [("2024-02-08", rows.filter(early())),
            ("2024-02-09", rows.filter(~early() & (F.col("TransactionDate") < cut))),
            ("2024-02-10", rows.filter(~early() & (F.col("TransactionDate") >= cut)).unionByName(resent))]


def three_runs(spark: SparkSession, folder: str) -> LayerStore:
    """The store that three daily runs leave."""
    key = (spark.sparkContext.applicationId, folder, "three_runs")
    if key not in _built:
        store = LayerStore(spark, scratch(spark, "three-runs"))
        for as_of, batch in run_batches(spark, folder):
            run_pipeline(store, batch, as_of)
        _built[key] = (store.root, None)
    return LayerStore(spark, _built[key][0])


def early(column: str = "TransactionDate", payment: str = "PaymentMethod"):
    """First of two arrivals: rows before mid-January, except UPI payments,
    which settle late and arrive with the second batch."""
    return (F.col(column) < F.lit("2024-01-16").cast("timestamp_ntz")) & (F.trim(payment) != "upi")
