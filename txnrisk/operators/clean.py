"""Landed text to typed, deduplicated transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnrisk.schemas import AMOUNT, RAW_COLUMNS, TRANSACTION_COLUMNS

# Raw columns whose text can fail to convert, with the type they become. A date
# that is already a timestamp (zoned or not) keeps its type.
_CONVERTED = {
    "TransactionAmount": AMOUNT, "TransactionDate": "timestamp",
    "LocationLat": "double", "LocationLon": "double", "IsFraud": "boolean",
}


def _target(raw: DataFrame, name: str):
    landed = raw.schema[name].dataType
    if name == "TransactionDate" and landed.typeName().startswith("timestamp"):
        return landed
    return _CONVERTED[name]


def typed(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """The landed columns renamed and converted; text trimmed and upper-cased."""
    def convert(name: str) -> Column:
        source = F.col(name)
        if name not in _CONVERTED:
            return source.cast("string")
        return source.try_cast(_target(raw, name)) if lenient else source.cast(_target(raw, name))

    columns = {name: convert(name) for name in RAW_COLUMNS}
    for name in ("PaymentMethod", "DeviceType"):
        columns[name] = F.upper(F.trim(name))
    return raw.select(*[columns[r].alias(t) for r, t in zip(RAW_COLUMNS, TRANSACTION_COLUMNS)])


def _malformed(raw: DataFrame) -> Column:
    """True when some non-NULL value of the row does not convert."""
    failed = F.lit(False)
    for name in _CONVERTED:
        failed = failed | (F.col(name).isNotNull() & F.col(name).try_cast(_target(raw, name)).isNull())
    return failed


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: bool = False) -> DataFrame:
    """The last (or first) row of each key under a total order.

    ``row_number() = 1`` is cut down to one row per key and task before the
    shuffle, so a key with any number of copies stays cheap.
    """
    ordering = [F.col(c).asc() if first else F.col(c).desc() for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def deduplicate(transactions: DataFrame) -> DataFrame:
    """Keep the latest version of each transaction id; rows without id go.

    Ties on the date fall to the larger amount, then to the other columns.
    """
    others = [c for c in TRANSACTION_COLUMNS
              if c not in ("transaction_id", "transaction_date", "transaction_amount")]
    return latest_per_key(
        transactions.filter(F.col("transaction_id").isNotNull()), ["transaction_id"],
        ["transaction_date", "transaction_amount", *others])


def clean(raw: DataFrame, on_bad: str = "raise") -> DataFrame:
    """Typed transactions: latest per id, id present, amount above zero.

    ``on_bad="raise"`` lets a value that does not convert fail the job;
    ``"quarantine"`` leaves such rows out (see :func:`quarantine`).
    """
    if on_bad not in ("raise", "quarantine"):
        raise ValueError(f"on_bad must be 'raise' or 'quarantine', not {on_bad!r}")
    lenient = on_bad == "quarantine"
    rows = raw.filter(~_malformed(raw)) if lenient else raw
    return deduplicate(typed(rows, lenient)).filter(F.col("transaction_amount") > 0)


def quarantine(raw: DataFrame) -> DataFrame:
    """Rows :func:`clean` rejects on their own merits, with the reason."""
    amount = F.col("TransactionAmount").try_cast(AMOUNT)
    reason = (F.when(_malformed(raw), "malformed value")
              .when(F.col("TransactionID").isNull(), "missing id")
              .when(amount.isNull(), "missing amount")
              .when(amount <= 0, "amount not positive"))
    return raw.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def batch_summary(raw: DataFrame) -> DataFrame:
    """Rows, fraud rows and fraud share of a batch."""
    fraud = F.col("IsFraud").cast("boolean")
    return raw.agg(
        F.count("*").alias("transactions"),
        F.count_if(fraud).alias("fraud_transactions"),
        F.try_divide(F.count_if(fraud), F.count("*")).cast("double").alias("fraud_share"))
