"""Raw transactions derived from the ``events`` table.

``events`` carries no payments, so each event is projected onto the landed
transaction layout, complete with the defects a landing zone has: missing ids,
non-positive amounts, untidy text and re-sent rows. FIXTURES.md defines it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnrisk.schemas import RAW_COLUMNS


def _padded(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def raw_from_events(events: DataFrame) -> DataFrame:
    event_id, user = F.col("event_id"), F.col("user_id")
    k = F.col("k")
    device_slot = event_id % 3
    payment = (F.when(F.col("event_type") == "click", " credit_card")
               .when(F.col("event_type") == "view", "Debit_Card ")
               .when(F.col("event_type") == "purchase", "bank_transfer")
               .when(F.col("event_type") == "signup", "DIGITAL_WALLET")
               .when(F.col("event_type") == "error", " upi "))
    moved = F.when((user % 5 == 0) & (F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")), 1)
    country = F.concat(F.lit("C"), ((user + F.coalesce(moved, F.lit(0))) % 10).cast("string"))
    ip_country = F.concat(F.lit("C"), ((user + F.when(k < 5, 3).otherwise(0)) % 10).cast("string"))
    resent = F.explode(F.when(event_id % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    value = F.when(event_id % 211 == 0, -F.col("value")).when(k < 3, F.col("value") * 4).otherwise(F.col("value"))

    # Parsed below the row generator, so once per event and not once per use.
    parsed = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return parsed.withColumn("resent", resent).select(
        F.when(event_id % 307 != 0, _padded("T", event_id, 9)).alias("TransactionID"),
        _padded("U", user, 6).alias("UserID"),
        _padded("M", event_id * 7919 % 97, 5).alias("MerchantID"),
        F.when(k % 10 == 0, F.concat(F.lit("DX"), event_id.cast("string")))
        .otherwise(F.concat(F.lit("D"), (user - user % 2).cast("string"), F.lit("-"), device_slot.cast("string")))
        .alias("DeviceID"),
        (value + F.col("resent")).alias("TransactionAmount"),
        F.when(F.col("resent") == 1, F.col("ts") + F.expr("interval 1 second")).otherwise(F.col("ts"))
        .alias("TransactionDate"),
        payment.alias("PaymentMethod"),
        F.when(device_slot == 0, "mobile").when(device_slot == 1, " Desktop").otherwise("TABLET ")
        .alias("DeviceType"),
        F.concat(F.lit("10."), (user % 256).cast("string"), F.lit("."), (event_id % 256).cast("string"), F.lit(".1"))
        .alias("IP_Address"),
        (user * 37 % 110 - 55 + (event_id % 7 - 3) * F.lit(0.05).cast("double") + F.when(k < 3, 20).otherwise(0))
        .cast("double").alias("LocationLat"),
        (user * 53 % 340 - 170 + (event_id % 5 - 2) * F.lit(0.05).cast("double") + F.when(k < 3, -9).otherwise(0))
        .cast("double").alias("LocationLon"),
        ip_country.alias("IP_Country"),
        country.alias("BillingCountry"),
        (k < 3).alias("IsFraud"),
    ).select(*RAW_COLUMNS)


def read_raw(spark: SparkSession, folder: str) -> DataFrame:
    return raw_from_events(spark.read.parquet(f"{folder}/events.parquet"))
