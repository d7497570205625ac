"""Column contracts shared by every layer."""

from pyspark.sql import types as T

# Names, order and domains that existing consumers of these
# tables rely on.
RAW_COLUMNS = [
    "TransactionID", "UserID", "MerchantID", "DeviceID", "TransactionAmount",
    "TransactionDate", "PaymentMethod", "DeviceType", "IP_Address",
    "LocationLat", "LocationLon", "IP_Country", "BillingCountry", "IsFraud",
]
TRANSACTION_COLUMNS = [
    "transaction_id", "user_id", "merchant_id", "device_id",
    "transaction_amount", "transaction_date", "payment_method", "device_type",
    "ip_address", "location_lat", "location_lon", "ip_country",
    "billing_country", "is_fraud_label",
]
FEATURE_COLUMNS = [
    "amount_zscore", "velocity_1hr", "impossible_travel_flag",
    "new_device_flag", "device_amount_percentile", "off_hours_flag",
    "location_mismatch_flag", "merchant_risk_rate",
]
SCORE_COLUMNS = [
    "transaction_id", "user_id", "merchant_id", "transaction_date",
    "fraud_probability", "risk_tier",
]
PAYMENT_METHODS = ["CREDIT_CARD", "DEBIT_CARD", "BANK_TRANSFER", "DIGITAL_WALLET", "UPI"]
DEVICE_TYPES = ["MOBILE", "DESKTOP", "TABLET"]
RISK_TIERS = ["Low", "Medium", "High"]
SCD_ID = "dbt_scd_id"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
UPDATED_AT = "dbt_updated_at"

AMOUNT = T.DecimalType(12, 2)

# As landed: everything that can be malformed arrives as text.
RAW_SCHEMA = T.StructType([
    T.StructField("TransactionID", T.StringType()),
    T.StructField("UserID", T.StringType()),
    T.StructField("MerchantID", T.StringType()),
    T.StructField("DeviceID", T.StringType()),
    T.StructField("TransactionAmount", T.StringType()),
    T.StructField("TransactionDate", T.StringType()),
    T.StructField("PaymentMethod", T.StringType()),
    T.StructField("DeviceType", T.StringType()),
    T.StructField("IP_Address", T.StringType()),
    T.StructField("LocationLat", T.StringType()),
    T.StructField("LocationLon", T.StringType()),
    T.StructField("IP_Country", T.StringType()),
    T.StructField("BillingCountry", T.StringType()),
    T.StructField("IsFraud", T.StringType()),
])

TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("transaction_amount", AMOUNT),
    T.StructField("transaction_date", T.TimestampType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("location_lat", T.DoubleType()),
    T.StructField("location_lon", T.DoubleType()),
    T.StructField("ip_country", T.StringType()),
    T.StructField("billing_country", T.StringType()),
    T.StructField("is_fraud_label", T.BooleanType()),
])

SCORE_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("transaction_date", T.TimestampType()),
    T.StructField("fraud_probability", T.DoubleType()),
    T.StructField("risk_tier", T.StringType()),
])

LEDGER_SCHEMA = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("loaded_at", T.TimestampType()),
    T.StructField("load_id", T.StringType()),
    T.StructField("note", T.StringType()),
])
