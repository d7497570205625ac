"""Small fixtures and row comparison shared by the tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from txnrisk.schemas import TRANSACTION_COLUMNS, TRANSACTION_SCHEMA

FOLDER = "/root/testdata/sf0.001"


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows_of(df, *columns):
    frame = df.select(*columns) if columns else df.select(*sorted(df.columns))
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def transactions(spark, rows):
    """Transactions from dicts; unnamed columns get plain values."""
    plain = dict(
        user_id="U1", merchant_id="M1", device_id="D1", transaction_amount=Decimal("10.00"),
        transaction_date=at("2024-01-01 00:00:00"), payment_method="UPI", device_type="MOBILE", ip_address="10.0.0.1",
        location_lat=0.0, location_lon=0.0, ip_country="C1", billing_country="C1", is_fraud_label=False)
    made = []
    for i, row in enumerate(rows):
        full = {"transaction_id": f"T{i}", **plain, **row}
        if isinstance(full["transaction_date"], str):
            full["transaction_date"] = at(full["transaction_date"])
        if not isinstance(full["transaction_amount"], Decimal):
            full["transaction_amount"] = Decimal(str(full["transaction_amount"])).quantize(Decimal("0.01"))
        made.append(tuple(full[c] for c in TRANSACTION_COLUMNS))
    return spark.createDataFrame(made, TRANSACTION_SCHEMA)


def raw_rows(spark, rows):
    """Landed text rows from dicts."""
    from txnrisk.schemas import RAW_COLUMNS, RAW_SCHEMA
    plain = dict(
        TransactionID="T1", UserID="U1", MerchantID="M1", DeviceID="D1", TransactionAmount="10.00",
        TransactionDate="2024-01-01T00:00:00+00:00", PaymentMethod="UPI", DeviceType="MOBILE",
        IP_Address="10.0.0.1", LocationLat="1.5", LocationLon="2.5", IP_Country="US", BillingCountry="US",
        IsFraud="False")
    return spark.createDataFrame([tuple({**plain, **r}[c] for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)
