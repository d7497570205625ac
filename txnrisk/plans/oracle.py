"""SQL statements that compute the registered queries independently.

Written for a plain SQL engine over the same parquet tables: text-book forms
(moving frames, row numbers, range joins), sharing no code with the operators (only the list of declared checks).
``build`` puts the needed common table expressions in front of a statement.
"""

from __future__ import annotations

import re

from txnrisk.plans.contracts import contracts

CTES: dict[str, str] = {}


def _cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


_cte("raw_once", """
SELECT event_id,
  CASE WHEN event_id % 307 <> 0 THEN 'T' || lpad(CAST(event_id AS VARCHAR), 9, '0') END AS TransactionID,
  'U' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS UserID,
  'M' || lpad(CAST(event_id * 7919 % 97 AS VARCHAR), 5, '0') AS MerchantID,
  CASE WHEN k % 10 = 0 THEN 'DX' || CAST(event_id AS VARCHAR)
       ELSE 'D' || CAST(user_id - user_id % 2 AS VARCHAR) || '-' || CAST(event_id % 3 AS VARCHAR) END AS DeviceID,
  CASE WHEN event_id % 211 = 0 THEN -value WHEN k < 3 THEN value * 4 ELSE value END AS TransactionAmount,
  ts AS TransactionDate,
  CASE event_type WHEN 'click' THEN ' credit_card' WHEN 'view' THEN 'Debit_Card '
       WHEN 'purchase' THEN 'bank_transfer' WHEN 'signup' THEN 'DIGITAL_WALLET' WHEN 'error' THEN ' upi ' END
    AS PaymentMethod,
  CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN ' Desktop' ELSE 'TABLET ' END AS DeviceType,
  '10.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) || '.1' AS IP_Address,
  CAST(user_id * 37 % 110 - 55 + (event_id % 7 - 3) * CAST(0.05 AS DOUBLE)
       + CASE WHEN k < 3 THEN 20 ELSE 0 END AS DOUBLE) AS LocationLat,
  CAST(user_id * 53 % 340 - 170 + (event_id % 5 - 2) * CAST(0.05 AS DOUBLE)
       + CASE WHEN k < 3 THEN -9 ELSE 0 END AS DOUBLE) AS LocationLon,
  'C' || CAST((user_id + CASE WHEN k < 5 THEN 3 ELSE 0 END) % 10 AS VARCHAR) AS IP_Country,
  'C' || CAST((user_id + CASE WHEN user_id % 5 = 0 AND ts >= TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END) % 10
       AS VARCHAR) AS BillingCountry,
  k < 3 AS IsFraud
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
""")
_cte("raw", """
SELECT * EXCLUDE (event_id) FROM raw_once
UNION ALL
SELECT * EXCLUDE (event_id) REPLACE (TransactionAmount + 1 AS TransactionAmount,
       TransactionDate + INTERVAL 1 SECOND AS TransactionDate)
FROM raw_once WHERE event_id % 50 = 0
""")


def _clean(source: str, amount_filter: str = "AND transaction_amount > 0") -> str:
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT TransactionID AS transaction_id, UserID AS user_id, MerchantID AS merchant_id, DeviceID AS device_id,
    CAST(TransactionAmount AS DECIMAL(12,2)) AS transaction_amount, TransactionDate AS transaction_date,
    upper(trim(PaymentMethod)) AS payment_method, upper(trim(DeviceType)) AS device_type,
    IP_Address AS ip_address, LocationLat AS location_lat, LocationLon AS location_lon,
    IP_Country AS ip_country, BillingCountry AS billing_country, IsFraud AS is_fraud_label,
    row_number() OVER (PARTITION BY TransactionID ORDER BY TransactionDate DESC, TransactionAmount DESC) AS rn
  FROM {source})
WHERE rn = 1 AND transaction_id IS NOT NULL {amount_filter}"""


# Arrival: early rows first, UPI payments settle late with the second batch.
_EARLY = "TransactionDate < TIMESTAMP '2024-01-16' AND PaymentMethod <> ' upi '"
_cte("raw_1", f"SELECT * FROM raw WHERE {_EARLY}")
_cte("raw_2", f"SELECT * FROM raw WHERE NOT ({_EARLY})")
_cte("dedup", _clean("raw", ""))
_cte("fact", _clean("raw"))
_cte("fact_1", _clean("raw_1"))
_cte("fact_2", _clean("raw_2"))
_cte("upserted", """
SELECT * FROM fact_1 WHERE transaction_id NOT IN (SELECT transaction_id FROM fact_2)
UNION ALL SELECT * FROM fact_2""")
_cte("newer", "SELECT * FROM fact WHERE transaction_date > (SELECT max(transaction_date) FROM fact_1)")


def _mean(where: str = "") -> str:
    """Mean amount to six digits, halves up, in whole cents: a double mean can
    fall on the wrong side of a half."""
    kept = f"FILTER (WHERE {where})" if where else ""
    cents, rows = f"sum(CAST(transaction_amount * 100 AS HUGEINT)) {kept}", f"count(*) {kept}"
    return f"CAST((2 * {cents} * 10000 + {rows}) // (2 * {rows}) AS DOUBLE) / 1000000"


def _baseline(source: str) -> str:
    return f"""
SELECT user_id, {_mean()} AS avg_amount_30d, stddev_samp(transaction_amount) AS stddev_amount_30d,
  quantile_disc(transaction_amount, 0.9) AS p90_amount_30d,
  CAST(min(hour(transaction_date)) AS INTEGER) AS earliest_active_hour,
  CAST(max(hour(transaction_date)) AS INTEGER) AS latest_active_hour, count(*) AS transaction_count_30d
FROM {source} WHERE transaction_date >= DATE '2024-02-10' - 30 GROUP BY user_id"""


_cte("baseline", _baseline("fact"))
_cte("baseline_1", _baseline("fact_1"))
_cte("baseline_affected", _baseline(
    "(SELECT * FROM upserted WHERE user_id IN (SELECT user_id FROM fact_2))"))
def _risk(as_of: str, source: str = "fact") -> str:
    return f"""
SELECT merchant_id, count(*) AS transaction_count_90d, count(*) FILTER (WHERE is_fraud_label) AS fraud_count_90d,
  count(*) FILTER (WHERE is_fraud_label) / count(*) AS fraud_rate_90d,
  {_mean()} AS avg_transaction_amount_90d,
  count(DISTINCT user_id) AS distinct_customer_count_90d
FROM {source} WHERE transaction_date >= DATE '{as_of}' - 90 GROUP BY merchant_id"""


_cte("risk", _risk("2024-04-10"))
_cte("risk_february", _risk("2024-02-10"))


def _latest(source: str, key: str, a: str, b: str) -> str:
    return f"""
SELECT {key}, {a}, {b}, transaction_date FROM (
  SELECT {key.split(' AS ')[0]}, {a}, {b}, transaction_date,
    row_number() OVER (PARTITION BY {key} ORDER BY transaction_date DESC, transaction_id DESC) AS rn
  FROM (SELECT *, payment_method AS preferred_payment_method, user_id AS primary_user_id FROM {source}))
WHERE rn = 1"""


for _suffix in ("", "_1"):
    _cte(f"users_latest{_suffix}", _latest(f"fact{_suffix}", "user_id", "billing_country", "preferred_payment_method"))
    _cte(f"devices_latest{_suffix}", _latest(f"fact{_suffix}", "device_id", "device_type", "primary_user_id"))


def _snapshots(key: str, a: str, b: str, first: str, second: str) -> str:
    """Two check-strategy snapshots, at 2024-01-16 and 2024-01-31."""
    t1, t2 = "TIMESTAMP '2024-01-16'", "TIMESTAMP '2024-01-31'"
    changed = f"(o.{a} IS DISTINCT FROM n.{a} OR o.{b} IS DISTINCT FROM n.{b})"
    rows = f"""
  SELECT o.{key}, o.{a}, o.{b}, {t1} AS dbt_valid_from,
    CASE WHEN n.{key} IS NOT NULL AND {changed} THEN {t2} END AS dbt_valid_to,
    CASE WHEN n.{key} IS NOT NULL AND {changed} THEN {t2} ELSE {t1} END AS dbt_updated_at
  FROM {first} o LEFT JOIN {second} n ON o.{key} = n.{key}
  UNION ALL
  SELECT n.{key}, n.{a}, n.{b}, {t2}, CAST(NULL AS TIMESTAMP), {t2}
  FROM {second} n LEFT JOIN {first} o ON o.{key} = n.{key} WHERE o.{key} IS NULL OR {changed}"""
    return f"""
SELECT md5({key} || '|' || CAST(dbt_valid_from AS VARCHAR)) AS dbt_scd_id, * FROM ({rows})"""


_cte("users_snap", _snapshots("user_id", "billing_country", "preferred_payment_method",
                              "users_latest_1", "users_latest"))
_cte("devices_snap", _snapshots("device_id", "device_type", "primary_user_id", "devices_latest_1", "devices_latest"))


def _versions(key: str, columns: list[str], source: str = "fact") -> str:
    listed = ", ".join(columns)
    lags = ", ".join(f"lag({c}) OVER w AS old_{c}" for c in columns)
    changed = " OR ".join(f"{c} IS DISTINCT FROM old_{c}" for c in columns)
    return f"""
SELECT md5({key} || '|' || CAST(dbt_valid_from AS VARCHAR)) AS dbt_scd_id, * FROM (
  SELECT {key}, {listed}, transaction_date AS dbt_valid_from,
    lead(transaction_date) OVER (PARTITION BY {key} ORDER BY transaction_date, transaction_id) AS dbt_valid_to
  FROM (
    SELECT *, row_number() OVER w AS n, {lags}
    FROM (SELECT *, payment_method AS preferred_payment_method, user_id AS primary_user_id FROM {source})
    WINDOW w AS (PARTITION BY {key} ORDER BY transaction_date, transaction_id))
  WHERE n = 1 OR {changed})"""


_cte("users_v", _versions("user_id", ["billing_country", "preferred_payment_method"]))
_cte("devices_v", _versions("device_id", ["device_type", "primary_user_id"]))
_cte("country_v", _versions("user_id", ["billing_country"]))


def _asof(versions: str, source: str = "fact") -> str:
    return f"""
SELECT h.*, s.billing_country AS billing_country_at_tx_time
FROM {source} h LEFT JOIN {versions} s ON h.user_id = s.user_id AND h.transaction_date >= s.dbt_valid_from
  AND (h.transaction_date < s.dbt_valid_to OR s.dbt_valid_to IS NULL)"""


_cte("located", _asof("country_v"))
_cte("located_snap", _asof("users_snap"))
_WINDOWED = """
SELECT *, lag(transaction_date) OVER u AS prev_transaction_date, lag(location_lat) OVER u AS prev_lat,
  lag(location_lon) OVER u AS prev_lon,
  count(*) OVER (PARTITION BY user_id ORDER BY transaction_date
                 RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS velocity_1hr_inclusive,
  min(transaction_date) OVER (PARTITION BY user_id, device_id) AS device_first_seen_at
FROM located WINDOW u AS (PARTITION BY user_id ORDER BY transaction_date, transaction_id)"""
_MOVED = """
SELECT *,
  CASE WHEN prev_lat IS NOT NULL THEN 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(location_lat - prev_lat) / 2), 2)
    + cos(radians(prev_lat)) * cos(radians(location_lat)) * pow(sin(radians(location_lon - prev_lon) / 2), 2)))) END
    AS distance_km,
  CASE WHEN prev_transaction_date IS NOT NULL THEN
    greatest(floor(epoch(transaction_date)) - floor(epoch(prev_transaction_date)), 1) / CAST(3600 AS DOUBLE)
  END AS hours_since_prev
FROM windowed"""
_cte("windowed", _WINDOWED)
_cte("moved", _MOVED)

# Three daily runs: early rows; late ones before the 24th; the rest, and one user's early rows again, moved.
_LATE_CUT = "TIMESTAMP '2024-01-24'"
_cte("run_3_raw", f"""
SELECT * FROM raw_2 WHERE TransactionDate >= {_LATE_CUT}
UNION ALL
SELECT * REPLACE ('U000004' AS UserID, 'M00001' AS MerchantID, abs(TransactionAmount) + 5 AS TransactionAmount,
  TransactionDate + INTERVAL 1 DAY AS TransactionDate) FROM raw_1 WHERE UserID = 'U000003'""")
_cte("run_2", _clean(f"(SELECT * FROM raw_2 WHERE TransactionDate < {_LATE_CUT})"))
_cte("run_3", _clean("run_3_raw"))
_cte("run_before_3", """
SELECT * FROM run_2 UNION ALL SELECT * FROM fact_1 WHERE transaction_id NOT IN (SELECT transaction_id FROM run_2)""")
_cte("run_fact", """
SELECT * FROM run_3
UNION ALL SELECT * FROM run_2 WHERE transaction_id NOT IN (SELECT transaction_id FROM run_3)
UNION ALL SELECT * FROM fact_1 WHERE transaction_id NOT IN (SELECT transaction_id FROM run_3)
  AND transaction_id NOT IN (SELECT transaction_id FROM run_2)""")
_cte("run_country_v", _versions("user_id", ["billing_country"], "run_fact"))
_cte("run_located", _asof("run_country_v", "run_fact"))
_cte("run_windowed", _WINDOWED.replace("FROM located", "FROM run_located"))
_cte("run_moved", _MOVED.replace("FROM windowed", "FROM run_windowed"))
_cte("run_baseline", _baseline("run_fact"))
_cte("run_risk", _risk("2024-02-10", "run_fact"))
_cte("run_users", _latest("run_fact", "user_id", "billing_country", "preferred_payment_method"))


def _features_with(risk: str) -> str:
    return f"""
SELECT d.transaction_id, d.user_id, d.merchant_id,
  (CAST(d.transaction_amount AS DOUBLE) - b.avg_amount_30d) / nullif(b.stddev_amount_30d, 0) AS amount_zscore,
  greatest(d.velocity_1hr_inclusive - 1, 0) AS velocity_1hr,
  CASE WHEN d.distance_km / d.hours_since_prev > 900 THEN 1 ELSE 0 END AS impossible_travel_flag,
  CASE WHEN d.transaction_date = d.device_first_seen_at THEN 1 ELSE 0 END AS new_device_flag,
  CAST(d.transaction_amount AS DOUBLE) / nullif(CAST(b.p90_amount_30d AS DOUBLE), 0) AS device_amount_percentile,
  CAST((2 * CAST(d.transaction_amount * 100 AS HUGEINT) * 1000000000 + CAST(b.p90_amount_30d * 100 AS HUGEINT))
    // (2 * CAST(b.p90_amount_30d * 100 AS HUGEINT)) AS DOUBLE) / 1000000000 AS exact_percentile,
  CASE WHEN hour(d.transaction_date) NOT BETWEEN b.earliest_active_hour AND b.latest_active_hour THEN 1 ELSE 0 END
    AS off_hours_flag,
  CASE WHEN d.ip_country <> d.billing_country_at_tx_time THEN 1 ELSE 0 END AS location_mismatch_flag,
  m.fraud_rate_90d AS merchant_risk_rate, d.is_fraud_label, d.transaction_date,
  d.transaction_amount, d.payment_method, d.device_type, d.billing_country
FROM moved d LEFT JOIN baseline b ON b.user_id = d.user_id LEFT JOIN {risk} m ON m.merchant_id = d.merchant_id"""


_cte("features", _features_with("risk"))
_cte("features_february", _features_with("risk_february"))

# What was known just before each transaction: moving frames that leave the row's instant out, labels a week late.
_cte("known", """
SELECT *, count(*) OVER w AS n, sum(CAST(transaction_amount * 100 AS HUGEINT)) OVER w AS cents,
  sum(CAST(transaction_amount * 100 AS HUGEINT) * CAST(transaction_amount * 100 AS HUGEINT)) OVER w AS squares,
  CAST(quantile_disc(transaction_amount, 0.9) OVER w * 100 AS HUGEINT) AS p90_cents,
  min(hour(transaction_date)) OVER w AS first_hour, max(hour(transaction_date)) OVER w AS last_hour,
  count(*) OVER m AS labelled, count(*) FILTER (WHERE is_fraud_label) OVER m AS frauds
FROM moved WINDOW w AS (PARTITION BY user_id ORDER BY transaction_date
    RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING),
  m AS (PARTITION BY merchant_id ORDER BY transaction_date
    RANGE BETWEEN INTERVAL 97 DAYS PRECEDING AND (INTERVAL 7 DAYS + INTERVAL 1 MICROSECOND) PRECEDING)""")
_cte("features_known", """
SELECT transaction_id, user_id, merchant_id,
  (CAST(transaction_amount AS DOUBLE) - CAST((2 * cents * 10000 + n) // (2 * n) AS DOUBLE) / 1000000)
    / nullif(CASE WHEN n > 1 THEN sqrt(CAST(n * squares - cents * cents AS DOUBLE) / (n * (n - 1))) / 100 END, 0)
    AS amount_zscore,
  greatest(velocity_1hr_inclusive - 1, 0) AS velocity_1hr,
  CASE WHEN distance_km / hours_since_prev > 900 THEN 1 ELSE 0 END AS impossible_travel_flag,
  CASE WHEN transaction_date = device_first_seen_at THEN 1 ELSE 0 END AS new_device_flag,
  CAST((2 * CAST(transaction_amount * 100 AS HUGEINT) * 1000000000 + p90_cents) // (2 * p90_cents) AS DOUBLE)
    / 1000000000 AS exact_percentile,
  CASE WHEN hour(transaction_date) NOT BETWEEN first_hour AND last_hour THEN 1 ELSE 0 END AS off_hours_flag,
  CASE WHEN ip_country <> billing_country_at_tx_time THEN 1 ELSE 0 END AS location_mismatch_flag,
  CASE WHEN labelled > 0 THEN frauds / labelled END AS merchant_risk_rate, is_fraud_label, transaction_date
FROM known""")

_LOGIT = """-3.0 + 0.6 * coalesce(least(greatest(amount_zscore, -5.0), 5.0), 0)
  + 0.7 * velocity_1hr + 2.0 * impossible_travel_flag + 1.0 * new_device_flag
  + 0.3 * coalesce(least(device_amount_percentile, 5.0), 0) + 0.5 * off_hours_flag
  + 1.5 * location_mismatch_flag + 4.0 * coalesce(merchant_risk_rate, 0)"""
_TIER = """CASE WHEN fraud_probability < 0 THEN NULL WHEN fraud_probability <= 0.3 THEN 'Low'
  WHEN fraud_probability <= 0.7 THEN 'Medium' WHEN fraud_probability <= 1.0 THEN 'High' END AS risk_tier"""
for _name, _source in (("scored", "features"), ("scored_february", "features_february")):
    _cte(_name, f"""
SELECT *, {_TIER} FROM (
  SELECT *, round(1 / (1 + exp(-CAST({_LOGIT} AS DOUBLE))), 6) AS fraud_probability FROM {_source})""")
_cte("kpi", """
SELECT CAST(transaction_date AS DATE) AS date_key, count(*) AS total_transactions,
  count(*) FILTER (WHERE risk_tier = 'High') AS flagged_high,
  count(*) FILTER (WHERE risk_tier = 'Medium') AS flagged_medium,
  count(*) FILTER (WHERE risk_tier = 'Low') AS flagged_low,
  avg(fraud_probability) AS avg_fraud_probability
FROM scored GROUP BY 1""")


def _user_life(source: str, users: str) -> str:
    return f"""
SELECT f.user_id, min(f.transaction_date) AS first_seen_at,
  max(f.transaction_date) AS last_seen_at, count(*) AS lifetime_transaction_count,
  any_value(l.billing_country) AS billing_country,
  any_value(l.preferred_payment_method) AS preferred_payment_method
FROM {source} f JOIN {users} l ON l.user_id = f.user_id GROUP BY f.user_id"""


def _device_life(source: str) -> str:
    return f"""
SELECT device_id, arg_min(device_type, (transaction_date, transaction_id)) AS device_type,
  arg_min(user_id, (transaction_date, transaction_id)) AS first_user_id,
  arg_max(user_id, (transaction_date, transaction_id)) AS latest_user_id,
  min(transaction_date) AS first_seen_at, max(transaction_date) AS last_seen_at,
  count(*) AS lifetime_transaction_count, count(DISTINCT user_id) AS distinct_user_count
FROM {source} GROUP BY device_id"""


_cte("user_life", _user_life("fact", "users_latest"))
_cte("user_life_1", _user_life("fact_1", "users_latest_1"))
_cte("device_life", _device_life("fact"))
_cte("device_life_1", _device_life("fact_1"))


def build(statement: str) -> str:
    """``statement`` preceded by the expressions it uses, directly or not."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
                needed.add(name)
                visit(CTES[name])

    visit(statement)
    ctes = ",\n".join(f"{name} AS ({CTES[name]}\n)" for name in CTES if name in needed)
    return f"WITH {ctes}\n{statement.strip()}" if ctes else statement.strip()


_AMOUNT = "CAST(transaction_amount AS DOUBLE) AS transaction_amount"
_BRONZE = f"""transaction_id, user_id, merchant_id, device_id, {_AMOUNT}, transaction_date, payment_method,
  device_type, ip_address, location_lat, location_lon, ip_country, billing_country, is_fraud_label"""
_BASELINE = """user_id, avg_amount_30d,
  round(stddev_amount_30d, 6) AS stddev_amount_30d, CAST(p90_amount_30d AS DOUBLE) AS p90_amount_30d,
  earliest_active_hour, latest_active_hour, transaction_count_30d"""
_KPI = """date_key, total_transactions, flagged_high, flagged_medium, flagged_low,
  round(avg_fraud_probability, 6) AS avg_fraud_probability"""
_FEATURES = """transaction_id, user_id, merchant_id, round(amount_zscore, 6) AS amount_zscore, velocity_1hr,
  impossible_travel_flag, new_device_flag, exact_percentile AS device_amount_percentile,
  off_hours_flag, location_mismatch_flag, round(merchant_risk_rate, 9) AS merchant_risk_rate, is_fraud_label,
  transaction_date"""
_FLAG = "risk_tier = 'High'"
_RISK_AMOUNT = f"CAST(coalesce(sum(transaction_amount) FILTER (WHERE {_FLAG}), 0) AS DOUBLE)"
_PER_DATE = "CAST(TransactionDate AS DATE)"


def _fraud_by(expression: str, name: str) -> str:
    return f"""SELECT {expression} AS {name}, count(*) AS transactions,
  count(*) FILTER (WHERE is_fraud_label) AS fraud,
  round(count(*) FILTER (WHERE is_fraud_label) / count(*), 9) AS fraud_rate,
  count(*) FILTER (WHERE {_FLAG}) AS flagged, {_RISK_AMOUNT} AS flagged_amount
FROM scored GROUP BY 1"""


def _precision_recall(group: str) -> str:
    return f"""
  round(count(*) FILTER (WHERE {_FLAG} AND is_fraud_label) / nullif(count(*) FILTER (WHERE {_FLAG}), 0), 9)
    AS "precision",
  round(count(*) FILTER (WHERE {_FLAG} AND is_fraud_label) / nullif(count(*) FILTER (WHERE is_fraud_label), 0), 9)
    AS recall,
  round(CAST(sum(CASE WHEN {_FLAG} AND is_fraud_label THEN transaction_amount ELSE 0 END) AS DOUBLE)
    / nullif(CAST(sum(CASE WHEN is_fraud_label THEN transaction_amount ELSE 0 END) AS DOUBLE), 0), 9)
    AS fraud_amount_detected
FROM scored {group}"""


def _psi(source: str, bucket: str) -> str:
    return f"""WITH c AS (SELECT {bucket} AS bucket,
    count(*) FILTER (WHERE transaction_date < TIMESTAMP '2024-01-16') AS reference_rows,
    count(*) FILTER (WHERE transaction_date >= TIMESTAMP '2024-01-16') AS current_rows FROM {source} GROUP BY 1),
  s AS (SELECT *, greatest(reference_rows / sum(reference_rows) OVER (), 0.0001) AS e,
    greatest(current_rows / sum(current_rows) OVER (), 0.0001) AS a FROM c)
SELECT bucket, reference_rows, current_rows, round((a - e) * ln(a / e), 6) AS psi_term FROM s"""


def _psi_of_all(bounds: dict[str, tuple[int, int, int]]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS feature, transaction_date, coalesce(least(greatest(floor(round(CAST("
        f"{'exact_percentile' if name == 'device_amount_percentile' else name} AS DOUBLE), 6) * {steps}), {low * steps}), "
        f"{high * steps}), -1000) AS bucket FROM scored" for name, (steps, low, high) in bounds.items())
    return f"""WITH r AS ({rows}),
  c AS (SELECT feature, bucket, count(*) FILTER (WHERE transaction_date < TIMESTAMP '2024-01-16') AS reference_rows,
    count(*) FILTER (WHERE transaction_date >= TIMESTAMP '2024-01-16') AS current_rows FROM r GROUP BY 1, 2),
  s AS (SELECT *, greatest(reference_rows / sum(reference_rows) OVER (PARTITION BY feature), 0.0001) AS e,
    greatest(current_rows / sum(current_rows) OVER (PARTITION BY feature), 0.0001) AS a FROM c)
SELECT feature, count(*) AS buckets, CAST(sum(current_rows) AS BIGINT) AS current_rows,
  round(sum((a - e) * ln(a / e)), 6) AS psi FROM s GROUP BY feature"""


STATEMENTS: dict[str, str] = {
    # landing and bronze
    "scan_raw": "SELECT * FROM raw",
    "scan_by_business_date": f"""SELECT {_PER_DATE} AS business_date, count(*) AS row_count,
      round(sum(TransactionAmount), 2) AS amount FROM raw GROUP BY 1""",
    "scan_one_business_date": f"""SELECT {_PER_DATE} AS business_date, count(*) AS row_count,
      round(sum(TransactionAmount), 2) AS amount FROM raw WHERE {_PER_DATE} = DATE '2024-01-20' GROUP BY 1""",
    "scan_flat_folder": "SELECT IP_Country AS ip_country, count(*) AS row_count FROM raw GROUP BY 1",
    "scan_named_table": f"SELECT {_BRONZE} FROM fact",
    "bronze_dedup": f"SELECT transaction_id, transaction_date, {_AMOUNT} FROM dedup",
    "bronze_clean": f"SELECT {_BRONZE} FROM fact",
    "bronze_quarantine": """SELECT CASE WHEN TransactionID IS NULL THEN 'missing id' ELSE 'amount not positive' END
      AS reason, UserID AS user_id, TransactionDate AS transaction_date, TransactionAmount AS amount
      FROM raw WHERE TransactionID IS NULL OR TransactionAmount <= 0""",
    "batch_fraud_summary": """SELECT count(*) AS transactions, count(*) FILTER (WHERE IsFraud) AS fraud_transactions,
      round(count(*) FILTER (WHERE IsFraud) / count(*), 9) AS fraud_share FROM raw""",
    "pending_files": f"""SELECT DISTINCT {_PER_DATE} AS business_date FROM raw
      WHERE TransactionDate >= TIMESTAMP '2024-01-16'""",
    "load_ledger": f"SELECT {_PER_DATE} AS business_date, count(*) AS rows_loaded FROM raw GROUP BY 1",
    "load_ledger_seed": f"""SELECT DISTINCT {_PER_DATE} AS business_date, CAST(NULL AS BIGINT) AS rows_loaded,
      'present before the first load' AS note FROM raw""",
    "append_batches": f"""SELECT {_PER_DATE} AS business_date, count(*) AS row_count,
      round(sum(TransactionAmount), 2) AS amount FROM raw GROUP BY 1""",
    # incremental state
    "state_watermark": """SELECT max(transaction_date) AS watermark, TIMESTAMP '1900-01-01' AS empty_watermark
      FROM fact_1""",
    "incremental_filter_event_time": "SELECT transaction_id, transaction_date FROM newer",
    "affected_users": "SELECT DISTINCT user_id FROM newer",
    "affected_users_history": """SELECT transaction_id, user_id FROM fact
      WHERE user_id IN (SELECT user_id FROM newer)""",
    "affected_merchants_history": """SELECT transaction_id, merchant_id FROM fact
      WHERE merchant_id IN (SELECT merchant_id FROM newer)""",
    "incremental_filter_affected": f"SELECT {_BASELINE} FROM baseline WHERE user_id IN (SELECT user_id FROM newer)",
    "bronze_incremental": f"""SELECT transaction_id, transaction_date, {_AMOUNT} FROM fact_1
      UNION ALL SELECT transaction_id, transaction_date, {_AMOUNT} FROM ({_clean(
          "(SELECT * FROM raw_2 WHERE TransactionDate > (SELECT max(transaction_date) FROM fact_1))")})""",
    "fact_upsert": f"SELECT {_BRONZE} FROM upserted",
    "upsert_user_baseline": f"""SELECT {_BASELINE} FROM baseline_1
      WHERE user_id NOT IN (SELECT user_id FROM baseline_affected)
      UNION ALL SELECT {_BASELINE} FROM baseline_affected""",
    "upsert_daily_kpi": f"SELECT {_KPI} FROM kpi",
    "daily_kpi_incremental": f"SELECT {_KPI} FROM kpi WHERE date_key >= DATE '2024-01-16'",
    # dimensions and history
    "users_latest": "SELECT * FROM users_latest",
    "devices_latest": "SELECT * FROM devices_latest",
    "user_lifetime_dim": "SELECT * FROM user_life",
    "device_lifetime_dim": "SELECT * FROM device_life",
    "user_lifetime_incremental": """SELECT * FROM user_life WHERE user_id IN (SELECT user_id FROM newer)
      UNION ALL SELECT * FROM user_life_1 WHERE user_id NOT IN (SELECT user_id FROM newer)""",
    "device_lifetime_incremental": """SELECT * FROM device_life WHERE device_id IN (SELECT device_id FROM newer)
      UNION ALL SELECT * FROM device_life_1 WHERE device_id NOT IN (SELECT device_id FROM newer)""",
    "scd2_users_event_time": "SELECT * FROM users_v",
    "scd2_devices_event_time": "SELECT * FROM devices_v",
    "scd2_users_two_batches": "SELECT * FROM users_snap",
    "scd2_devices_two_batches": "SELECT * FROM devices_snap",
    "users_current": """SELECT user_id, billing_country, preferred_payment_method, dbt_valid_from
      FROM users_snap WHERE dbt_valid_to IS NULL""",
    "devices_current": """SELECT device_id, device_type, primary_user_id, dbt_valid_from
      FROM devices_snap WHERE dbt_valid_to IS NULL""",
    "asof_billing_country": """SELECT transaction_id, transaction_date, ip_country, billing_country_at_tx_time
      FROM located_snap""",
    "asof_billing_country_event_time": """SELECT transaction_id, transaction_date, ip_country,
      billing_country_at_tx_time FROM located""",
    # baselines
    "user_baseline_30d": f"SELECT {_BASELINE} FROM baseline",
    "baseline_from_partials": f"SELECT {_BASELINE} FROM baseline",
    "merchant_risk_from_partials": """SELECT merchant_id, transaction_count_90d, fraud_count_90d,
      round(fraud_rate_90d, 9) AS fraud_rate_90d,
      avg_transaction_amount_90d,
      distinct_customer_count_90d FROM risk""",
    "merchant_risk_90d": """SELECT merchant_id, transaction_count_90d, fraud_count_90d,
      round(fraud_rate_90d, 9) AS fraud_rate_90d,
      avg_transaction_amount_90d,
      distinct_customer_count_90d FROM risk""",
    "user_baseline_point_in_time": """SELECT transaction_id, count(*) OVER w AS prior_count,
      round(CAST(avg(transaction_amount) OVER w AS DOUBLE), 8) AS prior_avg_amount,
      round(stddev_samp(CAST(transaction_amount AS DOUBLE)) OVER w, 6) AS prior_stddev_amount
      FROM fact WINDOW w AS (PARTITION BY user_id ORDER BY transaction_date
        RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)""",
    # features
    "prev_transaction": "SELECT transaction_id, prev_transaction_date, prev_lat, prev_lon FROM windowed",
    "velocity_1h": "SELECT transaction_id, velocity_1hr FROM features",
    "device_first_seen": "SELECT transaction_id, device_first_seen_at FROM windowed",
    "feat_amount_zscore": "SELECT transaction_id, round(amount_zscore, 6) AS amount_zscore FROM features",
    "feat_impossible_travel": """SELECT transaction_id, round(distance_km, 6) AS distance_km,
      round(hours_since_prev, 9) AS hours_since_prev,
      CASE WHEN distance_km / hours_since_prev > 900 THEN 1 ELSE 0 END AS impossible_travel_flag FROM moved""",
    "feat_new_device": "SELECT transaction_id, new_device_flag FROM features",
    "feat_amount_p90_ratio": """SELECT transaction_id, exact_percentile AS device_amount_percentile
      FROM features""",
    "flag_off_hours": "SELECT transaction_id, off_hours_flag FROM features",
    "flag_location_mismatch": "SELECT transaction_id, location_mismatch_flag FROM features",
    "device_risk": """SELECT device_id, count(DISTINCT user_id) AS distinct_users, count(*) AS transactions,
      round(count(*) FILTER (WHERE is_fraud_label) / count(*), 9) AS fraud_rate,
      CAST(date_diff('day', CAST(min(transaction_date) AS DATE), DATE '2024-02-10') AS INTEGER) AS age_days
      FROM fact GROUP BY device_id""",
    "user_frequency": """SELECT transaction_id,
      count(*) OVER (PARTITION BY user_id ORDER BY transaction_date
        RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS transactions_24h,
      count(*) OVER (PARTITION BY user_id ORDER BY transaction_date
        RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW) AS transactions_7d FROM fact""",
    "features_full": f"SELECT {_FEATURES} FROM features",
    "features_point_in_time": f"SELECT {_FEATURES} FROM features_known",
    "features_incremental": f"""SELECT {_FEATURES} FROM features
      WHERE transaction_id IN (SELECT transaction_id FROM newer)""",
    # scoring and evaluation
    "score_transactions": """SELECT transaction_id, user_id, merchant_id, transaction_date, fraud_probability,
      risk_tier FROM scored""",
    "risk_tier": """SELECT risk_tier, count(*) AS transactions, min(fraud_probability) AS lowest,
      max(fraud_probability) AS highest FROM scored GROUP BY risk_tier""",
    "eval_confusion": f"""SELECT count(*) FILTER (WHERE {_FLAG} AND is_fraud_label) AS true_positives,
      count(*) FILTER (WHERE {_FLAG} AND NOT is_fraud_label) AS false_positives,
      count(*) FILTER (WHERE NOT ({_FLAG}) AND is_fraud_label) AS false_negatives,
      count(*) FILTER (WHERE NOT ({_FLAG}) AND NOT is_fraud_label) AS true_negatives FROM scored""",
    "eval_precision_recall": "SELECT" + _precision_recall(""),
    "eval_weekly_decay": "SELECT CAST(date_trunc('week', transaction_date) AS DATE) AS week_start,"
                         + _precision_recall("GROUP BY 1"),
    "eval_pr_auc": """WITH c AS (SELECT fraud_probability AS p, count(*) FILTER (WHERE is_fraud_label) AS f,
        count(*) AS n FROM scored GROUP BY 1),
      r AS (SELECT f, sum(f) OVER (ORDER BY p DESC) AS tp, sum(n) OVER (ORDER BY p DESC) AS np, sum(f) OVER () AS t FROM c)
      SELECT round(sum(CAST(tp AS DOUBLE) / np * f / t), 6) AS pr_auc FROM r""",
    # dashboard measures
    "daily_kpi": f"SELECT {_KPI} FROM kpi",
    "exec_overview": f"""SELECT count(*) AS total_transactions,
      count(*) FILTER (WHERE {_FLAG}) AS flagged_transactions,
      round(count(*) FILTER (WHERE {_FLAG}) / count(*), 9) AS flagged_share,
      round(count(*) FILTER (WHERE is_fraud_label) / count(*), 9) AS fraud_rate,
      {_RISK_AMOUNT} AS amount_at_risk,
      round(count(*) FILTER (WHERE {_FLAG} AND is_fraud_label) / count(*) FILTER (WHERE {_FLAG}), 9)
        AS model_precision FROM scored""",
    "flagged_trend": f"""WITH d AS (SELECT CAST(transaction_date AS DATE) AS date_key, count(*) AS transactions,
        count(*) FILTER (WHERE {_FLAG}) AS flagged FROM scored GROUP BY 1)
      SELECT date_key, transactions, flagged, flagged - lag(flagged) OVER (ORDER BY date_key) AS flagged_change,
        round(avg(flagged) OVER (ORDER BY date_key ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 9)
          AS flagged_moving_avg FROM d""",
    "tier_distribution": """SELECT risk_tier, count(*) AS transactions,
      round(count(*) / sum(count(*)) OVER (), 9) AS share FROM scored GROUP BY risk_tier""",
    "fraud_by_payment_method": _fraud_by("payment_method", "payment_method"),
    "fraud_by_device_type": _fraud_by("device_type", "device_type"),
    "fraud_by_country": _fraud_by("billing_country", "billing_country"),
    "fraud_by_hour": _fraud_by("CAST(hour(transaction_date) AS INTEGER)", "hour_of_day"),
    "kpi_grouping_sets": f"""SELECT payment_method, device_type, billing_country, count(*) AS transactions,
      count(*) FILTER (WHERE is_fraud_label) AS fraud, count(*) FILTER (WHERE {_FLAG}) AS flagged,
      {_RISK_AMOUNT} AS flagged_amount FROM scored
      GROUP BY GROUPING SETS ((payment_method), (device_type), (billing_country), ())""",
    "score_histogram": """SELECT CAST(least(floor(fraud_probability * 10), 9) AS INTEGER) AS bucket,
      count(*) AS transactions, count(*) FILTER (WHERE is_fraud_label) AS fraud FROM scored GROUP BY 1""",
    "tier_by_method_pivot": "SELECT risk_tier, " + ", ".join(
        f"count(*) FILTER (WHERE payment_method = '{m}') AS {m.lower()}"
        for m in ("CREDIT_CARD", "DEBIT_CARD", "BANK_TRANSFER", "DIGITAL_WALLET", "UPI"))
        + " FROM scored GROUP BY risk_tier",
    "top_flagged_users": f"""SELECT user_id, count(*) FILTER (WHERE {_FLAG}) AS flagged,
      {_RISK_AMOUNT} AS flagged_amount, count(*) AS transactions FROM scored GROUP BY user_id
      ORDER BY flagged DESC, flagged_amount DESC, user_id LIMIT 20""",
    "top_risky_merchants": """SELECT merchant_id, transaction_count_90d, fraud_count_90d,
      round(fraud_rate_90d, 9) AS fraud_rate_90d FROM risk
      ORDER BY risk.fraud_rate_90d DESC, transaction_count_90d DESC, merchant_id LIMIT 20""",
    "user_drillthrough": """SELECT s.user_id, s.transaction_id, s.transaction_date,
      CAST(s.transaction_amount AS DOUBLE) AS transaction_amount, s.fraud_probability, s.risk_tier,
      b.avg_amount_30d,
      round(CAST(s.transaction_amount AS DOUBLE) / b.avg_amount_30d, 9) AS amount_vs_avg
      FROM scored s LEFT JOIN baseline b ON b.user_id = s.user_id""",
    "user_behaviour_change": f"""WITH c AS (SELECT user_id,
        count(*) FILTER (WHERE transaction_date >= DATE '2024-01-31' - 7) AS recent_count,
        count(*) FILTER (WHERE transaction_date < DATE '2024-01-31' - 7) AS baseline_count,
        {_mean("transaction_date >= DATE '2024-01-31' - 7")} AS r,
        {_mean("transaction_date < DATE '2024-01-31' - 7")} AS b
        FROM fact WHERE transaction_date >= DATE '2024-01-31' - 30 AND transaction_date < DATE '2024-01-31'
        GROUP BY user_id)
      SELECT user_id, recent_count, baseline_count, r AS recent_avg, b AS baseline_avg,
        round(r / b, 9) AS amount_ratio,
        round((recent_count / CAST(7 AS DOUBLE)) / nullif(baseline_count / CAST(23 AS DOUBLE), 0), 9) AS volume_ratio
      FROM c""",
    # monitoring
    "drift_psi": _psi("scored", "CAST(least(floor(fraud_probability * 10), 9) AS INTEGER)"),
    "feature_drift_psi": _psi("scored", "CAST(least(velocity_1hr, 5) AS INTEGER)"),
    "feature_drift_all": _psi_of_all({
        "amount_zscore": (2, -3, 3), "velocity_1hr": (1, 0, 20), "impossible_travel_flag": (1, 0, 1),
        "new_device_flag": (1, 0, 1), "device_amount_percentile": (4, 0, 5), "off_hours_flag": (1, 0, 1),
        "location_mismatch_flag": (1, 0, 1), "merchant_risk_rate": (50, 0, 1)}),
    "fraud_rate_drift": """WITH d AS (SELECT CAST(transaction_date AS DATE) AS date_key, count(*) AS transactions,
        count(*) FILTER (WHERE is_fraud_label) AS fraud FROM fact GROUP BY 1),
      p AS (SELECT *, fraud / transactions AS rate,
        sum(fraud) OVER w / sum(transactions) OVER w AS prior FROM d
        WINDOW w AS (ORDER BY date_key ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
      SELECT date_key, transactions, fraud, round(rate, 9) AS fraud_rate, round(prior, 9) AS prior_rate,
        round(rate - prior, 9) AS rate_change FROM p""",
    "data_freshness": """SELECT payment_method, max(transaction_date) AS latest_at, count(*) AS transactions,
      round((epoch(TIMESTAMP '2024-02-10') - floor(epoch(max(transaction_date)))) / 3600.0, 9) AS age_hours
      FROM fact GROUP BY payment_method""",
    # quality
    "dq_not_null": """SELECT UserID AS user_id, TransactionDate AS transaction_date FROM raw
      WHERE TransactionID IS NULL""",
    "dq_unique": """SELECT TransactionID AS transaction_id, count(*) AS copies FROM raw
      WHERE TransactionID IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "dq_accepted_values": """SELECT TransactionID AS transaction_id, PaymentMethod AS payment_method,
      TransactionDate AS transaction_date FROM raw WHERE PaymentMethod NOT IN
      ('CREDIT_CARD', 'DEBIT_CARD', 'BANK_TRANSFER', 'DIGITAL_WALLET', 'UPI')""",
    "dq_accepted_range": """SELECT TransactionID AS transaction_id, TransactionDate AS transaction_date,
      TransactionAmount AS amount FROM raw WHERE TransactionAmount < 0 OR TransactionAmount > 100""",
    "dq_expression": """SELECT TransactionID AS transaction_id, TransactionDate AS transaction_date, IP_Country AS ip_country
      FROM raw WHERE NOT (IP_Country = BillingCountry)""",
    "dq_relationships": """SELECT device_id, count(*) AS row_count FROM fact
      WHERE device_id NOT IN (SELECT device_id FROM fact_1) GROUP BY device_id""",
    "daily_run_scores": """SELECT transaction_id, user_id, merchant_id, transaction_date, fraud_probability, risk_tier
      FROM scored_february""",
    "train_and_score": """SELECT count(*) FILTER (WHERE transaction_date < TIMESTAMP '2024-01-23') AS trained_rows,
      count(*) FILTER (WHERE transaction_date < TIMESTAMP '2024-01-23' AND is_fraud_label) AS trained_fraud,
      count(*) FILTER (WHERE transaction_date >= TIMESTAMP '2024-01-23') AS scored_rows,
      count(*) FILTER (WHERE transaction_date >= TIMESTAMP '2024-01-23' AND is_fraud_label) AS scored_fraud,
      true AS all_probabilities_valid, true AS fraud_scores_higher FROM fact""",
    # three daily runs, against a rebuild over all their rows
    "daily_run_resent_far_back": f"SELECT {_BRONZE} FROM run_fact",
    "daily_run_incremental_features": """SELECT transaction_id, user_id, greatest(velocity_1hr_inclusive - 1, 0) AS velocity_1hr,
      CASE WHEN distance_km / hours_since_prev > 900 THEN 1 ELSE 0 END AS impossible_travel_flag,
      CASE WHEN transaction_date = device_first_seen_at THEN 1 ELSE 0 END AS new_device_flag,
      CASE WHEN ip_country <> billing_country_at_tx_time THEN 1 ELSE 0 END AS location_mismatch_flag FROM run_moved""",
    "daily_run_baseline": f"SELECT {_BASELINE} FROM run_baseline",
    "daily_run_merchant_risk": """SELECT merchant_id, transaction_count_90d, fraud_count_90d,
      round(fraud_rate_90d, 9) AS fraud_rate_90d, avg_transaction_amount_90d, distinct_customer_count_90d FROM run_risk""",
    "daily_run_snapshots": "SELECT user_id, billing_country, preferred_payment_method FROM run_users",
    "daily_run_country_versions": "SELECT * FROM run_country_v",
    "daily_run_kpi": """SELECT CAST(transaction_date AS DATE) AS date_key, count(*) AS total_transactions,
      count(*) AS tiered FROM run_fact GROUP BY 1""",
    "daily_run_refresh_times": """SELECT user_id, CASE
        WHEN user_id IN (SELECT user_id FROM run_3) OR user_id IN (SELECT user_id FROM run_before_3
          WHERE transaction_id IN (SELECT transaction_id FROM run_3)) OR user_id IN (SELECT user_id FROM run_fact
          WHERE CAST(transaction_date AS DATE) = DATE '2024-01-10') THEN DATE '2024-02-10'
        WHEN user_id IN (SELECT user_id FROM run_2) OR user_id IN (SELECT user_id FROM fact_1
          WHERE transaction_id IN (SELECT transaction_id FROM run_2)) OR user_id IN (SELECT user_id FROM run_before_3
          WHERE CAST(transaction_date AS DATE) = DATE '2024-01-09') THEN DATE '2024-02-09'
        ELSE DATE '2024-02-08' END AS refreshed_on FROM run_baseline""",
    # heavy keys
    "velocity_1h_sliced": "SELECT transaction_id, velocity_1hr FROM features",
    "scd2_sliced": "SELECT * FROM users_v",
    "asof_sliced": "SELECT transaction_id, transaction_date, ip_country, billing_country_at_tx_time FROM located",
    "features_full_sliced": f"SELECT {_FEATURES} FROM features",
    # streaming, against the batch form over the same rows
    "stream_bronze_dedup": "SELECT DISTINCT TransactionID AS transaction_id FROM raw WHERE TransactionID IS NOT NULL",
    "stream_daily_kpi": f"SELECT {_KPI} FROM kpi",
    "stream_velocity_sliding": """WITH starts AS (SELECT user_id,
        time_bucket(INTERVAL 5 MINUTES, transaction_date, TIMESTAMP '2000-01-01') - to_minutes(5 * back) AS window_start
        FROM fact CROSS JOIN range(12) t(back))
      SELECT user_id, window_start, count(*) AS transactions FROM starts GROUP BY user_id, window_start""",
    # all sessions, open ones at the end of the input too
    "stream_burst_sessions": """WITH marked AS (SELECT user_id, transaction_date, is_fraud_label,
        CASE WHEN transaction_date <= lag(transaction_date) OVER u + INTERVAL 10 MINUTES THEN 0 ELSE 1 END AS opens
        FROM fact WINDOW u AS (PARTITION BY user_id ORDER BY transaction_date)),
      numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY transaction_date
        ROWS UNBOUNDED PRECEDING) AS session FROM marked)
      SELECT user_id, min(transaction_date) AS session_start,
        max(transaction_date) + INTERVAL 10 MINUTES AS session_end, count(*) AS transactions,
        count(*) FILTER (WHERE is_fraud_label) AS fraud
      FROM numbered GROUP BY user_id, session
      HAVING count(*) >= 2""",
    "stream_scored_alerts": """SELECT transaction_id, user_id, transaction_date, fraud_probability, risk_tier
      FROM scored WHERE fraud_probability > 0.7""",
    "stream_velocity_exact": "SELECT transaction_id, velocity_1hr FROM features",
}


def _quality_report() -> str:
    """One row per declared check, as one plain statement per check."""
    sources = {
        "bronze_transactions": "fact", "fact": "fact", "users_versions": "users_snap",
        "devices_versions": "devices_snap", "features": "features", "scores": "scored", "daily_kpi": "kpi",
        "users_current": "(SELECT * FROM users_snap WHERE dbt_valid_to IS NULL)",
        "devices_current": "(SELECT * FROM devices_snap WHERE dbt_valid_to IS NULL)",
        "user_baseline": "(SELECT *, DATE '2024-02-10' AS last_updated_at FROM baseline)",
        "merchant_risk": "(SELECT *, DATE '2024-02-10' AS last_updated_at FROM risk)",
    }
    parts = []
    for table, checks in contracts().items():
        for check in checks:
            column = check.column
            if check.kind == "relationships":
                parent, parent_column = check.arguments
                counted = (f"SELECT count(*) FROM {sources[table]} WHERE {column} IS NOT NULL AND {column} NOT IN "
                           f"(SELECT {parent_column} FROM {sources[parent]} WHERE {parent_column} IS NOT NULL)")
            elif check.kind == "unique":
                counted = (f"SELECT count(*) FROM (SELECT {column} FROM {sources[table]} WHERE {column} IS NOT NULL "
                           f"GROUP BY {column} HAVING count(*) > 1)")
            else:
                failing = {
                    "not_null": lambda: f"{column} IS NULL",
                    "accepted_values": lambda: f"{column} NOT IN ({', '.join(map(_literal, check.arguments))})",
                    "accepted_range": lambda: " OR ".join(
                        f"{column} {sign} {bound}" for sign, bound in zip("<>", check.arguments) if bound is not None),
                    "expression_is_true": lambda: f"NOT ({column})",
                }[check.kind]()
                counted = f"SELECT count(*) FROM {sources[table]} WHERE {failing}"
            shown = column.replace("'", "''")
            parts.append(f"SELECT '{table}' AS table_name, '{shown}' AS column_name, '{check.kind}' AS check_name, "
                         f"({counted}) AS failures")
    return "\nUNION ALL ".join(parts)


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


STATEMENTS["user_frequency_sliced"] = STATEMENTS["user_frequency"]
STATEMENTS["features_incremental_bounded"] = STATEMENTS["features_incremental"]
STATEMENTS["dq_report"] = _quality_report()


def oracle_statements() -> dict[str, str]:
    return {name: _flatten(build(sql)) for name, sql in STATEMENTS.items()}


def _flatten(sql: str) -> str:
    """Merge a statement's own WITH into the common one in front of it."""
    return re.sub(r"\n\)\nWITH ", "\n),\n", sql)
