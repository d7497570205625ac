"""The physical plans the operators are meant to have."""

import re

import pytest

from tests.helpers import FOLDER
from txnrisk.operators.behaviour import behaviour_windows, user_frequency
from txnrisk.operators.clean import deduplicate
from txnrisk.operators.point_in_time import prior_merchant_rate
from txnrisk.operators.scd2 import asof_join
from txnrisk.plans import layers
from txnrisk.plans.catalogue import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_all_user_windows_share_one_shuffle(spark):
    text = plan(behaviour_windows(layers.fact(spark, FOLDER)))
    assert exchanges(text) == 1 and text.count("Sort [") == 2


def test_asof_and_windows_share_shuffle_and_sort(spark):
    fact = layers.fact(spark, FOLDER)
    located = asof_join(fact, layers.country_versions(spark, FOLDER), "user_id", "transaction_date", "transaction_id",
                        {"billing_country": "then"})
    text = plan(behaviour_windows(located))
    assert exchanges(text) == 1 and text.count("Sort [") == 2


def test_copies_are_cut_before_the_shuffle(spark):
    text = plan(deduplicate(layers.fact(spark, FOLDER)))
    assert "Partial" in text and text.count("WindowGroupLimit") == 2


def test_trailing_counts_need_one_shuffle(spark):
    text = plan(user_frequency(layers.fact(spark, FOLDER).select("transaction_id", "user_id", "transaction_date")))
    assert exchanges(text) == 1


def test_sums_before_shuffle_once_and_narrow(spark):
    rows = layers.fact(spark, FOLDER).select("transaction_id", "merchant_id", "transaction_date", "is_fraud_label")
    text = plan(prior_merchant_rate(rows))
    assert exchanges(text) == 1 and "SortMergeJoin" not in text


def test_kpis_read_only_their_columns(spark):
    text = plan(QUERIES["daily_kpi"](spark, FOLDER))
    assert re.search(r"ReadSchema: struct<transaction_date:timestamp_ntz,fraud_probability:double,risk_tier:string>", text)


def test_trailing_window_prunes_days(spark):
    text = plan(QUERIES["user_baseline_30d"](spark, FOLDER))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*>= 2024-01-11", text)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(transaction_date", text)


# These run Spark jobs or fit a model on the way to their result.
EAGER = {n for n in QUERIES if n.startswith("stream_")} | {"train_and_score", "daily_run_scores"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert not re.search(r"Python|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin", text)
