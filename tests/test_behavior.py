"""Leakage, ties and NULLs in the history features."""

import datetime as dt

from conftest import same_rows
from pyspark.sql import functions as F

from riskloom.operators import behavior, network
from riskloom.sources import fixtures as X

FEATURES = [
    "customer_prior_transactions", "previous_customer_amount", "customer_avg_amount_prior", "customer_std_amount_prior",
    "minutes_since_previous_transaction", "calculated_txn_count_1h", "calculated_amount_1h", "calculated_txn_count_24h",
    "calculated_amount_24h", "new_device_for_customer_flag", "device_changed_from_previous_flag",
]


def test_later_rows_never_change_earlier_features(spark, folder):
    tx = X.tx(spark, folder)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    early = tx.filter(F.col("transaction_ts") < cut)
    columns = ["transaction_key", *FEATURES, "prior_customers_on_device", "prior_devices_on_card"]
    everything = network.network_features(behavior.behavior_features(tx)).filter(F.col("transaction_ts") < cut)
    assert same_rows(everything, network.network_features(behavior.behavior_features(early)), columns)


def test_row_order_does_not_matter(spark, folder):
    tx = X.tx(spark, folder)
    columns = ["transaction_key", *FEATURES]
    shuffled = tx.orderBy(F.md5("transaction_key")).repartition(5)
    assert same_rows(behavior.behavior_features(tx), behavior.behavior_features(shuffled), columns)


def test_first_row_has_no_history(spark, folder):
    first = behavior.behavior_features(X.tx(spark, folder)).filter("customer_prior_transactions = 0")
    assert first.filter(
        "previous_customer_amount is not null or customer_avg_amount_prior is not null "
        "or new_device_for_customer_flag = 0 or new_merchant_for_customer_flag = 0").count() == 0


def payments(spark, rows):
    schema = ("transaction_key string, transaction_ts timestamp_ntz, amount double, device_fingerprint string, "
              "transaction_hour int")
    return spark.createDataFrame(rows, schema).withColumns({
        "customer_id": F.lit("c"), "card_number": F.lit("k"), "merchant": F.lit("m"), "ip_address": F.lit("i")})


def test_ties_count_and_range_ends_are_inclusive(spark):
    t = dt.datetime(2024, 1, 1, 12)
    rows = [("a", t, 10.0, "d1", 12), ("b", t, 20.0, "d1", 12), ("c", t + dt.timedelta(hours=1), 30.0, "d2", 13),
            ("d", t + dt.timedelta(hours=1, microseconds=1), 40.0, "d2", 13)]
    got = {r["transaction_key"]: r for r in behavior.behavior_features(payments(spark, rows)).collect()}
    assert [got[k]["calculated_txn_count_1h"] for k in "abcd"] == [1, 1, 2, 1]
    assert [got[k]["calculated_amount_1h"] for k in "abcd"] == [20.0, 10.0, 30.0, 30.0]
    assert [got[k]["customer_prior_transactions"] for k in "abcd"] == [0, 1, 2, 3]
    assert [got[k]["device_changed_from_previous_flag"] for k in "abcd"] == [0, 0, 1, 0]


def test_zero_history_gives_null_ratios(spark):
    t = dt.datetime(2024, 1, 1, 12)
    rows = [("a", t, 0.0, "d", 12), ("b", t + dt.timedelta(seconds=90, milliseconds=999), 5.0, None, 12)]
    got = {r["transaction_key"]: r for r in behavior.behavior_features(payments(spark, rows)).collect()}
    assert got["b"]["amount_vs_customer_average"] is None
    assert got["b"]["minutes_since_previous_transaction"] == 1.5
    assert got["b"]["device_changed_from_previous_flag"] == 0


def test_running_distinct_is_exact(spark, folder):
    tx = X.tx(spark, folder)
    got = network.network_features(tx)
    a, b = got.alias("a"), tx.alias("b")
    brute = a.join(b, F.expr(
        "a.device_fingerprint = b.device_fingerprint and (b.transaction_ts, b.transaction_key) < (a.transaction_ts, a.transaction_key)"),
        "left").groupBy("a.transaction_key").agg(
            F.count_distinct("b.customer_id").alias("prior_customers_on_device"),
            F.count_distinct("b.card_number").alias("prior_cards_on_device"),
            F.count("b.transaction_key").alias("prior_device_transactions"))
    assert same_rows(got, brute, brute.columns)
