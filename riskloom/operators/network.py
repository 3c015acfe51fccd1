"""Card, device and customer links: leakage-safe history features and full-period edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators.behavior import EVENT_ORDER
from riskloom.operators.skew import MAX_ROWS_PER_TASK, per_entity, running


LINK_INPUTS = [
    "transaction_key", "transaction_ts", "device_fingerprint", "customer_id", "card_number", "merchant",
]


def _device_history(df: DataFrame, chunk: str | None) -> DataFrame:
    # The device window comes first: its exchange also serves the finer (device, x) windows.
    df = running(df, ["device_fingerprint"], EVENT_ORDER, {"prior_device_transactions": ("count", None)}, chunk)
    # An entity linked for the first time opens a new link, so counting first links before the
    # current row gives the exact running distinct count without collecting a set.
    for linked, name in [("customer_id", "customer"), ("card_number", "card"), ("merchant", "merchant")]:
        df = running(df, ["device_fingerprint", linked], EVENT_ORDER, {f"_links_{name}": ("count", None)}, chunk)
    return running(df, ["device_fingerprint"], EVENT_ORDER, {
        "prior_customers_on_device": ("sum", (F.col("_links_customer") == 0).cast("bigint")),
        "prior_cards_on_device": ("sum", (F.col("_links_card") == 0).cast("bigint")),
        "prior_merchants_on_device": ("sum", (F.col("_links_merchant") == 0).cast("bigint")),
    }, chunk)


def _card_history(df: DataFrame, chunk: str | None) -> DataFrame:
    return running(df, ["card_number"], EVENT_ORDER, {
        "prior_card_transactions": ("count", None),
        "prior_devices_on_card": ("sum", (F.col("_links_card") == 0).cast("bigint")),
    }, chunk)


def network_features(df: DataFrame, max_rows: int = MAX_ROWS_PER_TASK, rows: int | None = None) -> DataFrame:
    """Rows with their earlier device and card use, and the flags built on it, in place: one exchange by device and one
    by card carry the row along. No key is looked up, so NULL or repeated keys lose and multiply nothing, and none has to
    be counted first. Columns that nobody reads are pruned before the exchanges.
    """
    rows = df.count() if rows is None else rows
    table = per_entity(df, ["device_fingerprint"], EVENT_ORDER, _device_history, max_rows, rows)
    table = per_entity(table, ["card_number"], EVENT_ORDER, _card_history, max_rows, rows)
    known_device = F.col("prior_device_transactions") > 0
    return table.withColumns({
        "device_customer_sequence": F.col("_links_customer") + 1,
        "device_card_sequence": F.col("_links_card") + 1,
        "device_merchant_sequence": F.col("_links_merchant") + 1,
        "new_customer_on_existing_device_flag": C.flag((F.col("_links_customer") == 0) & known_device),
        "new_card_on_existing_device_flag": C.flag((F.col("_links_card") == 0) & known_device),
        "device_shared_by_multiple_customers_flag": C.flag(F.col("prior_customers_on_device") >= 2),
        "device_shared_by_multiple_cards_flag": C.flag(F.col("prior_cards_on_device") >= 2),
        "card_used_across_multiple_devices_flag": C.flag(F.col("prior_devices_on_card") >= 2),
    }).drop("_links_customer", "_links_card", "_links_merchant")


def _edges(df: DataFrame, linked: str, counted: str, counted_as: str) -> DataFrame:
    return df.groupBy("device_fingerprint", linked).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_distinct(F.col(counted)).alias(counted_as),
        F.min("transaction_ts").alias("first_seen"),
        F.max("transaction_ts").alias("last_seen"),
        F.sum("is_fraud").alias("fraud_transactions"),
        C.pct(F.col("is_fraud")).alias("fraud_rate_pct"),
    )


def device_card_edges(df: DataFrame) -> DataFrame:
    return _edges(df, "card_number", "customer_id", "customers")


def device_customer_edges(df: DataFrame) -> DataFrame:
    return _edges(df, "customer_id", "card_number", "cards")


def device_connectivity(df: DataFrame) -> DataFrame:
    """Every device with its size, links and fraud."""
    return df.groupBy("device_fingerprint").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_distinct(F.col("customer_id")).alias("customers"),
        F.count_distinct(F.col("card_number")).alias("cards"),
        F.count_distinct(F.col("merchant")).alias("merchants"),
        F.sum("is_fraud").alias("fraud_transactions"),
        C.pct(F.col("is_fraud")).alias("fraud_rate_pct"),
    )


def top_devices(df: DataFrame, limit: int = 200) -> DataFrame:
    """Most shared devices; the device itself settles ties."""
    return (
        device_connectivity(df).filter("transactions > 1")
        .orderBy(F.desc("customers"), F.desc("cards"), F.desc("transactions"), F.asc_nulls_last("device_fingerprint"))
        .limit(limit)
    )


def suspicious_devices(df: DataFrame, limit: int = 500) -> DataFrame:
    """Devices with many links, fraud before size; the device itself settles ties."""
    return (
        device_connectivity(df).filter("transactions >= 2")
        .orderBy(F.desc("customers"), F.desc("cards"), F.desc("fraud_transactions"),
                 F.asc_nulls_last("device_fingerprint"))
        .limit(limit)
    )


def device_summary(df: DataFrame) -> DataFrame:
    """How many devices are reused, shared, fraud-only, legitimate-only or mixed."""
    devices = df.groupBy("device_fingerprint").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_distinct(F.col("customer_id")).alias("customers"),
        F.count_distinct(F.col("card_number")).alias("cards"),
        F.min("is_fraud").alias("low"), F.max("is_fraud").alias("high"),
    )
    return devices.agg(
        F.count(F.lit(1)).alias("devices"),
        F.count_if(F.col("transactions") > 1).alias("reused_devices"),
        F.count_if(F.col("customers") > 1).alias("devices_shared_by_customers"),
        F.count_if(F.col("cards") > 1).alias("devices_shared_by_cards"),
        F.count_if(F.col("low") == 1).alias("fraud_only_devices"),
        F.count_if(F.col("high") == 0).alias("legitimate_only_devices"),
        F.count_if(F.col("low") != F.col("high")).alias("mixed_fraud_devices"),
    )


def ip_summary(df: DataFrame) -> DataFrame:
    addresses = df.groupBy("ip_address").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_distinct(F.col("customer_id")).alias("customers"),
        F.count_distinct(F.col("card_number")).alias("cards"),
    )
    return addresses.agg(
        F.count(F.lit(1)).alias("ip_addresses"),
        F.count_if(F.col("transactions") > 1).alias("reused_ips"),
        F.count_if(F.col("customers") > 1).alias("ips_shared_by_customers"),
        F.count_if(F.col("cards") > 1).alias("ips_shared_by_cards"),
        F.max("transactions").alias("max_transactions_per_ip"),
    )
