"""Chronological split, model table, samples and feature policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators.ordered import MAX_ROWS_PER_TASK, exact_quantiles

# Feature lists and the policy of each feature.
NUMERIC_FEATURES = [
    "amount", "log_amount", "distance_from_home", "transaction_hour", "weekend_transaction", "card_present",
    "customer_prior_transactions", "minutes_since_previous_transaction", "previous_customer_amount",
    "customer_avg_amount_prior", "customer_std_amount_prior", "amount_vs_customer_average",
    "amount_zscore_vs_customer_history", "calculated_txn_count_1h", "calculated_amount_1h",
    "calculated_txn_count_24h", "calculated_amount_24h", "new_merchant_for_customer_flag",
    "overnight_transaction_flag",
]
CATEGORICAL_FEATURES = [
    "merchant_category", "merchant_type", "merchant", "currency", "country", "city_size", "card_type", "device",
    "channel",
]
NETWORK_FEATURES = [
    "prior_device_transactions", "prior_card_transactions", "prior_customers_on_device", "prior_cards_on_device",
    "prior_devices_on_card", "prior_merchants_on_device", "new_device_for_customer_flag",
    "device_changed_from_previous_flag", "new_customer_on_existing_device_flag", "new_card_on_existing_device_flag",
    "device_shared_by_multiple_customers_flag", "device_shared_by_multiple_cards_flag",
    "card_used_across_multiple_devices_flag",
]
BENCHMARK_FEATURES = [f for f in NETWORK_FEATURES if f not in ("prior_device_transactions", "prior_card_transactions")]
EXCLUDED_FEATURES = ["customer_id", "card_number", "device_fingerprint", "ip_address", "velocity_last_hour"]
MODEL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
SPLITS = ["train", "validation", "test"]
RULE_COLUMNS = ["distance_from_home", "calculated_txn_count_1h", "calculated_amount_24h"]


def timestamp(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def chrono_split(validation_start: str, test_start: str, ts: str = "transaction_ts") -> Column:
    """Half-open periods: before the first cut train, before the second validation, then test."""
    return (
        F.when(F.col(ts) < timestamp(validation_start), "train")
        .when(F.col(ts) < timestamp(test_start), "validation")
        .otherwise("test")
    )


def valid_rows(features: DataFrame) -> DataFrame:
    """The gate before any model table: rows with a time and a label of 0 or 1."""
    return features.filter(F.col("transaction_ts").isNotNull() & F.col("is_fraud").isin(0, 1))


def model_base(features: DataFrame, validation_start: str, test_start: str) -> DataFrame:
    """Rows with a time and a label, with the model features and the benchmark-only network features."""
    derived = {
        "log_amount": C.log_amount(F.col("amount")),
        "weekend_transaction": F.col("weekend_transaction").cast("int"),
        "card_present": F.col("card_present").cast("int"),
    }
    names = ["transaction_key", "transaction_ts", "transaction_date"]
    return (
        valid_rows(features)
        .withColumns(derived)
        .select(*names, chrono_split(validation_start, test_start).alias("data_split"), "is_fraud",
                *MODEL_FEATURES, *NETWORK_FEATURES)
    )


def split_summary(base: DataFrame) -> DataFrame:
    report = base.groupBy("data_split").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("is_fraud").alias("fraud_transactions"),
        C.pct(F.col("is_fraud")).alias("fraud_rate_pct"),
        F.min("transaction_ts").alias("first_transaction"),
        F.max("transaction_ts").alias("last_transaction"),
    )
    return report.orderBy(F.array_position(F.array(*[F.lit(s) for s in SPLITS]), F.col("data_split")))


def hash_sample(df: DataFrame, buckets: int, key: str = "transaction_key") -> DataFrame:
    """The same one in ``buckets`` keys on every run and every cluster."""
    return df.filter(C.sample_bucket(F.col(key), buckets) == 0)


def sample_summary(sample: DataFrame) -> DataFrame:
    return sample.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("is_fraud").alias("fraud_transactions"),
        C.pct(F.col("is_fraud")).alias("fraud_rate_pct"),
    )


def feature_policy(features: DataFrame) -> DataFrame:
    """Features per policy, how many of them the table holds, and their known values."""
    policy = {f: "main_model" for f in MODEL_FEATURES}
    policy |= {f: "rule_or_benchmark" for f in BENCHMARK_FEATURES}
    policy |= {f: "excluded" for f in EXCLUDED_FEATURES}
    held = [f for f in policy if f in features.columns]
    known = features.agg(*[F.count(F.col(f)).alias(f) for f in held]).unpivot([], held, "feature", "known_values")
    table = features.sparkSession.createDataFrame(list(policy.items()), "feature string, policy string")
    return table.join(known, "feature", "left").groupBy("policy").agg(
        F.count(F.lit(1)).alias("features"),
        F.count("known_values").alias("features_in_table"),
        F.coalesce(F.sum("known_values"), F.lit(0)).alias("known_values"),
    ).orderBy("policy")


def rule_thresholds(train: DataFrame, probability: float = 0.95, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Upper percentiles of the training rows with a known distance, as one row."""
    known = train.filter(F.col("distance_from_home").isNotNull())
    quantiles = exact_quantiles(known, RULE_COLUMNS, [probability], max_rows)
    names = dict(zip(RULE_COLUMNS, ["distance_p95", "velocity_1h_p95", "amount_24h_p95"]))
    return quantiles.agg(*[
        F.max(F.when(F.col("feature") == c, F.col("value"))).alias(n) for c, n in names.items()])


def category_domain(train: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    """Values of the other period per column: rows, and whether training knows the value.

    A missing category is a value of its own; a value training never saw counts as unseen.
    """
    def values(df: DataFrame) -> DataFrame:
        filled = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(C.MISSING_CATEGORY)).alias(c) for c in columns])
        return filled.unpivot([], columns, "feature", "category").groupBy("feature", "category").agg(
            F.count(F.lit(1)).alias("transactions"))

    known = values(train).select("feature", "category", F.lit(1).alias("known"))
    return values(other).join(known, ["feature", "category"], "left").select(
        "feature", "category", "transactions", F.coalesce("known", F.lit(0)).alias("in_training"))
