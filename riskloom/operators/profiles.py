"""Counting reports over payments and features. Each is one scan with map-side partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators.duplicates import duplicate_id_count

# Report names of the counted columns and the profiled dimensions.
DISTINCT_COUNTS = {
    "unique_transaction_ids": "transaction_id", "unique_customers": "customer_id", "unique_cards": "card_number",
    "unique_merchants": "merchant", "unique_device_fingerprints": "device_fingerprint",
    "unique_ip_addresses": "ip_address", "countries": "country", "currencies": "currency",
}
MISSING_COUNTS = {
    "missing_amount": "amount", "missing_timestamp": "transaction_ts", "missing_customer": "customer_id",
    "missing_card": "card_number", "missing_merchant": "merchant",
    "missing_device_fingerprint": "device_fingerprint", "missing_ip_address": "ip_address",
}
DIMENSIONS = [
    "merchant_category", "merchant_type", "currency", "country", "city_size", "card_type", "card_present",
    "device", "channel", "high_risk_merchant", "transaction_hour", "weekend_transaction",
]
BEHAVIOR_SIGNALS = {
    "new_device": "new_device_for_customer_flag", "new_ip": "new_ip_for_customer_flag",
    "new_merchant": "new_merchant_for_customer_flag", "device_changed": "device_changed_from_previous_flag",
}
NETWORK_SIGNALS = {
    "new_customer_existing_device": "new_customer_on_existing_device_flag",
    "new_card_existing_device": "new_card_on_existing_device_flag",
    "device_multiple_customers": "device_shared_by_multiple_customers_flag",
    "device_multiple_cards": "device_shared_by_multiple_cards_flag",
    "card_multiple_devices": "card_used_across_multiple_devices_flag",
}


def _fraud_value() -> Column:
    return F.sum(F.when(F.col("is_fraud") == 1, F.col("amount")).otherwise(0.0))


def _volume() -> list[Column]:
    return [F.count(F.lit(1)).alias("transactions"), F.sum("is_fraud").alias("fraud_transactions")]


def raw_quality(df: DataFrame) -> DataFrame:
    """Key, amount and label defects of typed rows."""
    return df.agg(
        F.count(F.lit(1)).alias("transaction_rows"),
        F.count_distinct(F.col("transaction_id")).alias("unique_transaction_ids"),
        F.count_if(F.col("transaction_id").isNull()).alias("null_transaction_ids"),
        F.count_if(F.col("amount").isNull() | (F.col("amount") < 0)).alias("invalid_or_null_transaction_amounts"),
        F.count_if(F.col("is_fraud") == 1).alias("fraud_transactions"),
        C.rounded(F.avg("is_fraud"), 9).alias("fraud_rate"),
    )


def side_table_keys(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("identity_rows"),
                  F.count_distinct(F.col(key)).alias("unique_identity_transaction_ids"))


def match_rate(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of the left join and the share that found a partner.

    The right side shrinks to one count per key first, so a key with many rows on both sides is
    never multiplied out.
    """
    partners = right.filter(F.col(right_key).isNotNull()).groupBy(F.col(right_key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_partners"))
    keys = left.groupBy(F.col(left_key).alias("_left")).agg(F.count(F.lit(1)).alias("_rows"))
    joined = keys.join(partners, F.col("_left") == F.col("_key"), "left")
    matched = F.sum(F.when(F.col("_partners").isNotNull(), F.col("_rows") * F.col("_partners")).otherwise(0))
    rows = F.sum(F.col("_rows") * F.coalesce("_partners", F.lit(1)))
    return joined.agg(rows.alias("joined_rows"), C.rounded(C.ratio(matched, rows), 9).alias("identity_match_rate"))


def dataset_profile(df: DataFrame) -> DataFrame:
    """Distinct counts, time span, fraud and defects of the typed table."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_distinct(F.col(c)).alias(n) for n, c in DISTINCT_COUNTS.items()],
        F.min("transaction_ts").alias("min_timestamp"),
        F.max("transaction_ts").alias("max_timestamp"),
        F.count_if(F.col("is_fraud") == 1).alias("fraud_transactions"),
        C.rounded(F.avg("is_fraud"), 9).alias("fraud_rate"),
        F.count_if(F.col("transaction_id").isNull()).alias("missing_transaction_id"),
        F.count_if(F.col("customer_id").isNull()).alias("missing_customer_id"),
        F.count_if(F.col("transaction_ts").isNull()).alias("invalid_or_missing_timestamp"),
        F.count_if(F.col("amount").isNull()).alias("invalid_or_missing_amount"),
        F.count_if(F.col("is_fraud").isNull()).alias("invalid_or_missing_fraud_label"),
        F.count_if(F.col("amount") < 0).alias("negative_amounts"),
    )


def quality_summary(df: DataFrame) -> DataFrame:
    """The cleaned table in one row."""
    distinct = {n: c for n, c in DISTINCT_COUNTS.items() if n.startswith("unique_")}
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_distinct(F.col(c)).alias(n) for n, c in distinct.items()],
        F.min("transaction_ts").alias("min_timestamp"),
        F.max("transaction_ts").alias("max_timestamp"),
        F.count_if(F.col("is_fraud") == 1).alias("fraud_transactions"),
        C.pct(F.col("is_fraud")).alias("fraud_rate_pct"),
        F.count_if(F.col("amount") < 0).alias("negative_amount"),
        *[F.count_if(F.col(c).isNull()).alias(n) for n, c in MISSING_COUNTS.items()],
    ).withColumn("duplicate_transaction_ids", duplicate_id_count(df).scalar())


def missingness(df: DataFrame) -> DataFrame:
    """Blank and null-like values of every raw text column; one scan for all columns."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count_if(C.is_blank_like(F.col(c))).alias(c) for c in df.columns])
    report = counts.unpivot(["total_rows"], df.columns, "column_name", "missing_rows")
    share = C.rounded(F.lit(100.0) * C.ratio(F.col("missing_rows"), F.col("total_rows")), 4)
    return report.select("column_name", "total_rows", "missing_rows", share.alias("missing_pct")).orderBy(
        F.desc("missing_pct"), "column_name")


def fraud_by_dimension(df: DataFrame, dimensions: list[str] = DIMENSIONS) -> DataFrame:
    """Volume, fraud and value of every category of every dimension in one shuffle."""
    texts = df.select("is_fraud", "amount", *[F.col(d).cast("string").alias(d) for d in dimensions])
    return (
        texts.unpivot(["is_fraud", "amount"], dimensions, "dimension", "category")
        .groupBy("dimension", "category")
        .agg(
            *_volume(),
            C.pct(F.col("is_fraud")).alias("fraud_rate_pct"),
            C.rounded(F.avg("amount"), 2).alias("avg_transaction_amount"),
            C.rounded(F.sum("amount"), 2).alias("total_transaction_value"),
            C.rounded(_fraud_value(), 2).alias("fraud_transaction_value"),
        )
        .orderBy("dimension", F.desc("fraud_rate_pct"), "category")
    )


def amount_bands(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("amount").isNotNull())
        .groupBy(C.amount_band(F.col("amount")).alias("amount_band"))
        .agg(*_volume(), C.pct(F.col("is_fraud")).alias("fraud_rate_pct"),
             C.rounded(F.avg("amount"), 2).alias("avg_amount"), C.rounded(_fraud_value(), 2).alias("fraud_value"))
        .orderBy("amount_band")
    )


def daily_trend(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("transaction_date")
        .agg(*_volume(), C.pct(F.col("is_fraud")).alias("fraud_rate_pct"),
             C.rounded(F.sum("amount"), 2).alias("transaction_value"), C.rounded(_fraud_value(), 2).alias("fraud_value"))
        .orderBy("transaction_date")
    )


def fraud_overall(df: DataFrame) -> DataFrame:
    return df.agg(*_volume(), C.pct(F.col("is_fraud")).alias("fraud_rate_pct"),
                  C.rounded(_fraud_value(), 2).alias("fraud_value"))


def fraud_by(df: DataFrame, column: str, with_amount: bool = False, by_rate: bool = True) -> DataFrame:
    """Fraud rate of every value of one column."""
    extra = [C.rounded(F.avg("amount"), 2).alias("avg_amount")] if with_amount else []
    report = df.groupBy(column).agg(*_volume(), C.pct(F.col("is_fraud"), 3).alias("fraud_rate_pct"), *extra)
    return report.orderBy(F.desc("fraud_rate_pct"), column) if by_rate else report.orderBy(column)


def _signal_rates(df: DataFrame, signals: dict[str, Column], name: str, value: str, as_text: bool) -> DataFrame:
    kind = "string" if as_text else "int"
    flags = df.select("is_fraud", *[c.cast(kind).alias(s) for s, c in signals.items()])
    return (
        flags.unpivot(["is_fraud"], list(signals), name, value)
        .groupBy(name, value).agg(*_volume(), C.pct(F.col("is_fraud")).alias("fraud_rate_pct"))
        .orderBy(name, value)
    )


def behavior_signals(df: DataFrame) -> DataFrame:
    return _signal_rates(df, {s: F.col(c) for s, c in BEHAVIOR_SIGNALS.items()}, "signal", "signal_value", False)


def network_signals(df: DataFrame) -> DataFrame:
    return _signal_rates(df, {s: F.col(c) for s, c in NETWORK_SIGNALS.items()}, "signal", "signal_value", False)


def audit_signals(df: DataFrame) -> DataFrame:
    """Signals suspiciously close to the label, with their values as text."""
    signals = {
        "new_device": F.col("new_device_for_customer_flag"),
        "device_changed": F.col("device_changed_from_previous_flag"),
        "new_merchant": F.col("new_merchant_for_customer_flag"),
        "high_risk_merchant": F.col("high_risk_merchant"),
        "amount_under_10": C.flag(F.col("amount") < 10),
        "amount_under_25": C.flag(F.col("amount") < 25),
    }
    return _signal_rates(df, signals, "feature", "feature_value", True)


def behavior_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_distinct(F.col("transaction_key")).alias("unique_transaction_keys"),
        F.count_if(F.col("minutes_since_previous_transaction") < 0).alias("negative_time_gaps"),
        C.rounded(F.avg("calculated_txn_count_1h"), 2).alias("avg_prior_transactions_1h"),
        F.max("calculated_txn_count_1h").alias("max_prior_transactions_1h"),
        C.rounded(F.avg("calculated_txn_count_24h"), 2).alias("avg_prior_transactions_24h"),
        F.max("calculated_txn_count_24h").alias("max_prior_transactions_24h"),
        C.pct(F.col("new_device_for_customer_flag"), 2).alias("new_device_pct"),
        C.pct(F.col("new_merchant_for_customer_flag"), 2).alias("new_merchant_pct"),
    )


def network_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_distinct(F.col("transaction_key")).alias("unique_transaction_keys"),
        F.max("prior_customers_on_device").alias("max_prior_customers_on_device"),
        F.max("prior_cards_on_device").alias("max_prior_cards_on_device"),
        F.max("prior_devices_on_card").alias("max_prior_devices_on_card"),
        F.max("prior_merchants_on_device").alias("max_prior_merchants_on_device"),
        C.pct(F.col("new_customer_on_existing_device_flag")).alias("new_customer_existing_device_pct"),
        C.pct(F.col("new_card_on_existing_device_flag")).alias("new_card_existing_device_pct"),
        C.pct(F.col("device_shared_by_multiple_customers_flag")).alias("multi_customer_device_pct"),
        C.pct(F.col("device_shared_by_multiple_cards_flag")).alias("multi_card_device_pct"),
    )


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are known; NULL when either is constant."""
    both_x, both_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_pop(both_x) * F.stddev_pop(both_y)
    return F.covar_pop(x.cast("double"), y.cast("double")) / F.nullif(spread, F.lit(0.0))


def velocity_check(df: DataFrame) -> DataFrame:
    """Supplied against computed 1 h velocity: mean absolute gaps and correlations."""
    count_gap = F.abs(F.col("velocity_num_transactions") - F.col("calculated_txn_count_1h"))
    amount_gap = F.abs(F.col("velocity_total_amount") - F.col("calculated_amount_1h"))
    return df.filter(F.col("velocity_num_transactions").isNotNull()).agg(
        F.count(F.lit(1)).alias("transactions"),
        C.rounded(F.avg(count_gap), 4).alias("avg_count_difference"),
        C.rounded(F.avg(amount_gap), 2).alias("avg_amount_difference"),
        C.rounded(correlation(F.col("velocity_num_transactions"), F.col("calculated_txn_count_1h")), 6)
        .alias("count_correlation"),
        C.rounded(correlation(F.col("velocity_total_amount"), F.col("calculated_amount_1h")), 6)
        .alias("amount_correlation"),
    )


def velocity_audit(df: DataFrame) -> DataFrame:
    """The same comparison as an integrity report."""
    gap = F.abs(F.col("velocity_num_transactions") - F.col("calculated_txn_count_1h"))
    return df.filter(F.col("velocity_num_transactions").isNotNull()).agg(
        C.rounded(F.avg("velocity_num_transactions"), 2).alias("source_avg_transaction_count"),
        C.rounded(F.avg("calculated_txn_count_1h"), 2).alias("calculated_customer_avg_1h"),
        C.rounded(correlation(F.col("velocity_num_transactions"), F.col("calculated_txn_count_1h")), 4)
        .alias("count_correlation"),
        C.rounded(correlation(F.col("velocity_total_amount"), F.col("calculated_amount_1h")), 4)
        .alias("amount_correlation"),
        C.rounded(F.avg(gap), 2).alias("avg_absolute_count_difference"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each named table; every branch is a bare count, so no column is read."""
    parts = [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n, t in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
