"""Additive explanations: per-feature contributions in log-odds, and the reports built on them."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import columns as C

# Display names and direction texts.
FRIENDLY_NAMES = {
    "amount": "Transaction amount",
    "log_amount": "Transaction amount scale",
    "distance_from_home": "Distance from home",
    "transaction_hour": "Transaction hour",
    "weekend_transaction": "Weekend transaction",
    "card_present": "Card present",
    "customer_prior_transactions": "Prior customer transactions",
    "minutes_since_previous_transaction": "Time since previous transaction",
    "previous_customer_amount": "Previous transaction amount",
    "customer_avg_amount_prior": "Historical average amount",
    "customer_std_amount_prior": "Historical amount variation",
    "amount_vs_customer_average": "Amount vs customer average",
    "amount_zscore_vs_customer_history": "Amount anomaly score",
    "calculated_txn_count_1h": "Transactions in prior hour",
    "calculated_amount_1h": "Spend in prior hour",
    "calculated_txn_count_24h": "Transactions in prior 24 hours",
    "calculated_amount_24h": "Spend in prior 24 hours",
    "new_merchant_for_customer_flag": "New merchant for customer",
    "overnight_transaction_flag": "Overnight transaction",
    "merchant_category": "Merchant category",
    "merchant_type": "Merchant type",
    "merchant": "Merchant",
    "currency": "Currency",
    "country": "Country",
    "city_size": "City size",
    "card_type": "Card type",
    "device": "Device type",
    "channel": "Payment channel",
}
HIGHER, LOWER = "Higher fraud risk", "Lower fraud risk"
RAISES, LOWERS = "Raises risk", "Lowers risk"


def friendly_name(feature: Column) -> Column:
    names = F.create_map(*[F.lit(x) for x in chain.from_iterable(FRIENDLY_NAMES.items())])
    return F.coalesce(F.element_at(names, feature), feature)


def feature_means(reference: DataFrame, columns: list[str]) -> dict[str, float]:
    """Fitted centre of each feature: one aggregated row."""
    row = reference.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return {c: float(row[c]) if row[c] is not None else 0.0 for c in columns}


def linear_contributions(rows: DataFrame, coefficients: dict[str, float], reference: DataFrame,
                         intercept: float = 0.0, keep: list[str] | None = None) -> DataFrame:
    """Contributions of a linear score, exact: coefficient times distance from the reference mean.

    One row per case with one ``contribution`` entry per feature and the base value, which together
    give the score. A missing input sits at the mean and contributes nothing.
    """
    kept = keep or ["transaction_key"]
    means = feature_means(reference, list(coefficients))
    entries = []
    for name, weight in coefficients.items():
        mean, value = F.lit(means[name]), F.col(name).cast("double")
        entries.append(F.struct(
            F.lit(name).alias("feature"), value.alias("value"),
            (F.lit(float(weight)) * (F.coalesce(value, mean) - mean)).alias("contribution")))
    base = intercept + sum(weight * means[name] for name, weight in coefficients.items())
    return rows.select(*kept, F.array(*entries).alias("contributions"), F.lit(float(base)).alias("base_value"))


def long_contributions(contributions: DataFrame) -> DataFrame:
    """One row per case and feature."""
    kept = [c for c in contributions.columns if c != "contributions"]
    return contributions.select(*kept, F.inline("contributions"))


def global_importance(contributions: DataFrame) -> DataFrame:
    """Mean absolute contribution of every feature, strongest first."""
    report = long_contributions(contributions).groupBy("feature").agg(
        C.rounded(F.avg(F.abs("contribution")), 6).alias("mean_absolute_contribution"))
    return report.select("feature", friendly_name(F.col("feature")).alias("friendly_name"),
                         "mean_absolute_contribution").orderBy(F.desc("mean_absolute_contribution"), "feature")


def top_drivers(contributions: DataFrame, limit: int = 5, raises: str = HIGHER, lowers: str = LOWER) -> DataFrame:
    """The strongest features of every case.

    A case's entries already travel in one array of fixed length, so they are ranked inside the
    row: no exchange, whatever the number of cases.
    """
    kept = [c for c in contributions.columns if c != "contributions"]
    ranked = F.sort_array(F.transform("contributions", lambda e: F.struct(
        (-F.abs(e["contribution"])).alias("by"), e["feature"].alias("feature"), e["value"].alias("feature_value"),
        e["contribution"].alias("contribution"))))
    rows = contributions.select(*kept, F.posexplode(F.slice(ranked, 1, limit)).alias("position", "entry"))
    return rows.select(
        *kept, (F.col("position") + 1).alias("driver_rank"), "entry.feature",
        friendly_name(F.col("entry.feature")).alias("friendly_name"), "entry.feature_value", "entry.contribution",
        F.when(F.col("entry.contribution") > 0, raises).otherwise(lowers).alias("direction"))


def case_summary(contributions: DataFrame, limit: int = 5) -> DataFrame:
    """One row per case: score, band, base value and its strongest drivers in words."""
    p = F.col("fraud_probability")
    ranked = F.slice(F.sort_array(F.transform("contributions", lambda e: F.struct(
        (-F.abs(e["contribution"])).alias("by"), e["feature"].alias("feature"), e["contribution"].alias("contribution")
    ))), 1, limit)
    words = F.transform(ranked, lambda e: F.concat(
        friendly_name(e["feature"]), F.lit(": "), F.when(e["contribution"] > 0, HIGHER).otherwise(LOWER)))
    kept = [c for c in contributions.columns if c not in ("contributions", "base_value")]
    return contributions.withColumn("_words", words).select(
        *kept, C.risk_score(p).alias("risk_score"), C.risk_band(p).alias("risk_band"),
        C.rounded(F.col("base_value"), 6).alias("base_value_log_odds"),
        *[F.get("_words", F.lit(i)).alias(f"top_driver_{i + 1}") for i in range(limit)])
