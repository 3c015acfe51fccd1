"""Daily monitoring, distribution drift (PSI), performance drift and alerts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators.metrics import confusion_counts, confusion_metrics
from riskloom.operators.ordered import MAX_ROWS_PER_TASK, exact_quantiles

# Monitored features, PSI constants, alert levels and texts.
NUMERIC_FEATURES = [
    "amount", "distance_from_home", "transaction_hour", "customer_prior_transactions",
    "minutes_since_previous_transaction", "customer_avg_amount_prior", "amount_vs_customer_average",
    "calculated_txn_count_1h", "calculated_amount_24h",
]
CATEGORICAL_FEATURES = ["merchant_category", "currency", "country", "card_type", "device", "channel"]
PSI_BINS = 10
PSI_FLOOR = 0.000001
ALERT_PSI = 0.10
HIGH_PSI = 0.25
PERFORMANCE_DROP_PP = -5
SCORE_MESSAGE = "Model score distribution shifted from reference population."
NUMERIC_MESSAGE = "Numeric feature distribution shifted from reference population."
CATEGORICAL_MESSAGE = "Categorical feature distribution shifted from reference population."
PERFORMANCE_MESSAGE = "Precision or recall declined by more than 5 percentage points."

DAY = "transaction_date"


def daily_monitoring(scored: DataFrame, threshold: float = C.DECISION_THRESHOLD) -> DataFrame:
    """Volume, alert rate, confusion counts and rates of each day; a 0/0 rate is NULL."""
    flagged = F.col("fraud_probability") >= F.lit(threshold)
    counts = confusion_counts(flagged, F.col("is_fraud"))
    counts.pop("true_negatives")
    table = scored.groupBy(DAY).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("is_fraud").alias("fraud_transactions"),
        C.pct(F.col("is_fraud")).alias("actual_fraud_rate_pct"),
        C.rounded(F.avg("fraud_probability"), 6).alias("avg_fraud_probability"),
        C.pct(C.flag(flagged)).alias("alert_rate_pct"),
        *[c.alias(n) for n, c in counts.items()],
        C.rounded(F.avg("amount"), 2).alias("avg_transaction_amount"),
    )
    tp = F.col("true_positives")
    return table.withColumns({
        "precision": C.rounded(F.try_divide(tp, tp + F.col("false_positives")), 9),
        "recall": C.rounded(F.try_divide(tp, tp + F.col("false_negatives")), 9),
    }).orderBy(DAY)


def _gap(current: Column, reference: Column) -> Column:
    return (current - reference) * F.ln(current / reference)


def _share(part: Column, whole: Column) -> Column:
    share = part / whole
    return F.when(part == 0, F.lit(PSI_FLOOR)).otherwise(share)


def known_number(name: str) -> Column:
    """A column as double; NaN is as missing as NULL, on either side of a comparison."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def psi_edges(reference: DataFrame, features: list[str], bins: int = PSI_BINS,
              max_rows: int = MAX_ROWS_PER_TASK) -> dict[str, list[float]]:
    """Distinct quantile edges of every feature, fitted once: at most ``bins + 1`` numbers each."""
    known = reference.select(*[known_number(f).alias(f) for f in features])
    quantiles = exact_quantiles(known, features, [float(p) for p in np.linspace(0, 1, bins + 1)], max_rows)
    edges: dict[str, set[float]] = {f: set() for f in features}
    for row in quantiles.collect():
        edges[row["feature"]].add(row["value"])
    return {f: sorted(values) for f, values in edges.items()}


def _histograms(df: DataFrame, edges: dict[str, list[float]], keep: list[str]) -> DataFrame:
    """Rows per bin of every feature, as one map per group; one scan, at most ``bins`` entries per map."""
    entries = []
    for feature, cuts in edges.items():
        x = known_number(feature)
        # Inner edges only, the outer ones are open; without two edges to divide there is one bin.
        index = sum([(x >= F.lit(e)).cast("int") for e in cuts[1:-1]], F.lit(0))
        entries.append(F.struct(F.lit(feature).alias("feature"), F.when(x.isNotNull(), index).alias("bin"), x.alias("value")))
    counts = df.select(*keep, F.inline(F.array(*entries))).groupBy(*keep, "feature", "bin").agg(
        F.count("value").alias("n"), F.sum("value").alias("total"))
    return counts.groupBy(*keep, "feature").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "n")))).alias("bins"),
        F.sum("n").alias("known"), F.sum("total").alias("total"))


def numeric_psi(reference: DataFrame, current: DataFrame, features: list[str] = NUMERIC_FEATURES,
                bins: int = PSI_BINS, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """PSI of every feature on every day against the reference, with both means.

    The outer edges are open. Fewer than three distinct edges give 0, an empty side gives NULL.
    """
    edges = psi_edges(reference, features, bins, max_rows)
    base = _histograms(reference, edges, []).select(
        "feature", F.col("bins").alias("ref_bins"), F.col("known").alias("ref_known"), F.col("total").alias("ref_total"))
    # One row per monitored feature.
    joined = _histograms(current, edges, [DAY]).join(F.broadcast(base), "feature", "left")
    sizes = F.create_map(*[F.lit(v) for f in features for v in (f, len(edges[f]))])
    edge_count = F.element_at(sizes, F.col("feature"))

    def count_in(bins_map: str, index: Column) -> Column:
        return F.coalesce(F.element_at(bins_map, index), F.lit(0))

    distance = F.aggregate(
        F.sequence(F.lit(0), edge_count - 2), F.lit(0.0),
        lambda acc, i: acc + _gap(
            _share(count_in("bins", i), F.col("known")), _share(count_in("ref_bins", i), F.col("ref_known"))))
    psi = (
        F.when((F.col("known") == 0) | (F.coalesce("ref_known", F.lit(0)) == 0), F.lit(None))
        .when(edge_count < 3, F.lit(0.0)).otherwise(distance)
    )
    return joined.select(
        DAY, "feature", C.rounded(psi, 9).alias("psi"),
        C.rounded(F.try_divide("ref_total", "ref_known"), 6).alias("reference_mean"),
        C.rounded(F.try_divide("total", "known"), 6).alias("current_mean"),
    ).withColumn("status", C.drift_status(F.col("psi"))).orderBy(DAY, "feature")


def categorical_psi(reference: DataFrame, current: DataFrame,
                    features: list[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """PSI of every categorical feature on every day; a missing value is a category of its own.

    A category absent on a day contributes what the floor share gives. That amount is known per
    feature, so each day only corrects it for the categories it does hold: no day-by-category grid.
    """
    def shares(df: DataFrame, keep: list[str]) -> DataFrame:
        filled = df.select(*keep, *[
            F.coalesce(F.col(c).cast("string"), F.lit(C.MISSING_CATEGORY)).alias(c) for c in features])
        counts = filled.unpivot(keep, features, "feature", "category").groupBy(*keep, "feature", "category").agg(
            F.count(F.lit(1)).alias("n"))
        # Every row has every feature, so the size of a day is the sum over one feature's categories.
        totals = counts.groupBy(*keep, "feature").agg(F.sum("n").alias("size"))
        return counts.join(totals, [*keep, "feature"]).withColumn("share", F.col("n") / F.col("size"))

    floor = F.lit(PSI_FLOOR)
    base = shares(reference, []).select(
        "feature", "category", F.col("share").alias("ref_share"), _gap(floor, F.col("share")).alias("absent_gap"))
    absent = base.groupBy("feature").agg(F.sum("absent_gap").alias("all_absent"))
    days = shares(current, [DAY]).join(base, ["feature", "category"], "left")
    here = _gap(F.col("share"), F.coalesce("ref_share", floor)) - F.coalesce("absent_gap", F.lit(0.0))
    report = days.groupBy(DAY, "feature").agg(F.sum(here).alias("here")).join(absent, "feature", "left")
    psi = C.rounded(F.col("here") + F.coalesce("all_absent", F.lit(0.0)), 9)
    return report.select(DAY, "feature", psi.alias("psi")).withColumn(
        "status", C.drift_status(F.col("psi"))).orderBy(DAY, "feature")


def score_drift(reference: DataFrame, current: DataFrame, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    drift = numeric_psi(reference, current, ["fraud_probability"], max_rows=max_rows)
    return drift.select(
        DAY, F.col("reference_mean").alias("reference_avg_score"), F.col("current_mean").alias("current_avg_score"),
        F.col("psi").alias("score_psi"), "status")


def performance_drift(daily: DataFrame, reference_scored: DataFrame,
                      threshold: float = C.DECISION_THRESHOLD) -> DataFrame:
    """Each day's precision and recall against the reference sample; an unknown change counts as stable."""
    reference = confusion_metrics(reference_scored, threshold).select(F.struct("precision", "recall")).scalar()
    table = daily.withColumn("_reference", reference).select(
        DAY, "precision", "recall", "actual_fraud_rate_pct", "alert_rate_pct",
        F.col("_reference.precision").alias("reference_precision"),
        F.col("_reference.recall").alias("reference_recall"))
    hundred = F.lit(100.0)
    table = table.withColumns({
        "precision_change_pp": C.rounded((F.col("precision") - F.col("reference_precision")) * hundred, 6),
        "recall_change_pp": C.rounded((F.col("recall") - F.col("reference_recall")) * hundred, 6),
    })
    dropped = (F.col("precision_change_pp") < PERFORMANCE_DROP_PP) | (F.col("recall_change_pp") < PERFORMANCE_DROP_PP)
    return table.withColumn("performance_status", F.when(dropped, "Review Required").otherwise("Stable")).orderBy(DAY)


def _psi_alerts(drift: DataFrame, kind: str, item: Column, psi: str, message: str) -> DataFrame:
    return drift.filter(F.col(psi) >= ALERT_PSI).select(
        DAY, F.lit(kind).alias("alert_type"), item.alias("item"),
        F.when(F.col(psi) >= HIGH_PSI, "High").otherwise("Moderate").alias("severity"),
        F.col(psi).alias("value"), F.lit(message).alias("message"))


def monitoring_alerts(scores: DataFrame, numeric: DataFrame, categorical: DataFrame,
                      performance: DataFrame) -> DataFrame:
    """All drift and performance alerts in one shape; unavailable PSI raises none."""
    dropped = performance.filter(F.col("performance_status") == "Review Required").select(
        DAY, F.lit("Model Performance").alias("alert_type"), F.lit("precision_or_recall").alias("item"),
        F.lit("High").alias("severity"), F.least("precision_change_pp", "recall_change_pp").alias("value"),
        F.lit(PERFORMANCE_MESSAGE).alias("message"))
    return (
        _psi_alerts(scores, "Score Drift", F.lit("fraud_probability"), "score_psi", SCORE_MESSAGE)
        .unionByName(_psi_alerts(numeric, "Numeric Feature Drift", F.col("feature"), "psi", NUMERIC_MESSAGE))
        .unionByName(_psi_alerts(categorical, "Categorical Feature Drift", F.col("feature"), "psi", CATEGORICAL_MESSAGE))
        .unionByName(dropped)
    )


def monitoring_summary(scores: DataFrame, numeric: DataFrame, categorical: DataFrame, performance: DataFrame,
                       reference: DataFrame, current: DataFrame, threshold: float = C.DECISION_THRESHOLD) -> DataFrame:
    """Counts of high drift and alerts over the monitored days, with both periods."""
    def high(drift: DataFrame) -> Column:
        return drift.agg(F.count_if(F.col("status") == "High Drift")).scalar()

    def period(df: DataFrame) -> Column:
        first, last = F.min(DAY).cast("string"), F.max(DAY).cast("string")
        return df.agg(F.concat_ws(" to ", first, last)).scalar()

    alerts = monitoring_alerts(scores, numeric, categorical, performance)
    return performance.agg(
        F.count(F.lit(1)).alias("monitoring_days"),
        F.max("reference_precision").alias("reference_precision"),
        F.max("reference_recall").alias("reference_recall"),
    ).select(
        "monitoring_days", period(reference).alias("reference_period"), period(current).alias("monitoring_period"),
        F.lit(threshold).alias("decision_threshold"), "reference_precision", "reference_recall",
        high(numeric).alias("high_numeric_drift_events"), high(categorical).alias("high_categorical_drift_events"),
        high(scores).alias("high_score_drift_events"),
        alerts.agg(F.count(F.lit(1))).scalar().alias("total_monitoring_alerts"),
    )
