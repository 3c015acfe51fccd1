"""From scores to decisions: economics, review capacity, bands, and rules against the model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators.metrics import ECONOMIC_THRESHOLDS, by_threshold, confusion_counts, with_rates
from riskloom.operators.modeling import timestamp
from riskloom.operators.skew import attach

# Cost assumptions, capacities, rule cut points, compared systems and their flags.
REVIEW_COST = 5.0
FRICTION_COST = 15.0
RECOVERY_RATE = 0.9
DAILY_CAPACITIES = [500, 1000, 2000, 5000, 10000]
RULE_SCORE_CUT = 3
AMOUNT_RATIO_CUT = 3
SYSTEMS = {
    "Behavioral rules": "behavioral_rules_flag",
    "ML only": "ml_flag",
    "ML + behavioral rules": "ml_behavioral_hybrid_flag",
    "Synthetic network rules": "network_rule_flag",
    "ML + network rules": "ml_network_hybrid_flag",
}
# Bins of a probability in which the rows of a day are counted before any is exchanged.
SCORE_BINS = 10_000
RANK_SALTS = 32


def _fraud_value() -> Column:
    return F.sum(F.when(F.col("is_fraud") == 1, F.col("amount")).otherwise(0.0))


def score_join(facts: DataFrame, predictions: DataFrame) -> DataFrame:
    """Scores attached to the scored period's payments. Keys are unique, so the join cannot skew."""
    columns = ["transaction_key", "transaction_ts", "transaction_date", "amount", "merchant_category", "merchant",
               "channel", "country", "is_fraud"]
    return facts.select(*columns).join(predictions.select("transaction_key", "fraud_probability"), "transaction_key")


def value_baseline(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("is_fraud").alias("fraud_transactions"),
        C.rounded(F.sum("amount"), 2).alias("transaction_value"),
        C.rounded(_fraud_value(), 2).alias("fraud_value"),
        C.rounded(F.avg(F.when(F.col("is_fraud") == 1, F.col("amount"))), 2).alias("avg_fraud_amount"),
    )


def threshold_economics(scored: DataFrame, thresholds: list[float] = ECONOMIC_THRESHOLDS,
                        review_cost: float = REVIEW_COST, friction_cost: float = FRICTION_COST,
                        recovery_rate: float = RECOVERY_RATE) -> DataFrame:
    """Fraud caught and missed, value and total cost at every threshold of the grid."""
    table = by_threshold(scored, thresholds, {
        "rows": F.count(F.lit(1)), "fraud": F.count_if(F.col("is_fraud") == 1), "value": _fraud_value()})
    prevented = F.col("value") * F.lit(recovery_rate)
    review = F.col("rows") * F.lit(review_cost)
    friction = (F.col("rows") - F.col("fraud")) * F.lit(friction_cost)
    hundred = F.lit(100.0)
    return table.select(
        "threshold",
        F.col("rows").alias("flagged_transactions"),
        C.rounded(hundred * C.ratio(F.col("rows"), F.col("all_rows")), 6).alias("review_rate_pct"),
        F.col("fraud").alias("fraud_caught"),
        (F.col("all_fraud") - F.col("fraud")).alias("fraud_missed"),
        (F.col("rows") - F.col("fraud")).alias("false_alerts"),
        C.rounded(hundred * C.ratio(F.col("fraud"), F.col("all_fraud")), 6).alias("transaction_recall_pct"),
        C.rounded(F.col("all_value"), 4).alias("total_fraud_value"),
        C.rounded(F.col("value"), 4).alias("fraud_value_caught"),
        C.rounded(hundred * C.ratio(F.col("value"), F.col("all_value")), 6).alias("fraud_value_capture_pct"),
        C.rounded(F.col("all_value") - F.col("value"), 4).alias("fraud_value_missed"),
        C.rounded(prevented, 4).alias("estimated_prevented_loss"),
        review.alias("manual_review_cost"),
        friction.alias("false_positive_friction_cost"),
        C.rounded(F.col("all_value") - prevented + review + friction, 4).alias("estimated_total_cost"),
    ).orderBy("threshold")


def cheapest_threshold(economics: DataFrame) -> DataFrame:
    """First threshold with the lowest total cost."""
    return economics.select("threshold", "estimated_total_cost").orderBy("estimated_total_cost", "threshold").limit(1)


def daily_top(scored: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` highest-scored rows of each day with their ``risk_rank``.

    Scores are counted per day in SCORE_BINS bins, and only rows in the bins that reach ``limit`` are exchanged. One of
    those may still hold a large share of a day, so each day is cut to its best rows in salted parts first; only
    ``salts * limit`` rows of a day meet in one task.
    """
    binned = scored.withColumn("_bin", F.coalesce(
        F.floor(F.col("fraud_probability") * SCORE_BINS).cast("bigint"), F.lit(-1).cast("bigint")))
    down = Window.partitionBy("transaction_date").orderBy(F.desc("_bin"))
    counts = binned.groupBy("transaction_date", "_bin").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_above", F.sum("_n").over(down.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
    cuts = counts.filter(F.col("_above") < limit).groupBy("transaction_date").agg(F.min("_bin").alias("_cut"))
    # One row per day.
    scored = attach(binned, F.broadcast(cuts), ["transaction_date"]).filter(F.col("_bin") >= F.col("_cut")).drop(
        "_bin", "_cut")
    best = [F.desc("fraud_probability"), F.asc("transaction_key")]
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64("transaction_key"), F.lit(RANK_SALTS)))
    part = Window.partitionBy("transaction_date", "_salt").orderBy(*best)
    day = Window.partitionBy("transaction_date").orderBy(*best)
    kept = salted.withColumn("_part_rank", F.row_number().over(part)).filter(F.col("_part_rank") <= limit)
    return (
        kept.withColumn("risk_rank", F.row_number().over(day)).filter(F.col("risk_rank") <= limit)
        .drop("_salt", "_part_rank")
    )


def review_capacity(scored: DataFrame, capacities: list[int] = DAILY_CAPACITIES) -> DataFrame:
    """What a team catches that reviews the best N rows of each day, for every N."""
    fraud = F.count_if(F.col("is_fraud") == 1)
    ordered = sorted(capacities)
    # A row counts for every capacity that reaches its rank: rows are summed by the first such one.
    missed = reduce(lambda a, b: a + b, [(F.col("risk_rank") > c).cast("int") for c in ordered])
    reviewed = daily_top(scored.select("transaction_date", "transaction_key", "fraud_probability", "is_fraud", "amount"),
                         ordered[-1])
    parts = reviewed.groupBy(missed.alias("_from")).agg(
        F.count(F.lit(1)).alias("_rows"), fraud.alias("_fraud"), _fraud_value().alias("_value"))
    days = scored.groupBy("transaction_date").agg(fraud.alias("_f"), _fraud_value().alias("_v"))
    overall = days.agg(F.count(F.lit(1)).alias("_days"), F.sum("_f").alias("_all_fraud"),
                       C.rounded(F.sum("_v"), 2).alias("_all_value"))
    # The totals of the period join the ranked parts as one more row; nothing is multiplied out.
    summary = parts.unionByName(overall.withColumn("_from", F.lit(0)), allowMissingColumns=True)
    grid = summary.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(len(ordered) - 1)))).filter("_i >= _from")
    table = grid.groupBy("_i").agg(*[
        F.coalesce(F.sum(c), F.lit(0)).alias(c)
        for c in ("_days", "_rows", "_fraud", "_value", "_all_fraud", "_all_value")])
    hundred = F.lit(100.0)
    return table.select(
        F.element_at(F.array(*[F.lit(c) for c in ordered]), F.col("_i") + 1).alias("daily_review_capacity"),
        F.col("_days").alias("days"),
        F.col("_rows").alias("total_reviews"),
        F.col("_fraud").alias("fraud_transactions_caught"),
        (F.col("_rows") - F.col("_fraud")).alias("false_alerts"),
        C.rounded(hundred * C.ratio(F.col("_fraud"), F.col("_all_fraud")), 6).alias("fraud_recall_pct"),
        C.rounded(F.col("_value"), 4).alias("fraud_value_caught"),
        C.rounded(hundred * C.ratio(F.col("_value"), F.col("_all_value")), 6).alias("fraud_value_capture_pct"),
        C.rounded(hundred * C.ratio(F.col("_fraud"), F.col("_rows")), 6).alias("fraud_per_100_reviews"),
    ).orderBy("daily_review_capacity")


def risk_bands(scored: DataFrame) -> DataFrame:
    report = scored.groupBy(C.risk_band(F.col("fraud_probability")).alias("risk_band")).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("is_fraud").alias("fraud_transactions"),
        C.pct(F.col("is_fraud")).alias("actual_fraud_rate_pct"),
        C.rounded(F.avg("fraud_probability"), 4).alias("avg_model_probability"),
        C.rounded(F.sum("amount"), 2).alias("transaction_value"),
        C.rounded(_fraud_value(), 2).alias("fraud_value"),
    )
    return report.orderBy(C.band_order(F.col("risk_band"), C.RISK_BANDS))


def rule_score(features: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Add the seven-rule behaviour score; an unknown input scores zero.

    ``thresholds`` is the one-row training table, read as one scalar subquery.
    """
    limit = F.col("_limit")
    rules = [
        F.col("distance_from_home") >= limit["distance_p95"],
        ~F.col("card_present").cast("boolean"),
        C.is_overnight(F.col("transaction_hour")),
        F.col("amount_vs_customer_average") >= AMOUNT_RATIO_CUT,
        F.col("calculated_txn_count_1h") >= limit["velocity_1h_p95"],
        F.col("calculated_amount_24h") >= limit["amount_24h_p95"],
        F.col("new_merchant_for_customer_flag") == 1,
    ]
    limits = thresholds.select(F.struct("distance_p95", "velocity_1h_p95", "amount_24h_p95")).scalar()
    score = reduce(lambda a, b: a + b, [C.flag(r) for r in rules])
    return features.withColumn("_limit", limits).withColumn("behavioral_rule_score", score).drop("_limit")


def rule_decisions(features: DataFrame, scored: DataFrame, thresholds: DataFrame, test_start: str,
                   ml_threshold: float = C.DECISION_THRESHOLD) -> DataFrame:
    """Rule score, network rule, model flag and the hybrid flags of every scored payment."""
    # The date bound is implied by the scores but prunes the feature scan before the join.
    recent = features.filter(F.col("transaction_ts") >= timestamp(test_start))
    ruled = rule_score(recent, thresholds).withColumn("network_rule_flag", C.flag(
        (F.col("new_customer_on_existing_device_flag") == 1)
        | (F.col("new_card_on_existing_device_flag") == 1)
        | (F.col("device_shared_by_multiple_customers_flag") == 1)))
    columns = ["transaction_key", "transaction_ts", "amount", "is_fraud", "behavioral_rule_score", "network_rule_flag"]
    joined = ruled.select(*columns).join(scored.select("transaction_key", "fraud_probability"), "transaction_key")
    rules, model = F.col("behavioral_rule_score") >= RULE_SCORE_CUT, F.col("fraud_probability") >= F.lit(ml_threshold)
    return joined.withColumns({
        "ml_flag": C.flag(model),
        "behavioral_rules_flag": C.flag(rules),
        "ml_behavioral_hybrid_flag": C.flag(model | rules),
        "ml_network_hybrid_flag": C.flag(model | (F.col("network_rule_flag") == 1)),
    })


def system_comparison(decisions: DataFrame, systems: dict[str, str] = SYSTEMS) -> DataFrame:
    """Confusion counts, rates and caught value of every decision system; one scan for all."""
    flags = decisions.select("is_fraud", "amount", *[F.col(c).alias(s) for s, c in systems.items()])
    flagged = F.col("flag") == 1
    hundred = F.lit(100.0)
    table = flags.unpivot(["is_fraud", "amount"], list(systems), "system", "flag").groupBy("system").agg(
        F.count_if(flagged).alias("flagged_transactions"),
        C.rounded(hundred * F.avg("flag"), 6).alias("review_rate_pct"),
        *[c.alias(n) for n, c in confusion_counts(flagged, F.col("is_fraud")).items()],
        F.sum(F.when(flagged & (F.col("is_fraud") == 1), F.col("amount")).otherwise(0.0)).alias("_caught"),
        _fraud_value().alias("_total"),
    )
    return with_rates(table).select(
        "system", "flagged_transactions", "review_rate_pct", "true_positives", "false_positives", "false_negatives",
        "true_negatives", "precision", "recall", "f1",
        C.rounded(F.col("_caught"), 4).alias("fraud_value_caught"),
        C.rounded(hundred * C.ratio(F.col("_caught"), F.col("_total")), 6).alias("fraud_value_capture_pct"),
    ).orderBy(F.array_position(F.array(*[F.lit(s) for s in systems]), F.col("system")))


def rule_score_profile(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("behavioral_rule_score").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("is_fraud").alias("fraud_transactions"),
        C.pct(F.col("is_fraud")).alias("fraud_rate_pct"),
        C.rounded(F.avg("fraud_probability"), 4).alias("avg_ml_probability"),
    ).orderBy("behavioral_rule_score")
