"""Classifier metrics from scored rows, all computed by aggregation."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators.ordered import running_totals, settled
from riskloom.operators.skew import MAX_ROWS_PER_TASK

# The threshold grids, with the floating-point steps that comparisons must agree on.
SWEEP_THRESHOLDS = [float(t) for t in np.arange(0.10, 0.91, 0.05)]
ECONOMIC_THRESHOLDS = [float(t) for t in np.arange(0.10, 0.96, 0.05)]

SCORE = "fraud_probability"
LABEL = "is_fraud"


def _count_where(condition: Column) -> Column:
    return F.count_if(condition)


def confusion_counts(flagged: Column, label: Column) -> dict[str, Column]:
    return {
        "true_positives": _count_where(flagged & (label == 1)),
        "false_positives": _count_where(flagged & (label == 0)),
        "false_negatives": _count_where(~flagged & (label == 1)),
        "true_negatives": _count_where(~flagged & (label == 0)),
    }


def with_rates(df: DataFrame, places: int = 9) -> DataFrame:
    """Precision, recall and F1 from confusion counts; zero where the denominator is zero."""
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return df.withColumns({
        "precision": C.rounded(C.ratio(tp, tp + fp), places),
        "recall": C.rounded(C.ratio(tp, tp + fn), places),
        "f1": C.rounded(C.ratio(2 * tp, 2 * tp + fp + fn), places),
    })


def confusion_metrics(scored: DataFrame, threshold: float = C.DECISION_THRESHOLD) -> DataFrame:
    flagged = F.col(SCORE) >= F.lit(threshold)
    counts = confusion_counts(flagged, F.col(LABEL))
    table = scored.agg(
        F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()],
        C.rounded(F.avg(C.flag(flagged)), 9).alias("review_rate"))
    return with_rates(table).withColumn("threshold", F.lit(threshold))


def by_threshold(scored: DataFrame, thresholds: list[float], measures: dict[str, Column],
                 score: str = SCORE) -> DataFrame:
    """Totals of every measure at or above each threshold (``name``) and overall (``all_name``).

    Rows fall into the bands between thresholds and are aggregated once; only the band table, one
    row more than there are thresholds, is spread over the grid.
    """
    band = reduce(lambda a, b: a + b, [(F.col(score) >= F.lit(t)).cast("int") for t in thresholds])
    bands = scored.groupBy(band.alias("_band")).agg(*[c.alias(n) for n, c in measures.items()])
    grid = bands.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(len(thresholds)))))
    above = F.col("_i") <= F.col("_band")
    totals = grid.groupBy("_i").agg(
        *[F.sum(F.when(above, F.col(n)).otherwise(0)).alias(n) for n in measures],
        *[F.sum(n).alias(f"all_{n}") for n in measures],
    )
    values = F.array(*[F.lit(round(t, 2)) for t in thresholds])
    return totals.select(F.element_at(values, F.col("_i")).alias("threshold"), *totals.columns[1:])


def threshold_sweep(scored: DataFrame, thresholds: list[float] = SWEEP_THRESHOLDS) -> DataFrame:
    table = by_threshold(scored, thresholds, {"rows": F.count(F.lit(1)), "fraud": F.count_if(F.col(LABEL) == 1)})
    counts = table.select(
        "threshold",
        F.col("fraud").alias("true_positives"),
        (F.col("rows") - F.col("fraud")).alias("false_positives"),
        (F.col("all_fraud") - F.col("fraud")).alias("false_negatives"),
        (F.col("all_rows") - F.col("all_fraud") - F.col("rows") + F.col("fraud")).alias("true_negatives"),
        C.rounded(C.ratio(F.col("rows"), F.col("all_rows")), 9).alias("review_rate"),
    )
    return with_rates(counts).orderBy("threshold")


def best_threshold(sweep: DataFrame) -> DataFrame:
    """First threshold with the highest F1."""
    return sweep.select("threshold", "f1", "precision", "recall").orderBy(F.desc("f1"), "threshold").limit(1)


def _ranked_scores(scored: DataFrame, max_rows: int) -> DataFrame:
    """Distinct scores, highest first, with their labels and the labels above them."""
    distinct = scored.groupBy((-F.col(SCORE)).alias("rank_by")).agg(
        F.count_if(F.col(LABEL) == 1).alias("pos"), F.count_if(F.col(LABEL) == 0).alias("neg"))
    rows = scored.count()
    return running_totals(settled(distinct, rows, max_rows), [], "rank_by", ["pos", "neg"], rows, max_rows)


def roc_auc(scored: DataFrame, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Chance that a fraud outranks a legitimate row; ties count half."""
    wins = F.sum(F.col("neg") * (F.col("before_pos") + F.col("pos") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return _ranked_scores(scored, max_rows).agg(C.rounded(wins / F.nullif(pairs, F.lit(0.0)), 9).alias("roc_auc"))


def pr_auc(scored: DataFrame, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Average precision by the step rule."""
    tp, fp = F.col("before_pos") + F.col("pos"), F.col("before_neg") + F.col("neg")
    steps = F.sum(F.col("pos") * (tp / (tp + fp)))
    return _ranked_scores(scored, max_rows).agg(
        C.rounded(steps / F.nullif(F.sum("pos").cast("double"), F.lit(0.0)), 9).alias("pr_auc"))
