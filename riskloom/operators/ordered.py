"""Exact order statistics without collecting a group: collapse to distinct values, then running totals.

Ranks, quantiles and curve areas only need the counts per distinct value and the totals of all
smaller values. Small inputs use one window. Larger ones are cut into ranges of the sorted values,
summed inside the ranges in parallel; the totals of the ranges before are running totals again, of a
table as much shorter as a range is long, found in the same way.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.skew import BROADCAST_KEYS, MAX_ROWS_PER_TASK, attach
from riskloom.session import ensure_checkpoint_dir


def running_totals(df: DataFrame, groups: list[str], value: str, measures: list[str], rows: int,
                   max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Add ``before_<measure>``: the total of the measure over all smaller values of the group.

    ``value`` must be unique within a group; ``rows`` is an upper bound of the table's rows.
    """
    if rows <= max_rows:
        before = (
            Window.partitionBy(*(groups or [F.lit(0)])).orderBy(value)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return df.withColumns({f"before_{m}": F.coalesce(F.sum(m).over(before), F.lit(0)) for m in measures})

    # Four rows a range at least, so that each level is shorter than the one below.
    ranges = max(2, ceil(2 * rows / max(8, max_rows)))
    keys = groups or ["_all"]
    base = df if groups else df.withColumn("_all", F.lit(0))
    # Ranges of group and value together: a long group has many, short groups share one. The checkpoint fixes them, as
    # the number of a range must not change if a task is run again.
    ensure_checkpoint_dir(df.sparkSession)
    placed = base.repartitionByRange(ranges, *[F.col(c).asc_nulls_last() for c in [*keys, value]]).withColumn(
        "_range", F.spark_partition_id()).checkpoint()
    inside = (
        Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = placed.groupBy(*keys, "_range").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    # One row for each range, and one more for each group that begins inside a range.
    pieces = totals.count()
    if pieces >= rows:  # groups so short that ranges do not shorten anything: one window holds them
        max_rows = pieces
    totals = totals.withColumnRenamed("_range", "_place")
    offsets = running_totals(totals, keys, "_place", [f"_t_{m}" for m in measures], pieces, max_rows).select(
        *keys, F.col("_place").alias("_range"), *[F.col(f"before__t_{m}").alias(f"_o_{m}") for m in measures])
    offsets = F.broadcast(offsets) if ranges <= BROADCAST_KEYS else offsets
    local = placed.withColumns({f"_i_{m}": F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures})
    joined = attach(local, offsets, [*keys, "_range"])
    return joined.select(
        *df.columns, *[(F.col(f"_i_{m}") + F.col(f"_o_{m}")).alias(f"before_{m}") for m in measures]
    )


def settled(df: DataFrame, rows: int, max_rows: int) -> DataFrame:
    """A table that several passes will read: large ones are computed once, into the checkpoint folder."""
    if rows <= max_rows:
        return df
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def long_values(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Numeric columns in long form ``(keep.., feature, value)``; one scan for all columns."""
    kept = keep or []
    doubles = df.select(*kept, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(kept, columns, "feature", "value")


def _quantiles_at_once(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    points = F.array(*[F.lit(float(p)) for p in probabilities])
    row = df.agg(*[F.percentile(F.col(c).cast("double"), points).alias(c) for c in columns])
    named = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("values")) for c in columns])
    long = row.select(F.inline(named)).select("feature", F.posexplode("values").alias("i", "value"))
    return long.select("feature", F.element_at(points, F.col("i") + 1).alias("probability"), "value")


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float],
                    max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Linearly interpolated quantiles of each column, NULLs ignored: ``(feature, probability, value)``.

    While all values fit one task, the built-in percentile holds them. Beyond that, the values stay
    distributed and the quantiles are read off their running counts.
    """
    rows = df.count() * len(columns)
    if rows <= max_rows:
        return _quantiles_at_once(df, columns, probabilities)
    counts = (
        long_values(df, columns).filter(F.col("value").isNotNull())
        .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    counts = settled(counts, rows, max_rows)
    ranked = running_totals(counts, ["feature"], "value", ["n"], rows, max_rows)
    sizes = F.broadcast(  # one row per column of the input
        counts.groupBy("feature").agg(F.sum("n").alias("_size"))
    )
    ranked = ranked.join(sizes, "feature")
    low = F.col("before_n")
    high = F.col("before_n") + F.col("n")

    def holds(probability, step):
        rank = step(probability * (F.col("_size") - 1))
        return (rank >= low) & (rank < high)

    wanted = F.filter(
        F.array(*[F.lit(float(p)) for p in probabilities]),
        lambda p: holds(p, F.floor) | holds(p, F.ceil),
    )
    hits = ranked.withColumn("probability", F.explode(wanted))
    at = F.col("probability") * (F.col("_size") - 1)
    p = F.col("probability")
    picked = hits.groupBy("feature", "probability").agg(
        F.max(F.when(holds(p, F.floor), F.col("value"))).alias("_low"),
        F.max(F.when(holds(p, F.ceil), F.col("value"))).alias("_high"),
        F.max(at - F.floor(at)).alias("_weight"),
    )
    return picked.select(
        "feature", "probability",
        (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_weight")).alias("value"),
    )
