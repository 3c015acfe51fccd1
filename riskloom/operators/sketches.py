"""Distinct counts that are stored by day and merged over any days: HyperLogLog sketches instead of exact sets.

An exact distinct count has to see all days again whenever one is added. A sketch of a day has a few kilobytes, however
many values it stands for, and the union of days is the union of their sketches. The exact reports stay the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C

# Binary logarithm of a sketch's registers.
LG_REGISTERS = 12
# Standard deviations within which an estimate is promised to lie.
DEVIATIONS = 4.0


def relative_error(lg_registers: int = LG_REGISTERS) -> float:
    """Bound of an estimate's relative error: DEVIATIONS times the standard error of merged sketches."""
    return DEVIATIONS * 1.04 / (1 << lg_registers) ** 0.5


def daily_sketches(df: DataFrame, counted: dict[str, str], by: list[str] | None = None, day: str = "transaction_date",
                   lg_registers: int = LG_REGISTERS) -> DataFrame:
    """One row a day (and ``by``): rows, and a sketch of each of ``counted`` (name to column). NULL is no value.

    Sketches are built in the tasks and merged after the exchange, so a busy day is not a hot key.
    """
    return df.groupBy(*(by or []), day).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_registers)).alias(name) for name, c in counted.items()])


def merged_sketches(sketches: DataFrame, names: list[str], by: list[str] | None = None, day: str = "transaction_date",
                    start: str | None = None, end: str | None = None) -> DataFrame:
    """Stored days from ``start`` up to ``end`` (half-open) merged into one row, or one for each ``by``."""
    kept = sketches
    if start is not None:
        kept = kept.filter(F.col(day) >= F.lit(start).cast("date"))
    if end is not None:
        kept = kept.filter(F.col(day) < F.lit(end).cast("date"))
    return kept.groupBy(*(by or [])).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *[F.hll_union_agg(n).alias(n) for n in names])


def estimates(merged: DataFrame, names: list[str]) -> DataFrame:
    """Sketches turned into counts."""
    return merged.withColumns({n: F.coalesce(F.hll_sketch_estimate(n), F.lit(0)) for n in names})


def shared_entities(sketches: DataFrame, entity: str, names: list[str]) -> DataFrame:
    """How many entities (devices, addresses) are reused, and are shared by several of each of ``names``, over all days.

    Few values are told apart exactly, a sketch begins as a list of them; estimates are near whole numbers.
    """
    found = estimates(merged_sketches(sketches, names, [entity]), names)
    return found.agg(
        F.count(F.lit(1)).alias("entities"), F.count_if(F.col("rows") > 1).alias("reused"),
        *[F.count_if(F.col(n) > 1).alias(f"shared_by_{n}") for n in names])


def against_exact(df: DataFrame, merged: DataFrame, counted: dict[str, str], lg_registers: int = LG_REGISTERS) -> DataFrame:
    """Each measure's exact count, and whether the estimate is within the promised error: (measure, exact_count, within)."""
    exact = df.agg(*[F.count_distinct(F.col(c)).alias(n) for n, c in counted.items()]).first()
    found = estimates(merged, list(counted))

    def row(name: str) -> Column:
        true = exact[name]
        bound = max(0.5, true * relative_error(lg_registers))
        return F.struct(F.lit(name).alias("measure"), F.lit(true).cast("bigint").alias("exact_count"),
                        C.flag(F.abs(F.col(name) - true) <= bound).alias("within"))

    return found.select(F.inline(F.array(*[row(n) for n in counted])))
