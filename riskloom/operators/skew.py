"""Ordered per-entity history that also holds when one entity owns a large share of all rows.

A window function keeps one partition key in one task. That is the right plan for ordinary
entities, and it is what ``running`` uses. An entity with more than ``max_rows`` rows is split off
by ``split_heavy``; its rows are range-partitioned on the full event order, so they spread over
several tasks whatever the key, the timestamp or the ties look like. Every chunk then computes its
local history and adds what the earlier chunks carry in. Both ways give the same result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import sort_struct
from riskloom.session import ensure_checkpoint_dir

# Rows of one entity that one task may order; well inside what a sort spills comfortably.
MAX_ROWS_PER_TASK = 5_000_000
# Rows that a task orders on average. Every sort in a chain of windows holds them once.
ROWS_PER_TASK = 200_000
CHUNK = "_chunk"
# A key list up to this size is read by every task; a longer one is joined by shuffle.
BROADCAST_KEYS = 100_000


def match(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality on all keys where NULL equals NULL."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def attach(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on NULL-safe keys, the keys kept once."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, "left").drop(*[f"_r_{k}" for k in keys])


def split_heavy(df: DataFrame, keys: list[str], max_rows: int = MAX_ROWS_PER_TASK, rows: int | None = None
                ) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary entities, and the rows of entities above ``max_rows`` (None when there are none).

    A table that fits the limit as a whole needs no look at its keys; callers that know an upper
    bound of its rows pass it and save the count. The list of heavy keys has at
    most ``rows / max_rows`` entries; it is checkpointed so both sides of the split see the same list.
    """
    if (df.count() if rows is None else rows) <= max_rows:
        return df, None
    heavy = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > max_rows).select(*keys)
    )
    ensure_checkpoint_dir(df.sparkSession)
    heavy = heavy.checkpoint()
    found = heavy.count()
    if found == 0:
        return df, None
    if found <= BROADCAST_KEYS:
        heavy = F.broadcast(heavy)
    condition = match(df, heavy, keys)
    return df.join(heavy, condition, "left_anti"), df.join(heavy, condition, "left_semi")


def dealt(df: DataFrame, keys: list[str], rows: int, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows dealt by a hash of the keys over as many tasks as their number asks for, so that a task's share does not grow
    with the table. Windows by these keys, or by more, need no further exchange; a small table is left as it is."""
    if rows <= per_task:
        return df
    return df.repartition(max(ceil(rows / per_task), df.sparkSession.sparkContext.defaultParallelism), *keys)


def chunk_rows(df: DataFrame, keys: list[str], order: list[str], max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Range-partition on entity and event order and number the ranges.

    The checkpoint fixes the ranges: the chunk number must not change if a task is run again.
    """
    ensure_checkpoint_dir(df.sparkSession)
    parts = max(2, ceil(2 * df.count() / max_rows))
    ranges = [F.col(c).asc_nulls_last() for c in [*keys, *order]]
    return df.repartitionByRange(parts, *ranges).withColumn(CHUNK, F.spark_partition_id()).checkpoint()


def per_entity(df: DataFrame, keys: list[str], order: list[str],
               build: Callable[[DataFrame, str | None], DataFrame],
               max_rows: int = MAX_ROWS_PER_TASK, rows: int | None = None) -> DataFrame:
    """Apply ``build(rows, chunk)`` to ordinary entities with ``chunk=None`` and to heavy ones in chunks."""
    rows = df.count() if rows is None else rows
    light, heavy = split_heavy(df, keys, max_rows, rows)
    result = build(dealt(light, keys, rows), None)
    if heavy is None:
        return result
    chunked = build(chunk_rows(heavy, keys, order, max_rows), CHUNK).drop(CHUNK)
    return result.unionByName(chunked)


# What can be carried along an entity's history. Each value looks at strictly earlier rows only,
# except "whole_mean" and "whole_count", which cover all rows of the entity.
Spec = dict[str, tuple[str, Column | str | None]]


def _expr(value: Column | str | None) -> Column | None:
    return F.col(value) if isinstance(value, str) else value


def running(df: DataFrame, keys: list[str], order: list[str], spec: Spec, chunk: str | None = None) -> DataFrame:
    """Add history columns: ``count``, ``sum``, ``mean``, ``std``, ``lag``, ``whole_mean``, ``whole_count``."""
    if chunk is None:
        return _running_direct(df, keys, order, spec)
    return _running_chunked(df, keys, order, spec, chunk)


def _ordered(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])


def _running_direct(df: DataFrame, keys: list[str], order: list[str], spec: Spec) -> DataFrame:
    window = _ordered(keys, order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    made = {}
    for name, (kind, value) in spec.items():
        column = _expr(value)
        made[name] = {
            "count": lambda c: (F.row_number().over(window) - 1).cast("bigint"),
            "sum": lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)),
            "mean": lambda c: F.avg(c).over(before),
            "std": lambda c: F.stddev_samp(c).over(before),
            "lag": lambda c: F.lag(c).over(window),
            "whole_mean": lambda c: F.avg(c).over(whole),
            "whole_count": lambda c: F.count(F.lit(1)).over(whole),
        }[kind](column)
    return df.withColumns(made)


def _running_chunked(df: DataFrame, keys: list[str], order: list[str], spec: Spec, chunk: str) -> DataFrame:
    local_keys = [*keys, chunk]
    window = _ordered(local_keys, order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)

    # Totals of each chunk, and what all earlier chunks of the entity add up to.
    totals = [F.count(F.lit(1)).alias("_rows")]
    for name, (kind, value) in spec.items():
        column = _expr(value)
        if kind in ("sum", "mean", "std", "whole_mean"):
            totals += [F.count(column).alias(f"_n_{name}"), F.sum(column).alias(f"_s_{name}")]
        if kind == "std":
            totals += [F.var_pop(column).alias(f"_v_{name}"), F.avg(column).alias(f"_m_{name}")]
        if kind == "lag":
            totals.append(F.max_by(F.struct(column.alias("v")), sort_struct(order)).alias(f"_last_{name}"))
    summary = df.groupBy(*local_keys).agg(*totals)

    chunks = Window.partitionBy(*keys).orderBy(chunk)
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)

    def carried(column: str) -> Column:
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    carry = {"_c_rows": carried("_rows"), "_w_rows": F.sum("_rows").over(whole)}
    for name, (kind, _) in spec.items():
        if kind in ("sum", "mean", "std"):
            carry[f"_cn_{name}"] = carried(f"_n_{name}")
            carry[f"_cs_{name}"] = carried(f"_s_{name}")
        if kind == "std":
            # Squared deviations around the entity's overall mean merge by plain addition.
            centre = F.sum(f"_s_{name}").over(whole) / F.nullif(F.sum(f"_n_{name}").over(whole), F.lit(0))
            shift = F.col(f"_m_{name}") - centre
            squares = F.col(f"_n_{name}") * (F.col(f"_v_{name}") + shift * shift)
            carry[f"_cc_{name}"] = centre
            carry[f"_cq_{name}"] = F.coalesce(F.sum(squares).over(earlier), F.lit(0.0))
        if kind == "lag":
            carry[f"_cl_{name}"] = F.last(f"_last_{name}").over(earlier)
        if kind == "whole_mean":
            carry[f"_cw_{name}"] = (
                F.sum(f"_s_{name}").over(whole) / F.nullif(F.sum(f"_n_{name}").over(whole), F.lit(0))
            )
    carry_table = summary.select(*local_keys, *[c.alias(n) for n, c in carry.items()])

    local = {"_l_rows": F.row_number().over(window) - 1}
    for name, (kind, value) in spec.items():
        column = _expr(value)
        if kind in ("sum", "mean", "std"):
            local[f"_ln_{name}"] = F.count(column).over(before)
            local[f"_ls_{name}"] = F.coalesce(F.sum(column).over(before), F.lit(0))
        if kind == "std":
            local[f"_lv_{name}"] = F.coalesce(F.var_pop(column).over(before), F.lit(0.0))
        if kind == "lag":
            local[f"_ll_{name}"] = F.lag(column).over(window)
    joined = attach(df.withColumns(local), carry_table, local_keys)

    made = {}
    for name, (kind, _) in spec.items():
        n_local, n_carry = F.col(f"_ln_{name}"), F.col(f"_cn_{name}")
        s_local, s_carry = F.col(f"_ls_{name}"), F.col(f"_cs_{name}")
        n_all = n_local + n_carry
        if kind == "count":
            made[name] = (F.col("_l_rows") + F.col("_c_rows")).cast("bigint")
        elif kind == "sum":
            made[name] = s_local + s_carry
        elif kind == "mean":
            made[name] = (s_local + s_carry) / F.nullif(n_all, F.lit(0))
        elif kind == "std":
            centre = F.col(f"_cc_{name}")
            shift_local = s_local / F.nullif(n_local, F.lit(0)) - centre
            squares = (
                F.col(f"_cq_{name}") + n_local * F.col(f"_lv_{name}")
                + F.coalesce(n_local * shift_local * shift_local, F.lit(0.0))
            )
            shift_all = (s_local + s_carry) / F.nullif(n_all, F.lit(0)) - centre
            deviation = F.greatest(squares - n_all * shift_all * shift_all, F.lit(0.0))
            made[name] = F.when(n_all > 1, F.sqrt(deviation / (n_all - 1)))
        elif kind == "lag":
            made[name] = F.when(F.col("_l_rows") == 0, F.col(f"_cl_{name}.v")).otherwise(F.col(f"_ll_{name}"))
        elif kind == "whole_mean":
            made[name] = F.col(f"_cw_{name}")
        elif kind == "whole_count":
            made[name] = F.col("_w_rows")
    return joined.select(*df.columns, *[c.alias(n) for n, c in made.items()])
