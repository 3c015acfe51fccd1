"""Leakage-safe behaviour features: only earlier rows of the same customer count."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators.skew import (
    BROADCAST_KEYS,
    CHUNK,
    MAX_ROWS_PER_TASK,
    attach,
    chunk_rows,
    dealt,
    match,
    per_entity,
    running,
    split_heavy,
)
from riskloom.session import ensure_checkpoint_dir

EVENT_ORDER = ["transaction_ts", "transaction_key"]
HOUR = 3_600
HOURS = {"1h": HOUR, "24h": 24 * HOUR}
BUCKET_SECONDS = 60
# Rows of one customer within a day up to which a range frame is read anew for each row; beyond, buckets are summed.
DENSE_ROWS = 2_000
HISTORY_INPUTS = [
    "transaction_key", "customer_id", "transaction_ts", "amount", "merchant", "device_fingerprint", "ip_address",
    "transaction_hour",
]


def _customer_history(df: DataFrame, chunk: str | None) -> DataFrame:
    return running(df, ["customer_id"], EVENT_ORDER, {
        "customer_prior_transactions": ("count", None),
        "previous_customer_transaction_ts": ("lag", "transaction_ts"),
        "previous_customer_amount": ("lag", "amount"),
        "previous_customer_merchant": ("lag", "merchant"),
        "previous_device_fingerprint": ("lag", "device_fingerprint"),
        "customer_avg_amount_prior": ("mean", "amount"),
        "customer_std_amount_prior": ("std", "amount"),
    }, chunk)


def _novelty(df: DataFrame, chunk: str | None) -> DataFrame:
    # Rows clustered by customer are clustered by (customer, x) too: no further exchange.
    for linked, name in [("device_fingerprint", "device"), ("ip_address", "ip"), ("merchant", "merchant")]:
        df = running(df, ["customer_id", linked], EVENT_ORDER, {f"_seen_{name}": ("count", None)}, chunk)
    return df


def _velocity_direct(df: DataFrame) -> DataFrame:
    made = {}
    for suffix, seconds in HOURS.items():
        # Same leading sort key as the row-based history, so both share one sort.
        recent = (
            "over (partition by customer_id order by transaction_ts asc nulls last "
            f"range between interval '{seconds // HOUR}' hour preceding and current row)"
        )
        made[f"calculated_txn_count_{suffix}"] = F.expr(f"(count(1) {recent}) - 1")
        made[f"calculated_amount_{suffix}"] = F.expr(f"(sum(amount) {recent}) - amount")
    return df.withColumns(made)


def _velocity_bucketed(df: DataFrame, bucket_seconds: int) -> DataFrame:
    """The same range counts for customers too large for one task.

    Payments collapse to distinct instants, which fall into short time buckets. What lies in the
    range is: the own bucket up to now, whole buckets in between, and the end of the oldest
    bucket. The oldest bucket travels to the current one shifted by the range, so all three parts
    come from groups of at most two buckets.
    """
    width = bucket_seconds * 1_000_000
    keys = ["customer_id", "_at"]
    rows = df.withColumn("_at", C.micros(F.col("transaction_ts")))
    instants = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum("amount"), F.lit(0.0)).alias("_s")
    ).withColumn("_bucket", F.floor(F.col("_at") / width))
    buckets = instants.groupBy("customer_id", "_bucket").agg(F.sum("_n").alias("_bn"), F.sum("_s").alias("_bs"))
    result = rows
    for suffix, seconds in HOURS.items():
        span, steps = seconds * 1_000_000, seconds // bucket_seconds
        between = Window.partitionBy("customer_id").orderBy("_bucket").rangeBetween(-(steps - 1), -1)
        # Payments without a time are peers of each other only; their one bucket has nothing before it.
        middle = buckets.filter(F.col("_bucket").isNotNull()).select(
            "customer_id", "_bucket",
            F.sum("_bn").over(between).alias("_mn"), F.sum("_bs").over(between).alias("_ms"))
        real = instants.select(*keys, "_bucket", F.col("_at").alias("_pos"), F.lit(True).alias("_real"), "_n", "_s")
        oldest = instants.filter(F.col("_at").isNotNull()).select(
            *keys, (F.col("_bucket") + steps).alias("_bucket"), (F.col("_at") + span).alias("_pos"),
            F.lit(False).alias("_real"), "_n", "_s")
        both = real.unionByName(oldest)
        group = Window.partitionBy("customer_id", "_bucket")
        up_to_now = group.orderBy(F.col("_pos").asc_nulls_last()).rangeBetween(Window.unboundedPreceding, 0)
        from_now = group.orderBy(F.col("_pos").desc_nulls_last()).rangeBetween(Window.unboundedPreceding, 0)
        ends = both.withColumns({
            "_hn": F.sum(F.when(F.col("_real"), F.col("_n")).otherwise(0)).over(up_to_now),
            "_hs": F.sum(F.when(F.col("_real"), F.col("_s")).otherwise(0.0)).over(up_to_now),
            "_tn": F.sum(F.when(~F.col("_real"), F.col("_n")).otherwise(0)).over(from_now),
            "_ts": F.sum(F.when(~F.col("_real"), F.col("_s")).otherwise(0.0)).over(from_now),
        }).filter("_real").select(*keys, "_bucket", "_hn", "_hs", "_tn", "_ts")
        parts = attach(ends, middle, ["customer_id", "_bucket"]).select(
            *keys,
            (F.col("_hn") + F.coalesce("_mn", F.lit(0)) + F.col("_tn")).alias(f"_count_{suffix}"),
            (F.col("_hs") + F.coalesce("_ms", F.lit(0.0)) + F.col("_ts")).alias(f"_sum_{suffix}"),
        )
        result = attach(result, parts, keys)
    return result.select(
        *df.columns,
        *[c for s in HOURS for c in (
            (F.col(f"_count_{s}") - 1).alias(f"calculated_txn_count_{s}"),
            (F.col(f"_sum_{s}") - F.col("amount")).alias(f"calculated_amount_{s}"),
        )],
    )


def _days(df: DataFrame) -> DataFrame:
    """Payments of each customer and day."""
    day = F.floor(C.micros(F.col("transaction_ts")) / (HOURS["24h"] * 1_000_000))
    return df.groupBy("customer_id", day.alias("_day")).agg(F.count(F.lit(1)).alias("_n"))


def volume(df: DataFrame, dense_rows: int = DENSE_ROWS) -> tuple[int, int]:
    """Rows, and customer days of more than ``dense_rows``: one counting pass, for callers that build several features."""
    found = _days(df).agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count_if(F.col("_n") > dense_rows)).first()
    return found[0], found[1]


def split_dense(df: DataFrame, dense_rows: int = DENSE_ROWS, known_none: bool = False
                ) -> tuple[DataFrame, DataFrame | None]:
    """Rows of customers whose days all stay within ``dense_rows``, and those of the others (None when there are none).

    A range frame costs the rows inside it for each row, so what counts is a customer's busiest day, not the customer's
    rows. Days are counted with partial sums before the exchange; a list of busy customers is checkpointed.
    ``known_none`` says that ``volume`` has found no such day.
    """
    busy = _days(df).filter(F.col("_n") > dense_rows).select("customer_id").distinct()
    if known_none or busy.isEmpty():
        return df, None
    ensure_checkpoint_dir(df.sparkSession)
    busy = busy.checkpoint()
    found = busy.count()
    if found <= BROADCAST_KEYS:
        busy = F.broadcast(busy)
    condition = match(df, busy, ["customer_id"])
    return df.join(busy, condition, "left_anti"), df.join(busy, condition, "left_semi")


def velocity_features(df: DataFrame, max_rows: int = MAX_ROWS_PER_TASK, bucket_seconds: int = BUCKET_SECONDS,
                      dense_rows: int = DENSE_ROWS) -> DataFrame:
    """Count and value of the customer's payments in the last 1 h and 24 h, self excluded, ties included."""
    rows, busy_days = volume(df, dense_rows)
    light, heavy = split_heavy(df, ["customer_id"], max_rows, rows)
    light, dense = split_dense(light, dense_rows, busy_days == 0)
    result = _velocity_direct(dealt(light, ["customer_id"], rows))
    for part in (heavy, dense):
        if part is not None:
            result = result.unionByName(_velocity_bucketed(part, bucket_seconds))
    return result


def with_history(df: DataFrame, max_rows: int = MAX_ROWS_PER_TASK, bucket_seconds: int = BUCKET_SECONDS,
                 rows: int | None = None, dense_rows: int = DENSE_ROWS, busy_days: int | None = None) -> DataFrame:
    """Add the history features next to the columns of ``df``, in place: no key is looked up, so NULL or repeated
    transaction keys lose and multiply nothing. Columns that nobody reads are pruned before the windows.
    """
    if rows is None and busy_days is None:
        rows, busy_days = volume(df, dense_rows)
    rows = df.count() if rows is None else rows
    light, heavy = split_heavy(df, ["customer_id"], max_rows, rows)
    light, dense = split_dense(light, dense_rows, busy_days == 0)
    light = dealt(light, ["customer_id"], rows)
    table = _novelty(_velocity_direct(_customer_history(light, None)), None)
    if dense is not None:
        dense = dealt(dense, ["customer_id"], rows)
        table = table.unionByName(_velocity_bucketed(_novelty(_customer_history(dense, None), None), bucket_seconds))
    if heavy is not None:
        chunks = chunk_rows(heavy, ["customer_id"], EVENT_ORDER, max_rows)
        chunked = _novelty(_customer_history(chunks, CHUNK), CHUNK).drop(CHUNK)
        table = table.unionByName(_velocity_bucketed(chunked, bucket_seconds))
    average, deviation = F.col("customer_avg_amount_prior"), F.col("customer_std_amount_prior")
    return table.withColumns({
        "minutes_since_previous_transaction":
            C.minutes_between(F.col("transaction_ts"), F.col("previous_customer_transaction_ts")),
        "amount_vs_customer_average": F.col("amount") / F.nullif(average, F.lit(0.0)),
        "amount_zscore_vs_customer_history": (F.col("amount") - average) / F.nullif(deviation, F.lit(0.0)),
        "new_device_for_customer_flag": C.flag(F.col("_seen_device") == 0),
        "new_ip_for_customer_flag": C.flag(F.col("_seen_ip") == 0),
        "new_merchant_for_customer_flag": C.flag(F.col("_seen_merchant") == 0),
        "device_changed_from_previous_flag":
            C.flag(F.col("previous_device_fingerprint") != F.col("device_fingerprint")),
        "overnight_transaction_flag": C.flag(C.is_overnight(F.col("transaction_hour"))),
    }).drop("_seen_device", "_seen_ip", "_seen_merchant")


def behavior_features(df: DataFrame, max_rows: int = MAX_ROWS_PER_TASK, bucket_seconds: int = BUCKET_SECONDS,
                      rows: int | None = None, busy_days: int | None = None) -> DataFrame:
    """The full feature table: the payment with its history, velocity, novelty and change flags."""
    return with_history(df, max_rows, bucket_seconds, rows, busy_days=busy_days)


RISK_FLAGS_VIEW = "transaction_risk_flags"


def risk_flags(df: DataFrame, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """First descriptive flags. The customer mean here covers all rows, so these are not model features."""

    def build(rows: DataFrame, chunk: str | None) -> DataFrame:
        return running(rows, ["customer_id"], EVENT_ORDER, {
            "_customer_mean": ("whole_mean", "amount"),
            "_earlier": ("count", None),
            "previous_customer_transaction_ts": ("lag", "transaction_ts"),
            "previous_customer_amount": ("lag", "amount"),
        }, chunk)

    table = per_entity(df, ["customer_id"], EVENT_ORDER, build, max_rows)
    return table.withColumns({
        "unusually_high_amount_flag": C.flag(F.col("amount") > F.col("_customer_mean") * 3),
        "high_risk_merchant_flag": C.flag(F.col("high_risk_merchant")),
        "overnight_transaction_flag": C.flag(C.is_overnight(F.col("transaction_hour"))),
        "card_not_present_flag": C.flag(~F.col("card_present")),
        "customer_transaction_number": F.col("_earlier") + 1,
    }).drop("_customer_mean", "_earlier")
