"""Typing and cleaning of all-text payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C

# Which raw columns get which treatment.
TEXT_COLUMNS = [
    "transaction_id", "customer_id", "card_number", "merchant_category", "merchant_type", "merchant",
    "country", "city", "card_type", "device", "device_fingerprint", "ip_address",
]
UPPER_COLUMNS = ["currency"]
LOWER_COLUMNS = ["city_size", "channel"]
BOOLEAN_COLUMNS = ["card_present", "high_risk_merchant", "weekend_transaction"]
VELOCITY_KEYS = [
    "num_transactions", "total_amount", "unique_merchants", "unique_countries", "max_single_amount",
]


def _present(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def clean_text(df: DataFrame) -> DataFrame:
    """Trim text, blanks to NULL, normalise case."""
    made = {n: C.blank_to_null(F.col(n)) for n in _present(df, TEXT_COLUMNS)}
    made |= {n: F.upper(C.blank_to_null(F.col(n))) for n in _present(df, UPPER_COLUMNS)}
    made |= {n: F.lower(C.blank_to_null(F.col(n))) for n in _present(df, LOWER_COLUMNS)}
    return df.withColumns(made)


def clean_casts(df: DataFrame) -> DataFrame:
    """Text to timestamp, double and integer; unreadable text becomes NULL."""
    made: dict[str, Column] = {}
    if "timestamp" in df.columns:
        made["transaction_ts"] = F.col("timestamp").try_cast("timestamp_ntz")
    if "amount" in df.columns:
        made["amount"] = F.col("amount").try_cast("double")
    if "transaction_hour" in df.columns:
        made["transaction_hour"] = C.parse_integer(F.col("transaction_hour"))
    return df.withColumns(made).drop("timestamp")


def clean_booleans(df: DataFrame) -> DataFrame:
    """Token sets to booleans, and the fraud label to 1, 0 or NULL."""
    made = {n: C.parse_boolean(F.col(n)) for n in _present(df, BOOLEAN_COLUMNS)}
    if "is_fraud" in df.columns:
        made["is_fraud"] = C.parse_label(F.col("is_fraud"))
    return df.withColumns(made)


def stage(df: DataFrame) -> DataFrame:
    """All typing rules in one projection over the raw text."""
    staged = clean_booleans(clean_casts(clean_text(df)))
    raw = {n: C.blank_to_null(F.col(n)) for n in _present(df, ["distance_from_home", "velocity_last_hour"])}
    return staged.withColumns(raw)


def date_parts(df: DataFrame) -> DataFrame:
    ts = F.col("transaction_ts")
    return df.withColumns({
        "transaction_date": F.to_date(ts),
        "derived_hour": F.hour(ts),
        "day_of_week": C.day_of_week(ts),
    })


def extract_distance(df: DataFrame) -> DataFrame:
    """First signed number of the free-text distance."""
    return df.withColumn("distance_from_home", C.first_number(F.col("distance_from_home")))


def dictionary(text: Column) -> Column:
    """A JSON or Python-literal dictionary as ``map<string,string>``; NULL when it is neither."""
    literals = text
    for python, json in [("True", "true"), ("False", "false"), ("None", "null")]:
        bare_word = F.regexp_replace(literals, rf"(?<=[:,\[]\s?){python}\b", json)
        literals = F.when(F.contains(text, F.lit(python)), bare_word).otherwise(literals)
    return F.from_json(literals, "map<string,string>")


def _value_type(value: Column) -> Column:
    return (
        F.when(value.isNull(), "NoneType")
        .when(value.isin("true", "false"), "bool")
        .when(value.rlike(r"^-?[0-9]+$"), "int")
        .when(value.rlike(r"^-?[0-9]*\.?[0-9]+([eE][-+]?[0-9]+)?$"), "float")
        .otherwise("str")
    )


def discover_keys(df: DataFrame, column: str = "velocity_last_hour") -> DataFrame:
    """Keys of the serialized dictionary with their column name and a sample type, over all rows.

    A key seen with several types reports the alphabetically first, so the answer does not depend on row order.
    """
    pairs = df.select(F.explode(F.map_entries(dictionary(F.col(column)))).alias("entry"))
    return (
        pairs.groupBy(F.col("entry.key").alias("source_key"))
        .agg(F.min(_value_type(F.col("entry.value"))).alias("sample_type"))
        .select("source_key", F.concat(F.lit("velocity_"), C.column_name(F.col("source_key"))).alias("column_name"),
                "sample_type")
    )


def parse_velocity(df: DataFrame, keys: list[str] = VELOCITY_KEYS, column: str = "velocity_last_hour") -> DataFrame:
    """One double column per dictionary key; the text is parsed once per row."""
    parsed = df.withColumn("_velocity", dictionary(F.col(column)))
    return parsed.withColumns(
        {f"velocity_{k}": F.col("_velocity").getItem(k).try_cast("double") for k in keys}
    ).drop("_velocity")


def clean(df: DataFrame) -> DataFrame:
    """Raw text to the analysis-ready table."""
    typed = date_parts(stage(df))
    if "distance_from_home" in df.columns:
        typed = extract_distance(typed)
    if "velocity_last_hour" in df.columns:
        typed = parse_velocity(typed)
    return typed
