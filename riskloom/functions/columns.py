"""Scalar column functions. Everything here stays inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token sets, cut points and labels that results must agree on.
TRUE_TOKENS = ["true", "1", "yes", "y"]
FALSE_TOKENS = ["false", "0", "no", "n"]
NULL_TOKENS = ["null", "none", "nan", "na", "n/a"]
NUMBER_PATTERN = r"-?[0-9]+(?:\.[0-9]+)?"
AMOUNT_BANDS = [
    (10, "01_under_10"),
    (25, "02_10_25"),
    (50, "03_25_50"),
    (100, "04_50_100"),
    (250, "05_100_250"),
    (500, "06_250_500"),
    (1000, "07_500_1000"),
    (2500, "08_1000_2500"),
    (None, "09_2500_plus"),
]
RISK_BANDS = [(0.30, "Low"), (0.60, "Medium"), (0.80, "High"), (None, "Critical")]
ACTIONS = [(0.30, "Approve"), (0.60, "Monitor"), (0.75, "Manual review"), (None, "Escalate for review")]
DRIFT_LEVELS = [(0.10, "Stable"), (0.25, "Moderate Drift"), (None, "High Drift")]
DECISION_THRESHOLD = 0.75
OVERNIGHT_HOURS = (0, 5)
CARD_MASK = "•••• •••• •••• "
MISSING_CATEGORY = "MISSING"


def rounded(value: Column, places: int) -> Column:
    """Scale, round half away from zero, scale back: decimal text never decides the last digit."""
    scale = F.lit(float(10**places))
    return F.round(value * scale) / scale


def pct(flag: Column, places: int = 4) -> Column:
    """Mean of a 0/1 column as a rounded percentage."""
    return rounded(F.lit(100.0) * F.avg(flag), places)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double; zero when the denominator is zero."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def parse_tokens(text: Column, yes: Column, no: Column) -> Column:
    token = F.lower(F.trim(text))
    return F.when(token.isin(TRUE_TOKENS), yes).when(token.isin(FALSE_TOKENS), no)


def parse_boolean(text: Column) -> Column:
    return parse_tokens(text, F.lit(True), F.lit(False))


def parse_label(text: Column) -> Column:
    return parse_tokens(text, F.lit(1), F.lit(0))


def parse_integer(text: Column) -> Column:
    """Text to integer, fractions rounded; NULL when unreadable or out of range."""
    return F.round(text.try_cast("double")).try_cast("int")


def first_number(text: Column) -> Column:
    return F.regexp_extract(text, NUMBER_PATTERN, 0).try_cast("double")


def is_blank_like(text: Column) -> Column:
    token = F.lower(F.trim(text))
    return text.isNull() | (token == "") | token.isin(NULL_TOKENS)


def day_of_week(ts: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(ts) - 1


def column_name(key: Column) -> Column:
    """A free-text key as a column name: lower case, other characters collapsed to ``_``."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(key)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def banded(value: Column, bands: list[tuple[float | None, str]]) -> Column:
    """Label of the first band whose upper bound lies above the value; the last band is open."""
    bounded = [(F.lit(upper), label) for upper, label in bands if upper is not None]
    first, *rest = bounded
    chain = reduce(lambda acc, b: acc.when(value < b[0], b[1]), rest, F.when(value < first[0], first[1]))
    return chain.otherwise(bands[-1][1])


def amount_band(amount: Column) -> Column:
    return banded(amount, AMOUNT_BANDS)


def risk_band(probability: Column) -> Column:
    return banded(probability, RISK_BANDS)


def action(probability: Column) -> Column:
    return banded(probability, ACTIONS)


def drift_status(psi: Column) -> Column:
    return F.when(psi.isNull(), "Unavailable").otherwise(banded(psi, DRIFT_LEVELS))


def band_order(label: Column, bands: list[tuple[float | None, str]]) -> Column:
    return F.array_position(F.array(*[F.lit(name) for _, name in bands]), label)


def confusion_label(actual: Column, probability: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    flagged = probability >= F.lit(threshold)
    return (
        F.when((actual == 1) & flagged, "True Positive")
        .when((actual == 0) & flagged, "False Positive")
        .when((actual == 1) & ~flagged, "False Negative")
        .otherwise("True Negative")
    )


def risk_score(probability: Column) -> Column:
    """0..100, halves to the even neighbour."""
    return F.bround(probability * F.lit(100.0), 0).cast("int")


def mask_card(card: Column) -> Column:
    text = card.cast("string")
    return F.when(F.length(text) <= 4, text).otherwise(F.concat(F.lit(CARD_MASK), F.right(text, F.lit(4))))


def outcome(label: Column) -> Column:
    return F.when(label == 1, "Fraud").otherwise("Legitimate")


def is_overnight(hour: Column) -> Column:
    return hour.between(*OVERNIGHT_HOURS)


def minutes_between(later: Column, earlier: Column) -> Column:
    """Minutes between two timestamps, counted in crossed whole-second boundaries."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(60.0)


def log_amount(amount: Column) -> Column:
    return F.when(amount > -1, F.log1p(amount))


def sample_bucket(key: Column, buckets: int, seed: str = "") -> Column:
    """Stable bucket number of a key: the leading 32 bits of its md5, modulo ``buckets``."""
    digest = F.md5(F.concat(F.lit(seed), key))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def sort_struct(columns: list[str]) -> Column:
    """A struct that compares like an ascending, NULLS LAST ordering of the columns."""
    parts = []
    for name in columns:
        parts += [F.col(name).isNull().alias(f"{name}_missing"), F.col(name)]
    return F.struct(*parts)
