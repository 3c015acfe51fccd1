"""Investigation lookups over a list of cases instead of one click at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators.modeling import MODEL_FEATURES
from riskloom.session import ensure_checkpoint_dir

QUEUE_SIZE = 100
MAX_BROADCAST_CASES = 10_000
QUEUE_COLUMNS = ["transaction_key", "fraud_probability", "is_fraud"]
CASE_NETWORK_COLUMNS = [
    "prior_customers_on_device", "prior_cards_on_device", "prior_devices_on_card", "prior_merchants_on_device",
    "new_customer_on_existing_device_flag", "new_card_on_existing_device_flag",
    "device_shared_by_multiple_customers_flag", "device_shared_by_multiple_cards_flag",
]
CASE_IDENTIFIERS = [
    "source_transaction_id", "customer_id", "card_number", "device_fingerprint", "ip_address", "transaction_ts",
]


def in_every_task(cases: DataFrame, limit: int = MAX_BROADCAST_CASES) -> DataFrame:
    """Broadcast a case list after checking its size; a longer list stays distributed."""
    return F.broadcast(cases) if cases.limit(limit + 1).count() <= limit else cases


def _queue(scored: DataFrame, limit: int) -> DataFrame:
    return scored.select(*QUEUE_COLUMNS).orderBy(F.desc("fraud_probability"), "transaction_key").limit(limit)


def queue_high_risk(scored: DataFrame, limit: int = QUEUE_SIZE) -> DataFrame:
    return _queue(scored, limit)


def queue_false_positives(scored: DataFrame, limit: int = QUEUE_SIZE, threshold: float = C.DECISION_THRESHOLD) -> DataFrame:
    return _queue(scored.filter((F.col("is_fraud") == 0) & (F.col("fraud_probability") >= F.lit(threshold))), limit)


def queue_false_negatives(scored: DataFrame, limit: int = QUEUE_SIZE, threshold: float = C.DECISION_THRESHOLD) -> DataFrame:
    return _queue(scored.filter((F.col("is_fraud") == 1) & (F.col("fraud_probability") < F.lit(threshold))), limit)


def random_queue(scored: DataFrame, limit: int = QUEUE_SIZE, seed: str = "queue-") -> DataFrame:
    """A repeatable random sample of fixed size: the smallest seeded digests."""
    digest = F.md5(F.concat(F.lit(seed), F.col("transaction_key")))
    return scored.select(*QUEUE_COLUMNS).orderBy(digest, "transaction_key").limit(limit)


def case_decisions(scored: DataFrame, threshold: float = C.DECISION_THRESHOLD) -> DataFrame:
    """Score, band, action and confusion label of every scored payment."""
    p = F.col("fraud_probability")
    return scored.select(
        "transaction_key", p, C.risk_score(p).alias("risk_score"), C.risk_band(p).alias("risk_band"),
        C.action(p).alias("action"), C.confusion_label(F.col("is_fraud"), p, threshold).alias("case_type"))


CLOSURE_KEYS = ["customer_id", "device_fingerprint", "card_number"]


def case_closure(facts: DataFrame, cases: DataFrame) -> DataFrame:
    """All payments that a case's features are built from: those of its customer, its device or its card.

    One pass over the facts finds the cases' entities, a second one keeps their payments; both meet lists of checked size,
    so nothing is exchanged before the rows are few. NULL is an entity like others, as it is for the windows. The result
    is stored, as several windows read it.
    """
    ensure_checkpoint_dir(facts.sparkSession)
    about = facts.join(in_every_task(cases.select("transaction_key")), "transaction_key", "left_semi").select(
        *CLOSURE_KEYS).checkpoint()
    kept, marks = facts, []
    for key in CLOSURE_KEYS:
        wanted = about.select(F.col(key).alias("_entity"), F.lit(True).alias(f"_{key}")).distinct()
        kept = kept.join(in_every_task(wanted), F.col(key).eqNullSafe(F.col("_entity")), "left").drop("_entity")
        marks.append(F.col(f"_{key}").isNotNull())
    return kept.filter(marks[0] | marks[1] | marks[2]).select(*facts.columns).checkpoint()


def case_lookup(base: DataFrame, network: DataFrame, cases: DataFrame) -> DataFrame:
    """Model row and network row of every case."""
    keys = in_every_task(cases.select("transaction_key"))
    model = base.select("transaction_key", *MODEL_FEATURES, "is_fraud").join(keys, "transaction_key", "left_semi")
    links = network.select("transaction_key", *CASE_IDENTIFIERS, *CASE_NETWORK_COLUMNS).join(
        keys, "transaction_key", "left_semi")
    return model.join(links, "transaction_key")


def _first_per_case(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    window = Window.partitionBy("case_key").orderBy(*order)
    return df.withColumn("position", F.row_number().over(window)).filter(F.col("position") <= limit)


def customer_history(facts: DataFrame, cases: DataFrame, limit: int = 20) -> DataFrame:
    """Each case customer's latest payments up to the time of the case, the case included.

    A case list of checked size is read by every task next to the facts; a task keeps at most
    ``limit`` rows per case before anything is exchanged, however long the customer's history is.
    """
    about = in_every_task(cases).join(facts.select("transaction_key", "customer_id", "transaction_ts"), "transaction_key").select(
        F.col("transaction_key").alias("case_key"), F.col("customer_id").alias("case_customer"),
        F.col("transaction_ts").alias("case_ts"))
    earlier = facts.join(
        in_every_task(about),
        (F.col("customer_id") == F.col("case_customer")) & (F.col("transaction_ts") <= F.col("case_ts")))
    rows = earlier.select(
        "case_key", F.col("transaction_ts").alias("timestamp"), "transaction_key", "amount", "currency", "merchant",
        "channel", "country", C.outcome(F.col("is_fraud")).alias("outcome"))
    return _first_per_case(rows, [F.desc("timestamp"), F.desc("transaction_key")], limit)


def _linked(edges: DataFrame, facts: DataFrame, cases: DataFrame, linked: str, limit: int) -> DataFrame:
    about = in_every_task(cases).join(facts.select("transaction_key", "device_fingerprint"), "transaction_key").select(
        F.col("transaction_key").alias("case_key"), "device_fingerprint")
    rows = edges.join(in_every_task(about), "device_fingerprint").drop("device_fingerprint")
    return _first_per_case(rows, [F.desc("fraud_transactions"), F.desc("transactions"), F.asc_nulls_last(linked)], limit)


def linked_customers(edges: DataFrame, facts: DataFrame, cases: DataFrame, limit: int = 50) -> DataFrame:
    """Customers seen on the device of each case, most fraud first."""
    return _linked(edges, facts, cases, "customer_id", limit)


def linked_cards(edges: DataFrame, facts: DataFrame, cases: DataFrame, limit: int = 50) -> DataFrame:
    """Cards seen on the device of each case, most fraud first, numbers masked."""
    return _linked(edges, facts, cases, "card_number", limit).withColumn(
        "card_number", C.mask_card(F.col("card_number")))


def case_devices(facts: DataFrame, cases: DataFrame, limit: int = MAX_BROADCAST_CASES) -> list[str | None]:
    """Devices of a case list of checked size, for a lookup in stored edges."""
    found = facts.join(in_every_task(cases, limit), "transaction_key", "left_semi").select("device_fingerprint").distinct()
    devices = [r[0] for r in found.limit(limit + 1).collect()]
    if len(devices) > limit:
        raise ValueError(f"more than {limit} devices: join the edges instead of looking them up")
    return devices


def case_studies(scored: DataFrame, per_type: int = 5, threshold: float = C.DECISION_THRESHOLD) -> DataFrame:
    """The best examples of each kind of outcome: four ranked classes from one scan.

    A payment can stand for two classes, so the classes are exploded, not exclusive. The rank
    filter lets every task drop all but its best rows before the exchange.
    """
    p, fraud = F.col("fraud_probability"), F.col("is_fraud") == 1
    flagged = p >= F.lit(threshold)
    types = F.array_compact(F.array(
        F.when(fraud, "high_risk_true_positive"),
        F.when(~fraud & flagged, "false_positive"),
        F.when(fraud & ~flagged, "false_negative"),
        F.when(~fraud, "low_risk_true_negative"),
    ))
    rows = scored.select("transaction_key", p, "is_fraud", F.explode(types).alias("case_type"))
    strength = F.when(F.col("case_type") == "low_risk_true_negative", -p).otherwise(p)
    window = Window.partitionBy("case_type").orderBy(strength.desc(), F.asc("transaction_key"))
    return rows.withColumn("case_rank", F.row_number().over(window)).filter(F.col("case_rank") <= per_type)
