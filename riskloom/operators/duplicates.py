"""Reused transaction ids: how many, how different, and a unique key for every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators.skew import MAX_ROWS_PER_TASK, ROWS_PER_TASK, dealt, per_entity, running, split_heavy

ID = "transaction_id"

# Compared fields with their report names, and the order rows of one id are numbered in.
CONFLICT_FIELDS = {
    "customer_id": "customer", "card_number": "card", "transaction_ts": "timestamp", "merchant": "merchant",
    "amount": "amount", "currency": "currency", "country": "country", "city": "city", "card_type": "card_type",
    "device": "device", "channel": "channel", "device_fingerprint": "device_fingerprint", "ip_address": "ip",
    "high_risk_merchant": "high_risk", "is_fraud": "fraud_label",
}
SCORED_FIELDS = [
    "customer_id", "card_number", "transaction_ts", "merchant", "amount", "device_fingerprint", "ip_address", "is_fraud",
]
BEHAVIOR_FIELDS = {
    "transaction_ts": "timestamp", "customer_id": "customer", "card_number": "card", "amount": "amount",
    "merchant": "merchant", "is_fraud": "fraud_label",
}
SEQUENCE_ORDER = [
    "transaction_ts", "customer_id", "card_number", "amount", "merchant", "device_fingerprint", "ip_address",
]

# Rows of one id whose scored fields meet in one array.
ARRAY_ROWS = 10_000


def _differs(name: str) -> Column:
    """More than one distinct known value in the group; needs no distinct set and combines on the map side."""
    return F.min(name) != F.max(name)


def _row_identity(columns: list[str]) -> Column:
    """A hash of the whole row that tells NULL from absent neighbours."""
    parts = []
    for name in columns:
        parts += [F.col(name).isNull(), F.col(name)]
    return F.xxhash64(*parts)


def id_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(ID).agg(F.count(F.lit(1)).alias("rows_per_id"))


def duplicate_id_count(df: DataFrame) -> DataFrame:
    """Number of known ids used by more than one row."""
    return id_counts(df.filter(F.col(ID).isNotNull())).agg(
        F.count_if(F.col("rows_per_id") > 1).alias("duplicate_transaction_ids"))


def duplicate_summary(df: DataFrame) -> DataFrame:
    known = F.count_if(F.col(ID).isNotNull())
    return id_counts(df).agg(
        F.sum("rows_per_id").alias("total_rows"),
        known.alias("unique_transaction_ids"),
        (F.sum("rows_per_id") - known).alias("extra_duplicate_rows"),
        F.count_if(F.col("rows_per_id") > 1).alias("duplicate_id_groups"),
    )


def duplicate_conflicts(df: DataFrame) -> DataFrame:
    """Reused ids whose rows are identical, and those whose rows differ anywhere."""
    identity = df.select(ID, _row_identity([c for c in df.columns if c != ID]).alias("identity"))
    groups = identity.groupBy(ID).agg(
        F.count(F.lit(1)).alias("rows_per_id"), _differs("identity").alias("conflicting")
    ).filter("rows_per_id > 1")
    return groups.agg(
        F.count(F.lit(1)).alias("duplicate_transaction_ids"),
        F.count_if(~F.col("conflicting")).alias("exact_duplicate_ids"),
        F.count_if(F.col("conflicting")).alias("conflicting_duplicate_ids"),
    )


def duplicate_samples(df: DataFrame, ids: int = 100) -> DataFrame:
    """All rows of the first reused ids."""
    chosen = id_counts(df).filter("rows_per_id > 1").orderBy(F.asc_nulls_last(ID)).limit(ids).select(ID)
    return df.join(F.broadcast(chosen), ID).orderBy(ID, F.asc_nulls_last("transaction_ts"))


def duplicate_group_sizes(df: DataFrame) -> DataFrame:
    return (
        id_counts(df).filter("rows_per_id > 1")
        .groupBy("rows_per_id").agg(F.count(F.lit(1)).alias("transaction_ids")).orderBy("rows_per_id")
    )


def field_conflicts(df: DataFrame) -> DataFrame:
    """For each field, the number of reused ids whose rows disagree on it."""
    fields = {c: label for c, label in CONFLICT_FIELDS.items() if c in df.columns}
    groups = df.filter(F.col(ID).isNotNull()).groupBy(ID).agg(
        F.count(F.lit(1)).alias("rows_per_id"), *[_differs(c).alias(label) for c, label in fields.items()]
    ).filter("rows_per_id > 1")
    return groups.agg(
        F.count(F.lit(1)).alias("duplicate_ids"),
        *[F.count_if(F.col(label)).alias(f"{label}_conflicts") for label in fields.values()],
    )


def label_conflicts(df: DataFrame, limit: int = 100) -> DataFrame:
    """Reused ids whose rows carry both labels."""
    return (
        df.groupBy(ID).agg(
            F.count(F.lit(1)).alias("rows_per_id"),
            F.count_distinct(F.col("is_fraud")).alias("fraud_versions"),
            F.min("is_fraud").alias("min_fraud_label"),
            F.max("is_fraud").alias("max_fraud_label"),
        )
        .filter("rows_per_id > 1 and fraud_versions > 1")
        .orderBy(F.asc_nulls_last(ID)).limit(limit)
    )


def _scores_of_small(rows: DataFrame) -> DataFrame:
    """Distinct known values of the scored fields, all added up, of ids of few rows, which meet in one array."""
    values = F.collect_list(F.struct(*SCORED_FIELDS)).alias("versions")
    found = rows.groupBy(ID).agg(values).filter(F.size("versions") > 1)
    kinds = [F.size(F.array_distinct(F.array_compact(F.col(f"versions.{c}")))) for c in SCORED_FIELDS]
    return found.select(ID, sum(kinds, F.lit(0)).cast("bigint").alias("conflict_score"))


def _scores_of_large(rows: DataFrame) -> DataFrame:
    """The same of ids of any number of rows: a row travels once for each field, so only the ids that need it come here."""
    versions = rows.groupBy(ID).agg(*[F.count_distinct(F.col(c)).alias(f"v_{c}") for c in SCORED_FIELDS])
    score = sum((F.col(f"v_{c}") for c in SCORED_FIELDS), F.lit(0))
    return versions.select(ID, score.cast("bigint").alias("conflict_score"))


def conflict_examples(df: DataFrame, ids: int = 50, array_rows: int = ARRAY_ROWS, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """All rows of the ids whose rows differ most; the id settles ties.

    The scored fields of a row are exchanged once. Ids of more than ``array_rows`` rows are split off by a count that
    combines before its exchange.
    """
    scored = df.select(ID, *[
        F.when(F.col(c) == 0, F.lit(0.0).cast(t)).otherwise(F.col(c)).alias(c) if t in ("double", "float") else F.col(c)
        for c, t in df.select(*SCORED_FIELDS).dtypes])  # the two zeros are one value
    rows = scored.count()
    few, many = split_heavy(scored, [ID], array_rows, rows)
    scores = _scores_of_small(dealt(few, [ID], rows, per_task))
    if many is not None:
        scores = scores.unionByName(_scores_of_large(many))
    worst = scores.orderBy(F.desc("conflict_score"), F.asc_nulls_last(ID)).limit(ids)
    return (
        df.join(F.broadcast(worst), ID)
        .orderBy(F.desc("conflict_score"), ID, F.asc_nulls_last("transaction_ts"))
        .select(*df.columns, "conflict_score")
    )


def duplicate_behavior(df: DataFrame) -> DataFrame:
    """Do rows sharing an id look like separate payments? Time, customer and card all differing says yes."""
    groups = df.groupBy(ID).agg(
        F.count(F.lit(1)).alias("rows_per_id"), *[_differs(c).alias(label) for c, label in BEHAVIOR_FIELDS.items()]
    ).filter("rows_per_id > 1")
    separate = F.col("timestamp") & F.col("customer") & F.col("card")
    return groups.agg(
        F.count(F.lit(1)).alias("duplicate_ids"),
        *[F.count_if(F.col(label)).alias(f"different_{label}_ids") for label in BEHAVIOR_FIELDS.values()],
        F.count_if(separate).alias("strongly_separate_transaction_like_ids"),
    )


def conflicting_ids(df: DataFrame) -> int:
    """Ids, NULL aside, whose rows differ in any column. Two digests a row, combined before the exchange."""
    rest = [c for c in df.columns if c != ID]
    rows = df.filter(F.col(ID).isNotNull()).select(ID, F.xxhash64(*rest).alias("a"), F.xxhash64(F.lit(1), *rest).alias("b"))
    same = rows.groupBy(ID).agg(*[f(c).alias(f"{n}_{c}") for c in "ab" for n, f in (("low", F.min), ("high", F.max))])
    return same.filter((F.col("low_a") != F.col("high_a")) | (F.col("low_b") != F.col("high_b"))).count()


def dedup_first(df: DataFrame) -> DataFrame:
    """One row of every id, if rows of one id are copies of each other; with any conflict nothing is removed.

    Rows with a NULL id say nothing about each other and all stay. A grouped exchange of whole rows follows only when
    there is something to remove; copies combine before it.
    """
    if conflicting_ids(df):
        return df
    known = df.filter(F.col(ID).isNotNull()).dropDuplicates([ID])
    return known.unionByName(df.filter(F.col(ID).isNull()))


def unique_keys(df: DataFrame, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """One key per row: the bare id when unique, else the id and its position among the rows sharing it."""
    # Columns beyond the named order only settle full ties, so a rerun numbers copies the same way.
    rest = sorted(c for c in df.columns if c not in (ID, *SEQUENCE_ORDER))
    order = [c for c in SEQUENCE_ORDER if c in df.columns] + rest

    def build(rows: DataFrame, chunk: str | None) -> DataFrame:
        return running(rows, [ID], order, {
            "source_id_occurrences": ("whole_count", None), "_earlier": ("count", None)}, chunk)

    table = per_entity(df, [ID], order, build, max_rows)
    key = F.when(F.col("source_id_occurrences") == 1, F.col(ID)).otherwise(
        F.concat(F.col(ID), F.lit("_"), (F.col("_earlier") + 1).cast("string")))
    return table.select(
        F.col(ID).alias("source_transaction_id"),
        key.alias("transaction_key"),
        C.flag(F.col("source_id_occurrences") > 1).alias("reused_source_id_flag"),
        "source_id_occurrences",
        *[c for c in df.columns if c != ID],
    )


def key_validation(keyed: DataFrame) -> DataFrame:
    return keyed.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(F.col("transaction_key")).alias("unique_transaction_keys"),
        F.count_distinct(F.col("source_transaction_id")).alias("unique_source_ids"),
        F.sum("reused_source_id_flag").alias("rows_with_reused_source_ids"),
    ).withColumn("duplicate_transaction_keys", F.col("total_rows") - F.col("unique_transaction_keys"))


def population_summary(keyed: DataFrame) -> DataFrame:
    return keyed.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("is_fraud").alias("fraud_transactions"),
        C.pct(F.col("is_fraud")).alias("fraud_rate_pct"),
        F.min("transaction_ts").alias("start_date"),
        F.max("transaction_ts").alias("end_date"),
    )
