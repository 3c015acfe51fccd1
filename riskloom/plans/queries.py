"""Registered queries: every operator over the driver tables, by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators import behavior as B
from riskloom.operators import cases as K
from riskloom.operators import cleaning as L
from riskloom.operators import decisions as D
from riskloom.operators import duplicates as U
from riskloom.operators import explain as E
from riskloom.operators import metrics as Q
from riskloom.operators import ml
from riskloom.operators import modeling as M
from riskloom.operators import monitoring as R
from riskloom.operators import network as N
from riskloom.operators import profiles as P
from riskloom.operators import saved
from riskloom.operators import sketches as H
from riskloom.sources import fixtures as X
from riskloom.sources import tables as S

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered runs, shared with the oracle SQL.
CAPACITIES = [5, 10, 20, 50, 100]
COEFFICIENTS = {
    "amount": 0.02, "distance_from_home": 0.8, "transaction_hour": -0.05, "customer_prior_transactions": 0.01,
    "minutes_since_previous_transaction": -0.0005, "amount_vs_customer_average": 0.4,
    "calculated_txn_count_1h": 0.6, "new_merchant_for_customer_flag": 0.3,
}
INTERCEPT = -1.5
RARE_ROWS = 100
RAW_TEXT = [
    "transaction_id", "customer_id", "timestamp", "amount", "currency", "card_present", "distance_from_home",
    "transaction_hour", "velocity_last_hour", "is_fraud",
]


# A mean of cents over a power of two ends in an exact five two digits earlier than other doubles.
FINER = {"customer_avg_amount_prior": 8}


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Engines add doubles in different orders; the digits that matter stay."""
    return df.select(*[
        C.rounded(F.col(f.name), FINER.get(f.name, places)).alias(f.name)
        if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema])


def behavior(spark: SparkSession, folder: str) -> DataFrame:
    """Payments with history, for queries that read a few of the columns."""
    return B.with_history(X.tx(spark, folder))


def network(spark: SparkSession, folder: str) -> DataFrame:
    """The same with network features."""
    payments = X.tx(spark, folder)
    rows, busy_days = B.volume(payments)
    return N.network_features(B.with_history(payments, rows=rows, busy_days=busy_days), rows=rows)


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    """All columns of all features: the wide rows move once."""
    payments = X.tx(spark, folder)
    rows, busy_days = B.volume(payments)
    return N.network_features(B.behavior_features(payments, rows=rows, busy_days=busy_days), rows=rows)


def network_only(spark: SparkSession, folder: str) -> DataFrame:
    """Network features with the label: nothing in them needs the customer history."""
    return N.network_features(X.tx(spark, folder).select(*N.LINK_INPUTS, "is_fraud"))


def base(spark: SparkSession, folder: str) -> DataFrame:
    return M.model_base(feature_table(spark, folder), X.VALIDATION_START, X.TEST_START)


def light_base(spark: SparkSession, folder: str) -> DataFrame:
    """Behaviour features with their period, for queries that read no network feature."""
    features = M.valid_rows(behavior(spark, folder)).withColumn("log_amount", C.log_amount(F.col("amount")))
    return features.withColumn("data_split", M.chrono_split(X.VALIDATION_START, X.TEST_START))


def split(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("data_split") == name)


def scored_periods(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All scored rows of the validation and of the test period."""
    scored = X.tx_scored(spark, folder, X.VALIDATION_START)
    in_test = F.col("transaction_ts") >= M.timestamp(X.TEST_START)
    return scored.filter(~in_test), scored.filter(in_test)


def stored(df: DataFrame, table: str, partition_by: list[str] | None = None) -> DataFrame:
    """A stage table: written once where several steps read it, so its windows run once."""
    root = S.scratch_folder(df.sparkSession)
    S.write_stage(df, root, "modeling", table, partition_by)
    return S.read_stage(df.sparkSession, root, "modeling", table)


def feature_periods(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = light_base(spark, folder).select("data_split", R.DAY, *R.NUMERIC_FEATURES)
    rows = stored(rows, "drift_rows", ["data_split"])
    return split(rows, "validation"), split(rows, "test")


def category_periods(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = X.tx(spark, folder).withColumn("data_split", M.chrono_split(X.VALIDATION_START, X.TEST_START))
    return split(rows, "validation"), split(rows, "test")


# --- sources and sinks -------------------------------------------------------------------------

def scan_raw_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Raw payments written as CSV and scanned back, every column as text."""
    path = f"{S.scratch_folder(spark)}/raw_csv"
    S.write_csv(X.tx_raw(spark, folder).select(*RAW_TEXT), path)
    return S.read_raw_csv(spark, path, RAW_TEXT)


def materialize_stage(spark: SparkSession, folder: str) -> DataFrame:
    """Stage tables written by namespace and read back, with their row counts."""
    root = S.scratch_folder(spark)
    raw = S.write_stage(X.tx_raw(spark, folder), root, "raw", "transactions")
    # Written twice: readers get the later version.
    S.write_stage(S.read_stage(spark, root, "raw", "transactions").limit(1), root, "analytics", "transactions_clean")
    clean = S.write_stage(L.clean(S.read_stage(spark, root, "raw", "transactions")), root, "analytics", "transactions_clean")
    counts = [("raw.transactions", raw["rows"]), ("analytics.transactions_clean", clean["rows"])]
    return spark.createDataFrame(counts, "table_name string, rows bigint")


def stage_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, missing keys, amounts and labels of the clean table, observed while it is written, beside what is read back."""
    root = S.scratch_folder(spark)
    missing = {f"missing_{c}": F.count_if(F.col(c).isNull()) for c in ("transaction_id", "amount", "is_fraud")}
    seen = S.write_stage(L.clean(X.tx_raw(spark, folder)), root, "analytics", "transactions_clean", measures=missing)
    read = S.read_stage(spark, root, "analytics", "transactions_clean")
    return read.agg(F.count(F.lit(1)).alias("rows"), F.lit(seen["rows"]).cast("bigint").alias("observed_rows"),
                    *[F.lit(seen[name]).cast("bigint").alias(name) for name in missing])


def split_tables(spark: SparkSession, folder: str) -> DataFrame:
    """One table partitioned by period; reading a period opens only its folder."""
    root = S.scratch_folder(spark)
    marked = X.tx(spark, folder).withColumn("data_split", M.chrono_split(X.VALIDATION_START, X.TEST_START))
    S.write_stage(marked, root, "modeling", "splits", ["data_split"])
    stored = S.read_stage(spark, root, "modeling", "splits")
    return P.table_counts({name: split(stored, name) for name in M.SPLITS})


def write_report(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{S.scratch_folder(spark)}/daily_trend"
    S.write_report(P.daily_trend(X.tx(spark, folder)), path)
    return spark.read.option("header", True).schema(
        "transaction_date date, transactions bigint, fraud_transactions bigint, fraud_rate_pct double, "
        "transaction_value double, fraud_value double").csv(path)


def write_scores(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{S.scratch_folder(spark)}/scores"
    S.write_scores(X.tx_scored(spark, folder), path)
    return spark.read.parquet(path).select(
        "transaction_key", "is_fraud", C.rounded(F.col("fraud_probability"), 9).alias("fraud_probability"))


def table_counts(spark: SparkSession, folder: str) -> DataFrame:
    return P.table_counts({
        "tx": X.tx(spark, folder), "tx_raw": X.tx_raw(spark, folder), "tx_reused": X.tx_reused(spark, folder),
        "tx_scored": X.tx_scored(spark, folder)})


SKETCHED = {"customers": "customer_id", "cards": "card_number", "devices": "device_fingerprint", "ips": "ip_address",
            "transactions": "transaction_key"}


def sketched_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct counts from stored daily sketches, merged over the test period and over all days, against exact ones."""
    facts = X.tx(spark, folder)
    days = stored(H.daily_sketches(facts, SKETCHED), "daily_sketches")
    test = facts.filter(F.col("transaction_ts") >= M.timestamp(X.TEST_START))
    parts = [("all", facts, None), ("test", test, X.TEST_START[:10])]
    found = [H.against_exact(rows, H.merged_sketches(days, list(SKETCHED), start=start), SKETCHED).select(
        F.lit(name).alias("period"), "*") for name, rows, start in parts]
    return found[0].unionByName(found[1])


def sketched_devices(spark: SparkSession, folder: str) -> DataFrame:
    """Reused and shared devices from sketches stored by device and day."""
    names = {"customers": "customer_id", "cards": "card_number"}
    days = stored(H.daily_sketches(X.tx(spark, folder), names, ["device_fingerprint"]), "device_sketches")
    return H.shared_entities(days, "device_fingerprint", list(names))


# --- cleaning ----------------------------------------------------------------------------------

def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return L.clean(X.tx_raw(spark, folder))


def with_defects(spark: SparkSession, folder: str) -> DataFrame:
    """Typed raw payments, where keys, amounts and labels can be missing."""
    return L.clean_booleans(L.clean_casts(L.clean_text(X.tx_raw(spark, folder))))


def dedup_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Every payment of an id of its own, loaded twice, without the copies."""
    table = X.tx_reused(spark, folder)
    single = table.groupBy("transaction_id").count().filter(F.col("count") == 1).select("transaction_id")
    once = table.join(single, "transaction_id", "left_semi")
    return U.dedup_first(once.unionByName(once))


def tx_ids(spark: SparkSession, folder: str) -> DataFrame:
    return X.tx(spark, folder).withColumn("transaction_id", F.col("source_transaction_id"))


# --- models ------------------------------------------------------------------------------------

def train_sample(spark: SparkSession, folder: str) -> DataFrame:
    return stored(split(light_base(spark, folder), "train").select(*M.NUMERIC_FEATURES), "train")


def stored_base(spark: SparkSession, folder: str) -> DataFrame:
    """The model table, stored because training reads it again and again."""
    columns = ["transaction_key", "transaction_ts", "transaction_date", "data_split", "is_fraud", *M.MODEL_FEATURES]
    return stored(light_base(spark, folder).select(*columns), "model_base", ["data_split"])


def _metrics(scored: DataFrame, threshold: float) -> DataFrame:
    scored = stored(scored.select("is_fraud", "fraud_probability"), "scored")
    return Q.confusion_metrics(scored, threshold).withColumns({
        "roc_auc": Q.roc_auc(scored).scalar(), "pr_auc": Q.pr_auc(scored).scalar()})


def train_logistic(spark: SparkSession, folder: str) -> DataFrame:
    table = stored_base(spark, folder)
    preparation, model = ml.train_logistic(split(table, "train"))
    return _metrics(ml.score_logistic(preparation, model, split(table, "validation")), 0.5)


# The saved model and its table, by application and data folder: trained once, read by every query that needs it.
_BOOSTED: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def boosted(spark: SparkSession, folder: str) -> tuple[PipelineModel, DataFrame]:
    """The boosted trees with full settings, saved in the shared folder and loaded, and the model table."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _BOOSTED:
        table = stored_base(spark, folder)
        path = f"{S.scratch_folder(spark)}/model"
        ml.train_gbt(split(table, "train"), split(table, "validation")).write().save(path)
        _BOOSTED[key] = path, table
    path, table = _BOOSTED[key]
    return PipelineModel.load(path), table


def train_gbt(spark: SparkSession, folder: str) -> DataFrame:
    model, table = boosted(spark, folder)
    return _metrics(ml.score_gbt(model, split(table, "validation")), 0.5)


def train_gbt_facts(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of any training: rows of both periods, no shorter prefix is better on validation, and none is longer
    than asked for."""
    model, table = boosted(spark, folder)
    train, validation = split(table, "train"), split(table, "validation")
    losses = ml.validation_losses(model, train, validation)
    facts = [(train.count(), validation.count(), sum(x < losses[-1] - 1e-12 for x in losses[:-1]),
              int(len(losses) > ml.BOOSTING_ROUNDS))]
    return spark.createDataFrame(
        facts, "training_rows long, validation_rows long, better_prefixes long, rounds_over_limit int")


def model_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """The one-row record that is kept beside the model."""
    model, table = boosted(spark, folder)
    scored = stored(ml.score_gbt(model, split(table, "validation")).select("is_fraud", "fraud_probability"), "scored")
    return ml.model_metadata(
        model, split(table, "train"), scored, Q.roc_auc(scored).first()[0], Q.pr_auc(scored).first()[0])


def model_metadata_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The parts of the record that any engine counts."""
    return model_metadata(spark, folder).select("feature_count", "training_rows", "validation_rows")


def score_test(spark: SparkSession, folder: str) -> DataFrame:
    model, table = boosted(spark, folder)
    return ml.score_gbt(model, split(table, "test")).select("transaction_key", "is_fraud", "fraud_probability")


def score_test_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows scored, rows without a key, and scores outside 0 to 1."""
    p = F.col("fraud_probability")
    return score_test(spark, folder).agg(
        F.count(F.lit(1)).alias("scored"), F.count_if(F.col("transaction_key").isNull()).alias("without_key"),
        F.count_if(p.isNull() | F.isnan(p) | (p < 0) | (p > 1)).alias("out_of_range"))


def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A saved and reloaded model scores the test period; rows where it disagrees with the original."""
    model, table = boosted(spark, folder)
    test = split(table, "test")
    path = f"{S.scratch_folder(spark)}/model"
    model.write().overwrite().save(path)
    before = ml.score_gbt(model, test).select("transaction_key", "fraud_probability")
    after = ml.score_gbt(PipelineModel.load(path), test).select(
        "transaction_key", F.col("fraud_probability").alias("reloaded"))
    return before.join(after, "transaction_key").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("fraud_probability") != F.col("reloaded")).alias("different"))


def logistic_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The saved and reloaded logistic model, preprocessing included, scores the test period; rows where it disagrees."""
    table = stored_base(spark, folder)
    test = split(table, "test")
    path = f"{S.scratch_folder(spark)}/logistic"
    model = saved.logistic_pipeline(split(table, "train"))
    model.write().save(path)
    before = saved.score(model, test).select("transaction_key", "fraud_probability")
    after = saved.score(saved.load(spark, path), test).select(
        "transaction_key", F.col("fraud_probability").alias("reloaded"))
    return before.join(after, "transaction_key").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("fraud_probability") != F.col("reloaded")).alias("different"))


def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    model, table = boosted(spark, folder)
    return ml.feature_importance(model, f"{S.scratch_folder(spark)}/model", table)


def feature_importance_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Features listed, negative shares, and the sum of all shares."""
    return feature_importance(spark, folder).agg(
        F.count_distinct("feature").alias("features"), F.count_if(F.col("gain_importance") < 0).alias("negative"),
        C.rounded(F.sum("gain_importance"), 6).alias("gain_sum"))


def tree_contributions(spark: SparkSession, folder: str) -> DataFrame:
    return E.top_drivers(_tree_parts(spark, folder))


def _tree_parts(spark: SparkSession, folder: str) -> DataFrame:
    model, table = boosted(spark, folder)
    scored = ml.score_gbt(model, split(table, "test"))
    return ml.tree_contributions(
        model, scored, f"{S.scratch_folder(spark)}/model", ["transaction_key", "fraud_probability"])


def tree_contributions_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows explained, and rows whose parts and base value miss the log-odds of the score."""
    p = F.col("fraud_probability")
    total = F.aggregate("contributions", F.col("base_value"), lambda a, x: a + x["contribution"])
    return _tree_parts(spark, folder).agg(
        F.count(F.lit(1)).alias("explained"),
        F.count_if(F.abs(total - F.ln(p / (1 - p))) > 1e-6 * (1 + F.abs(total))).alias("off"))


# --- explanations ------------------------------------------------------------------------------

def contributions(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["transaction_key", "data_split", *COEFFICIENTS]
    table = stored(light_base(spark, folder).select(*columns), "explained", ["data_split"])
    scores = X.tx_scored(spark, folder).select("transaction_key", "fraud_probability")
    test = split(table, "test").join(scores, "transaction_key")
    return E.linear_contributions(
        test, COEFFICIENTS, split(table, "train"), INTERCEPT, ["transaction_key", "fraud_probability"])


def contributions_long(spark: SparkSession, folder: str) -> DataFrame:
    return round_doubles(E.long_contributions(contributions(spark, folder)).drop("fraud_probability"))


def case_summary(spark: SparkSession, folder: str) -> DataFrame:
    cases = K.case_studies(X.tx_scored(spark, folder)).select("transaction_key", "case_type", "is_fraud")
    # Four classes of five rows.
    parts = contributions(spark, folder).join(F.broadcast(cases), "transaction_key")
    return round_doubles(E.case_summary(parts))


# --- monitoring --------------------------------------------------------------------------------

def psi_numeric(spark: SparkSession, folder: str) -> DataFrame:
    return R.numeric_psi(*feature_periods(spark, folder))


def psi_categorical(spark: SparkSession, folder: str) -> DataFrame:
    return R.categorical_psi(*category_periods(spark, folder))


def score_drift(spark: SparkSession, folder: str) -> DataFrame:
    return R.score_drift(*scored_periods(spark, folder))


def performance_drift(spark: SparkSession, folder: str) -> DataFrame:
    reference, _ = scored_periods(spark, folder)
    return R.performance_drift(R.daily_monitoring(X.tx_scored(spark, folder)), reference)


def _monitoring(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The four monitoring reports, stored first: alerts and summary read each of them more than once."""
    root = S.scratch_folder(spark)
    reports = {"score_drift": score_drift, "numeric_drift": psi_numeric, "categorical_drift": psi_categorical,
               "performance_drift": performance_drift}
    for name, build in reports.items():
        S.write_stage(build(spark, folder), root, "modeling", name)
    return [S.read_stage(spark, root, "modeling", name) for name in reports]


def monitoring_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return R.monitoring_alerts(*_monitoring(spark, folder))


def monitoring_summary(spark: SparkSession, folder: str) -> DataFrame:
    return R.monitoring_summary(*_monitoring(spark, folder), *category_periods(spark, folder))


# --- decisions ---------------------------------------------------------------------------------

RULE_INPUTS = [
    "transaction_key", "transaction_ts", "amount", "is_fraud", "distance_from_home", "card_present",
    "transaction_hour", "amount_vs_customer_average", "calculated_txn_count_1h", "calculated_amount_24h",
    "new_merchant_for_customer_flag",
]
NETWORK_RULE_INPUTS = [
    "new_customer_on_existing_device_flag", "new_card_on_existing_device_flag",
    "device_shared_by_multiple_customers_flag",
]


def _by_period(features: DataFrame, columns: list[str]) -> DataFrame:
    period = M.chrono_split(X.VALIDATION_START, X.TEST_START)
    return stored(features.select(*columns).withColumn("data_split", period), "rule_inputs", ["data_split"])


def thresholds(spark: SparkSession, folder: str) -> DataFrame:
    train = split(light_base(spark, folder), "train").select(*M.RULE_COLUMNS)
    return M.rule_thresholds(stored(train, "train"))


def rule_score(spark: SparkSession, folder: str) -> DataFrame:
    table = _by_period(behavior(spark, folder), RULE_INPUTS)
    limits = M.rule_thresholds(split(table, "train"))
    return D.rule_score(split(table, "test"), limits).select("transaction_key", "behavioral_rule_score")


def rule_decisions(spark: SparkSession, folder: str) -> DataFrame:
    table = _by_period(network(spark, folder), RULE_INPUTS + NETWORK_RULE_INPUTS)
    limits = M.rule_thresholds(split(table, "train"))
    return D.rule_decisions(split(table, "test"), X.tx_scored(spark, folder), limits, X.TEST_START)


# --- cases -------------------------------------------------------------------------------------

def high_risk_cases(spark: SparkSession, folder: str) -> DataFrame:
    return K.queue_high_risk(X.tx_scored(spark, folder)).select("transaction_key")


def case_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Features of the cases alone, from the payments of their customers, devices and cards."""
    cases = high_risk_cases(spark, folder)
    payments = K.case_closure(X.tx(spark, folder), cases)
    rows, busy_days = B.volume(payments)
    features = N.network_features(B.with_history(payments, rows=rows, busy_days=busy_days), rows=rows)
    model = M.model_base(features, X.VALIDATION_START, X.TEST_START)
    return round_doubles(K.case_lookup(model, features, cases))


def risk_flags(spark: SparkSession, folder: str) -> DataFrame:
    """The flags through their view, as a reader of the clean table would ask for them."""
    S.publish_view(B.risk_flags(X.tx(spark, folder)), B.RISK_FLAGS_VIEW)
    columns = ", ".join(_flag_columns())
    return spark.sql(f"select {columns} from {B.RISK_FLAGS_VIEW}")


def payment_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """One payment by its key, the case of the highest risk: a bound parameter over a view."""
    case = K.queue_high_risk(X.tx_scored(spark, folder), 1).first()
    S.publish_view(X.tx(spark, folder), "payments")
    return S.select_by_key(spark, "payments", "transaction_key", case.transaction_key if case else None).select(
        "transaction_key", "customer_id", "card_number", "amount", "merchant", "channel", "is_fraud")


def customer_history(spark: SparkSession, folder: str) -> DataFrame:
    return K.customer_history(X.tx(spark, folder), high_risk_cases(spark, folder))


def linked_customers(spark: SparkSession, folder: str) -> DataFrame:
    facts = X.tx(spark, folder)
    return K.linked_customers(N.device_customer_edges(facts), facts, high_risk_cases(spark, folder))


def linked_customers_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same for five cases, from edges that are stored in buckets by device."""
    facts = X.tx(spark, folder)
    path = f"{S.scratch_folder(spark)}/edges"
    name = f"device_customer_edges_{path.split('-')[-1].split('/')[0]}"
    S.write_bucketed(N.device_customer_edges(facts), name, path, "device_fingerprint")
    cases = K.queue_high_risk(X.tx_scored(spark, folder), 5).select("transaction_key")
    edges = S.read_buckets(spark, name, "device_fingerprint", K.case_devices(facts, cases))
    return K.linked_customers(edges, facts, cases)


def linked_cards(spark: SparkSession, folder: str) -> DataFrame:
    facts = X.tx(spark, folder)
    return K.linked_cards(N.device_card_edges(facts), facts, high_risk_cases(spark, folder))


def _on(source: Query, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(source(spark, folder))


def _flag_columns() -> list[str | Column]:
    return ["transaction_key", "unusually_high_amount_flag", "high_risk_merchant_flag", "overnight_transaction_flag",
            "card_not_present_flag", "customer_transaction_number", "previous_customer_transaction_ts",
            "previous_customer_amount"]


QUERIES: dict[str, Query] = {
    # sources, sinks, stages
    "scan_raw_csv": scan_raw_csv,
    "materialize_stage": materialize_stage,
    "stage_quality": stage_quality,
    "sketched_profile": sketched_profile,
    "sketched_devices": sketched_devices,
    "split_tables": split_tables,
    "write_report": write_report,
    "write_scores": write_scores,
    "table_counts": table_counts,
    "raw_quality": _on(with_defects, P.raw_quality),
    "side_table_keys": lambda s, d: P.side_table_keys(X.table(s, d, "lineitem"), "l_orderkey"),
    "match_rate": lambda s, d: P.match_rate(X.table(s, d, "orders"), X.table(s, d, "lineitem"), "o_orderkey", "l_orderkey"),
    # cleaning
    "clean_text": _on(X.tx_raw, lambda t: L.clean_text(t).select("transaction_id", "customer_id", "currency")),
    "clean_casts": _on(X.tx_raw, lambda t: L.clean_casts(t).select(
        "transaction_id", "transaction_ts", "amount", "transaction_hour")),
    "clean_booleans": _on(X.tx_raw, lambda t: L.clean_booleans(t).select("transaction_id", "card_present", "is_fraud")),
    "date_parts": _on(X.tx, lambda t: L.date_parts(t).select(
        "transaction_key", "transaction_date", "derived_hour", "day_of_week")),
    "extract_distance": _on(X.tx_raw, lambda t: L.extract_distance(t).select("transaction_id", "distance_from_home")),
    "discover_keys": _on(X.tx_raw, L.discover_keys),
    "parse_velocity": _on(X.tx_raw, lambda t: L.parse_velocity(t).select(
        "transaction_id", "velocity_num_transactions", "velocity_total_amount")),
    "clean_table": _on(cleaned, lambda t: t.drop("velocity_last_hour", "velocity_unique_merchants",
                                                 "velocity_unique_countries", "velocity_max_single_amount")),
    # reused ids
    "duplicate_id_count": _on(X.tx_reused, U.duplicate_id_count),
    "duplicate_summary": _on(X.tx_reused, U.duplicate_summary),
    "duplicate_conflicts": _on(X.tx_reused, U.duplicate_conflicts),
    "duplicate_samples": _on(X.tx_reused, U.duplicate_samples),
    "duplicate_group_sizes": _on(X.tx_reused, U.duplicate_group_sizes),
    "field_conflicts": _on(X.tx_reused, U.field_conflicts),
    "label_conflicts": _on(X.tx_reused, U.label_conflicts),
    "conflict_examples": _on(X.tx_reused, U.conflict_examples),
    "duplicate_behavior": _on(X.tx_reused, U.duplicate_behavior),
    "dedup_first": _on(X.tx_reused, U.dedup_first),
    "dedup_copies": dedup_copies,
    "unique_keys": _on(X.tx_reused, U.unique_keys),
    "key_validation": _on(X.tx_reused, lambda t: U.key_validation(U.unique_keys(t))),
    "population_summary": _on(X.tx_reused, lambda t: U.population_summary(U.unique_keys(t))),
    # profiles
    "dataset_profile": _on(tx_ids, P.dataset_profile),
    "quality_summary": _on(tx_ids, P.quality_summary),
    "missingness": _on(X.tx_raw, P.missingness),
    "fraud_by_dimension": _on(X.tx, P.fraud_by_dimension),
    "amount_bands": _on(X.tx, P.amount_bands),
    "daily_trend": _on(X.tx, P.daily_trend),
    "fraud_overall": _on(X.tx, P.fraud_overall),
    "fraud_by_category": _on(X.tx, lambda t: P.fraud_by(t, "merchant_category", with_amount=True)),
    "fraud_by_channel": _on(X.tx, lambda t: P.fraud_by(t, "channel")),
    "fraud_by_hour": _on(X.tx, lambda t: P.fraud_by(t, "transaction_hour", by_rate=False)),
    # behaviour
    "velocity_features": _on(X.tx, lambda t: round_doubles(B.velocity_features(t).select(
        "transaction_key", "calculated_txn_count_1h", "calculated_amount_1h", "calculated_txn_count_24h",
        "calculated_amount_24h"))),
    "behavior_features": _on(X.tx, lambda t: round_doubles(B.behavior_features(t))),
    "risk_flags": risk_flags,
    "behavior_summary": _on(behavior, P.behavior_summary),
    "behavior_signals": _on(behavior, P.behavior_signals),
    "audit_signals": _on(behavior, P.audit_signals),
    "velocity_check": _on(behavior, P.velocity_check),
    "velocity_audit": _on(behavior, P.velocity_audit),
    # network
    "network_features": _on(feature_table, round_doubles),
    "network_summary": _on(network_only, P.network_summary),
    "network_signals": _on(network_only, P.network_signals),
    "device_summary": _on(X.tx, N.device_summary),
    "ip_summary": _on(X.tx, N.ip_summary),
    "top_devices": _on(X.tx, N.top_devices),
    "suspicious_devices": _on(X.tx, N.suspicious_devices),
    "device_card_edges": _on(X.tx, N.device_card_edges),
    "device_customer_edges": _on(X.tx, N.device_customer_edges),
    # model table
    "chrono_split": _on(X.tx, lambda t: t.select(
        "transaction_key", M.chrono_split(X.VALIDATION_START, X.TEST_START).alias("data_split"))),
    "model_base": _on(base, round_doubles),
    "split_summary": _on(X.tx, lambda t: M.split_summary(
        t.withColumn("data_split", M.chrono_split(X.VALIDATION_START, X.TEST_START)))),
    "hash_sample": _on(X.tx, lambda t: M.hash_sample(t, 10).select("transaction_key", "transaction_ts", "is_fraud")),
    "sample_summary": _on(X.tx, lambda t: M.sample_summary(M.hash_sample(
        t.filter(F.col("transaction_ts") < M.timestamp(X.VALIDATION_START)), 10))),
    "feature_policy": _on(network, lambda t: M.feature_policy(t.withColumn("log_amount", C.log_amount(F.col("amount"))))),
    "category_domain": _on(X.tx, lambda t: M.category_domain(
        t.filter(F.col("transaction_ts") < M.timestamp(X.VALIDATION_START)),
        t.filter(F.col("transaction_ts") >= M.timestamp(X.TEST_START)), M.CATEGORICAL_FEATURES)),
    "rule_thresholds": lambda s, d: round_doubles(thresholds(s, d)),
    # metrics
    "confusion_metrics": _on(X.tx_scored, Q.confusion_metrics),
    "threshold_sweep": _on(X.tx_scored, Q.threshold_sweep),
    "best_threshold": _on(X.tx_scored, lambda t: Q.best_threshold(Q.threshold_sweep(t))),
    "roc_auc": _on(X.tx_scored, Q.roc_auc),
    "pr_auc": _on(X.tx_scored, Q.pr_auc),
    # decisions
    "score_join": lambda s, d: round_doubles(D.score_join(
        X.tx(s, d).filter(F.col("transaction_ts") >= M.timestamp(X.TEST_START)), X.tx_scored(s, d))),
    "value_baseline": _on(X.tx_scored, D.value_baseline),
    "threshold_economics": _on(X.tx_scored, D.threshold_economics),
    "cheapest_threshold": _on(X.tx_scored, lambda t: D.cheapest_threshold(D.threshold_economics(t))),
    "review_capacity": _on(X.tx_scored, lambda t: D.review_capacity(t, CAPACITIES)),
    "risk_bands": _on(X.tx_scored, D.risk_bands),
    "rule_score": rule_score,
    "rule_decisions": _on(rule_decisions, round_doubles),
    "system_comparison": _on(rule_decisions, D.system_comparison),
    "rule_score_profile": _on(rule_decisions, D.rule_score_profile),
    # monitoring
    "daily_monitoring": _on(X.tx_scored, R.daily_monitoring),
    "psi_numeric": psi_numeric,
    "psi_categorical": psi_categorical,
    "score_drift": score_drift,
    "performance_drift": performance_drift,
    "monitoring_alerts": monitoring_alerts,
    "monitoring_summary": monitoring_summary,
    # models and explanations
    "class_weights": _on(X.tx, lambda t: ml.class_weights(
        t.filter(F.col("transaction_ts") < M.timestamp(X.VALIDATION_START)))),
    "preprocess_numeric": _on(train_sample, ml.numeric_preprocessing),
    "preprocess_categorical": _on(X.tx, lambda t: ml.categorical_levels(
        t.filter(F.col("transaction_ts") < M.timestamp(X.VALIDATION_START)), rare_rows=RARE_ROWS)),
    "train_logistic": train_logistic,
    "train_gbt": train_gbt,
    "train_gbt_facts": train_gbt_facts,
    "model_metadata": model_metadata,
    "model_metadata_facts": model_metadata_facts,
    "score_test_facts": score_test_facts,
    "feature_importance_facts": feature_importance_facts,
    "tree_contributions_facts": tree_contributions_facts,
    "score_test": score_test,
    "model_roundtrip": model_roundtrip,
    "logistic_roundtrip": logistic_roundtrip,
    "feature_importance": feature_importance,
    "tree_contributions": tree_contributions,
    "contributions": contributions_long,
    "global_importance": _on(contributions, E.global_importance),
    "top_drivers": _on(contributions, lambda t: round_doubles(E.top_drivers(t))),
    "case_drivers": _on(contributions, lambda t: round_doubles(
        E.top_drivers(t, 10, E.RAISES, E.LOWERS).drop("base_value"))),
    "case_summary": case_summary,
    # cases
    "case_studies": _on(X.tx_scored, lambda t: round_doubles(K.case_studies(t))),
    "queue_high_risk": _on(X.tx_scored, lambda t: round_doubles(K.queue_high_risk(t))),
    "queue_false_positives": _on(X.tx_scored, lambda t: round_doubles(K.queue_false_positives(t))),
    "queue_false_negatives": _on(X.tx_scored, lambda t: round_doubles(K.queue_false_negatives(t))),
    "random_queue": _on(X.tx_scored, lambda t: round_doubles(K.random_queue(t))),
    "case_decisions": _on(X.tx_scored, lambda t: round_doubles(K.case_decisions(t))),
    "case_lookup": case_lookup,
    "payment_by_key": payment_by_key,
    "customer_history": customer_history,
    "linked_customers": linked_customers,
    "linked_customers_stored": linked_customers_stored,
    "linked_cards": linked_cards,
}

# Results with a day in them show it as ISO text: a plain date has no common form across result readers.
DATED = [
    "write_report", "date_parts", "clean_table", "daily_trend", "behavior_features", "network_features", "model_base",
    "score_join", "daily_monitoring", "psi_numeric", "psi_categorical", "score_drift", "performance_drift",
    "monitoring_alerts",
]


def _with_text_date(query: Query) -> Query:
    return lambda spark, folder: query(spark, folder).withColumn(
        "transaction_date", F.col("transaction_date").cast("string"))


QUERIES |= {key: _with_text_date(QUERIES[key]) for key in DATED}
