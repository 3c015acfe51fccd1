"""Invariants of the reports, and edge cases the driver tables do not hold."""

import math

import numpy as np
import pytest
from conftest import rows_of, same_rows
from pyspark.sql import functions as F

from riskloom.operators import behavior, cases, decisions, duplicates, metrics, modeling, monitoring, network, profiles, sketches
from riskloom.sources import fixtures as X
from riskloom.sources import tables


def test_confusion_counts_cover_all_rows(spark, folder):
    scored = X.tx_scored(spark, folder)
    rows = scored.count()
    for r in metrics.threshold_sweep(scored).collect():
        assert r.true_positives + r.false_positives + r.false_negatives + r.true_negatives == rows
    assert sum(r["transactions"] for r in decisions.risk_bands(scored).collect()) == rows
    assert metrics.threshold_sweep(scored).count() == 17
    assert decisions.threshold_economics(scored).count() == 18


def test_capacity_beyond_all_rows_catches_everything(spark, folder):
    scored = X.tx_scored(spark, folder)
    best = decisions.review_capacity(scored, [3, 10_000]).collect()[-1]
    assert best["total_reviews"] == scored.count()
    assert best["fraud_recall_pct"] == 100.0 and best["fraud_value_capture_pct"] == pytest.approx(100.0, abs=1e-4)


def test_ranking_metrics_against_brute_force(spark):
    rng = np.random.default_rng(3)
    score, label = rng.integers(0, 8, 60) / 8, rng.integers(0, 2, 60)
    df = spark.createDataFrame([(float(s), int(y)) for s, y in zip(score, label)], "fraud_probability double, is_fraud int")
    pos, neg = score[label == 1], score[label == 0]
    auc = np.mean([[1.0 if p > n else 0.5 if p == n else 0.0 for n in neg] for p in pos])
    assert metrics.roc_auc(df).first()[0] == pytest.approx(auc, abs=1e-9)
    area, seen = 0.0, 0.0
    for cut in sorted(set(score), reverse=True):
        above = score >= cut
        recall = (label[above] == 1).sum() / (label == 1).sum()
        area += (recall - seen) * (label[above] == 1).mean()
        seen = recall
    assert metrics.pr_auc(df).first()[0] == pytest.approx(area, abs=1e-9)


def numpy_psi(reference, current, bins=10):
    edges = np.unique(np.quantile(reference, np.linspace(0, 1, bins + 1)))
    if len(edges) < 3:
        return 0.0
    edges[0], edges[-1] = -np.inf, np.inf
    shares = [np.histogram(v, edges)[0] / len(v) for v in (reference, current)]
    ref, cur = [np.where(s == 0, 1e-6, s) for s in shares]
    return float(np.sum((cur - ref) * np.log(cur / ref)))


def psi_frames(spark, reference, current):
    day = F.lit("2024-01-01").cast("date")
    make = lambda v: spark.createDataFrame([(x,) for x in v], "x double")
    return make(reference), make(current).withColumn("transaction_date", day)


def test_numeric_psi_against_numpy(spark):
    rng = np.random.default_rng(5)
    reference = [float(x) for x in np.round(rng.gamma(2, 10, 400), 1)]
    current = [float(x) for x in np.round(rng.gamma(2, 14, 90), 1)]
    got = monitoring.numeric_psi(*psi_frames(spark, reference, current), ["x"]).first()
    assert got["psi"] == pytest.approx(numpy_psi(reference, current), abs=1e-8)
    assert got["current_mean"] == pytest.approx(np.mean(current), abs=1e-6)


def test_numeric_psi_edge_cases(spark):
    same = monitoring.numeric_psi(*psi_frames(spark, [1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0, 4.0]), ["x"]).first()
    constant = monitoring.numeric_psi(*psi_frames(spark, [2.0] * 5, [1.0, 3.0]), ["x"]).first()
    empty = monitoring.numeric_psi(*psi_frames(spark, [1.0, 2.0, 3.0], [None, None]), ["x"]).first()
    assert same["psi"] == 0.0 and constant["psi"] == 0.0
    for reference in ([0.0, 1.0, 0.0], [0.0] * 7 + [1.0] * 4, [0.0] * 19 + [1.0]):
        got = monitoring.numeric_psi(*psi_frames(spark, reference, [1.0, 1.0, 0.0]), ["x"]).first()["psi"]
        assert got == pytest.approx(numpy_psi(reference, [1.0, 1.0, 0.0]), abs=1e-8)
    assert empty["psi"] is None and empty["status"] == "Unavailable"


def test_categorical_psi_counts_missing_and_new_categories(spark):
    schema = "c string"
    reference = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [(None,)], schema)
    current = spark.createDataFrame([("a",)] * 4 + [("n",)] * 4, schema).withColumn(
        "transaction_date", F.lit("2024-01-01").cast("date"))
    floor = 1e-6
    want = sum((c - r) * math.log(c / r) for c, r in [(0.5, 0.6), (floor, 0.3), (floor, 0.1), (0.5, floor)])
    assert monitoring.categorical_psi(reference, current, ["c"]).first()["psi"] == pytest.approx(want, abs=1e-8)


def test_unknown_performance_counts_as_stable(spark, folder):
    scored = X.tx_scored(spark, folder).filter("fraud_probability < 0.75")
    daily = monitoring.daily_monitoring(scored)
    report = monitoring.performance_drift(daily, X.tx_scored(spark, folder))
    assert daily.filter("precision is null").count() == daily.count()
    assert report.filter("precision_change_pp is not null").count() == 0


def test_row_identity_tells_nulls_apart(spark):
    df = spark.createDataFrame(
        [("a", None, "x"), ("a", "x", None), ("b", None, None), ("b", None, None)], "transaction_id string, p string, q string")
    got = duplicates.duplicate_conflicts(df).first()
    assert (got["exact_duplicate_ids"], got["conflicting_duplicate_ids"]) == (1, 1)


def test_match_rate_counts_partners(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "a int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "b int")
    got = profiles.match_rate(left, right, "a", "b").first()
    joined = left.join(right, F.col("a") == F.col("b"), "left")
    assert got["joined_rows"] == joined.count() == 6
    assert got["identity_match_rate"] == pytest.approx(4 / 6, abs=1e-8)


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 5.0)], "x double, y double")
    assert df.agg(profiles.correlation(F.col("x"), F.col("y"))).first()[0] is None


def test_no_excluded_or_benchmark_feature_reaches_the_model():
    model = set(modeling.MODEL_FEATURES)
    assert len(model) == 28 and len(modeling.BENCHMARK_FEATURES) == 11 and len(modeling.EXCLUDED_FEATURES) == 5
    assert not model & set(modeling.BENCHMARK_FEATURES + modeling.EXCLUDED_FEATURES)


def test_hash_sample_is_stable_and_about_one_in_n(spark, folder):
    tx = X.tx(spark, folder)
    sample = modeling.hash_sample(tx, 5)
    assert rows_of(sample) == rows_of(modeling.hash_sample(tx.repartition(7), 5))
    assert 120 < sample.count() < 280


def test_case_studies_have_at_most_five_per_type(spark, folder):
    counts = cases.case_studies(X.tx_scored(spark, folder)).groupBy("case_type").count().collect()
    assert len(counts) == 4 and all(r["count"] <= 5 for r in counts)


def test_stage_partitions_are_pruned(spark, folder, tmp_path):
    tx = X.tx(spark, folder).withColumn("data_split", modeling.chrono_split(X.VALIDATION_START, X.TEST_START))
    assert tables.write_stage(tx, str(tmp_path), "modeling", "splits", ["data_split"])["rows"] == tx.count()
    test = tables.read_stage(spark, str(tmp_path), "modeling", "splits").filter("data_split = 'test'")
    assert test.count() == X.tx_scored(spark, folder).count()
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_split" in plan
    with pytest.raises(ValueError):
        tables.stage_path(str(tmp_path), "other", "x")


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    root, three = str(tmp_path), spark.range(3)
    with pytest.raises(FileNotFoundError):
        tables.read_stage(spark, root, "staging", "ids")
    assert tables.write_stage(three, root, "staging", "ids", measures={"most": F.max("id")}) == {"rows": 3, "most": 2}
    opened = tables.read_stage(spark, root, "staging", "ids")
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 77, F.raise_error("lost")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        tables.write_stage(broken, root, "staging", "ids")
    assert rows_of(tables.read_stage(spark, root, "staging", "ids")) == rows_of(three)
    # A table may be rewritten from itself, and who has opened it reads on.
    tables.write_stage(tables.read_stage(spark, root, "staging", "ids").filter("id > 0"), root, "staging", "ids")
    assert rows_of(tables.read_stage(spark, root, "staging", "ids")) == [(1,), (2,)] and opened.count() == 3
    for n in (7, 8):
        tables.write_stage(spark.range(n), root, "staging", "ids")
    versions = [x for x in (tmp_path / "staging" / "ids").iterdir() if x.name.startswith("version-")]
    assert tables.read_stage(spark, root, "staging", "ids").count() == 8 and len(versions) == 2


def test_keys_are_bound_not_pasted(spark):
    tables.publish_view(spark.createDataFrame([("a", 1), ("b' or '1' = '1", 2)], "k string, n int"), "keyed")
    assert [r.n for r in tables.select_by_key(spark, "keyed", "k", "b' or '1' = '1").collect()] == [2]
    assert tables.select_by_key(spark, "keyed", "k", None).count() == 0
    with pytest.raises(ValueError):
        tables.select_by_key(spark, "keyed", "k = 'a' or k", "a")


def test_a_case_needs_only_the_payments_of_its_entities(spark, folder):
    payments = X.tx(spark, folder).withColumn(
        "device_fingerprint", F.when(F.col("device_fingerprint") != "D7", F.col("device_fingerprint")))
    few = payments.filter("transaction_key in ('TX_3', 'TX_500', 'TX_900')").select("transaction_key")
    odd = payments.filter(F.col("device_fingerprint").isNull()).select("transaction_key").limit(1)
    chosen = few.unionByName(odd)
    closure = cases.case_closure(payments, chosen)
    assert closure.count() < payments.count() and closure.columns == payments.columns
    whole, part = (network.network_features(behavior.behavior_features(t)).join(chosen, "transaction_key", "left_semi")
                   for t in (payments, closure))
    assert same_rows(whole, part) and part.count() >= 3
    assert cases.case_closure(payments, chosen.limit(0)).count() == 0


def test_sketches_of_days_merge_to_those_of_all_rows(spark):
    """Estimates stay within the promised error, whatever days are merged, and few values are counted exactly."""
    rows = spark.range(60_000).select(
        F.expr("date'2024-01-01' + cast(id % 9 as int)").alias("transaction_date"), (F.col("id") % 23_000).alias("a"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("b"), (F.col("id") % 400).alias("device"))
    counted = {"a": "a", "b": "b"}
    days = sketches.daily_sketches(rows, counted)
    assert days.count() == 9
    for start, end in ((None, None), ("2024-01-03", "2024-01-05"), ("2024-01-09", None)):
        part = rows.filter(f"transaction_date >= '{start or '2000-01-01'}' and transaction_date < '{end or '2100-01-01'}'")
        merged = sketches.merged_sketches(days, ["a", "b"], start=start, end=end)
        found = {r.measure: r for r in sketches.against_exact(part, merged, counted).collect()}
        assert found["a"].within == found["b"].within == 1 and found["b"].exact_count == 7
        assert merged.first().rows == part.count()
    by_device = sketches.daily_sketches(rows, counted, ["device"])
    shared = sketches.shared_entities(by_device, "device", ["a", "b"]).first()
    exact = rows.groupBy("device").agg(F.count_distinct("b").alias("b")).filter("b > 1").count()
    assert (shared.entities, shared.reused, shared.shared_by_b) == (400, 400, exact)
    nothing = sketches.merged_sketches(sketches.daily_sketches(rows.limit(0), counted), ["a", "b"])
    assert [r.exact_count for r in sketches.against_exact(rows.limit(0), nothing, counted).collect()] == [0, 0]
    assert 0.06 < sketches.relative_error(12) < 0.07


def test_a_lookup_opens_its_buckets_and_exchanges_no_edges(spark, folder, tmp_path):
    facts = X.tx(spark, folder)
    edges = network.device_customer_edges(facts)
    tables.write_bucketed(edges, "edges_for_test", f"{tmp_path}/edges", "device_fingerprint", 16)
    some = [r[0] for r in facts.select("device_fingerprint").distinct().limit(1).collect()]
    found = tables.read_buckets(spark, "edges_for_test", "device_fingerprint", some)
    assert rows_of(found) == rows_of(edges.filter(F.col("device_fingerprint") == some[0]))
    plan = found.groupBy("device_fingerprint").count()._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 1 out of 16" in plan and "Exchange" not in plan
    assert tables.read_buckets(spark, "edges_for_test", "device_fingerprint", [*some, None]).count() == found.count()
    chosen = facts.select("transaction_key").limit(3)
    assert None not in cases.case_devices(facts, chosen) and len(cases.case_devices(facts, chosen)) <= 3
    with pytest.raises(ValueError):
        cases.case_devices(facts, facts.select("transaction_key"), 2)
    spark.sql("DROP TABLE edges_for_test")


def test_report_is_one_file(spark, folder, tmp_path):
    path = tmp_path / "report"
    tables.write_report(profiles.daily_trend(X.tx(spark, folder)), str(path))
    assert len(list(path.glob("*.csv"))) == 1


def test_namespaces_can_be_created_twice(spark):
    tables.create_namespaces(spark, ["modeling"])
    tables.create_namespaces(spark, ["modeling"])
    assert spark.catalog.databaseExists("modeling")
    spark.sql("DROP DATABASE modeling")
