"""Rows that used to lose, multiply or stop something: odd keys, busy days, conflicts, NaN, reordered files."""

import pytest
from conftest import rows_of, same_rows

from pyspark.sql import functions as F

from riskloom.operators import behavior as B
from riskloom.operators import decisions as D
from riskloom.operators import duplicates as U
from riskloom.operators import ml
from riskloom.operators import modeling as M
from riskloom.operators import monitoring as R
from riskloom.operators import network as N
from riskloom.plans import queries as Q
from riskloom.sources import fixtures as X
from riskloom.sources import tables as S


@pytest.fixture(scope="module")
def payments(spark, folder):
    return X.tx(spark, folder)


def odd_keys(payments):
    """Every third key NULL, every fifth shared by many rows; the rows stay tell-apart by their source id."""
    number = F.substring("transaction_key", 4, 20).cast("int")
    return payments.withColumn("transaction_key", F.when(number % 3 == 0, None).when(number % 5 == 0, "TX_SAME")
                               .otherwise(F.col("transaction_key")))


def test_odd_keys_lose_and_multiply_nothing(spark, payments):
    odd = odd_keys(payments).drop("transaction_ts").join(
        payments.select("source_transaction_id", F.col("transaction_ts")), "source_transaction_id").select(payments.columns)
    history = ["customer_prior_transactions", "calculated_txn_count_24h", "customer_avg_amount_prior"]
    links = ["prior_device_transactions", "prior_customers_on_device", "prior_card_transactions"]
    # Distinct times leave ties, where the key decides, out of the comparison.
    once = odd.groupBy("transaction_ts").count().filter("count = 1").select("transaction_ts")
    keep = lambda df: df.join(once, "transaction_ts", "left_semi")
    got, want = keep(B.behavior_features(odd)), keep(B.behavior_features(payments))
    assert same_rows(got.select("source_transaction_id", *history), want.select("source_transaction_id", *history))
    got = N.network_features(odd)
    assert got.count() == odd.count() and got.filter(F.col(links[0]).isNull()).isEmpty()
    assert same_rows(keep(got).select("source_transaction_id", *links),
                     keep(N.network_features(payments)).select("source_transaction_id", *links))


@pytest.mark.parametrize("dense", [1, 5])
def test_busy_days_give_the_same_windows(payments, dense):
    made = [f"calculated_{c}_{s}" for c in ("txn_count", "amount") for s in B.HOURS]
    want = B.velocity_features(payments).select("transaction_key", *made)
    assert same_rows(B.velocity_features(payments, dense_rows=dense).select("transaction_key", *made), want)
    assert same_rows(B.with_history(payments, dense_rows=dense).select("transaction_key", *made), want)


def test_copies_go_only_without_conflict(spark):
    copies = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("b", 2, None), ("b", 2, None), (None, 3, "y"), (None, 4, "y")],
                                   "transaction_id string, amount int, note string")
    assert rows_of(U.dedup_first(copies)) == rows_of(copies.distinct())
    conflict = copies.unionByName(spark.createDataFrame([("b", 2, "z")], copies.schema))
    assert rows_of(U.dedup_first(conflict)) == rows_of(conflict)
    assert U.dedup_first(copies.limit(0)).count() == 0


def test_nan_is_missing_on_both_sides_of_drift(spark):
    day = "2024-01-02"
    nan, values = float("nan"), [float(i) for i in range(40)]
    frame = lambda rows: spark.createDataFrame([(day, v) for v in rows], "transaction_date string, amount double")
    want = R.numeric_psi(frame(values), frame(values[10:]), ["amount"])
    got = R.numeric_psi(frame([*values, nan, nan, None]), frame([*values[10:], nan, None]), ["amount"])
    assert same_rows(got, want)
    assert R.numeric_psi(frame([nan, nan]), frame(values), ["amount"]).first()["psi"] is None


def test_daily_ranking_cuts_rows_before_the_exchange(spark):
    rows = spark.range(6000).select(
        F.concat(F.lit("d"), (F.col("id") % 2).cast("string")).alias("transaction_date"),
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("transaction_key"),
        (F.pmod(F.xxhash64("id"), F.lit(997)) / 997).alias("fraud_probability"))
    kept = D.daily_top(rows, 40)
    ranked = sorted(rows.collect(), key=lambda r: (r.transaction_date, -r.fraud_probability, r.transaction_key))
    want = {r.transaction_key for d in ("d0", "d1") for r in [x for x in ranked if x.transaction_date == d][:40]}
    assert {r.transaction_key for r in kept.collect()} == want
    assert "_cut" in kept._jdf.queryExecution().optimizedPlan().toString()


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('b,a,extra\n1,"x, y",z\n2,,z\n')
    got = S.read_raw_csv(spark, str(tmp_path / "a.csv"), ["a", "b"])
    assert [tuple(r) for r in got.collect()] == [("x, y", "1"), (None, "2")]
    with pytest.raises(ValueError):
        S.read_raw_csv(spark, str(tmp_path / "a.csv"), ["a", "c"])
    (tmp_path / "b.csv").write_text('a,b\n"line\nbreak",1\n')
    assert [tuple(r) for r in S.read_raw_csv(spark, str(tmp_path / "b.csv"), ["a", "b"], multi_line=True).collect()] == [("line\nbreak", "1")]
    assert S.malformed_rows(spark, str(tmp_path / "b.csv")) > 0 and S.malformed_rows(spark, str(tmp_path / "b.csv"), True) == 0


def test_wide_categories_pool_by_a_join(spark, folder, monkeypatch):
    base = Q.split(Q.light_base(spark, folder), "train")
    narrow = ml.Preprocessing.fit(base)
    monkeypatch.setattr(ml, "MAX_LEVELS", 3)
    wide = ml.Preprocessing.fit(base)
    assert narrow.wide is None and wide.wide is not None
    names = [f"c_{c}" for c in M.CATEGORICAL_FEATURES]
    keys = ["transaction_key", *names]
    assert rows_of(wide.apply(base).select(*keys)) == rows_of(narrow.apply(base).select(*keys))


def test_boosting_keeps_the_best_prefix_of_a_learnable_label(spark):
    base = Q.light_base(spark, "/root/testdata/sf0.01")
    noise = F.pmod(F.xxhash64("transaction_key"), F.lit(20)) == 0
    rule = (F.col("amount") > 50) != (F.col("transaction_hour") > 12)
    base = base.withColumn("is_fraud", (rule != noise).cast("int")).cache()
    train, validation = Q.split(base, "train"), Q.split(base, "validation")
    model = ml.train_gbt(train, validation, rounds=40)
    losses = ml.validation_losses(model, train, validation)
    assert len(losses) == len(model.stages[-1].treeWeights) <= 40
    assert losses[-1] == min(losses) < losses[0]
    # Storage does not matter: the same rows in other files and another order give the same trees.
    again = ml.train_gbt(train.repartition(7, "amount"), validation.repartition(3), rounds=4)
    once = ml.train_gbt(train, validation, rounds=4)
    assert again.stages[-1].toDebugString.split("\n")[1:] == once.stages[-1].toDebugString.split("\n")[1:]


def test_boosting_goes_on_past_a_round_that_raises_the_loss(spark, monkeypatch):
    value = lambda name: F.pmod(F.xxhash64("id", F.lit(name)), F.lit(1000)) / 1000
    rows = spark.range(1200).select(
        F.col("id").cast("string").alias("transaction_key"), (F.col("id") % 3 == 0).alias("late"),
        *[value(c).alias(c) for c in M.NUMERIC_FEATURES],
        *[F.when(value(c) < 0.5, "a").otherwise("b").alias(c) for c in M.CATEGORICAL_FEATURES],
        (value("n1") < 0.3 + 0.6 * value(M.NUMERIC_FEATURES[0])).cast("int").alias("is_fraud")).cache()
    train, validation = rows.filter("not late"), rows.filter("late")
    fitted = []
    fit = ml.GBTClassifier.fit
    monkeypatch.setattr(ml.GBTClassifier, "fit", lambda self, df: fitted.append(fit(self, df)) or fitted[-1])
    monkeypatch.setattr(ml, "FIRST_ROUNDS", 8)
    model = ml.train_gbt(train, validation, rounds=20, patience=6)
    kept = len(model.stages[-1].treeWeights)
    longest = max(fitted, key=lambda m: len(m.treeWeights))
    curve = ml.validation_losses(ml.PipelineModel([*model.stages[:-1], longest]), train, validation)
    assert kept == curve.index(min(curve)) + 1 and (len(curve) - kept >= 6 or len(curve) == 20)
    assert ml.validation_losses(model, train, validation) == curve[:kept]
    assert any(b > a for a, b in zip(curve, curve[1:kept])), curve
