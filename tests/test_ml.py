"""Model work: preprocessing, training, persistence, and additive explanations."""

from itertools import permutations

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from riskloom.operators import explain, ml, modeling, saved
from riskloom.plans import queries
from riskloom.sources import tables


@pytest.fixture(scope="module")
def base(spark, folder):
    return queries.stored_base(spark, folder).cache()


@pytest.fixture(scope="module")
def boosted(base):
    return ml.train_gbt(queries.split(base, "train"), queries.split(base, "validation"), 4)


def test_scaled_features_have_unit_population_deviation(base):
    train = queries.split(base, "train")
    ready = ml.Preprocessing.fit(train).apply(train)
    for name in ("amount", "minutes_since_previous_transaction", "customer_std_amount_prior"):
        mean, scale = ready.agg(F.avg(f"n_{name}"), F.stddev_pop(f"n_{name}")).first()
        assert mean == pytest.approx(0, abs=1e-4) and scale == pytest.approx(1, abs=1e-4)


def test_rare_levels_pool_and_unseen_levels_encode_to_zeros(base):
    train, test = queries.split(base, "train"), queries.split(base, "test")
    preparation, model = ml.train_logistic(train, 5)
    assert any(level["rare"] for level in preparation.levels.values())
    odd = test.limit(1).withColumn("channel", F.lit("never seen"))
    encoded = model.transform(preparation.apply(odd)).select("v_c_channel").first()[0]
    assert encoded.numNonzeros() == 0


def test_class_weights_balance(base):
    got = {r["is_fraud"]: r for r in ml.class_weights(base).collect()}
    assert got[0]["transactions"] * got[0]["class_weight"] == pytest.approx(got[1]["transactions"] * got[1]["class_weight"], rel=1e-6)


def test_scores_are_probabilities(base, boosted):
    low, high, rows = ml.score_gbt(boosted, base).agg(
        F.min("fraud_probability"), F.max("fraud_probability"), F.count("fraud_probability")).first()
    assert 0 <= low <= high <= 1 and rows == base.count()


def test_contributions_and_base_give_the_log_odds(spark, base, boosted):
    scored = ml.score_gbt(boosted, queries.split(base, "test"))
    parts = ml.tree_contributions(boosted, scored, tables.scratch_folder(spark), ["transaction_key", "fraud_probability"])
    total = F.aggregate("contributions", F.lit(0.0), lambda a, e: a + e["contribution"]) + F.col("base_value")
    odds = F.ln(F.col("fraud_probability") / (1 - F.col("fraud_probability")))
    assert parts.agg(F.max(F.abs(total - odds))).first()[0] < 1e-9


def test_leaf_contributions_are_shapley_values():
    rules = [
        (2.0, [0, 1, 2], [[("le", 0.5, True)], [("in", [1.0, 2.0], False)], [("le", 3.0, True), ("le", 1.0, False)]],
         [0.25, 0.6, 0.3]),
        (-1.0, [1], [[("le", 1.5, True)]], [0.4]),
    ]
    x = np.array([[0.2, 3.0, 2.0], [0.9, 1.0, 2.0], [0.1, 0.0, 9.0]])

    def value(row, known):
        total = 0.0
        for leaf, features, tests, shares in rules:
            product = leaf
            for f, t, s in zip(features, tests, shares):
                product *= ml._passes(x[row:row + 1, f], t)[0] if f in known else s
            total += product
        return total

    got, base = ml.leaf_contributions(x, rules)
    assert base == pytest.approx(value(0, set()))
    for row in range(3):
        want = np.zeros(3)
        for order in permutations(range(3)):
            for i, f in enumerate(order):
                want[f] += (value(row, set(order[:i + 1])) - value(row, set(order[:i]))) / 6
        assert got[row] == pytest.approx(want)


def test_many_features_in_a_leaf_give_shapley_values():
    """A leaf of six features: points enough for the polynomial, and runs of zeros and ones in the tests."""
    r = np.random.default_rng(4)
    shares = [float(x) for x in r.uniform(0.05, 0.95, 6)]
    rules = [(1.5, list(range(6)), [[("le", 0.5, True)]] * 6, shares)]
    x = r.uniform(0, 1, (8, 6))
    got, base = ml.leaf_contributions(x, rules)
    for row in range(8):
        held = [float(v <= 0.5) for v in x[row]]
        want = np.zeros(6)
        for order in permutations(range(6)):
            terms = list(shares)
            for f in order:
                before, terms[f] = np.prod(terms), held[f]
                want[f] += 1.5 * (np.prod(terms) - before) / 720
        assert got[row] == pytest.approx(want)
        assert got[row].sum() + base == pytest.approx(1.5 * np.prod(held))


@pytest.mark.parametrize("levels", [10_000, 3])
def test_logistic_model_is_saved_with_its_preprocessing(spark, base, tmp_path, monkeypatch, levels):
    monkeypatch.setattr(ml, "MAX_LEVELS", levels)
    train, test = queries.split(base, "train"), queries.split(base, "test")
    model = saved.logistic_pipeline(train, 5)
    assert (model.stages[0].fitted.wide is None) == (levels > 3)
    model.write().save(f"{tmp_path}/model")
    again = saved.load(spark, f"{tmp_path}/model")
    names = ["transaction_key", "fraud_probability"]
    assert rows_of(saved.score(model, test).select(*names)) == rows_of(saved.score(again, test).select(*names))
    assert saved.PreprocessingEstimator().fit(train).fitted.numeric == again.stages[0].fitted.numeric


def test_split_counts_match_the_trees(spark, base, boosted):
    report = ml.feature_importance(boosted, tables.scratch_folder(spark), base)
    splits = sum((t.numNodes - 1) // 2 for t in boosted.stages[-1].trees)
    assert report.agg(F.sum("split_count")).first()[0] == splits
    assert report.agg(F.sum("gain_importance")).first()[0] == pytest.approx(1)


def test_linear_contributions_sum_to_the_score(spark):
    rows = spark.createDataFrame([("a", 3.0, 1.0), ("b", None, 5.0)], "transaction_key string, x double, y double")
    reference = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "x double, y double")
    parts = explain.linear_contributions(rows, {"x": 2.0, "y": -1.0}, reference, 0.5)
    got = {r["transaction_key"]: (r["base_value"], [e["contribution"] for e in r["contributions"]]) for r in parts.collect()}
    assert got["a"] == (1.5, [2.0, 2.0]) and sum(got["a"][1]) + got["a"][0] == 0.5 + 2 * 3 - 1
    assert got["b"][1] == [0.0, -2.0]


def test_top_drivers_rank_by_size(spark):
    rows = spark.createDataFrame([("a", 3.0, 1.0)], "transaction_key string, amount double, other double")
    reference = spark.createDataFrame([(0.0, 0.0)], "amount double, other double")
    drivers = explain.top_drivers(explain.linear_contributions(rows, {"amount": 1.0, "other": -9.0}, reference)).collect()
    assert [(d["driver_rank"], d["friendly_name"], d["direction"]) for d in drivers] == [
        (1, "other", explain.LOWER), (2, "Transaction amount", explain.HIGHER)]


def test_model_inputs_exclude_shortcuts():
    used = set(modeling.NUMERIC_FEATURES + modeling.CATEGORICAL_FEATURES)
    assert not used & set(modeling.NETWORK_FEATURES)
