"""What a task holds and what is exchanged grows no faster than the input; results stay those of the plain form."""

from functools import partial

import pytest
from conftest import rows_of, same_rows

from riskloom.operators import behavior, duplicates, ml, network, skew
from riskloom.plans import queries
from riskloom.sources import fixtures as X

KIND = ("transaction_id string, customer_id long, card_number long, transaction_ts timestamp, merchant string, "
        "amount double, device_fingerprint string, ip_address string, is_fraud int")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("array_rows, per_task", [(10_000, 200_000), (5, 3)])
def test_conflict_scores_exchange_a_row_once(spark, array_rows, per_task):
    nan = float("nan")
    rows = [("a", 1, 1, None, "m", 0.0, "d", "i", 0), ("a", 1, 1, None, "m", -0.0, "d", "i", 0),
            ("b", 1, 2, None, "m", nan, "d", "i", 0), ("b", 1, 2, None, "m", nan, None, "i", 1),
            (None, 1, 1, None, "m", 2.0, "d", "i", 0), (None, 2, 1, None, "m", 3.0, "e", "i", 1),
            ("c", 1, 1, None, "m", 1.0, "d", "i", 0)]
    rows += [("h", k, k % 7, None, f"m{k % 3}", float(k), "d", None, k % 2) for k in range(40)]
    table = spark.createDataFrame(rows, KIND)
    found = duplicates.conflict_examples(table, 3, array_rows, per_task)
    # 40 customers and amounts, 7 cards, 3 merchants, a device, 2 labels; the null id takes a place and finds no rows.
    assert {(r["transaction_id"], r["conflict_score"]) for r in found.collect()} == {("h", 93), ("b", 8)}
    assert found.count() == 42
    every = duplicates.conflict_examples(table, 50, array_rows, per_task)
    assert {r["conflict_score"] for r in every.filter("transaction_id = 'a'").collect()} == {7}
    if array_rows > 40:
        assert "Expand" not in plan_of(found)


def test_customer_windows_are_dealt_by_rows(spark, folder, monkeypatch):
    table = X.tx(spark, folder)
    whole = behavior.behavior_features(table)
    monkeypatch.setattr(behavior, "dealt", partial(skew.dealt, per_task=100))
    parts = behavior.behavior_features(table)
    assert parts.rdd.getNumPartitions() == -(-table.count() // 100)
    assert same_rows(whole, parts)


def test_device_and_card_windows_are_dealt_by_rows(spark, folder, monkeypatch):
    table = X.tx(spark, folder).select(*network.LINK_INPUTS, "is_fraud")
    whole = network.network_features(table)
    monkeypatch.setattr(skew, "dealt", partial(skew.dealt, per_task=100))
    parts = network.network_features(table)
    assert parts.rdd.getNumPartitions() == -(-table.count() // 100)
    assert rows_of(whole) == rows_of(parts)


def test_training_keeps_assembled_features_alone(spark, folder, monkeypatch):
    base = queries.stored_base(spark, folder)
    seen = []
    fit = ml.GBTClassifier.fit
    monkeypatch.setattr(ml.GBTClassifier, "fit", lambda self, df: seen.append(df) or fit(self, df))
    ml.train_gbt(queries.split(base, "train"), queries.split(base, "validation"), 1)
    assert seen[0].columns == ["is_fraud", "class_weight", "held_out", "features"]


def test_contributions_leave_python_as_numbers(spark, folder, tmp_path):
    base = queries.stored_base(spark, folder)
    model = ml.train_gbt(queries.split(base, "train"), queries.split(base, "validation"), 2)
    test = queries.split(base, "test")
    parts = ml.tree_contributions(model, test, f"{tmp_path}/model", ["transaction_key", "amount"])
    assert "MapInArrow" in plan_of(parts)
    found = parts.collect()
    assert len(found) == test.count() > 0
    for row in found[:50]:
        assert [e["feature"] for e in row["contributions"]] == [*ml.NUMERIC_FEATURES, *ml.CATEGORICAL_FEATURES]
        assert row["contributions"][0]["value"] == row["amount"]
