"""Scalar rules on literal values."""

import pytest
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators import cleaning


def evaluate(spark, column, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v")).alias("x")).collect()]


@pytest.mark.parametrize("column, values, want, kind", [
    (C.blank_to_null, ["  a ", "   ", None, "\t"], ["a", None, None, "\t"], "string"),
    (C.parse_boolean, [" Yes", "0", "maybe", None], [True, False, None, None], "string"),
    (C.parse_label, ["TRUE", "n", "None"], [1, 0, None], "string"),
    (C.parse_integer, ["7", "1.7", "x", None, "99999999999"], [7, 2, None, None, None], "string"),
    (C.first_number, ["about -12.5 km", "none", "3 and 4", None], [-12.5, None, 3.0, None], "string"),
    (C.is_blank_like, [" NaN ", "", None, "n/a", "0"], [True, True, True, True, False], "string"),
    (C.column_name, [" Num Transactions! ", "a--b"], ["num_transactions", "a_b"], "string"),
    (C.amount_band, [9.99, 10.0, 2499.0, 2500.0], ["01_under_10", "02_10_25", "08_1000_2500", "09_2500_plus"], "double"),
    (C.risk_band, [0.29, 0.30, 0.60, 0.80], ["Low", "Medium", "High", "Critical"], "double"),
    (C.action, [0.1, 0.5, 0.74, 0.75], ["Approve", "Monitor", "Manual review", "Escalate for review"], "double"),
    (C.drift_status, [None, 0.05, 0.1, 0.25], ["Unavailable", "Stable", "Moderate Drift", "High Drift"], "double"),
    (C.risk_score, [0.025, 0.035, 0.126], [2, 4, 13], "double"),
    (C.mask_card, ["1234", "123456", None], ["1234", C.CARD_MASK + "3456", None], "string"),
    (C.log_amount, [0.0, None, -1.0], [0.0, None, None], "double"),
    (lambda v: C.rounded(v, 2), [1.005, 0.285, 2.675, -1.115], [1.0, 0.28, 2.68, -1.12], "double"),
    (lambda v: C.flag(v > 1), [2.0, 1.0, None], [1, 0, 0], "double"),
])
def test_column(spark, column, values, want, kind):
    assert evaluate(spark, column, values, kind) == want


def test_confusion_label(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.75), (1, 0.74), (0, 0.1)], "y int, p double")
    got = [r[0] for r in df.select(C.confusion_label(F.col("y"), F.col("p"))).collect()]
    assert got == ["True Positive", "False Positive", "False Negative", "True Negative"]


def test_dictionary_accepts_json_and_python_literals(spark):
    texts = ['{"a": 1, "b": 2.5}', "{'a': True, 'b': None}", "nothing", None]
    got = evaluate(spark, cleaning.dictionary, texts)
    assert got[0] == {"a": "1", "b": "2.5"}
    assert got[1]["a"] == "true" and got[1]["b"] is None
    assert got[3] is None


def test_key_discovery_reads_every_row(spark):
    df = spark.createDataFrame([("{'a': 1}",)] * 50 + [("{'Rare Key': 'x'}",)], "velocity_last_hour string")
    got = {r["source_key"]: (r["column_name"], r["sample_type"]) for r in cleaning.discover_keys(df).collect()}
    assert got == {"a": ("velocity_a", "int"), "Rare Key": ("velocity_rare_key", "str")}
