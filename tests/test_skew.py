"""The chunked way for heavy entities gives the same history as plain windows."""

import datetime as dt
import random

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from riskloom.operators import behavior, decisions, duplicates, metrics, network, ordered
from riskloom.operators.skew import CHUNK, chunk_rows, running, split_heavy
from riskloom.sources import fixtures as X

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def payments(spark):
    """One customer and one device hold most rows; ties, NULL keys, NULL amounts and NULL times occur."""
    rng = random.Random(7)
    rows = []
    for i in range(1200):
        hot = rng.random() < 0.6
        # Whole minutes and exact hours make ties and range ends that fall on a payment.
        ts = None if rng.random() < 0.02 else START + dt.timedelta(minutes=rng.choice([60, 30, 1]) * rng.randrange(60))
        rows.append((
            f"K{i:05d}", "hot" if hot else rng.choice(["a", "b", "c", None]), f"C{rng.randrange(5)}",
            ts, f"M{rng.randrange(4)}", None if rng.random() < 0.05 else round(rng.random() * 100, 2),
            rng.choice(["D1", "D1", "D1", "D2", None]), f"10.{rng.randrange(6)}", rng.randrange(24),
            rng.random() < 0.5, rng.random() < 0.5, int(rng.random() < 0.2),
        ))
    schema = ("transaction_key string, customer_id string, card_number string, transaction_ts timestamp_ntz, "
              "merchant string, amount double, device_fingerprint string, ip_address string, transaction_hour int, "
              "card_present boolean, high_risk_merchant boolean, is_fraud int")
    return spark.createDataFrame(rows, schema).repartition(4).cache()


def test_split_finds_only_heavy_keys(payments):
    light, heavy = split_heavy(payments, ["customer_id"], 300)
    assert [r[0] for r in heavy.select("customer_id").distinct().collect()] == ["hot"]
    assert light.count() + heavy.count() == payments.count()
    assert split_heavy(payments, ["customer_id"], 10_000)[1] is None


def test_null_key_can_be_heavy(payments):
    _, heavy = split_heavy(payments, ["customer_id"], 50)
    assert None in {r[0] for r in heavy.select("customer_id").distinct().collect()}


def test_a_heavy_entity_spreads_over_chunks(payments):
    _, heavy = split_heavy(payments, ["customer_id"], 300)
    sizes = [r["n"] for r in chunk_rows(heavy, ["customer_id"], behavior.EVENT_ORDER, 100)
             .groupBy(CHUNK).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 5 and max(sizes) < 200


def test_running_kinds(payments):
    spec = {
        "n": ("count", None), "s": ("sum", "amount"), "m": ("mean", "amount"), "d": ("std", "amount"),
        "l": ("lag", "amount"), "w": ("whole_mean", "amount"), "c": ("whole_count", None),
    }
    keys, order = ["customer_id"], behavior.EVENT_ORDER
    direct = running(payments, keys, order, spec)
    chunked = running(chunk_rows(payments, keys, order, 60), keys, order, spec, CHUNK)
    columns = ["transaction_key", *spec]
    assert same_rows(direct, chunked, columns)


@pytest.mark.parametrize("limit", [40, 300])
def test_behavior_features(payments, limit):
    assert same_rows(behavior.behavior_features(payments), behavior.behavior_features(payments, limit))


def test_velocity_features(payments):
    names = ["transaction_key", "calculated_txn_count_1h", "calculated_amount_1h", "calculated_txn_count_24h",
             "calculated_amount_24h"]
    assert same_rows(behavior.velocity_features(payments),
                     behavior.velocity_features(payments, 40, bucket_seconds=600), names)


def test_network_features(payments):
    assert same_rows(network.network_features(payments), network.network_features(payments, 100))


def test_risk_flags(payments):
    assert same_rows(behavior.risk_flags(payments), behavior.risk_flags(payments, 40))


def test_unique_keys_with_a_large_group_of_copies(spark, folder):
    reused = X.tx_reused(spark, folder)
    copies = reused.limit(1).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(400)))).drop("copy")
    table = reused.unionByName(copies)
    direct, chunked = duplicates.unique_keys(table), duplicates.unique_keys(table, 50)
    assert same_rows(direct, chunked)
    assert chunked.select("transaction_key").distinct().count() == table.count()


def test_running_totals_in_ranges(spark, folder):
    counts = X.tx(spark, folder).groupBy("channel", "amount").agg(F.count("*").alias("n"))
    one = ordered.running_totals(counts, ["channel"], "amount", ["n"], 10)
    many = ordered.running_totals(counts, ["channel"], "amount", ["n"], 1000, max_rows=50)
    assert same_rows(one, many)


def test_running_totals_of_many_levels(spark):
    """More ranges than one task may hold: their totals are running totals themselves; NULL groups are groups."""
    rows = spark.range(600).select(F.when(F.col("id") % 4 > 0, F.col("id") % 2).alias("g"), (F.col("id") * 7).alias("v"),
                                   (F.col("id") % 5).alias("n"))
    for groups in (["g"], []):
        one = ordered.running_totals(rows, groups, "v", ["n"], 10)
        assert same_rows(one, ordered.running_totals(rows, groups, "v", ["n"], 600, max_rows=12))


def test_quantiles_and_areas_in_ranges(spark, folder):
    tx, scored = X.tx(spark, folder), X.tx_scored(spark, folder)
    columns, points = ["amount", "distance_from_home", "transaction_hour"], [0.0, 0.05, 0.3, 0.5, 0.95, 1.0]
    assert same_rows(ordered.exact_quantiles(tx, columns, points),
                     ordered.exact_quantiles(tx, columns, points, max_rows=200))
    for area in (metrics.roc_auc, metrics.pr_auc):
        assert same_rows(area(scored), area(scored, max_rows=20))


def test_exact_quantiles_are_the_interpolated_ones(spark, folder):
    tx = X.tx(spark, folder)
    want = tx.agg(F.percentile("amount", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.95)))).first()[0]
    got = {r["probability"]: r["value"] for r in ordered.exact_quantiles(tx, ["amount"], [0.1, 0.5, 0.95]).collect()}
    assert [got[p] for p in (0.1, 0.5, 0.95)] == pytest.approx(want, abs=1e-9)


def test_daily_top_is_the_plain_rank(spark, folder):
    from pyspark.sql import Window

    scored = X.tx_scored(spark, folder)
    window = Window.partitionBy("transaction_date").orderBy(F.desc("fraud_probability"), "transaction_key")
    plain = scored.withColumn("risk_rank", F.row_number().over(window)).filter("risk_rank <= 7")
    assert same_rows(decisions.daily_top(scored, 7), plain)
