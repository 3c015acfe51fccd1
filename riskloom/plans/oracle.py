"""The same results as plain SQL over the driver tables, for an independent engine."""

from __future__ import annotations

from riskloom.sources import fixtures as X

# Fixed values, stated here again on purpose: a wrong one in an operator must not pass unseen.
BEHAVIOR_FIELDS = {'transaction_ts': 'timestamp',
 'customer_id': 'customer',
 'card_number': 'card',
 'amount': 'amount',
 'merchant': 'merchant',
 'is_fraud': 'fraud_label'}
CONFLICT_FIELDS = {'customer_id': 'customer',
 'card_number': 'card',
 'transaction_ts': 'timestamp',
 'merchant': 'merchant',
 'amount': 'amount',
 'currency': 'currency',
 'country': 'country',
 'city': 'city',
 'card_type': 'card_type',
 'device': 'device',
 'channel': 'channel',
 'device_fingerprint': 'device_fingerprint',
 'ip_address': 'ip',
 'high_risk_merchant': 'high_risk',
 'is_fraud': 'fraud_label'}
SCORED_FIELDS = ['customer_id', 'card_number', 'transaction_ts', 'merchant', 'amount', 'device_fingerprint', 'ip_address', 'is_fraud']
ECONOMIC_THRESHOLDS = [0.1, 0.15000000000000002, 0.20000000000000004, 0.25000000000000006, 0.30000000000000004, 0.3500000000000001,
 0.40000000000000013, 0.45000000000000007, 0.5000000000000001, 0.5500000000000002, 0.6000000000000002,
 0.6500000000000001, 0.7000000000000002, 0.7500000000000002, 0.8000000000000002, 0.8500000000000002,
 0.9000000000000002, 0.9500000000000003]
SWEEP_THRESHOLDS = [0.1, 0.15000000000000002, 0.20000000000000004, 0.25000000000000006, 0.30000000000000004, 0.3500000000000001,
 0.40000000000000013, 0.45000000000000007, 0.5000000000000001, 0.5500000000000002, 0.6000000000000002,
 0.6500000000000001, 0.7000000000000002, 0.7500000000000002, 0.8000000000000002, 0.8500000000000002,
 0.9000000000000002]
NUMERIC_FEATURES = ['amount', 'log_amount', 'distance_from_home', 'transaction_hour', 'weekend_transaction', 'card_present',
 'customer_prior_transactions', 'minutes_since_previous_transaction', 'previous_customer_amount',
 'customer_avg_amount_prior', 'customer_std_amount_prior', 'amount_vs_customer_average',
 'amount_zscore_vs_customer_history', 'calculated_txn_count_1h', 'calculated_amount_1h', 'calculated_txn_count_24h',
 'calculated_amount_24h', 'new_merchant_for_customer_flag', 'overnight_transaction_flag']
CATEGORICAL_FEATURES = ['merchant_category', 'merchant_type', 'merchant', 'currency', 'country', 'city_size', 'card_type', 'device',
 'channel']
NETWORK_FEATURES = ['prior_device_transactions', 'prior_card_transactions', 'prior_customers_on_device', 'prior_cards_on_device',
 'prior_devices_on_card', 'prior_merchants_on_device', 'new_device_for_customer_flag',
 'device_changed_from_previous_flag', 'new_customer_on_existing_device_flag', 'new_card_on_existing_device_flag',
 'device_shared_by_multiple_customers_flag', 'device_shared_by_multiple_cards_flag',
 'card_used_across_multiple_devices_flag']
BENCHMARK_FEATURES = ['prior_customers_on_device', 'prior_cards_on_device', 'prior_devices_on_card', 'prior_merchants_on_device',
 'new_device_for_customer_flag', 'device_changed_from_previous_flag', 'new_customer_on_existing_device_flag',
 'new_card_on_existing_device_flag', 'device_shared_by_multiple_customers_flag',
 'device_shared_by_multiple_cards_flag', 'card_used_across_multiple_devices_flag']
EXCLUDED_FEATURES = ['customer_id', 'card_number', 'device_fingerprint', 'ip_address', 'velocity_last_hour']
BEHAVIOR_SIGNALS = {'new_device': 'new_device_for_customer_flag',
 'new_ip': 'new_ip_for_customer_flag',
 'new_merchant': 'new_merchant_for_customer_flag',
 'device_changed': 'device_changed_from_previous_flag'}
DIMENSIONS = ['merchant_category', 'merchant_type', 'currency', 'country', 'city_size', 'card_type', 'card_present', 'device',
 'channel', 'high_risk_merchant', 'transaction_hour', 'weekend_transaction']
NETWORK_SIGNALS = {'new_customer_existing_device': 'new_customer_on_existing_device_flag',
 'new_card_existing_device': 'new_card_on_existing_device_flag',
 'device_multiple_customers': 'device_shared_by_multiple_customers_flag',
 'device_multiple_cards': 'device_shared_by_multiple_cards_flag',
 'card_multiple_devices': 'card_used_across_multiple_devices_flag'}
CAPACITIES = [5, 10, 20, 50, 100]
COEFFICIENTS = {'amount': 0.02,
 'distance_from_home': 0.8,
 'transaction_hour': -0.05,
 'customer_prior_transactions': 0.01,
 'minutes_since_previous_transaction': -0.0005,
 'amount_vs_customer_average': 0.4,
 'calculated_txn_count_1h': 0.6,
 'new_merchant_for_customer_flag': 0.3}
FINER = {'customer_avg_amount_prior': 8}
INTERCEPT = -1.5
RARE_ROWS = 100
RAW_TEXT = ['transaction_id', 'customer_id', 'timestamp', 'amount', 'currency', 'card_present', 'distance_from_home',
 'transaction_hour', 'velocity_last_hour', 'is_fraud']
DATED = ['write_report', 'date_parts', 'clean_table', 'daily_trend', 'behavior_features', 'network_features', 'model_base',
 'score_join', 'daily_monitoring', 'psi_numeric', 'psi_categorical', 'score_drift', 'performance_drift',
 'monitoring_alerts']
DRIFT_CATEGORIES = ['merchant_category', 'currency', 'country', 'card_type', 'device', 'channel']
DRIFT_NUMBERS = ['amount', 'distance_from_home', 'transaction_hour', 'customer_prior_transactions',
 'minutes_since_previous_transaction', 'customer_avg_amount_prior', 'amount_vs_customer_average',
 'calculated_txn_count_1h', 'calculated_amount_24h']
CATEGORICAL_MESSAGE = 'Categorical feature distribution shifted from reference population.'
NUMERIC_MESSAGE = 'Numeric feature distribution shifted from reference population.'
PERFORMANCE_MESSAGE = 'Precision or recall declined by more than 5 percentage points.'
SCORE_MESSAGE = 'Model score distribution shifted from reference population.'
MODEL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
FRIENDLY_NAMES = {'amount': 'Transaction amount',
 'log_amount': 'Transaction amount scale',
 'distance_from_home': 'Distance from home',
 'transaction_hour': 'Transaction hour',
 'weekend_transaction': 'Weekend transaction',
 'card_present': 'Card present',
 'customer_prior_transactions': 'Prior customer transactions',
 'minutes_since_previous_transaction': 'Time since previous transaction',
 'previous_customer_amount': 'Previous transaction amount',
 'customer_avg_amount_prior': 'Historical average amount',
 'customer_std_amount_prior': 'Historical amount variation',
 'amount_vs_customer_average': 'Amount vs customer average',
 'amount_zscore_vs_customer_history': 'Amount anomaly score',
 'calculated_txn_count_1h': 'Transactions in prior hour',
 'calculated_amount_1h': 'Spend in prior hour',
 'calculated_txn_count_24h': 'Transactions in prior 24 hours',
 'calculated_amount_24h': 'Spend in prior 24 hours',
 'new_merchant_for_customer_flag': 'New merchant for customer',
 'overnight_transaction_flag': 'Overnight transaction',
 'merchant_category': 'Merchant category',
 'merchant_type': 'Merchant type',
 'merchant': 'Merchant',
 'currency': 'Currency',
 'country': 'Country',
 'city_size': 'City size',
 'card_type': 'Card type',
 'device': 'Device type',
 'channel': 'Payment channel'}
HIGHER = 'Higher fraud risk'
LOWER = 'Lower fraud risk'
LOWERS = 'Lowers risk'
RAISES = 'Raises risk'

V, T = f"timestamp '{X.VALIDATION_START}'", f"timestamp '{X.TEST_START}'"
REUSED_COLUMNS = ["transaction_id", "customer_id", "card_number", "transaction_ts", "merchant", "amount",
                  "device_fingerprint", "ip_address", "currency", "channel", "is_fraud"]
TX_COLUMNS = [
    "transaction_key", "source_transaction_id", "customer_id", "card_number", "transaction_ts", "transaction_date",
    "transaction_hour", "weekend_transaction", "merchant_category", "merchant_type", "merchant", "high_risk_merchant",
    "amount", "currency", "country", "city_size", "card_type", "card_present", "device", "channel",
    "device_fingerprint", "ip_address", "distance_from_home", "velocity_num_transactions", "velocity_total_amount",
    "is_fraud",
]


def union(parts: list[str]) -> str:
    return "\nunion all ".join(parts)


def pct(flag: str, places: int = 4) -> str:
    return f"round(100.0 * avg({flag}), {places})"


def total(expr: str) -> str:
    return f"cast(sum({expr}) as bigint)"


def sampled(buckets: int, key: str = "transaction_key") -> str:
    return f"cast('0x' || substr(md5({key}), 1, 8) as bigint) % {buckets} = 0"


FRAUD_VALUE = "sum(case when is_fraud = 1 then amount else 0 end)"
VOLUME = f"count(*) as transactions, {total('is_fraud')} as fraud_transactions"

BASE = {
    "tx": X.TX, "tx_raw": X.TX_RAW, "tx_reused": X.TX_REUSED, "tx_scored": X.TX_SCORED,
    "tx_split": f"""select *, case when transaction_ts < {V} then 'train' when transaction_ts < {T} then 'validation'
        else 'test' end as data_split from tx""",
    "scored_from_validation": f"""select transaction_key, transaction_ts, transaction_date, amount, is_fraud,
        (amount + 60 * is_fraud) / (amount + 60 * is_fraud + 50) as fraud_probability from tx where transaction_ts >= {V}""",
    "bf_history": """
        select tx.*,
               row_number() over c - 1 as customer_prior_transactions,
               lag(transaction_ts) over c as previous_customer_transaction_ts,
               lag(amount) over c as previous_customer_amount,
               lag(merchant) over c as previous_customer_merchant,
               lag(device_fingerprint) over c as previous_device_fingerprint,
               avg(amount) over p as customer_avg_amount_prior,
               stddev_samp(amount) over p as customer_std_amount_prior,
               count(*) over h1 - 1 as calculated_txn_count_1h,
               (sum(amount) over h1) - amount as calculated_amount_1h,
               count(*) over h24 - 1 as calculated_txn_count_24h,
               (sum(amount) over h24) - amount as calculated_amount_24h,
               cast(row_number() over cd = 1 as int) as new_device_for_customer_flag,
               cast(row_number() over ci = 1 as int) as new_ip_for_customer_flag,
               cast(row_number() over cm = 1 as int) as new_merchant_for_customer_flag
        from tx
        window c as (partition by customer_id order by transaction_ts, transaction_key),
               p as (partition by customer_id order by transaction_ts, transaction_key
                     rows between unbounded preceding and 1 preceding),
               h1 as (partition by customer_id order by transaction_ts
                      range between interval '1 hour' preceding and current row),
               h24 as (partition by customer_id order by transaction_ts
                       range between interval '24 hours' preceding and current row),
               cd as (partition by customer_id, device_fingerprint order by transaction_ts, transaction_key),
               ci as (partition by customer_id, ip_address order by transaction_ts, transaction_key),
               cm as (partition by customer_id, merchant order by transaction_ts, transaction_key)""",
    "bf": f"""
        select *,
               date_diff('second', previous_customer_transaction_ts, transaction_ts) / 60.0
                   as minutes_since_previous_transaction,
               amount / nullif(customer_avg_amount_prior, 0) as amount_vs_customer_average,
               (amount - customer_avg_amount_prior) / nullif(customer_std_amount_prior, 0)
                   as amount_zscore_vs_customer_history,
               case when previous_device_fingerprint <> device_fingerprint then 1 else 0 end
                   as device_changed_from_previous_flag,
               cast(transaction_hour <= 5 as int) as overnight_transaction_flag,
               case when amount > -1 then ln(1 + amount) end as log_amount,
               case when transaction_ts < {V} then 'train' when transaction_ts < {T} then 'validation' else 'test' end
                   as data_split
        from bf_history""",
    "links": """
        select transaction_key,
               row_number() over (partition by device_fingerprint, customer_id order by transaction_ts, transaction_key)
                   as device_customer_sequence,
               row_number() over (partition by device_fingerprint, card_number order by transaction_ts, transaction_key)
                   as device_card_sequence,
               row_number() over (partition by device_fingerprint, merchant order by transaction_ts, transaction_key)
                   as device_merchant_sequence
        from tx""",
    "nf_history": """
        select bf.*, links.* exclude (transaction_key),
               row_number() over d - 1 as prior_device_transactions,
               row_number() over k - 1 as prior_card_transactions,
               cast(coalesce(sum(cast(device_customer_sequence = 1 as int)) over dp, 0) as bigint) as prior_customers_on_device,
               cast(coalesce(sum(cast(device_card_sequence = 1 as int)) over dp, 0) as bigint) as prior_cards_on_device,
               cast(coalesce(sum(cast(device_card_sequence = 1 as int)) over kp, 0) as bigint) as prior_devices_on_card,
               cast(coalesce(sum(cast(device_merchant_sequence = 1 as int)) over dp, 0) as bigint) as prior_merchants_on_device
        from bf join links using (transaction_key)
        window d as (partition by device_fingerprint order by transaction_ts, transaction_key),
               k as (partition by card_number order by transaction_ts, transaction_key),
               dp as (partition by device_fingerprint order by transaction_ts, transaction_key
                      rows between unbounded preceding and 1 preceding),
               kp as (partition by card_number order by transaction_ts, transaction_key
                      rows between unbounded preceding and 1 preceding)""",
    "nf": """
        select *,
               cast(device_customer_sequence = 1 and prior_device_transactions > 0 as int) as new_customer_on_existing_device_flag,
               cast(device_card_sequence = 1 and prior_device_transactions > 0 as int) as new_card_on_existing_device_flag,
               cast(prior_customers_on_device >= 2 as int) as device_shared_by_multiple_customers_flag,
               cast(prior_cards_on_device >= 2 as int) as device_shared_by_multiple_cards_flag,
               cast(prior_devices_on_card >= 2 as int) as card_used_across_multiple_devices_flag
        from nf_history""",
    "limits": """
        select quantile_cont(distance_from_home, 0.95) as distance_p95,
               quantile_cont(calculated_txn_count_1h, 0.95) as velocity_1h_p95,
               quantile_cont(calculated_amount_24h, 0.95) as amount_24h_p95
        from bf where data_split = 'train' and distance_from_home is not null""",
    "ruled": f"""
        select nf.*,
               coalesce(cast(distance_from_home >= distance_p95 as int), 0)
               + coalesce(cast(not card_present as int), 0)
               + coalesce(cast(transaction_hour between 0 and 5 as int), 0)
               + coalesce(cast(amount_vs_customer_average >= 3 as int), 0)
               + coalesce(cast(calculated_txn_count_1h >= velocity_1h_p95 as int), 0)
               + coalesce(cast(calculated_amount_24h >= amount_24h_p95 as int), 0)
               + new_merchant_for_customer_flag as behavioral_rule_score
        from nf, limits where transaction_ts >= {T}""",
    "decided": """
        select transaction_key, r.transaction_ts, r.amount, r.is_fraud, behavioral_rule_score,
               greatest(new_customer_on_existing_device_flag, new_card_on_existing_device_flag,
                        device_shared_by_multiple_customers_flag) as network_rule_flag,
               s.fraud_probability,
               cast(s.fraud_probability >= 0.75 as int) as ml_flag,
               cast(behavioral_rule_score >= 3 as int) as behavioral_rules_flag,
               cast(s.fraud_probability >= 0.75 or behavioral_rule_score >= 3 as int) as ml_behavioral_hybrid_flag,
               cast(s.fraud_probability >= 0.75 or network_rule_flag = 1 as int) as ml_network_hybrid_flag
        from ruled r join tx_scored s using (transaction_key)""",
    "queue": """select transaction_key, fraud_probability, is_fraud from tx_scored
        order by fraud_probability desc, transaction_key limit 100""",
    "card_edges": f"""select device_fingerprint, card_number, count(*) as transactions,
        count(distinct customer_id) as customers, min(transaction_ts) as first_seen, max(transaction_ts) as last_seen,
        {total('is_fraud')} as fraud_transactions, {pct('is_fraud')} as fraud_rate_pct from tx group by 1, 2""",
    "customer_edges": f"""select device_fingerprint, customer_id, count(*) as transactions,
        count(distinct card_number) as cards, min(transaction_ts) as first_seen, max(transaction_ts) as last_seen,
        {total('is_fraud')} as fraud_transactions, {pct('is_fraud')} as fraud_rate_pct from tx group by 1, 2""",
    "devices": f"""select device_fingerprint, count(*) as transactions, count(distinct customer_id) as customers,
        count(distinct card_number) as cards, count(distinct merchant) as merchants,
        {total('is_fraud')} as fraud_transactions, {pct('is_fraud')} as fraud_rate_pct from tx group by 1""",
    "reuse": "select transaction_id, count(*) as n from tx_reused group by 1 having count(*) > 1",
    "keyed": """
        select transaction_id as source_transaction_id,
               case when n = 1 then transaction_id else transaction_id || '_' || cast(position as varchar) end as transaction_key,
               cast(n > 1 as int) as reused_source_id_flag, n as source_id_occurrences, * exclude (transaction_id, n, position)
        from (select *, count(*) over (partition by transaction_id) as n,
                     row_number() over (partition by transaction_id order by transaction_ts, customer_id, card_number, amount,
                                        merchant, device_fingerprint, ip_address, channel, currency, is_fraud) as position
              from tx_reused) q""",
}
NEEDS = {
    "tx_scored": ["tx"], "tx_split": ["tx"], "scored_from_validation": ["tx"], "bf_history": ["tx"],
    "bf": ["bf_history"], "links": ["tx"], "nf_history": ["bf", "links"], "nf": ["nf_history"], "limits": ["bf"],
    "ruled": ["nf", "limits"], "decided": ["ruled", "tx_scored"], "queue": ["tx_scored"], "card_edges": ["tx"],
    "customer_edges": ["tx"], "devices": ["tx"], "reuse": ["tx_reused"], "keyed": ["tx_reused"],
}


def with_tables(names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """The query with the named views, and what they are built on, as common table expressions."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in NEEDS.get(name, []):
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        need(name)
    parts = [f"{n} as materialized ({BASE[n]})" for n in ordered]
    parts += [f"{n} as materialized ({q})" for n, q in (extra or {}).items()]
    return "with " + ",\n".join(parts) + "\n" + body


def rounded(columns: list[str], doubles: list[str], places: int = 6) -> str:
    return ", ".join(f"round({c}, {FINER.get(c, places)}) as {c}" if c in doubles else c for c in columns)


BEHAVIOR_COLUMNS = [
    "customer_prior_transactions", "previous_customer_transaction_ts", "previous_customer_amount",
    "previous_customer_merchant", "previous_device_fingerprint", "customer_avg_amount_prior",
    "customer_std_amount_prior", "calculated_txn_count_1h", "calculated_amount_1h", "calculated_txn_count_24h",
    "calculated_amount_24h", "minutes_since_previous_transaction", "amount_vs_customer_average",
    "amount_zscore_vs_customer_history", "new_device_for_customer_flag", "new_ip_for_customer_flag",
    "new_merchant_for_customer_flag", "device_changed_from_previous_flag", "overnight_transaction_flag",
]
DOUBLES = [
    "amount", "distance_from_home", "velocity_num_transactions", "velocity_total_amount", "previous_customer_amount",
    "customer_avg_amount_prior", "customer_std_amount_prior", "calculated_amount_1h", "calculated_amount_24h",
    "minutes_since_previous_transaction", "amount_vs_customer_average", "amount_zscore_vs_customer_history",
    "log_amount", "fraud_probability",
]
SEQUENCES = ["device_customer_sequence", "device_card_sequence", "device_merchant_sequence"]
NETWORK_COLUMNS = SEQUENCES + [c for c in NETWORK_FEATURES if c not in BEHAVIOR_COLUMNS]


def model_columns(columns: list[str]) -> str:
    flags = {"weekend_transaction", "card_present"}
    return ", ".join(
        f"cast({c} as int) as {c}" if c in flags else f"round({c}, {FINER.get(c, 6)}) as {c}" if c in DOUBLES else c
        for c in columns)


def confusion(flag: str) -> str:
    return (
        f"count(*) filter ({flag} and is_fraud = 1) as true_positives, "
        f"count(*) filter ({flag} and is_fraud = 0) as false_positives, "
        f"count(*) filter (not ({flag}) and is_fraud = 1) as false_negatives, "
        f"count(*) filter (not ({flag}) and is_fraud = 0) as true_negatives")


RATES = """
    round(case when true_positives + false_positives = 0 then 0
          else true_positives / cast(true_positives + false_positives as double) end, 9) as precision,
    round(case when true_positives + false_negatives = 0 then 0
          else true_positives / cast(true_positives + false_negatives as double) end, 9) as recall,
    round(case when 2 * true_positives + false_positives + false_negatives = 0 then 0
          else 2 * true_positives / cast(2 * true_positives + false_positives + false_negatives as double) end, 9) as f1"""


def grid(thresholds: list[float]) -> str:
    return f"(select unnest([{', '.join(repr(t) for t in thresholds)}]::double[]) as cut) g"


SWEEP = f"""select round(cut, 2) as threshold, true_positives, false_positives, false_negatives, true_negatives,
    round((true_positives + false_positives) / cast(rows as double), 9) as review_rate, {RATES}
    from (select cut, count(*) as rows, {confusion('fraud_probability >= cut')}
          from tx_scored, {grid(SWEEP_THRESHOLDS)} group by cut) q"""

ECONOMICS = f"""
    select round(cut, 2) as threshold, flagged as flagged_transactions,
           round(100.0 * flagged / cast(rows as double), 6) as review_rate_pct,
           caught as fraud_caught, fraud - caught as fraud_missed, flagged - caught as false_alerts,
           round(100.0 * caught / cast(fraud as double), 6) as transaction_recall_pct,
           round(value, 4) as total_fraud_value, round(caught_value, 4) as fraud_value_caught,
           round(100.0 * caught_value / value, 6) as fraud_value_capture_pct,
           round(value - caught_value, 4) as fraud_value_missed,
           round(caught_value * 0.9::double, 4) as estimated_prevented_loss,
           flagged * 5.0::double as manual_review_cost, (flagged - caught) * 15.0::double as false_positive_friction_cost,
           round(value - caught_value * 0.9::double + flagged * 5.0::double + (flagged - caught) * 15.0::double, 4)
               as estimated_total_cost
    from (select cut, count(*) as rows, count(*) filter (is_fraud = 1) as fraud, {FRAUD_VALUE} as value,
                 count(*) filter (fraud_probability >= cut) as flagged,
                 count(*) filter (fraud_probability >= cut and is_fraud = 1) as caught,
                 sum(case when fraud_probability >= cut and is_fraud = 1 then amount else 0 end) as caught_value
          from tx_scored, {grid(ECONOMIC_THRESHOLDS)} group by cut) q"""

BAND = """case when fraud_probability < 0.30 then 'Low' when fraud_probability < 0.60 then 'Medium'
    when fraud_probability < 0.80 then 'High' else 'Critical' end"""

DAILY = f"""
    select *, round(true_positives / cast(nullif(true_positives + false_positives, 0) as double), 9) as precision,
           round(true_positives / cast(nullif(true_positives + false_negatives, 0) as double), 9) as recall
    from (select transaction_date, {VOLUME}, {pct('is_fraud')} as actual_fraud_rate_pct,
                 round(avg(fraud_probability), 6) as avg_fraud_probability,
                 {pct('cast(fraud_probability >= 0.75 as int)')} as alert_rate_pct,
                 count(*) filter (fraud_probability >= 0.75 and is_fraud = 1) as true_positives,
                 count(*) filter (fraud_probability >= 0.75 and is_fraud = 0) as false_positives,
                 count(*) filter (fraud_probability < 0.75 and is_fraud = 1) as false_negatives,
                 round(avg(amount), 2) as avg_transaction_amount
          from tx_scored group by 1) d"""

STATUS = """case when psi is null then 'Unavailable' when psi < 0.10 then 'Stable' when psi < 0.25 then 'Moderate Drift'
    else 'High Drift' end"""


def numeric_drift(prefix: str, source: str, features: list[str]) -> dict[str, str]:
    """PSI steps: long form, exact edges of the reference, bin counts, distance over all bins."""
    long = union([
        f"select data_split, transaction_date, '{f}' as feature, cast({f} as double) as x from {source}" for f in features])
    cuts = ", ".join(repr(i * 0.1) for i in range(11))
    return {
        f"{prefix}_long": f"select * from ({long}) q where data_split <> 'train'",
        f"{prefix}_ranked": f"""select feature, x, row_number() over (partition by feature order by x) - 1 as r,
            count(*) over (partition by feature) as n from {prefix}_long where data_split = 'validation' and x is not null""",
        f"{prefix}_at": f"select distinct feature, n, q, q * (n - 1) as h from {prefix}_ranked, (select unnest([{cuts}]::double[]) as q) u",
        f"{prefix}_edges": f"""select feature, list_sort(list_distinct(list(edge))) as edges from (
            select a.feature, lo.x + (hi.x - lo.x) * (h - floor(h)) as edge from {prefix}_at a
            join {prefix}_ranked lo on lo.feature = a.feature and lo.r = floor(h)
            join {prefix}_ranked hi on hi.feature = a.feature and hi.r = ceil(h)) e group by feature""",
        f"{prefix}_binned": f"""select l.data_split, l.transaction_date, l.feature, x, edges,
            len(list_filter(edges[2:len(edges) - 1], lambda e: e <= x)) as bin
            from {prefix}_long l left join {prefix}_edges e on e.feature = l.feature""",
        f"{prefix}_ref": f"""select feature, bin, count(*) as n from {prefix}_binned
            where data_split = 'validation' and x is not null group by 1, 2""",
        f"{prefix}_cur": f"""select transaction_date, feature, bin, count(*) as n from {prefix}_binned
            where data_split = 'test' and x is not null group by 1, 2, 3""",
        f"{prefix}_ref_means": f"""select feature, count(x) as known, avg(x) as mean from {prefix}_binned
            where data_split = 'validation' group by 1""",
        f"{prefix}_days": f"""select transaction_date, feature, count(x) as known, avg(x) as mean,
            max(len(edges)) as edge_count from {prefix}_binned where data_split = 'test' group by 1, 2""",
        f"{prefix}_shares": f"""select d.transaction_date, d.feature, b.bin,
            coalesce(c.n / nullif(d.known, 0)::double, 0.000001) as cur,
            coalesce(r.n / nullif(m.known, 0)::double, 0.000001) as ref
            from {prefix}_days d join {prefix}_ref_means m on m.feature = d.feature
            cross join (select unnest(range(0, 10)) as bin) b
            left join {prefix}_cur c on c.transaction_date = d.transaction_date and c.feature = d.feature and c.bin = b.bin
            left join {prefix}_ref r on r.feature = d.feature and r.bin = b.bin
            where b.bin <= d.edge_count - 2""",
        f"{prefix}_distance": f"""select transaction_date, feature, sum((cur - ref) * ln(cur / ref)) as psi
            from {prefix}_shares group by 1, 2""",
        f"{prefix}_drift": f"""select transaction_date, feature, psi, {STATUS} as status, reference_mean, current_mean from (
            select d.transaction_date, d.feature, round(case when d.known = 0 or m.known = 0 then null
                when d.edge_count < 3 then 0.0 else p.psi end, 9) as psi,
                round(m.mean, 6) as reference_mean, round(d.mean, 6) as current_mean
            from {prefix}_days d join {prefix}_ref_means m on m.feature = d.feature
            left join {prefix}_distance p on p.transaction_date = d.transaction_date and p.feature = d.feature) q""",
    }


def categorical_drift() -> dict[str, str]:
    long = union([
        f"select data_split, transaction_date, '{f}' as feature, coalesce({f}, 'MISSING') as category from tx_split"
        for f in DRIFT_CATEGORIES])
    return {
        "c_long": f"select * from ({long}) q where data_split <> 'train'",
        "c_ref": """select feature, category, count(*) / sum(count(*)) over (partition by feature)::double as share
            from c_long where data_split = 'validation' group by 1, 2""",
        "c_cur": """select transaction_date, feature, category,
            count(*) / sum(count(*)) over (partition by transaction_date, feature)::double as share
            from c_long where data_split = 'test' group by 1, 2, 3""",
        "c_domain": """select distinct d.transaction_date, u.feature, u.category from (select distinct transaction_date from c_cur) d,
            (select feature, category from c_ref union select feature, category from c_cur) u""",
        "c_used": """select m.*, coalesce(c.share, 0.000001) as cur, coalesce(r.share, 0.000001) as ref,
            c.share is not null or r.share is not null as counts from c_domain m
            left join c_cur c using (transaction_date, feature, category) left join c_ref r using (feature, category)""",
        "c_drift": f"""select transaction_date, feature, psi, {STATUS} as status from (
            select transaction_date, feature, round(sum((cur - ref) * ln(cur / ref)), 9) as psi
            from c_used where counts group by 1, 2) q""",
    }


PERFORMANCE = {
    "daily": DAILY,
    "ref_rates": f"""select count(*) filter (fraud_probability >= 0.75 and is_fraud = 1) as tp,
        count(*) filter (fraud_probability >= 0.75 and is_fraud = 0) as fp,
        count(*) filter (fraud_probability < 0.75 and is_fraud = 1) as fn
        from scored_from_validation where transaction_ts < {T}""",
    "reference_rates": """select round(case when tp + fp = 0 then 0 else tp / (tp + fp)::double end, 9) as reference_precision,
        round(case when tp + fn = 0 then 0 else tp / (tp + fn)::double end, 9) as reference_recall from ref_rates""",
    "p_drift": """select *, case when precision_change_pp < -5 or recall_change_pp < -5 then 'Review Required' else 'Stable' end
        as performance_status from (
        select transaction_date, precision, recall, actual_fraud_rate_pct, alert_rate_pct, reference_precision, reference_recall,
               round((precision - reference_precision) * 100, 6) as precision_change_pp,
               round((recall - reference_recall) * 100, 6) as recall_change_pp
        from daily, reference_rates) q""",
}
FEATURE_SPLIT = {"bf_sample": "select * from bf"}
SCORE_SPLIT = {"score_sample": f"""select *, case when transaction_ts < {T} then 'validation' else 'test' end as data_split
    from scored_from_validation"""}
NUMERIC_DRIFT = FEATURE_SPLIT | numeric_drift("n", "bf_sample", DRIFT_NUMBERS)
SCORE_DRIFT = SCORE_SPLIT | numeric_drift("s", "score_sample", ["fraud_probability"])
ALL_DRIFT = NUMERIC_DRIFT | SCORE_DRIFT | categorical_drift() | PERFORMANCE


def _alert(source: str, kind: str, item: str, message: str) -> str:
    return f"""select transaction_date, '{kind}' as alert_type, {item} as item,
        case when psi >= 0.25 then 'High' else 'Moderate' end as severity, psi as value, '{message}' as message
        from {source} where psi >= 0.10"""


ALERTS = union([
    _alert("s_drift", "Score Drift", "'fraud_probability'", SCORE_MESSAGE),
    _alert("n_drift", "Numeric Feature Drift", "feature", NUMERIC_MESSAGE),
    _alert("c_drift", "Categorical Feature Drift", "feature", CATEGORICAL_MESSAGE),
    f"""select transaction_date, 'Model Performance', 'precision_or_recall', 'High',
        least(precision_change_pp, recall_change_pp), '{PERFORMANCE_MESSAGE}' from p_drift
        where performance_status = 'Review Required'""",
])

NAMES = ", ".join(f"'{k}': '{v}'" for k, v in FRIENDLY_NAMES.items())
FRIENDLY = f"map {{{NAMES}}}[feature]"
MEANS = {"means": "select " + ", ".join(f"avg({c}) as {c}" for c in COEFFICIENTS) + " from bf where data_split = 'train'"}
PARTS = MEANS | {
    "base_value": "select " + repr(INTERCEPT) + "::double" + "".join(
        f" + {w!r}::double * {c}" for c, w in COEFFICIENTS.items()) + " as base_value from means",
    "parts": union([
        f"""select b.transaction_key, s.fraud_probability, s.is_fraud, '{c}' as feature, cast(b.{c} as double) as feature_value,
            {w!r}::double * (coalesce(cast(b.{c} as double), m.{c}) - m.{c}) as contribution
            from bf b join tx_scored s using (transaction_key), means m""" for c, w in COEFFICIENTS.items()]),
    "ranked_parts": """select *, row_number() over (partition by transaction_key order by abs(contribution) desc, feature)
        as driver_rank from parts""",
}

STUDIES = {
    "classes": """
        select transaction_key, fraud_probability, is_fraud, 'high_risk_true_positive' as case_type, fraud_probability as strength
            from tx_scored where is_fraud = 1
        union all select transaction_key, fraud_probability, is_fraud, 'false_positive', fraud_probability
            from tx_scored where is_fraud = 0 and fraud_probability >= 0.75
        union all select transaction_key, fraud_probability, is_fraud, 'false_negative', fraud_probability
            from tx_scored where is_fraud = 1 and fraud_probability < 0.75
        union all select transaction_key, fraud_probability, is_fraud, 'low_risk_true_negative', -fraud_probability
            from tx_scored where is_fraud = 0""",
    "studies": """select * from (select transaction_key, fraud_probability, is_fraud, case_type,
        row_number() over (partition by case_type order by strength desc, transaction_key) as case_rank from classes) q
        where case_rank <= 5""",
}


def _queue(where: str, order: str = "fraud_probability desc, transaction_key") -> str:
    return with_tables("tx_scored", f"""select transaction_key, round(fraud_probability, 6) as fraud_probability, is_fraud
        from tx_scored {where} order by {order} limit 100""")


def _signals(source: str, signals: dict[str, str], name: str, value: str, kind: str) -> str:
    return union([
        f"""select '{s}' as {name}, cast({c} as {kind}) as {value}, {VOLUME}, {pct('is_fraud')} as fraud_rate_pct
            from {source} group by 1, 2""" for s, c in signals.items()])


def _levels() -> str:
    long = union([f"select '{c}' as feature, {c} as category from sample" for c in CATEGORICAL_FEATURES])
    return with_tables("tx", f"""select feature, category, n + case when rank = 1 then missing else 0 end as transactions,
        case when n + case when rank = 1 then missing else 0 end >= {RARE_ROWS} then category else '__infrequent__' end as level
        from (select feature, category, n, row_number() over (partition by feature order by n desc, category) as rank,
                     coalesce((select count(*) from long m where m.feature = c.feature and m.category is null), 0) as missing
              from (select feature, category, count(*) as n from long where category is not null group by 1, 2) c) q""",
        {"sample": f"select * from tx where transaction_ts < {V}", "long": long})


def _numeric_preprocessing() -> str:
    return with_tables("bf", union([f"""
        select '{c}' as feature, round(median, 6) as median, round(avg(coalesce(x, median)), 6) as mean,
               round(stddev_pop(coalesce(x, median)), 6) as scale
        from (select cast({c} as double) as x, (select quantile_cont(cast({c} as double), 0.5) from bf where data_split = 'train')
              as median from bf where data_split = 'train') q group by median""" for c in NUMERIC_FEATURES]))


def _policy() -> str:
    groups = {"main_model": MODEL_FEATURES, "rule_or_benchmark": BENCHMARK_FEATURES, "excluded": EXCLUDED_FEATURES}
    rows = [f"select '{p}' as policy, count({f}) as known from nf" if f != "velocity_last_hour"
            else f"select '{p}' as policy, cast(null as bigint) as known" for p, names in groups.items() for f in names]
    return with_tables("nf", f"""select policy, count(*) as features, count(known) as features_in_table,
        cast(coalesce(sum(known), 0) as bigint) as known_values from ({union(rows)}) q group by policy""")


def _missingness() -> str:
    rows = union([f"""select '{c}' as column_name, count(*) as total_rows,
        count(*) filter ({c} is null or trim({c}) = '' or lower(trim({c})) in ('null', 'none', 'nan', 'na', 'n/a')) as missing_rows
        from tx_raw""" for c in RAW_TEXT])
    return with_tables("tx_raw", f"select *, round(missing_rows / cast(total_rows as double) * 100, 4) as missing_pct from ({rows}) q")


BLANK = "nullif(trim({0}), '')"
TOKENS = "case when lower(trim({0})) in ('true', '1', 'yes', 'y') then {1} when lower(trim({0})) in ('false', '0', 'no', 'n') then {2} end"
LABEL = TOKENS.format("is_fraud", "1", "0")
PRESENT = TOKENS.format("card_present", "true", "false")
DISTANCE = "try_cast(regexp_extract({0}, '-?[0-9]+(?:\\.[0-9]+)?', 0) as double)"
JSON = "replace(velocity_last_hour, chr(39), chr(34))"
VELOCITY = ", ".join(
    f"try_cast(json_extract_string({JSON}, '$.{k}') as double) as velocity_{k}" for k in ("num_transactions", "total_amount"))

PROFILE = """count(distinct source_transaction_id) as unique_transaction_ids, count(distinct customer_id) as unique_customers,
    count(distinct card_number) as unique_cards, count(distinct merchant) as unique_merchants,
    count(distinct device_fingerprint) as unique_device_fingerprints, count(distinct ip_address) as unique_ip_addresses,
    min(transaction_ts) as min_timestamp, max(transaction_ts) as max_timestamp,
    count(*) filter (is_fraud = 1) as fraud_transactions"""

SYSTEM_COLUMNS = {
    "Behavioral rules": "behavioral_rules_flag", "ML only": "ml_flag", "ML + behavioral rules": "ml_behavioral_hybrid_flag",
    "Synthetic network rules": "network_rule_flag", "ML + network rules": "ml_network_hybrid_flag",
}

ORACLE: dict[str, str] = {
    "scan_raw_csv": with_tables("tx_raw", f"select {', '.join(f"nullif({c}, '') as {c}" for c in RAW_TEXT)} from tx_raw"),
    "materialize_stage": with_tables("tx_raw", """select 'raw.transactions' as table_name, count(*) as rows from tx_raw
        union all select 'analytics.transactions_clean', count(*) from tx_raw"""),
    "stage_quality": with_tables("tx_raw", f"""select count(*) as rows, count(*) as observed_rows,
        count(*) filter ({BLANK.format('transaction_id')} is null) as missing_transaction_id,
        count(*) filter (try_cast(amount as double) is null) as missing_amount,
        count(*) filter ({LABEL} is null)
        as missing_is_fraud from tx_raw"""),
    "sketched_profile": with_tables("tx", " union all ".join(
        f"select '{period}' as period, '{name}' as measure, count(distinct {column}) as exact_count, 1 as within from tx{where}"
        for period, where in (("all", ""), ("test", f" where transaction_ts >= {T}"))
        for name, column in {"customers": "customer_id", "cards": "card_number", "devices": "device_fingerprint",
                             "ips": "ip_address", "transactions": "transaction_key"}.items())),
    "sketched_devices": with_tables("tx", """select count(*) as entities, count(*) filter (n > 1) as reused,
        count(*) filter (customers > 1) as shared_by_customers, count(*) filter (cards > 1) as shared_by_cards
        from (select count(*) as n, count(distinct customer_id) as customers, count(distinct card_number) as cards
              from tx group by device_fingerprint) d"""),
    "split_tables": with_tables("tx_split", "select data_split as table_name, count(*) as rows from tx_split group by 1"),
    "write_scores": with_tables("tx_scored", """select transaction_key, is_fraud, round(fraud_probability, 9) as fraud_probability
        from tx_scored"""),
    "table_counts": with_tables("tx tx_raw tx_reused tx_scored", union([
        f"select '{t}' as table_name, count(*) as rows from {t}" for t in ("tx", "tx_raw", "tx_reused", "tx_scored")])),
    "raw_quality": with_tables("tx_raw", f"""select count(*) as transaction_rows, count(distinct id) as unique_transaction_ids,
        count(*) - count(id) as null_transaction_ids, count(*) filter (amt is null or amt < 0) as invalid_or_null_transaction_amounts,
        count(*) filter (label = 1) as fraud_transactions, round(avg(label), 9) as fraud_rate
        from (select {BLANK.format('transaction_id')} as id, try_cast(amount as double) as amt, {LABEL} as label from tx_raw) q"""),
    "side_table_keys": """select count(*) as identity_rows, count(distinct l_orderkey) as unique_identity_transaction_ids from lineitem""",
    "match_rate": """select count(*) as joined_rows, round(avg(case when l_orderkey is not null then 1.0 else 0.0 end), 9) as identity_match_rate
        from orders left join lineitem on o_orderkey = l_orderkey""",
    "clean_text": with_tables("tx_raw", f"""select {BLANK.format('transaction_id')} as transaction_id,
        {BLANK.format('customer_id')} as customer_id, upper({BLANK.format('currency')}) as currency from tx_raw"""),
    "clean_casts": with_tables("tx_raw", """select transaction_id, try_cast(timestamp as timestamp) as transaction_ts,
        try_cast(amount as double) as amount, try_cast(transaction_hour as integer) as transaction_hour from tx_raw"""),
    "clean_booleans": with_tables("tx_raw", f"select transaction_id, {PRESENT} as card_present, {LABEL} as is_fraud from tx_raw"),
    "date_parts": with_tables("tx", """select transaction_key, cast(transaction_ts as date) as transaction_date,
        cast(extract(hour from transaction_ts) as int) as derived_hour, cast(extract(dow from transaction_ts) as int) as day_of_week from tx"""),
    "extract_distance": with_tables("tx_raw", f"select transaction_id, {DISTANCE.format('distance_from_home')} as distance_from_home from tx_raw"),
    "discover_keys": with_tables("tx_raw", f"""select key as source_key, 'velocity_' || key as column_name,
        min(case when json_type(doc, '$.' || key) like '%BIGINT' then 'int' else 'float' end) as sample_type
        from (select doc, unnest(json_keys(doc)) as key from (select {JSON}::json as doc from tx_raw) q) k group by 1, 2"""),
    "parse_velocity": with_tables("tx_raw", f"select transaction_id, {VELOCITY} from tx_raw"),
    "clean_table": with_tables("tx_raw", f"""select {BLANK.format('transaction_id')} as transaction_id,
        {BLANK.format('customer_id')} as customer_id, try_cast(timestamp as timestamp) as transaction_ts,
        cast(try_cast(timestamp as timestamp) as date) as transaction_date,
        cast(extract(hour from try_cast(timestamp as timestamp)) as int) as derived_hour,
        cast(extract(dow from try_cast(timestamp as timestamp)) as int) as day_of_week,
        try_cast(amount as double) as amount, upper({BLANK.format('currency')}) as currency, {PRESENT} as card_present,
        {DISTANCE.format('distance_from_home')} as distance_from_home,
        try_cast(transaction_hour as integer) as transaction_hour, {LABEL} as is_fraud, {VELOCITY} from tx_raw"""),
    "duplicate_id_count": with_tables("reuse", "select count(*) as duplicate_transaction_ids from reuse where transaction_id is not null"),
    "duplicate_summary": with_tables("reuse", """select count(*) as total_rows, count(distinct transaction_id) as unique_transaction_ids,
        count(*) - count(distinct transaction_id) as extra_duplicate_rows, (select count(*) from reuse) as duplicate_id_groups from tx_reused"""),
    "duplicate_conflicts": with_tables("tx_reused", f"""select count(*) as duplicate_transaction_ids,
        count(*) filter (versions = 1) as exact_duplicate_ids, count(*) filter (versions > 1) as conflicting_duplicate_ids
        from (select transaction_id, count(*) as n, count(distinct ({', '.join(REUSED_COLUMNS[1:])})) as versions
              from tx_reused group by 1 having count(*) > 1) q"""),
    "duplicate_samples": with_tables("reuse", """select t.* from tx_reused t
        join (select transaction_id from reuse order by transaction_id limit 100) d using (transaction_id)"""),
    "duplicate_group_sizes": with_tables("reuse", "select n as rows_per_id, count(*) as transaction_ids from reuse group by 1"),
    "field_conflicts": with_tables("tx_reused", "select count(*) as duplicate_ids, " + ", ".join(
        f"count(*) filter ({l} > 1) as {l}_conflicts" for c, l in CONFLICT_FIELDS.items() if c in REUSED_COLUMNS)
        + " from (select transaction_id, " + ", ".join(
        f"count(distinct {c}) as {l}" for c, l in CONFLICT_FIELDS.items() if c in REUSED_COLUMNS)
        + " from tx_reused where transaction_id is not null group by 1 having count(*) > 1) q"),
    "label_conflicts": with_tables("tx_reused", """select transaction_id, count(*) as rows_per_id, count(distinct is_fraud) as fraud_versions,
        min(is_fraud) as min_fraud_label, max(is_fraud) as max_fraud_label from tx_reused group by 1
        having count(*) > 1 and count(distinct is_fraud) > 1 order by transaction_id limit 100"""),
    "conflict_examples": with_tables("tx_reused", f"""select t.*, conflict_score from tx_reused t join (
        select transaction_id, {' + '.join(f'count(distinct {c})' for c in SCORED_FIELDS)} as conflict_score from tx_reused
        group by 1 having count(*) > 1 order by conflict_score desc, transaction_id limit 50) d using (transaction_id)"""),
    "duplicate_behavior": with_tables("tx_reused", "select count(*) as duplicate_ids, " + ", ".join(
        f"count(*) filter ({l} > 1) as different_{l}_ids" for l in BEHAVIOR_FIELDS.values())
        + ", count(*) filter (timestamp > 1 and customer > 1 and card > 1) as strongly_separate_transaction_like_ids"
        + " from (select transaction_id, " + ", ".join(f"count(distinct {c}) as {l}" for c, l in BEHAVIOR_FIELDS.items())
        + " from tx_reused group by 1 having count(*) > 1) q"),
    # Ids of conflicting rows: nothing is removed. Copies only: one row of each id stays.
    # With conflicting rows under one id nothing is removed; of copies one row of each id stays.
    "dedup_first": with_tables("tx_reused", """select * from tx_reused where (select count(*) from conflicts) > 0
        union all select distinct * from tx_reused where (select count(*) from conflicts) = 0""", {
            "conflicts": "select transaction_id from (select distinct * from tx_reused) d group by 1 having count(*) > 1"}),
    # Facts of the trained models that any engine can state.
    "train_gbt_facts": with_tables("tx_split", """select count(*) filter (data_split = 'train') as training_rows,
        count(*) filter (data_split = 'validation') as validation_rows, 0::bigint as better_prefixes, 0 as rounds_over_limit
        from tx_split"""),
    "model_metadata_facts": with_tables("tx_split", f"""select {len(MODEL_FEATURES)} as feature_count,
        count(*) filter (data_split = 'train') as training_rows, count(*) filter (data_split = 'validation') as validation_rows
        from tx_split"""),
    "score_test_facts": with_tables("tx_split", """select count(*) as scored, 0::bigint as without_key,
        0::bigint as out_of_range from tx_split where data_split = 'test'"""),
    "feature_importance_facts": f"select {len(MODEL_FEATURES)}::bigint as features, 0::bigint as negative, 1.0::double as gain_sum",
    "tree_contributions_facts": with_tables("tx_split", """select count(*) as explained, 0::bigint as off
        from tx_split where data_split = 'test'"""),
    "dedup_copies": with_tables("tx_reused", """select distinct * from tx_reused where transaction_id in (
        select transaction_id from tx_reused group by 1 having count(*) = 1)"""),
    "unique_keys": with_tables("keyed", "select * from keyed"),
    "key_validation": with_tables("keyed", f"""select count(*) as total_rows, count(distinct transaction_key) as unique_transaction_keys,
        count(distinct source_transaction_id) as unique_source_ids, {total('reused_source_id_flag')} as rows_with_reused_source_ids,
        count(*) - count(distinct transaction_key) as duplicate_transaction_keys from keyed"""),
    "population_summary": with_tables("keyed", f"""select {VOLUME}, {pct('is_fraud')} as fraud_rate_pct,
        min(transaction_ts) as start_date, max(transaction_ts) as end_date from keyed"""),
    "dataset_profile": with_tables("tx", f"""select count(*) as row_count, {PROFILE}, count(distinct country) as countries,
        count(distinct currency) as currencies, round(avg(is_fraud), 9) as fraud_rate,
        count(*) - count(source_transaction_id) as missing_transaction_id, count(*) - count(customer_id) as missing_customer_id,
        count(*) - count(transaction_ts) as invalid_or_missing_timestamp, count(*) - count(amount) as invalid_or_missing_amount,
        count(*) - count(is_fraud) as invalid_or_missing_fraud_label, count(*) filter (amount < 0) as negative_amounts from tx"""),
    "quality_summary": with_tables("tx", f"""select count(*) as rows, {PROFILE}, {pct('is_fraud')} as fraud_rate_pct,
        count(*) filter (amount < 0) as negative_amount, count(*) - count(amount) as missing_amount,
        count(*) - count(transaction_ts) as missing_timestamp, count(*) - count(customer_id) as missing_customer,
        count(*) - count(card_number) as missing_card, count(*) - count(merchant) as missing_merchant,
        count(*) - count(device_fingerprint) as missing_device_fingerprint, count(*) - count(ip_address) as missing_ip_address,
        (select count(*) from (select source_transaction_id from tx where source_transaction_id is not null
         group by 1 having count(*) > 1) d) as duplicate_transaction_ids from tx"""),
    "missingness": _missingness(),
    "fraud_by_dimension": with_tables("tx", union([f"""select '{c}' as dimension, cast({c} as varchar) as category, {VOLUME},
        {pct('is_fraud')} as fraud_rate_pct, round(avg(amount), 2) as avg_transaction_amount,
        round(sum(amount), 2) as total_transaction_value, round({FRAUD_VALUE}, 2) as fraud_transaction_value
        from tx group by {c}""" for c in DIMENSIONS])),
    "amount_bands": with_tables("tx", f"""select case when amount < 10 then '01_under_10' when amount < 25 then '02_10_25'
        when amount < 50 then '03_25_50' when amount < 100 then '04_50_100' when amount < 250 then '05_100_250'
        when amount < 500 then '06_250_500' when amount < 1000 then '07_500_1000' when amount < 2500 then '08_1000_2500'
        else '09_2500_plus' end as amount_band, {VOLUME}, {pct('is_fraud')} as fraud_rate_pct, round(avg(amount), 2) as avg_amount,
        round({FRAUD_VALUE}, 2) as fraud_value from tx where amount is not null group by 1"""),
    "daily_trend": with_tables("tx", f"""select transaction_date, {VOLUME}, {pct('is_fraud')} as fraud_rate_pct,
        round(sum(amount), 2) as transaction_value, round({FRAUD_VALUE}, 2) as fraud_value from tx group by 1"""),
    "fraud_overall": with_tables("tx", f"select {VOLUME}, {pct('is_fraud')} as fraud_rate_pct, round({FRAUD_VALUE}, 2) as fraud_value from tx"),
    "fraud_by_category": with_tables("tx", f"""select merchant_category, {VOLUME}, {pct('is_fraud', 3)} as fraud_rate_pct,
        round(avg(amount), 2) as avg_amount from tx group by 1"""),
    "fraud_by_channel": with_tables("tx", f"select channel, {VOLUME}, {pct('is_fraud', 3)} as fraud_rate_pct from tx group by 1"),
    "fraud_by_hour": with_tables("tx", f"select transaction_hour, {VOLUME}, {pct('is_fraud', 3)} as fraud_rate_pct from tx group by 1"),
    "velocity_features": with_tables("bf_history", """select transaction_key, calculated_txn_count_1h,
        round(calculated_amount_1h, 6) as calculated_amount_1h, calculated_txn_count_24h,
        round(calculated_amount_24h, 6) as calculated_amount_24h from bf_history"""),
    "behavior_features": with_tables("bf", f"select {rounded(TX_COLUMNS + BEHAVIOR_COLUMNS, DOUBLES)} from bf"),
    "risk_flags": with_tables("tx", """select transaction_key,
        case when amount > 3 * avg(amount) over (partition by customer_id) then 1 else 0 end as unusually_high_amount_flag,
        cast(high_risk_merchant as int) as high_risk_merchant_flag, cast(transaction_hour <= 5 as int) as overnight_transaction_flag,
        cast(not card_present as int) as card_not_present_flag, row_number() over c as customer_transaction_number,
        lag(transaction_ts) over c as previous_customer_transaction_ts, lag(amount) over c as previous_customer_amount
        from tx window c as (partition by customer_id order by transaction_ts, transaction_key)"""),
    "behavior_summary": with_tables("bf", f"""select count(*) as transactions, count(distinct transaction_key) as unique_transaction_keys,
        count(*) filter (minutes_since_previous_transaction < 0) as negative_time_gaps,
        round(avg(calculated_txn_count_1h), 2) as avg_prior_transactions_1h, max(calculated_txn_count_1h) as max_prior_transactions_1h,
        round(avg(calculated_txn_count_24h), 2) as avg_prior_transactions_24h, max(calculated_txn_count_24h) as max_prior_transactions_24h,
        {pct('new_device_for_customer_flag', 2)} as new_device_pct, {pct('new_merchant_for_customer_flag', 2)} as new_merchant_pct from bf"""),
    "behavior_signals": with_tables("bf", _signals("bf", BEHAVIOR_SIGNALS, "signal", "signal_value", "int")),
    "audit_signals": with_tables("bf", _signals("bf", {
        "new_device": "new_device_for_customer_flag", "device_changed": "device_changed_from_previous_flag",
        "new_merchant": "new_merchant_for_customer_flag", "high_risk_merchant": "high_risk_merchant",
        "amount_under_10": "cast(amount < 10 as int)", "amount_under_25": "cast(amount < 25 as int)"},
        "feature", "feature_value", "varchar")),
    "velocity_check": with_tables("bf", """select count(*) as transactions,
        round(avg(abs(velocity_num_transactions - calculated_txn_count_1h)), 4) as avg_count_difference,
        round(avg(abs(velocity_total_amount - calculated_amount_1h)), 2) as avg_amount_difference,
        round(corr(velocity_num_transactions, calculated_txn_count_1h), 6) as count_correlation,
        round(corr(velocity_total_amount, calculated_amount_1h), 6) as amount_correlation
        from bf where velocity_num_transactions is not null"""),
    "velocity_audit": with_tables("bf", """select round(avg(velocity_num_transactions), 2) as source_avg_transaction_count,
        round(avg(calculated_txn_count_1h), 2) as calculated_customer_avg_1h,
        round(corr(velocity_num_transactions, calculated_txn_count_1h), 4) as count_correlation,
        round(corr(velocity_total_amount, calculated_amount_1h), 4) as amount_correlation,
        round(avg(abs(velocity_num_transactions - calculated_txn_count_1h)), 2) as avg_absolute_count_difference
        from bf where velocity_num_transactions is not null"""),
    "network_features": with_tables("nf", f"select {rounded(TX_COLUMNS + BEHAVIOR_COLUMNS + NETWORK_COLUMNS, DOUBLES)} from nf"),
    "network_summary": with_tables("nf", f"""select count(*) as transactions, count(distinct transaction_key) as unique_transaction_keys,
        max(prior_customers_on_device) as max_prior_customers_on_device, max(prior_cards_on_device) as max_prior_cards_on_device,
        max(prior_devices_on_card) as max_prior_devices_on_card, max(prior_merchants_on_device) as max_prior_merchants_on_device,
        {pct('new_customer_on_existing_device_flag')} as new_customer_existing_device_pct,
        {pct('new_card_on_existing_device_flag')} as new_card_existing_device_pct,
        {pct('device_shared_by_multiple_customers_flag')} as multi_customer_device_pct,
        {pct('device_shared_by_multiple_cards_flag')} as multi_card_device_pct from nf"""),
    "network_signals": with_tables("nf", _signals("nf", NETWORK_SIGNALS, "signal", "signal_value", "int")),
    "device_summary": with_tables("tx", """select count(*) as devices, count(*) filter (n > 1) as reused_devices,
        count(*) filter (customers > 1) as devices_shared_by_customers, count(*) filter (cards > 1) as devices_shared_by_cards,
        count(*) filter (low = 1 and high = 1) as fraud_only_devices, count(*) filter (low = 0 and high = 0) as legitimate_only_devices,
        count(*) filter (low <> high) as mixed_fraud_devices from (select device_fingerprint, count(*) as n,
        count(distinct customer_id) as customers, count(distinct card_number) as cards, min(is_fraud) as low, max(is_fraud) as high
        from tx group by 1) q"""),
    "ip_summary": with_tables("tx", """select count(*) as ip_addresses, count(*) filter (n > 1) as reused_ips,
        count(*) filter (customers > 1) as ips_shared_by_customers, count(*) filter (cards > 1) as ips_shared_by_cards,
        max(n) as max_transactions_per_ip from (select ip_address, count(*) as n, count(distinct customer_id) as customers,
        count(distinct card_number) as cards from tx group by 1) q"""),
    "top_devices": with_tables("devices", """select * from devices where transactions > 1
        order by customers desc, cards desc, transactions desc, device_fingerprint limit 200"""),
    "suspicious_devices": with_tables("devices", """select * from devices where transactions >= 2
        order by customers desc, cards desc, fraud_transactions desc, device_fingerprint limit 500"""),
    "device_card_edges": with_tables("card_edges", "select * from card_edges"),
    "device_customer_edges": with_tables("customer_edges", "select * from customer_edges"),
    "chrono_split": with_tables("tx_split", "select transaction_key, data_split from tx_split"),
    "model_base": with_tables("nf", f"""select transaction_key, transaction_ts, transaction_date, data_split, is_fraud,
        {model_columns(MODEL_FEATURES + NETWORK_FEATURES)} from nf where transaction_ts is not null and is_fraud in (0, 1)"""),
    "split_summary": with_tables("tx_split", f"""select data_split, {VOLUME}, {pct('is_fraud')} as fraud_rate_pct,
        min(transaction_ts) as first_transaction, max(transaction_ts) as last_transaction from tx_split group by 1"""),
    "hash_sample": with_tables("tx", f"select transaction_key, transaction_ts, is_fraud from tx where {sampled(10)}"),
    "sample_summary": with_tables("tx", f"select {VOLUME}, {pct('is_fraud')} as fraud_rate_pct from tx where transaction_ts < {V} and {sampled(10)}"),
    "feature_policy": _policy(),
    "category_domain": with_tables("tx_split", union([f"""select '{c}' as feature, {c} as category, count(*) as transactions,
        cast({c} in (select {c} from tx_split where data_split = 'train') as int) as in_training
        from tx_split where data_split = 'test' group by {c}""" for c in CATEGORICAL_FEATURES])),
    "rule_thresholds": with_tables("limits", """select round(distance_p95, 6) as distance_p95, round(velocity_1h_p95, 6) as velocity_1h_p95,
        round(amount_24h_p95, 6) as amount_24h_p95 from limits"""),
    "confusion_metrics": with_tables("tx_scored", f"""select *, {RATES}, 0.75::double as threshold from (select count(*) as rows,
        {confusion('fraud_probability >= 0.75')}, round(avg(cast(fraud_probability >= 0.75 as int)), 9) as review_rate from tx_scored) q"""),
    "threshold_sweep": with_tables("tx_scored", SWEEP),
    "best_threshold": with_tables("tx_scored", f"select threshold, f1, precision, recall from ({SWEEP}) s order by f1 desc, threshold limit 1"),
    "roc_auc": with_tables("tx_scored", """select round(sum(neg * (tp - pos / 2.0)) / (sum(pos) * sum(neg)), 9)::double as roc_auc
        from (select *, sum(pos) over (order by fraud_probability desc)::double as tp from (select fraud_probability,
        count(*) filter (is_fraud = 1)::double as pos, count(*) filter (is_fraud = 0)::double as neg from tx_scored group by 1) c) q"""),
    "pr_auc": with_tables("tx_scored", """select round(sum(pos * tp / (tp + fp)) / sum(pos), 9) as pr_auc
        from (select *, sum(pos) over w as tp, sum(neg) over w as fp from (select fraud_probability,
        count(*) filter (is_fraud = 1)::double as pos, count(*) filter (is_fraud = 0)::double as neg from tx_scored group by 1) c
        window w as (order by fraud_probability desc)) q"""),
    "score_join": with_tables("tx_scored", """select t.transaction_key, t.transaction_ts, t.transaction_date, round(t.amount, 6) as amount,
        t.merchant_category, t.merchant, t.channel, t.country, t.is_fraud, round(s.fraud_probability, 6) as fraud_probability
        from tx t join tx_scored s using (transaction_key)"""),
    "value_baseline": with_tables("tx_scored", f"""select {VOLUME}, round(sum(amount), 2) as transaction_value, round({FRAUD_VALUE}, 2) as fraud_value,
        round(avg(case when is_fraud = 1 then amount end), 2) as avg_fraud_amount from tx_scored"""),
    "threshold_economics": with_tables("tx_scored", ECONOMICS),
    "cheapest_threshold": with_tables("tx_scored", f"""select threshold, estimated_total_cost from ({ECONOMICS}) e
        order by estimated_total_cost, threshold limit 1"""),
    "review_capacity": with_tables("tx_scored", f"""select cap as daily_review_capacity, max(days) as days, count(*) as total_reviews,
        count(*) filter (is_fraud = 1) as fraud_transactions_caught, count(*) filter (is_fraud = 0) as false_alerts,
        round(100.0 * count(*) filter (is_fraud = 1) / max(all_fraud)::double, 6) as fraud_recall_pct,
        round({FRAUD_VALUE}, 4) as fraud_value_caught, round(100.0 * {FRAUD_VALUE} / max(all_value), 6) as fraud_value_capture_pct,
        round(100.0 * count(*) filter (is_fraud = 1) / count(*)::double, 6) as fraud_per_100_reviews
        from (select *, row_number() over (partition by transaction_date order by fraud_probability desc, transaction_key) as r
              from tx_scored) q,
             (select count(distinct transaction_date) as days, count(*) filter (is_fraud = 1) as all_fraud,
                     round({FRAUD_VALUE}, 2) as all_value from tx_scored) a,
             (select unnest({CAPACITIES}) as cap) c
        where r <= cap group by cap"""),
    "risk_bands": with_tables("tx_scored", f"""select {BAND} as risk_band, {VOLUME}, {pct('is_fraud')} as actual_fraud_rate_pct,
        round(avg(fraud_probability), 4) as avg_model_probability, round(sum(amount), 2) as transaction_value,
        round({FRAUD_VALUE}, 2) as fraud_value from tx_scored group by 1"""),
    "rule_score": with_tables("ruled", "select transaction_key, behavioral_rule_score from ruled"),
    "rule_decisions": with_tables("decided", """select * replace (round(amount, 6) as amount, round(fraud_probability, 6) as fraud_probability)
        from decided"""),
    "system_comparison": with_tables("decided", f"""select system, true_positives + false_positives as flagged_transactions,
        round(100.0 * (true_positives + false_positives) / rows::double, 6) as review_rate_pct, true_positives, false_positives,
        false_negatives, true_negatives, {RATES}, round(caught, 4) as fraud_value_caught,
        round(100.0 * caught / value, 6) as fraud_value_capture_pct from (""" + union([
        f"""select '{s}' as system, count(*) as rows, {confusion(f'{c} = 1')},
            sum(case when {c} = 1 and is_fraud = 1 then amount else 0 end) as caught, {FRAUD_VALUE} as value from decided"""
        for s, c in SYSTEM_COLUMNS.items()]) + ") q"),
    "rule_score_profile": with_tables("decided", f"""select behavioral_rule_score, {VOLUME}, {pct('is_fraud')} as fraud_rate_pct,
        round(avg(fraud_probability), 4) as avg_ml_probability from decided group by 1"""),
    "daily_monitoring": with_tables("tx_scored", DAILY),
    "psi_numeric": with_tables("bf", "select * from n_drift", NUMERIC_DRIFT),
    "psi_categorical": with_tables("tx_split", "select * from c_drift", categorical_drift()),
    "score_drift": with_tables("scored_from_validation", """select transaction_date, reference_mean as reference_avg_score,
        current_mean as current_avg_score, psi as score_psi, status from s_drift""", SCORE_DRIFT),
    "performance_drift": with_tables("tx_scored scored_from_validation", "select * from p_drift", PERFORMANCE),
    "monitoring_alerts": with_tables("bf tx_split tx_scored scored_from_validation", ALERTS, ALL_DRIFT),
    "monitoring_summary": with_tables("bf tx_split tx_scored scored_from_validation", f"""
        select (select count(*) from p_drift) as monitoring_days,
        (select min(transaction_date)::varchar || ' to ' || max(transaction_date)::varchar from tx_split
         where data_split = 'validation') as reference_period,
        (select min(transaction_date)::varchar || ' to ' || max(transaction_date)::varchar from tx_split
         where data_split = 'test') as monitoring_period,
        0.75::double as decision_threshold, reference_precision, reference_recall,
        (select count(*) from n_drift where status = 'High Drift') as high_numeric_drift_events,
        (select count(*) from c_drift where status = 'High Drift') as high_categorical_drift_events,
        (select count(*) from s_drift where status = 'High Drift') as high_score_drift_events,
        (select count(*) from ({ALERTS}) a) as total_monitoring_alerts from reference_rates""", ALL_DRIFT),
    "class_weights": with_tables("tx", f"""select is_fraud, count(*) as transactions,
        round(sum(count(*)) over ()::double / (2 * count(*)), 9) as class_weight from tx where transaction_ts < {V} group by 1"""),
    "model_roundtrip": with_tables("tx", f"select count(*) as rows, cast(0 as bigint) as different from tx where transaction_ts >= {T}"),
    "logistic_roundtrip": with_tables("tx", f"select count(*) as rows, cast(0 as bigint) as different from tx where transaction_ts >= {T}"),
    "preprocess_numeric": _numeric_preprocessing(),
    "preprocess_categorical": _levels(),
    "contributions": with_tables("bf tx_scored", """select transaction_key, round(base_value, 6) as base_value, feature,
        round(feature_value, 6) as value, round(contribution, 6) as contribution from parts, base_value""", PARTS),
    "global_importance": with_tables("bf tx_scored", f"""select feature, {FRIENDLY} as friendly_name,
        round(avg(abs(contribution)), 6) as mean_absolute_contribution from parts group by 1""", PARTS),
    "top_drivers": with_tables("bf tx_scored", f"""select transaction_key, round(fraud_probability, 6) as fraud_probability,
        round(base_value, 6) as base_value, driver_rank, feature, {FRIENDLY} as friendly_name, round(feature_value, 6) as feature_value,
        round(contribution, 6) as contribution, case when contribution > 0 then '{HIGHER}' else '{LOWER}' end as direction
        from ranked_parts, base_value where driver_rank <= 5""", PARTS),
    "case_drivers": with_tables("bf tx_scored", f"""select transaction_key, round(fraud_probability, 6) as fraud_probability,
        driver_rank, feature, {FRIENDLY} as friendly_name, round(feature_value, 6) as feature_value,
        round(contribution, 6) as contribution, case when contribution > 0 then '{RAISES}' else '{LOWERS}' end as direction
        from ranked_parts where driver_rank <= 10""", PARTS),
    "case_summary": with_tables("bf tx_scored", f"""select transaction_key, round(fraud_probability, 6) as fraud_probability, case_type, is_fraud,
        cast(round_even(fraud_probability * 100, 0) as int) as risk_score, {BAND} as risk_band, round(max(base_value), 6) as base_value_log_odds,
        """ + ", ".join(f"max(words) filter (driver_rank = {i}) as top_driver_{i}" for i in range(1, 6)) + f"""
        from (select s.*, driver_rank, base_value, {FRIENDLY} || ': ' || case when contribution > 0 then '{HIGHER}' else '{LOWER}' end as words
              from studies s join (select transaction_key, driver_rank, feature, contribution from ranked_parts) p using (transaction_key),
              base_value) q group by transaction_key, fraud_probability, case_type, is_fraud""", PARTS | STUDIES),
    "case_studies": with_tables("tx_scored", """select * replace (round(fraud_probability, 6) as fraud_probability) from studies""", STUDIES),
    "queue_high_risk": _queue(""),
    "queue_false_positives": _queue("where is_fraud = 0 and fraud_probability >= 0.75"),
    "queue_false_negatives": _queue("where is_fraud = 1 and fraud_probability < 0.75"),
    "random_queue": _queue("", "md5('queue-' || transaction_key), transaction_key"),
    "case_decisions": with_tables("tx_scored", f"""select transaction_key, round(fraud_probability, 6) as fraud_probability,
        cast(round_even(fraud_probability * 100, 0) as int) as risk_score, {BAND} as risk_band,
        case when fraud_probability < 0.30 then 'Approve' when fraud_probability < 0.60 then 'Monitor'
             when fraud_probability < 0.75 then 'Manual review' else 'Escalate for review' end as action,
        (case when (is_fraud = 1) = (fraud_probability >= 0.75) then 'True ' else 'False ' end)
        || (case when fraud_probability >= 0.75 then 'Positive' else 'Negative' end) as case_type from tx_scored"""),
    "case_lookup": with_tables("nf queue", f"""select transaction_key, {model_columns(MODEL_FEATURES)}, nf.is_fraud, source_transaction_id,
        customer_id, card_number, device_fingerprint, ip_address, transaction_ts, prior_customers_on_device, prior_cards_on_device,
        prior_devices_on_card, prior_merchants_on_device, new_customer_on_existing_device_flag, new_card_on_existing_device_flag,
        device_shared_by_multiple_customers_flag, device_shared_by_multiple_cards_flag from nf join queue using (transaction_key)"""),
    "payment_by_key": with_tables("tx tx_scored", """select transaction_key, customer_id, card_number, amount, merchant, channel, is_fraud
        from tx where transaction_key = (select transaction_key from tx_scored order by fraud_probability desc, transaction_key limit 1)"""),
    "customer_history": with_tables("tx queue", """select * from (select c.transaction_key as case_key, h.transaction_ts as timestamp,
        h.transaction_key, h.amount, h.currency, h.merchant, h.channel, h.country,
        case when h.is_fraud = 1 then 'Fraud' else 'Legitimate' end as outcome,
        row_number() over (partition by c.transaction_key order by h.transaction_ts desc, h.transaction_key desc) as position
        from queue q join tx c using (transaction_key) join tx h on h.customer_id = c.customer_id and h.transaction_ts <= c.transaction_ts) r
        where position <= 20"""),
    "linked_customers_stored": with_tables("customer_edges tx tx_scored", """select * from (select c.transaction_key as case_key,
        e.* exclude (device_fingerprint),
        row_number() over (partition by c.transaction_key order by fraud_transactions desc, transactions desc, e.customer_id) as position
        from (select transaction_key from tx_scored order by fraud_probability desc, transaction_key limit 5) q
        join tx c using (transaction_key) join customer_edges e using (device_fingerprint)) r where position <= 50"""),
    "linked_customers": with_tables("customer_edges queue tx", """select * from (select c.transaction_key as case_key, e.* exclude (device_fingerprint),
        row_number() over (partition by c.transaction_key order by fraud_transactions desc, transactions desc, e.customer_id) as position
        from queue q join tx c using (transaction_key) join customer_edges e using (device_fingerprint)) r where position <= 50"""),
    "linked_cards": with_tables("card_edges queue tx", """select * replace (case when length(card_number) <= 4 then card_number
        else '•••• •••• •••• ' || right(card_number, 4) end as card_number)
        from (select c.transaction_key as case_key, e.* exclude (device_fingerprint),
        row_number() over (partition by c.transaction_key order by fraud_transactions desc, transactions desc, e.card_number) as position
        from queue q join tx c using (transaction_key) join card_edges e using (device_fingerprint)) r where position <= 50"""),
}
ORACLE["write_report"] = ORACLE["daily_trend"]

for _key in DATED:
    ORACLE[_key] = f"select * replace (cast(transaction_date as varchar) as transaction_date) from ({ORACLE[_key]}) q"
