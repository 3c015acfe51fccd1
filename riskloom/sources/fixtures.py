"""Payment-shaped views over the driver tables. The same SQL text runs on Spark and on the oracle engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Chronological cut points of the views: 20 days train, 5 days validation, 5 days test.
VALIDATION_START = "2024-01-21 00:00:00"
TEST_START = "2024-01-26 00:00:00"

TX = """
select concat('TX_', cast(event_id as string)) as transaction_key,
       concat('TX_', cast(event_id as string)) as source_transaction_id,
       user_id as customer_id,
       concat('C', cast(user_id * 2 + k % 2 as string)) as card_number,
       ts as transaction_ts, cast(ts as date) as transaction_date,
       cast(extract(hour from ts) as int) as transaction_hour,
       extract(day from ts) % 7 in (0, 6) as weekend_transaction,
       concat('MC', cast(k % 8 as string)) as merchant_category,
       concat('MT', cast(k % 17 as string)) as merchant_type,
       concat('M', cast(k % 20 as string)) as merchant,
       k % 20 < 5 as high_risk_merchant,
       value as amount,
       case when user_id % 11 < 5 then 'USD' else 'EUR' end as currency,
       concat('N', cast(user_id % 12 as string)) as country,
       case when user_id % 3 = 0 then 'large' else 'medium' end as city_size,
       concat('T', cast(user_id % 5 as string)) as card_type,
       event_id % 2 = 0 as card_present,
       concat('DV', cast(event_id % 9 as string)) as device,
       case when event_id % 3 = 0 then 'web' when event_id % 3 = 1 then 'mobile' else 'pos' end as channel,
       concat('D', cast((user_id * 7 + k) % 400 as string)) as device_fingerprint,
       concat('10.0.', cast(user_id % 50 as string), '.', cast(event_id % 200 as string)) as ip_address,
       cast(case when k % 3 = 0 then 1 else 0 end as double) as distance_from_home,
       cast(k as double) as velocity_num_transactions,
       value * (k % 4) as velocity_total_amount,
       case when event_type = 'error' then 1 else 0 end as is_fraud
from (select *, cast(regexp_extract(props, '[0-9]+', 0) as int) as k from events) e
"""

TX_RAW = """
select case when event_id % 97 = 0 then '  ' else concat(' TX_', cast(event_id as string), ' ') end as transaction_id,
       cast(user_id as string) as customer_id,
       case when event_id % 41 = 0 then 'not a time' else cast(ts as string) end as timestamp,
       case when event_id % 50 = 0 then 'n/a' when event_id % 51 = 0 then '' else cast(value as string) end as amount,
       case when event_id % 3 = 0 then 'usd' when event_id % 3 = 1 then ' Eur ' else 'GBP' end as currency,
       case when event_id % 5 = 0 then 'TRUE' when event_id % 5 = 1 then '0' when event_id % 5 = 2 then ' yes' when event_id % 5 = 3 then 'N' else 'maybe' end as card_present,
       case when k % 10 = 0 then 'unknown' else concat('about -', cast(k as string), '.5 km') end as distance_from_home,
       case when k % 12 = 0 then 'x' else cast(extract(hour from ts) as string) end as transaction_hour,
       concat('{', chr(39), 'num_transactions', chr(39), ': ', cast(k as string), ', ', chr(39), 'total_amount', chr(39), ': ', cast(value as string), '}') as velocity_last_hour,
       case when event_type = 'error' then 'true' when event_type = 'signup' then 'None' else 'False' end as is_fraud
from (select *, cast(regexp_extract(props, '[0-9]+', 0) as int) as k from events) e
"""

TX_REUSED = """
select concat('L', cast(l_orderkey as string), '-', cast(l_linenumber as string)) as transaction_id,
       l_suppkey as customer_id, l_partkey as card_number, l_shipdate as transaction_ts,
       concat('M', cast(l_suppkey % 105 as string)) as merchant, l_extendedprice as amount,
       concat('D', cast(l_partkey % 997 as string)) as device_fingerprint,
       concat('10.', cast(l_suppkey as string), '.', cast(l_partkey as string)) as ip_address,
       case when l_suppkey % 2 = 0 then 'USD' else 'EUR' end as currency,
       l_linestatus as channel, case when l_returnflag = 'R' then 1 else 0 end as is_fraud
from lineitem
"""

TX_SCORED = f"""
select transaction_key, transaction_ts, transaction_date, amount, merchant_category, merchant, channel, country, is_fraud,
       (amount + 60 * is_fraud) / (amount + 60 * is_fraud + 50) as fraud_probability
from tx where transaction_ts >= timestamp '{TEST_START}'
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _from_parquet(sql: str, folder: str, name: str) -> str:
    return sql.replace(f"from {name}", f"from parquet.`{folder}/{name}.parquet`")


def tx(spark: SparkSession, folder: str) -> DataFrame:
    """Typed payments with a unique key."""
    return spark.sql(_from_parquet(TX, folder, "events"))


def tx_raw(spark: SparkSession, folder: str) -> DataFrame:
    """All-text payments with blanks, bad values and a serialized dictionary."""
    return spark.sql(_from_parquet(TX_RAW, folder, "events"))


def tx_reused(spark: SparkSession, folder: str) -> DataFrame:
    """Payments whose id is used by several, conflicting rows."""
    return spark.sql(_from_parquet(TX_REUSED, folder, "lineitem"))


def tx_scored(spark: SparkSession, folder: str, start: str = TEST_START) -> DataFrame:
    """Payments from ``start`` on with a closed-form score."""
    from pyspark.sql import functions as F

    columns = ["transaction_key", "transaction_ts", "transaction_date", "amount", "merchant_category",
               "merchant", "channel", "country", "is_fraud"]
    strength = F.col("amount") + 60 * F.col("is_fraud")
    return (
        tx(spark, folder)
        .filter(F.col("transaction_ts") >= F.lit(start).cast("timestamp_ntz"))
        .select(*columns, (strength / (strength + 50)).alias("fraud_probability"))
    )
