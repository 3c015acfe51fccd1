"""Raw CSV in; stage tables, scored rows and reports out."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import ensure_checkpoint_dir

# Source columns of the raw file, and the table namespaces.
RAW_COLUMNS = [
    "transaction_id", "customer_id", "card_number", "timestamp", "merchant_category", "merchant_type", "merchant",
    "amount", "currency", "country", "city", "city_size", "card_type", "card_present", "device", "channel",
    "device_fingerprint", "ip_address", "distance_from_home", "high_risk_merchant", "transaction_hour",
    "weekend_transaction", "velocity_last_hour", "is_fraud",
]
NAMESPACES = ["raw", "staging", "analytics", "modeling"]
# Buckets of a table that is looked up by key.
BUCKETS = 64
# Pointer file of a stage table.
CURRENT = "current"


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder every executor can reach, below the session's checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}"


def read_raw_csv(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """Every column as text, so that typing stays an explicit, auditable step.

    One record per line: the file splits into tasks. An empty field, quoted or not, is NULL. Columns are found by the
    names in the header, in any order; a file without one of them is an error. ``multi_line`` reads quoted line breaks,
    at the price of one task per file. ``malformed_rows`` counts the lines that do not have the header's fields.
    """
    wanted = columns or RAW_COLUMNS
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    found = reader.option("inferSchema", False).csv(path)
    missing = [c for c in wanted if c not in found.columns]
    if missing:
        raise ValueError(f"the file has no column {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in found.columns])
    return reader.schema(schema).option("enforceSchema", False).csv(path).select(*wanted)


def malformed_rows(spark: SparkSession, path: str, multi_line: bool = False) -> int:
    """Lines of a CSV file with more or fewer fields than its header, such as the halves of a quoted line break."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "_bad"]])
    rows = reader.schema(schema).option("columnNameOfCorruptRecord", "_bad").option("mode", "PERMISSIVE").csv(path)
    # Every column is read: a pruned one would not be missed in a short line.
    return rows.agg(F.max(F.xxhash64(*names)), F.count("_bad")).first()[1]


def write_csv(df: DataFrame, path: str) -> None:
    """Text exactly as it is: surrounding blanks belong to the raw value."""
    (
        df.write.mode("overwrite").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def write_report(report: DataFrame, path: str) -> None:
    """An aggregated report as one CSV file. Reports are small by construction; fact rows do not go here."""
    write_csv(report.repartition(1), path)


def stage_path(root: str, namespace: str, table: str) -> str:
    if namespace not in NAMESPACES:
        raise ValueError(f"unknown namespace {namespace}")
    return f"{root}/{namespace}/{table}"


def _switch(spark: SparkSession, path: str, version: str) -> str | None:
    """Make ``version`` the current one of a stage table by renaming a pointer file into place; returns the one before."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    pointer, fresh = hadoop.Path(f"{path}/{CURRENT}"), hadoop.Path(f"{path}/_{version}")
    files = pointer.getFileSystem(spark._jsc.hadoopConfiguration())
    before = current_version(spark, path)
    out = files.create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(pointer.toUri(), spark._jsc.hadoopConfiguration()).rename(fresh, pointer, over)
    return before


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the version readers get, None for a table that was never written to the end."""
    pointer = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{CURRENT}")
    if not pointer.getFileSystem(spark._jsc.hadoopConfiguration()).exists(pointer):
        return None
    return spark.read.text(pointer.toString()).first()[0]


def write_stage(df: DataFrame, root: str, namespace: str, table: str, partition_by: list[str] | None = None,
                measures: dict[str, Column] | None = None) -> dict[str, int]:
    """Replace a stage table; returns ``rows`` and the ``measures`` (aggregates), observed while it is written.

    The rows go to a folder of their own; only when all are there does the pointer file switch to it, in one rename. A
    job that fails leaves the old rows in place, and readers never meet a missing or half-written table. The version
    before the last stays for readers that have opened it; older ones go.
    """
    spark, path = df.sparkSession, stage_path(root, namespace, table)
    version = f"version-{uuid.uuid4().hex}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[
        c.alias(name) for name, c in (measures or {}).items()]).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{version}")
    before = _switch(spark, path, version)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("version-") and name not in (version, before):
            files.delete(entry.getPath(), True)
    return seen.get


def read_stage(spark: SparkSession, root: str, namespace: str, table: str) -> DataFrame:
    path = stage_path(root, namespace, table)
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no stage table at {path}")
    return spark.read.parquet(f"{path}/{version}")


def publish_view(df: DataFrame, name: str) -> None:
    """A named view for SQL; the name may be read at once, and replacing it changes later readers only."""
    df.createOrReplaceTempView(name)


def select_by_key(spark: SparkSession, view: str, column: str, value: object) -> DataFrame:
    """Rows of a view with one key. The names must be those of the view; the value is bound, never part of the text."""
    if column not in spark.table(view).columns:
        raise ValueError(f"{view} has no column {column}")
    return spark.sql(f"select * from `{view}` where `{column}` = :value", args={"value": value})


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int = BUCKETS) -> None:
    """A table of the catalog, its files in ``buckets`` by a hash of the key and sorted by it. A lookup of some keys opens
    their buckets only, and a join or grouping by the key needs no exchange on this side."""
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)


def read_buckets(spark: SparkSession, name: str, key: str, values: list) -> DataFrame:
    """Rows of a bucketed table with one of the keys; NULL among them finds the rows of no key."""
    known = [v for v in values if v is not None]
    wanted = F.col(key).isin(known)
    return spark.table(name).filter(wanted if len(known) == len(values) else wanted | F.col(key).isNull())


def write_scores(scored: DataFrame, path: str) -> None:
    """Scored rows as parquet, one folder per day: daily reports read only their days."""
    scored.write.mode("overwrite").partitionBy("transaction_date").parquet(path)


def create_namespaces(spark: SparkSession, names: list[str] = NAMESPACES) -> None:
    """Idempotent databases for sessions that keep the stages in a catalog instead of folders."""
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
