"""Helpers that several operators share: tables, stage tables in the shared folder, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir

# White space that separates words: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or a scratch folder of a local run."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stage_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; what follows no longer depends on lost tasks."""
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a stage table that nothing will read again."""
    for file in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def components(spark: SparkSession, edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an edge list, as (node, component), component being the smallest node reachable.

    Rounds of large-star and small-star: each node hands its neighbours to the smallest one it knows, so paths shorten
    geometrically and a star with any number of leaves stays one edge per leaf. Each round is two grouped exchanges of
    the edges; the edge list is written to the shared folder after each round. Nodes without an edge do not appear.
    """
    # The smaller node first. An edge of a node to itself says nothing.
    links = (
        edges.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m"))
        .distinct()
    )
    links = stage_table(spark, links, "links")
    while True:
        # Large star: every neighbour above the node is linked to the smallest in the node's neighbourhood.
        both = links.select(F.col("v").alias("n"), F.col("m").alias("o")).unionByName(
            links.select(F.col("m").alias("n"), F.col("v").alias("o")))
        low = both.groupBy("n").agg(F.min("o").alias("low"))
        low = low.select("n", F.least("n", "low").alias("low"))
        large = (
            both.filter(F.col("o") > F.col("n")).join(low, "n")
            .select(F.col("o").alias("v"), F.col("low").alias("m")).distinct()
        )
        # Small star: the node and all its smaller neighbours are linked to the smallest of them.
        least = large.groupBy("v").agg(F.min("m").alias("low"))
        small = (
            large.join(least, "v")
            .select(F.explode(F.array(F.struct("v", F.col("low").alias("m")),
                                      F.struct(F.col("m").alias("v"), F.col("low").alias("m")))).alias("e"))
            .select("e.v", "e.m").filter(F.col("v") != F.col("m")).distinct()
        )
        after = stage_table(spark, small, "links")
        drop_stage(spark, links)
        links = after
        # Done when only stars are left: each node has one edge down, and none is both a star's centre and a leaf.
        ends = links.select(F.col("v").alias("n"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(
            links.select(F.col("m").alias("n"), F.lit(0).alias("leaf"), F.lit(1).alias("centre")))
        ends = ends.groupBy("n").agg(F.sum("leaf").alias("leaves"), F.max("centre").alias("centre"))
        if ends.filter((F.col("leaves") > 1) | ((F.col("leaves") > 0) & (F.col("centre") > 0))).isEmpty():
            break
    roots = links.select(F.col("m").alias("node"), F.col("m").alias("component")).distinct()
    return links.select(F.col("v").alias("node"), F.col("m").alias("component")).unionByName(roots)
