"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "riskloom", master: str | None = None, shuffle_partitions: int | None = None,
                  memory: str | None = None) -> SparkSession:
    """A session with the settings the operators rely on: UTC, adaptive plans, Arrow batches.

    On a cluster leave ``master`` to the submit command and give ``shuffle_partitions`` generously,
    about the largest exchange over 200 MB: adaptive execution merges small partitions to the
    advisory size, but cannot split one that does not fit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in ``spark.checkpoint.dir``; local runs get a scratch folder.

    On a cluster a machine-local folder would not survive the loss of a machine, so a missing
    setting is an error there instead of a silent fallback.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
