"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # size of one task after a shuffle, and so of one file of a rebalanced write
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.ui.enabled": "false",
    # no Python call sites captured for every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "curbline", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, if it is set.

    Only a local session may fall back on a temporary folder of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured:
        if not current:
            context.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="curbline-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a scratch table; nothing exists there yet."""
    return f"{shared_dir(spark)}/scratch/{uuid.uuid4().hex}/{name}"


# Bytes of input behind one shuffle partition.
SHUFFLE_BYTES = 128 << 20


def fit_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Raise the number of shuffle partitions to suit the input; never lower it.

    Adaptive execution joins partitions that turn out small, but cannot split
    those of an aggregate that turn out large.
    """
    wanted = math.ceil(input_bytes / SHUFFLE_BYTES)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))


@contextmanager
def fitted_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Shuffle partitions to suit one step's input; what was set before holds again afterwards."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    fit_shuffles(spark, input_bytes)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def freeze(df: DataFrame) -> DataFrame:
    """Compute a reduced frame once and keep it in the shared folder.

    The copy survives the loss of executors, and later passes neither repeat the
    aggregation behind it nor see rows move between partitions.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
