"""Session settings the plans rely on, and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only: none of them fixes a partition count, so AQE sizes every
# shuffle from the data.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split a hot join key even where that costs one more exchange afterwards
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Shares of work for plans over tables: files are read, and shuffles dealt, in many small pieces,
# which AQE joins up to a size that a task's sorts and maps hold in a few hundred MB. With these
# a task's share does not grow with the input.
_SHARES = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

_SHARED = "spark.checkpoint.dir"


def prepare(spark: SparkSession, *, shares: bool = True) -> SparkSession:
    """Apply the runtime settings to a session and hand it back.

    ``shares`` is off for operators that deal out their own work.
    """
    for key, value in (_RUNTIME | (_SHARES if shares else {})).items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Raises when it is unset: a folder of the driver's own would lose what executors
    write on other machines.
    """
    configured = spark.conf.get(_SHARED, None)
    if not configured:
        raise RuntimeError(f"set {_SHARED} to a folder that the driver and all executors share")
    return configured


def with_local_dir(spark: SparkSession) -> SparkSession:
    """Give a one-machine session (tests, bench, local runs) a shared folder if it has none."""
    one_machine = spark.conf.get("spark.master", "").split("[")[0] == "local"
    if one_machine and not spark.conf.get(_SHARED, None):
        spark.conf.set(_SHARED, tempfile.mkdtemp(prefix="kiosklake-"))
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/kiosklake/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts lineage and computes a frame with several readers once; the written
    files survive the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str, times: int = 4) -> DataFrame:
    """Rows dealt by keys into as many tasks as the session has shuffle partitions, ``times`` over.

    For joins that make much of few bytes, which AQE would leave to a task or two.
    """
    return df.repartition(times * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
