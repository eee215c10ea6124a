"""Results that survive the loss of executors, kept in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder named by the session.

    Only a local session without the setting gets a folder of its own: on a
    cluster a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current is not None:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="scoreloom-"))
    return spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the written rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other job uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """As :func:`cut`, in packed columns: for wide rows, which take many times the room in a checkpoint."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(rdd: RDD) -> None:
    """Delete the files of the shuffles before ``rdd``, back to what is persisted.

    For results that are persisted or written.  What is lost later is computed again.
    """
    rdd._jrdd.rdd().cleanShuffleDependencies(True)


def drop_checkpoint(rdd: RDD | None) -> None:
    """Delete the checkpoint of an RDD that nothing reads any more."""
    path = rdd.getCheckpointFile() if rdd is not None else None
    if path:
        jvm = rdd.context._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(rdd.context._jsc.hadoopConfiguration()).delete(at, True)
