"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that results depend on.

    Timestamps are naive UTC values, so the session zone must be UTC. AQE is left to size the
    shuffle partitions and to split skewed joins, also when the split costs one more exchange.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    Only a local session may fall back to a folder of this machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="fareway-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from the written copy."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def write_aside(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back: later steps read only the columns they need.

    The folder stays, as the shared folder's owner decides when results are no longer wanted.
    """
    path = f"{shared_dir(df.sparkSession)}/frame-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
