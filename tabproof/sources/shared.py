"""Where intermediate files go: the folder every executor of the cluster can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Without that setting only a local session gets a temporary folder; on a cluster
    a machine-local folder would be wrong, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="tabproof-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Let long fits cut their lineage in the folder the session names, if it names one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared folder and read back; gone when the session ends."""
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(folder)
