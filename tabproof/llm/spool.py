"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from tabproof.sources.shared import shared_folder


#: Small rows of a file, where the number of rows is known beforehand.
FILE_ROWS = 200_000


def spool(df: DataFrame, purpose: str, most: int | None = None) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    ``most`` is a number of rows that ``df`` is known not to exceed: it is then written in
    no more files than these rows or the cluster's cores need. On a local file system each
    file costs its executor several processes, which show the executor's memory as their own
    until they have started.

    Cuts the lineage: an executor lost later costs a read of the files, not a new run of
    what made them. Spark also knows the size of the result from then on. The files go
    when the session's file system closes.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    if most is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, -(-most // FILE_ROWS)))
    df.write.parquet(path)
    _delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def spool_parts(spark: SparkSession, parts: Iterator[DataFrame], schema: str, purpose: str) -> DataFrame:
    """Write one part after the other into one folder and read all of them back."""
    path = shared_folder(spark, purpose)
    spark.createDataFrame([], schema).write.parquet(path)
    for part in parts:
        part.write.mode("append").parquet(path)
    _delete_on_exit(spark, path)
    return spark.read.schema(schema).parquet(path)


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
