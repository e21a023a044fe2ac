"""Tables written to the folder that driver and executors share (spark.checkpoint.dir)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where none is set, a local session gets one of its own; on a cluster, whose machines share no local folder, that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    where = spark._jvm.org.apache.hadoop.fs.Path(named)
    # a name without a scheme is of the cluster's default file system
    whole = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return whole if "://" in whole else whole.replace("file:", "file://", 1)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, and a lost executor costs no more than its tasks."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Removes the files of a table that `written` made, once nothing reads it any more."""
    spark = table.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
