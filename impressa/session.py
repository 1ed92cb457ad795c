"""Session helpers: where intermediate tables live and how they are written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse, which all executors reach as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession) -> str:
    """A new path under the scratch folder, owned by this application."""
    return f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage in storage that outlives an executor, fixes values that depend on the
    physical layout (partition numbers), and gives the planner true sizes for broadcast choices.
    The table is deleted when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    delete_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Let the file system drop ``path`` when the driver ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def discard(spark: SparkSession, path: str) -> None:
    """Drop an intermediate table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
