"""Folders for intermediate output that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """Below ``spark.checkpoint.dir``; where it is unset, which only local mode allows, in a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="gridloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df``, written to a scratch folder and read back; for small tables that the caller's result reads."""
    return written(df, scratch_path(df.sparkSession, label))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder by Spark's own file systems."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Scratch tables of one job, deleted at its end, however it ends."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def path(self, label: str) -> str:
        self.paths.append(scratch_path(self.spark, label))
        return self.paths[-1]

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        return written(df, self.path(label))

    def __exit__(self, *_: object) -> None:
        for path in self.paths:
            remove(self.spark, path)
