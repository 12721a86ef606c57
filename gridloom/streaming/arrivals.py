"""Arriving forecast files: each is decoded and published once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.plans import job
from gridloom.sources import grib


def ingest(spark: SparkSession, path: str, checkpoint: str, base: str, tensor_base: str | None = None) -> None:
    """Decodes and publishes all GRIB2 files that arrived below ``path`` since the last call. The checkpoint makes a file
    count once; a batch that is run again after a failure replaces its files' partitions, so nothing is published twice."""
    root = grib.qualified(spark, path)
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").option("pathGlobFilter", "*.grib2").option("recursiveFileLookup", "true").schema(schema).load(path)

    def publish(batch: DataFrame, _: int) -> None:
        if not batch.select("path").isEmpty():
            job.publish_files(batch, base, tensor_base, root=root)

    files.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
