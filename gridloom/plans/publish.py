"""Partitioned publishing, manifests and tensor export."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from gridloom.functions import keys as K
from gridloom.operators import fields as B
from gridloom.operators import tidy as T
from gridloom.sources.grib import qualified, store

PARTITIONS = ("year", "month", "day", "run", "source_file")
#: Points of a field that is written by a task, and to a file, of its own.
LARGE = 1 << 17


def _dated(rows: DataFrame) -> DataFrame:
    day = K.parse_date(F.col("date"), strict=True)
    return rows.withColumn("year", F.date_format(day, "yyyy")).withColumn("month", F.date_format(day, "MM")).withColumn("day", F.date_format(day, "dd"))


def _write(rows: DataFrame, base: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(*PARTITIONS).parquet(base)


def publish(tidy: DataFrame, base: str, sort: tuple[str, ...] = ("variable", "isobaricInhPa")) -> None:
    """Writes tidy rows (with date, run and source_file) below ``base``; only the partitions of these source files are replaced.

    For rows that exist already; from blocks, ``publish_blocks`` shuffles no cell. Rows are dealt by source file and
    variable and sorted by variable and level, so that row groups can be skipped by their statistics.
    """
    out = _dated(tidy).repartition("source_file", "variable").sortWithinPartitions(*PARTITIONS, *sort, F.desc("latitude"), "longitude")
    _write(out, base)


def publish_blocks(blocks: DataFrame, base: str) -> None:
    """Publishes the tidy rows of merged blocks: blocks are dealt by source file, those of LARGE fields also by field, and sorted;
    their cells, from the north and in the order of their grid, are exploded in the task that writes them. A source file of
    small fields thus is one file, not one for each of the tasks that its fields would be dealt to. ``source_file`` is a
    file's whole key: files with one name in two folders keep a partition each."""
    large = F.size("values") >= LARGE
    dealt = _dated(T.chosen(blocks)).repartition(*PARTITIONS, F.when(large, F.col("variable")), F.when(large, F.col("level")))
    rows = B.cells(dealt.sortWithinPartitions(*PARTITIONS, "variable", "level"))
    columns = [F.col("level").cast("double").alias("isobaricInhPa"), "latitude", "longitude", "variable", F.col("value").cast("float").alias("value"), "date", *PARTITIONS]
    _write(rows.select(*columns), base)


def read_published(spark: SparkSession, base: str) -> DataFrame:
    """The published rows; partition values stay text (month 03)."""
    rows = spark.read.parquet(base)
    parts = ", ".join(f"`{c}` string" for c in PARTITIONS)
    kinds = [f for f in rows.schema.fields if f.name not in PARTITIONS]
    return spark.read.schema(", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), parts])).parquet(base)


def manifest(tidy: DataFrame) -> DataFrame:
    """One row a source file that has rows."""
    return tidy.groupBy("source_file", "date", "run").agg(F.count("*").alias("n_rows"), F.count("value").alias("n_values"), F.count_distinct("variable").alias("n_variables")).withColumn("status", F.lit("ok"))


def block_manifest(blocks: DataFrame) -> DataFrame:
    """source_file, n_rows, n_values and n_variables of what ``publish_blocks`` writes, counted block by block."""
    held = F.size(F.filter("values", lambda x: ~F.isnan(x)))
    rows = T.chosen(blocks).select("source_file", "variable", F.size("values").alias("n"), held.alias("held"))
    return rows.groupBy("source_file").agg(F.sum("n").alias("n_rows"), F.sum("held").alias("n_values"), F.count_distinct("variable").alias("n_variables"))


def published_bytes(spark: SparkSession, base: str, runs: list[tuple[str, str]] | None = None) -> DataFrame:
    """source_file, bytes and files below ``base``, or below the partitions of ``runs`` (date, run), from a listing: no file is read."""
    folders = [base] if runs is None else [f"{base}/year={d[:4]}/month={d[4:6]}/day={d[6:8]}/run={r}" for d, r in runs]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folders)
    source = F.url_decode(F.regexp_replace(F.regexp_extract("path", r"/source_file=([^/]+)/", 1), r"\+", "%2B"))
    return files.select(source.alias("source_file"), "length").groupBy("source_file").agg(F.sum("length").alias("bytes"), F.count("*").alias("files"))


@dataclass
class Staged(WriterCommitMessage):
    files: list[tuple[str, str]] = field(default_factory=list)


class TensorWriter(DataSourceArrowWriter):
    """Streams sorted fields into .npy files: a task appends each field to its tensor's file aside, after a header that tells
    the whole shape, so it holds one field. The commit moves the files of the attempts that Spark accepted into place, each by
    one rename; what failed and speculative attempts wrote goes with the folder aside."""

    def __init__(self, path: str) -> None:
        self.path, self.aside = path, f"_aside-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        files, base = store(self.path)
        done, out, target, left = [], None, None, 0

        def close() -> None:
            if out is not None:
                out.close()
                if left:
                    raise ValueError(f"{target} lacks {left} fields")

        for batch in iterator:
            values = batch.column(batch.schema.names.index("values"))
            for i, row in enumerate(zip(*[batch.column(batch.schema.names.index(c)).to_pylist() for c in ("file", "n_channel", "n_level", "n_lat", "n_lon")], strict=True)):
                if row[0] != target:
                    close()
                    target, channels, levels, lat, lon = row
                    shape = (channels, lat, lon) if levels is None else (channels, levels, lat, lon)
                    name = f"{self.aside}/{uuid.uuid4().hex}.npy"
                    files.create_dir(f"{base}/{self.aside}")
                    out, left = files.open_output_stream(f"{base}/{name}", compression=None), channels * (levels or 1)
                    np.lib.format.write_array_header_1_0(out, {"descr": "<f4", "fortran_order": False, "shape": shape})
                    done.append((name, target))
                data = values[i].values.to_numpy(zero_copy_only=False)
                if len(data) != lat * lon or not left:
                    raise ValueError(f"{target}: a field of {len(data)} values, {left} fields to come")
                out.write(np.ascontiguousarray(data, "<f4").tobytes())
                left -= 1
        close()
        return Staged(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, base = store(self.path)
        for name, target in (f for m in messages if m for f in m.files):
            files.create_dir(f"{base}/{target}".rsplit("/", 1)[0])
            if files.get_file_info(f"{base}/{target}").type == fs.FileType.File:
                files.delete_file(f"{base}/{target}")
            files.move(f"{base}/{name}", f"{base}/{target}")
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, base = store(self.path)
        if files.get_file_info(f"{base}/{self.aside}").type == fs.FileType.Directory:
            files.delete_dir(f"{base}/{self.aside}")


class TensorSink(DataSource):
    """``write.format("npy")`` of rows (file, n_channel, n_level, n_lat, n_lon, values), a field a row, in which each file's
    rows lie in one task and in order. An existing file is replaced when the write commits."""

    @classmethod
    def name(cls) -> str:
        return "npy"

    def writer(self, schema: StructType, overwrite: bool) -> TensorWriter:
        return TensorWriter(self.options["path"])


#: Fields of a tensor that Spark hands to Python at once.
BATCH_FIELDS = 8


def export_npy(tensors: DataFrame, base: str) -> DataFrame:
    """Writes input_<tensor>.npy of each cycle below ``base``, a folder that pyarrow opens on all executors: date, run, tensor,
    path, shape. Lead times of a run go to folders of their own.

    Fields are dealt by tensor, sorted, and streamed by ``TensorWriter``; a missing value is NaN."""
    spark = tensors.sparkSession
    spark.dataSource.register(TensorSink)
    cut = lambda name, a, n: F.concat(F.lit(f"/{name}="), F.substring("date", a, n))
    lead = [F.when(F.col("lead") != "", F.concat(F.lit("/lead="), "lead")).otherwise(F.lit(""))] if "lead" in tensors.columns else []
    folder = F.concat(F.substring(cut("year", 1, 4), 2, 20), cut("month", 5, 2), cut("day", 7, 2), F.lit("/run="), "run", *lead)
    levels = F.when(F.col("tensor") == "upper", len(B.LEVELS))
    channels = F.when(F.col("tensor") == "upper", len(B.UPPER)).otherwise(len(B.SURFACE))
    rows = tensors.withColumn("file", F.concat(folder, F.lit("/input_"), "tensor", F.lit(".npy"))).withColumn("n_channel", channels).withColumn("n_level", levels)
    sent = rows.select("file", "n_channel", "n_level", "n_lat", "n_lon", "channel", "level_idx", "values").repartition("file").sortWithinPartitions("file", "channel", "level_idx")
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, str(BATCH_FIELDS))
    try:
        sent.write.format("npy").mode("append").save(qualified(spark, base))
    finally:
        spark.conf.set(batch, before)
    size = lambda c: F.col(c).cast("string")
    told = rows.groupBy("file", "date", "run", "tensor").agg(*[F.max(c).alias(c) for c in ("n_channel", "n_level", "n_lat", "n_lon")])
    return told.select("date", "run", "tensor", F.concat(F.lit(f"{base.rstrip('/')}/"), "file").alias("path"), F.concat_ws(",", size("n_channel"), size("n_level"), size("n_lat"), size("n_lon")).alias("shape"))
