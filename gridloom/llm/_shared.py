"""Files that all executors and the driver share, and bounded Arrow batches."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once by the numpy kernels; only bounds memory, no result depends on it.
CHUNK_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, a temporary one, which only local mode allows."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="gridloom-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/gridloom/{label}-{uuid.uuid4().hex}"


def free(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, Spark drops a query's shuffle files once it has been written. The session's setting is put back."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def write(df: DataFrame, path: str) -> DataFrame:
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: cuts the lineage, survives lost executors."""
    return write(df, new_path(df.sparkSession, label))


class Scratch:
    """Owns the intermediate tables of one operator call: ``keep`` writes one, ``finish`` writes the result elsewhere and
    deletes all others, so only the result's files stay for the caller."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.label, self.base, self.count = spark, label, new_path(spark, label), 0

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        self.count += 1
        return write(df, f"{self.base}/{label}-{self.count}")

    def drop(self, label: str) -> None:
        """Deletes the tables kept as ``label``, which nothing reads any more."""
        for i in range(1, self.count + 1):
            remove(self.spark, f"{self.base}/{label}-{i}")

    def finish(self, df: DataFrame) -> DataFrame:
        out = materialize(df, f"{self.label}-result")
        self.clear()
        return out

    def clear(self) -> None:
        remove(self.spark, self.base)


def numbered(df: DataFrame, order: list, name: str, scratch: Scratch) -> DataFrame:
    """Adds ``name``, the row's number from 0 in ``order``, and writes the rows. Tasks sort ranges of the order; only their
    sizes, a number for each task, come to the driver."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at, part = free(df, "_at"), free(df, "_part")
    rows = scratch.keep(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn(part, F.shiftrightunsigned(at, 33))
    sizes = sorted((r[part], r["count"]) for r in rows.groupBy(part).count().collect())
    starts, total = [], 0
    for p, size in sizes:
        starts.append((p, total))
        total += size
    first = spark.createDataFrame(starts, f"`{part}` long, _first long")
    number = F.col("_first") + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(first, part).select(*df.columns, number.alias(name))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store, by Spark's own file systems."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of long texts that Spark hands to Python at once.
BATCH_ROWS = 250


def bound_batches(spark: SparkSession) -> None:
    """Where the session has Spark's default of 10,000 rows a batch, which of whole texts takes tens of MB on either side of
    each task, sets BATCH_ROWS. Other values are the caller's and stay."""
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at least one row and about ``limit`` bytes of ``column``; nulls read as empty."""
    for batch in batches:
        k = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(k)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)
    give_back()


def give_back() -> None:
    """Returns a worker's free memory to the system at a task's end: workers are kept for later tasks."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)
