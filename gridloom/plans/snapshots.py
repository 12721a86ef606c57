"""Published rows in versions: readers see a source file's old state or its new one, never a part."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.plans import publish as P
from gridloom.plans.scratch import remove

_MANIFEST = "source_file string, version string, n_rows long"


class Snapshots:
    """Rows below ``base``: ``data/version=V`` has what one publication wrote, ``snapshots/N`` the version of each source file.

    A publication writes its rows under a version of its own, then a table of all source files' versions aside, and renames
    that to the next number: the one step by which readers see it. A reader takes the highest number when it plans, and
    that number's rows stay until ``vacuum``. What a crash leaves before the rename is in no snapshot; of two publications at a
    time the second to rename fails and may be run again. Source files are told by their whole key.
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs

    def _names(self, folder: str) -> list[str]:
        path = self.hadoop.Path(f"{self.base}/{folder}")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(x.getPath().getName() for x in files.listStatus(path)) if files.exists(path) else []

    def numbers(self) -> list[int]:
        return [int(x) for x in self._names("snapshots") if x.isdigit()]

    def manifest(self, number: int | None = None) -> DataFrame:
        """source_file, version and n_rows of a snapshot, the last if no number is given."""
        number = max(self.numbers(), default=0) if number is None else number
        if not number:
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.base}/snapshots/{number:012d}")

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a snapshot. Spark prunes versions and source files that are in none of its rows."""
        chosen = self.manifest(number).select(F.col("source_file").alias("_file"), F.col("version").alias("_version"))
        parts = ("version", *P.PARTITIONS)
        found = self.spark.read.parquet(f"{self.base}/data")
        kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields if f.name not in parts), *(f"`{c}` string" for c in parts)])
        rows = self.spark.read.schema(kinds).parquet(f"{self.base}/data")
        return rows.join(chosen, (F.col("source_file") == F.col("_file")) & (F.col("version") == F.col("_version")), "left_semi").drop("version")

    def publish(self, blocks: DataFrame) -> int:
        """Publishes merged blocks as the next snapshot and returns its number: their source files are replaced, others stay."""
        version, before = uuid.uuid4().hex, max(self.numbers(), default=0)
        P.publish_blocks(blocks, f"{self.base}/data/version={version}")
        new = P.block_manifest(blocks).select("source_file", F.lit(version).alias("version"), "n_rows")
        old = self.manifest(before).join(new.select("source_file"), "source_file", "left_anti").select("source_file", "version", "n_rows")
        aside = f"{self.base}/snapshots/_aside-{version}"
        old.unionByName(new).write.parquet(aside)
        try:
            self._rename(aside, f"{self.base}/snapshots/{before + 1:012d}")
        except Py4JJavaError as e:
            remove(self.spark, aside)
            remove(self.spark, f"{self.base}/data/version={version}")
            raise RuntimeError(f"snapshot {before + 1} is there already: another publication was first") from e
        return before + 1

    def _rename(self, source: str, target: str) -> None:
        """Fails where the target exists."""
        gateway = self.spark.sparkContext._gateway
        path = self.hadoop.Path(target)
        context = self.hadoop.FileContext.getFileContext(path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(self.hadoop.Path(source), path, gateway.new_array(gateway.jvm.org.apache.hadoop.fs.Options.Rename, 0))

    def vacuum(self, keep: int = 1) -> list[str]:
        """Deletes all snapshots but the last ``keep`` and the versions that none of these has, with what crashed publications left.
        To be run while nothing is published. Returns the versions deleted."""
        numbers = self.numbers()
        kept = numbers[-keep:]
        held = {r["version"] for n in kept for r in self.manifest(n).select("version").distinct().collect()}
        gone = [v for x in self._names("data") if (v := x.removeprefix("version=")) not in held and x.startswith("version=")]
        for name in self._names("snapshots"):
            if not name.isdigit() or int(name) not in kept:
                remove(self.spark, f"{self.base}/snapshots/{name}")
        for v in gone:
            remove(self.spark, f"{self.base}/data/version={v}")
        return gone
