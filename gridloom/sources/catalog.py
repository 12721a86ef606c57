"""Discovery of forecast files: listings are metadata scans, file contents are not read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions import keys as K

SUFFIX = ".grib2"


def listing(spark: SparkSession, path: str) -> DataFrame:
    """key, modified, length of all files below ``path``; fails where the path doesn't exist."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("key"), F.col("modificationTime").alias("modified"), "length")


def forecasts(objects: DataFrame) -> DataFrame:
    return objects.where(F.endswith("key", F.lit(SUFFIX)))


def latest(objects: DataFrame) -> DataFrame:
    """The newest forecast; of equally new ones that with the smallest key."""
    return forecasts(objects).orderBy(F.desc("modified"), F.asc("key")).limit(1)


def catalog(objects: DataFrame, default_date: str = "19700101") -> DataFrame:
    """Forecasts with date, run and lead time from their keys and names (YYYYMMDDHHMMSS-LEAD-STREAM-TYPE.grib2)."""
    name = K.base_name(F.col("key"))
    return forecasts(objects).select("key", "modified", *([c for c in ("length",) if c in objects.columns]), K.key_date(F.col("key"), default_date).alias("date"), K.key_run(F.col("key")).alias("run"), F.split_part(name, F.lit("-"), F.lit(2)).alias("lead"), F.substring(name, 1, 8).alias("name_date"))


def by_lead(objects: DataFrame) -> DataFrame:
    return catalog(objects).groupBy("lead", "name_date").agg(F.count("*").alias("n_files"))


def resolve(arguments: DataFrame, objects: DataFrame) -> DataFrame:
    """``arguments`` (key, prefix, date, run; blank where absent) with source_key: the key, else that of date and run, else the latest."""
    newest = latest(objects).select(F.col("key").alias("_latest"))
    dated = F.when(F.trim(F.coalesce("date", F.lit(""))) != "", K.candidate_key(F.coalesce("prefix", F.lit("")), F.trim("date"), K.normalize_run(F.col("run"))))
    out = arguments.join(F.broadcast(newest), F.lit(True), "left")  # one row
    return out.withColumn("source_key", K.or_default(F.col("key"), F.coalesce(dated, F.col("_latest")))).drop("_latest")


def download_key(date, run):
    """Key of a public archive's initial state."""
    return K.candidate_key(F.lit(""), date, run)


def sample(objects: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """n draws with replacement: draw, key. The draws depend on the seed only; files get a dense number by key within hash
    ranges, so no task orders all files."""
    files = forecasts(objects).select("key")
    parts = files.withColumn("part", F.substring(F.md5("key"), 1, 2))
    sizes = parts.groupBy("part").count().orderBy("part").collect()  # at most 256 rows
    total = sum(r["count"] for r in sizes)
    if not total:
        return files.select(F.lit(0).cast("long").alias("draw"), "key").limit(0)
    start, at = {}, 0
    for r in sizes:
        start[r["part"]], at = at, at + r["count"]
    offset = F.element_at(F.create_map(*[F.lit(x) for p in start.items() for x in p]), F.col("part"))
    numbered = parts.withColumn("no", F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1 + offset)
    number = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))), 1, 12), 16, 10).cast("long")
    draws = objects.sparkSession.range(n).select(F.col("id").alias("draw"), (number % total).alias("no"))
    return draws.join(numbered, "no").select("draw", "key")
