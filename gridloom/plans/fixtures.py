"""The given tables as forecast blocks, object listings and samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import fields as B

NAMES = ("gh", *B.UPPER_RAW)


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as fields on an 8 x 8 grid, 69 a cycle: four surface fields, then five variables on 13 levels."""
    f, v = F.col("vec_id") % 69, F.col("vec_id")
    cycle = F.floor(v / 69)
    surface = f < 4
    at = (f - 4).cast("int")
    variable = F.when(surface, F.get(F.array(*map(F.lit, B.SURFACE)), f.cast("int"))).otherwise(F.get(F.array(*map(F.lit, NAMES)), F.floor(at / 13).cast("int")))
    level = F.when(~surface, F.get(B.level_order(), at % 13))
    runs = F.array(*map(F.lit, ("00z", "06z", "12z", "18z")))
    grid = lambda a, b: F.array(*[F.lit(a + b * i) for i in range(8)])
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", cycle.alias("cycle"), variable.alias("variable"), level.alias("level"), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.floor(cycle / 4).cast("int")), "yyyyMMdd").alias("date"), F.get(runs, (cycle % 4).cast("int")).alias("run"),
        grid(90.0, -25.0).alias("lats"), grid(0.0, 45.0).alias("lons"), F.col("embedding").alias("values"), F.concat(F.lit("cycle-"), cycle.cast("string"), F.lit(".grib2")).alias("source_file"),
    )


def large_blocks(spark: SparkSession, sf_dir: str, n_lat: int = 721, n_lon: int = 1440) -> DataFrame:
    """The first cycle on a grid of the real size: its fields' 8 x 8 values, stretched."""
    first = blocks(spark, sf_dir).where("cycle = 0").repartition(16)
    kind = first.schema

    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, columns = np.linspace(0, 7, n_lat), np.linspace(0, 7, n_lon)
        lats, lons = np.linspace(90.0, -90.0, n_lat).tolist(), (np.arange(n_lon) * 360.0 / n_lon).tolist()
        for batch in batches:
            for row in batch.to_pylist():
                small = np.array(row["values"], np.float64).reshape(8, 8)
                down = np.array([np.interp(rows, range(8), small[:, j]) for j in range(8)]).T
                wide = np.array([np.interp(columns, range(8), line) for line in down]).astype(np.float32).reshape(-1)
                out = pa.RecordBatch.from_pylist([row | {"lats": lats, "lons": lons, "values": []}], schema=batch.schema)
                at = batch.schema.get_field_index("values")
                flat = pa.ListArray.from_arrays(pa.array([0, len(wide)], pa.int32()), pa.array(wide))
                yield pa.RecordBatch.from_arrays([flat if i == at else c for i, c in enumerate(out.columns)], names=batch.schema.names)

    return first.mapInArrow(stretch, kind)


def named_files(fields: DataFrame) -> DataFrame:
    """With the names that forecast files have."""
    return fields.withColumn("source_file", F.concat("date", F.substring("run", 1, 2), F.lit("0000-0h-oper-fc.grib2")))


def overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset 0 lacks a third of the variables and the northmost row of vec_id % 5 = 0; dataset 1 has all, negated."""
    base = blocks(spark, sf_dir)
    number = F.array_position(F.array(*map(F.lit, (*B.SURFACE, *NAMES))), F.col("variable"))
    zero = base.where(number % 3 != 0).withColumn("dataset_ord", F.lit(0))
    cut = F.col("vec_id") % 5 == 0
    zero = zero.withColumn("values", F.when(cut, F.slice("values", 9, 56)).otherwise(F.col("values"))).withColumn("lats", F.when(cut, F.slice("lats", 2, 7)).otherwise(F.col("lats")))
    one = base.withColumn("dataset_ord", F.lit(1)).withColumn("values", F.transform("values", lambda x: -x))
    return zero.unionByName(one)


def dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cycle dealt to three files: the first as dataset 0 of ``overlapping``, the second with every other variable,
    negated, the third with all, doubled."""
    first = overlapping(spark, sf_dir).where("dataset_ord = 0").drop("dataset_ord")
    base = blocks(spark, sf_dir)
    number = F.array_position(F.array(*map(F.lit, (*B.SURFACE, *NAMES))), F.col("variable"))
    times = lambda df, k: df.withColumn("values", F.transform("values", lambda x: (x * F.lit(float(k))).cast("float")))
    name = lambda df, k: df.withColumn("source_file", F.concat("date", F.substring("run", 1, 2), F.lit(f"0000-0h-oper-f{k}.grib2")))
    return name(first, 0).unionByName(name(times(base.where(number % 2 == 0), -1), 1)).unionByName(name(times(base, 2), 2))


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as objects of a listing, some without a run in the key, some no forecasts."""
    hour = F.lpad((F.floor(F.hour("ts") / 6) * 6).cast("string"), 2, "0")
    day = F.date_format("ts", "yyyyMMdd")
    run = F.when(F.col("event_id") % 7 == 0, "latest").otherwise(F.concat(hour, F.lit("z")))
    suffix = F.when(F.col("event_id") % 5 == 0, ".idx").otherwise(".grib2")
    name = F.concat(day, hour, F.lit("0000-"), (F.col("event_id") % 4 * 6).cast("string"), F.lit("h-oper-fc-"), F.col("event_id").cast("string"), suffix)
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.concat_ws("/", F.lit("ecmwf"), day, run, name).alias("key"), F.col("ts").alias("modified"))


def surface_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").alias("lat"), F.col("l_linenumber").alias("lon"), F.col("l_quantity").alias("msl"), F.col("l_extendedprice").alias("u10"), F.col("l_discount").alias("v10"), F.col("l_tax").alias("t2m"))


FIELDS_SQL = """
b0 AS (SELECT vec_id, vec_id // 69 AS cycle, vec_id % 69 AS f, embedding FROM embeddings),
b AS (SELECT vec_id, cycle, CASE WHEN f < 4 THEN ['msl','u10','v10','t2m'][f + 1] ELSE ['gh','q','t','u','v'][(f - 4) // 13 + 1] END AS variable,
      CASE WHEN f >= 4 THEN CAST([1000,925,850,700,600,500,400,300,250,200,150,100,50][(f - 4) % 13 + 1] AS DOUBLE) END AS level,
      strftime(DATE '2024-01-01' + CAST(cycle // 4 AS INTEGER), '%Y%m%d') AS date, ['00z','06z','12z','18z'][cycle % 4 + 1] AS run,
      'cycle-' || cycle || '.grib2' AS source_file, embedding FROM b0),
c AS (SELECT * EXCLUDE embedding, 90.0::DOUBLE - 25 * (pos // 8) AS latitude, 45.0::DOUBLE * (pos % 8) AS longitude FROM (SELECT *, unnest(embedding)::FLOAT AS value, unnest(range(64)) AS pos FROM b)),
full_ AS (SELECT cycle FROM b GROUP BY cycle HAVING count(*) = 69),
z AS (SELECT * REPLACE (CASE WHEN variable = 'gh' THEN 'z' ELSE variable END AS variable, CASE WHEN variable = 'gh' THEN (value * 9.80665::FLOAT)::FLOAT ELSE value END AS value) FROM c)"""
OBJECTS_SQL = """
o0 AS (SELECT event_id, ts, strftime(ts, '%Y%m%d') AS day, lpad(CAST(hour(ts) // 6 * 6 AS VARCHAR), 2, '0') AS hh FROM events),
o AS (SELECT event_id, 'ecmwf/' || day || '/' || CASE WHEN event_id % 7 = 0 THEN 'latest' ELSE hh || 'z' END || '/' || day || hh || '0000-' || (event_id % 4 * 6) || 'h-oper-fc-' || event_id ||
      CASE WHEN event_id % 5 = 0 THEN '.idx' ELSE '.grib2' END AS key, ts AS modified FROM o0),
g AS (SELECT *, coalesce(nullif(regexp_extract(key, '(20\\d{6})', 1), ''), '19700101') AS date, coalesce(nullif(regexp_extract(lower(key), '/(00z|06z|12z|18z)/', 1), ''), '00z') AS run,
      string_split(key, '/')[-1] AS name FROM o)""".replace("\\\\", "\\")
