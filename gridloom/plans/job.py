"""The forecast job: files are decoded, merged, checked, published as tidy partitions and tensors, and listed in a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import keys as K
from gridloom.operators import fields as B
from gridloom.operators import quality as Q
from gridloom.operators import tidy as T
from gridloom.plans import publish as P
from gridloom.plans.scratch import Scratch, kept
from gridloom.sources import grib


def run(spark: SparkSession, source: str, base: str, tensor_base: str | None = None, default_date: str = "19700101", codecs: dict[str, str] | None = None) -> DataFrame:
    """Publishes all GRIB2 files below ``source`` to ``base`` (and tensors to ``tensor_base``) and returns the manifest.
    ``codecs`` decode packings that the library doesn't (``grib.fields``)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.grib2").load(source)
    root = grib.qualified(spark, source)
    return _publish(_listed(files, default_date, root), _keyed(grib.read_fields(spark, source, default_date, codecs=codecs), root), base, tensor_base)


def publish_files(files: DataFrame, base: str, tensor_base: str | None = None, default_date: str = "19700101", root: str = "") -> DataFrame:
    """The same for ``files`` (path, content) below ``root``: a file's partition is replaced, others stay.

    A file is told by its key, its path below ``root``, so equal names in two folders don't meet.
    manifest: one row a file with date, run, lead, n_fields, missing, n_errors (fields that couldn't be decoded), n_rows,
    n_values, n_variables, bytes and status: ok; incomplete, if a field lacks: then nothing of the file is published.
    """
    return _publish(_listed(files, default_date, root), _keyed(grib.decode(files, default_date, root=root), root), base, tensor_base)


def publish_cycles(fields: DataFrame, base: str, tensor_base: str | None = None, each: tuple[str, ...] = ("variable", "level")) -> DataFrame:
    """The same for the fields of several files, published by cycle: all files of one date, run and lead are one source,
    ``DATE/RUN/LEAD``. Of files that have the same field (or variable, as ``each`` tells) the one with the least key gives it."""
    with Scratch(fields.sparkSession) as scratch:
        # decoded once: the order of the files, the list and the merge read these
        fields = grib.by_cycle(scratch.keep(fields, "files"))
        listed = fields.select("source_file", "date", "run", "lead").distinct()
        return _publish(listed, fields, base, tensor_base, each)


def _keyed(fields: DataFrame, root: str) -> DataFrame:
    return fields.withColumn("source_file", K.relative_key(F.col("source_file"), root))


def _listed(files: DataFrame, default_date: str, root: str) -> DataFrame:
    date, run = K.path_date_run(F.col("path"), root, default_date)
    lead = F.split_part(K.base_name(F.col("path")), F.lit("-"), F.lit(2))
    return files.select(K.relative_key(F.col("path"), root).alias("source_file"), date.alias("date"), run.alias("run"), lead.alias("lead"))


def _publish(listed: DataFrame, fields: DataFrame, base: str, tensor_base: str | None, each: tuple[str, ...] = ("variable",)) -> DataFrame:
    spark = fields.sparkSession
    with Scratch(spark) as scratch:
        # decoded once, and merged once: the checks, the rows, the tensors and the manifest read these
        blocks = scratch.keep(fields, "fields")
        whole = scratch.keep(B.complete_only(grib.merged(blocks, each)), "merged")
        P.publish_blocks(whole, base)
        if tensor_base:
            P.export_npy(T.tensors(whole), tensor_base)
        return kept(_manifest(listed, blocks, whole, base), "manifest")


def _manifest(listed: DataFrame, blocks: DataFrame, whole: DataFrame, base: str) -> DataFrame:
    spark = listed.sparkSession
    errors = blocks.groupBy("source_file").agg(F.count(F.when(F.col("decode_error").isNotNull(), 1)).alias("n_errors"))
    fields = B.completeness(blocks.where("decode_error is null").withColumn("cycle", F.col("source_file"))).withColumnRenamed("cycle", "source_file")
    rows = P.block_manifest(whole)
    out = listed.join(errors, "source_file", "left").join(fields, "source_file", "left").join(rows, "source_file", "left")
    runs = [tuple(r) for r in whole.select("date", "run").distinct().collect()]  # of what was published just now
    if runs:
        out = out.join(P.published_bytes(spark, base, runs), "source_file", "left")
    else:
        out = out.withColumn("bytes", F.lit(0))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    good = F.coalesce("complete", F.lit(False))
    return out.select("source_file", "date", "run", "lead", zero("n_fields"), F.coalesce("missing", F.lit("all")).alias("missing"), zero("n_errors"),
                      zero("n_rows"), zero("n_values"), zero("n_variables"), F.when(good, F.coalesce("bytes", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("bytes"), F.when(good, "ok").otherwise("incomplete").alias("status"))


def verify(source: DataFrame, published: DataFrame, fields: tuple[tuple[str, float | None], ...] = (("t2m", None), ("z", 500.0))) -> DataFrame:
    """source_file, variable, level and the comparison of published rows with the source's blocks, for each of ``fields``.

    Both sides are compared by digests of their fields; only fields that differ are compared cell by cell. A field that a
    source file lacks, or of which no row was published, is an error at the first action."""
    keys = ["source_file", "variable", "isobaricInhPa"]
    named = B.geopotential(source).withColumn("isobaricInhPa", F.col("level").cast("double"))
    asked = F.array(*[F.struct(F.lit(v).alias("variable"), F.lit(x).cast("double").alias("isobaricInhPa")) for v, x in fields])
    one = F.lit(False)  # plain comparisons, which reach the scan of the published files
    for variable, level in fields:
        one = one | ((F.col("variable") == variable) & (F.col("isobaricInhPa").isNull() if level is None else F.col("isobaricInhPa") == float(level)))
    chosen = named.where(one)
    report = kept(Q.compare(T.long_form(chosen.drop("isobaricInhPa"), ("source_file",)), published.where(one), keys), "comparison")
    wanted = named.select("source_file").distinct().select("source_file", F.explode(asked).alias("f")).select("source_file", "f.variable", "f.isobaricInhPa")
    held = published.where(one).select(*keys).distinct().withColumn("published", F.lit(True))
    out = wanted.alias("w").join(report.alias("r"), Q._matched("w", "r", keys), "left").join(held.alias("h"), Q._matched("w", "h", keys), "left")
    lacks = F.raise_error(F.concat(F.lit("nothing published for "), F.col("w.variable"), F.lit(" of "), F.col("w.source_file")))
    absent = F.raise_error(F.concat(F.lit("no field "), F.col("w.variable"), F.lit(" in "), F.col("w.source_file")))
    status = F.when(F.col("r.n").isNull() & F.col("h.published").isNull(), absent).when(F.col("h.published").isNull(), lacks).otherwise(F.col("r.status"))
    return out.select(*[F.col(f"w.{c}").alias(c) for c in keys], *[F.col(f"r.{c}") for c in report.columns if c not in (*keys, "status")], status.alias("status"))


def write_files(blocks: DataFrame, base: str, packing: str = "ieee", scale: int = -16) -> DataFrame:
    """Writes a GRIB2 file for each source_file of ``blocks`` (at most 69 fields) below ``base``: path. Packings are those of
    ``grib.encode``."""
    import pandas as pd

    base = grib.qualified(blocks.sparkSession, base)

    def write(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame.iloc[0]
        path = f"{base}/{first['date']}/{first['run']}/{first['source_file']}"
        files, local = grib.store(path)
        files.create_dir(local.rsplit("/", 1)[0])
        points = "row_points" in frame.columns
        with files.open_output_stream(local, compression=None) as f:
            for row in frame.itertuples():
                reduced = list(row.row_points) if points and row.row_points is not None else None
                f.write(grib.encode(row.variable, None if pd.isna(row.level) else row.level, list(row.lats), None if reduced else list(row.lons), row.values_, packing, scale, reduced))
        return pd.DataFrame({"path": [path]})

    return blocks.withColumnRenamed("values", "values_").groupBy("source_file").applyInPandas(write, "path string")
