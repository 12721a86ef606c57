"""Tidy tables, rasters and tensors from field blocks; cells are exploded last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators import fields as B

COLUMNS = ("isobaricInhPa", "latitude", "longitude", "variable", "value", "date", "run")


def long_form(blocks: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The tidy columns of all blocks; surface rows have no level."""
    return B.cells(blocks).select(*extra, F.col("level").cast("double").alias("isobaricInhPa"), "latitude", "longitude", "variable", F.col("value").cast("float").alias("value"), "date", "run")


def surface(blocks: DataFrame, variables: tuple[str, ...] = B.SURFACE, extra: tuple[str, ...] = ()) -> DataFrame:
    return long_form(blocks.where(F.col("level").isNull() & F.col("variable").isin(*variables)), extra)


def upper(blocks: DataFrame, variables: tuple[str, ...] = B.UPPER, extra: tuple[str, ...] = ()) -> DataFrame:
    chosen = B.geopotential(B.select_levels(blocks)).where(F.col("variable").isin(*variables))
    return long_form(chosen, extra)


def consolidated(blocks: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return surface(blocks, extra=extra).unionByName(upper(blocks, extra=extra))


def chosen(blocks: DataFrame) -> DataFrame:
    """The blocks of ``consolidated`` rows: surface variables and, on the listed levels, upper ones with geopotential."""
    levels = F.col("level").isin(*[float(x) for x in B.LEVELS])
    low = F.col("level").isNull() & F.col("variable").isin(*B.SURFACE)
    return B.geopotential(blocks.where(low | (levels & F.col("variable").isin("gh", *B.UPPER))))


def coerce(value: Column) -> Column:
    """Numbers in single precision; what is no number is null."""
    return B.missing(value.try_cast("double").cast("float"))


def broadcast_long(blocks: DataFrame) -> DataFrame:
    """Every variable on every level: surface fields are repeated on each level of their cycle, at block grain."""
    levels = blocks.where("level is not null").select("cycle", F.col("level").alias("_level")).distinct()
    flat = blocks.where("level is null").join(levels, "cycle").withColumn("level", F.col("_level")).drop("_level")
    return B.cells(blocks.where("level is not null").unionByName(flat))


def unpivot(wide: DataFrame, ids: list[str], variables: list[str]) -> DataFrame:
    return wide.unpivot(ids, variables, "variable", "value")


def duplicates(cells: DataFrame, keys: list[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def raster(cells: DataFrame, longitudes: list[float], label=lambda x: f"lon_{x:g}", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row a latitude of each field, one column a longitude; a point that occurs twice in a field is an error. ``keys`` tell fields apart."""
    columns = [F.when(F.count(F.when(F.col("longitude") == x, 1)) > 1, F.raise_error(F.lit("duplicate cell")).cast("float")).otherwise(F.max(F.when(F.col("longitude") == x, F.col("value")))).alias(label(x)) for x in longitudes]
    return cells.groupBy(*keys, "latitude").agg(*columns).orderBy(*keys, F.desc("latitude"))


def raster_blocks(blocks: DataFrame, longitudes: list[float], label=lambda x: f"lon_{x:g}", keys: tuple[str, ...] = ()) -> DataFrame:
    """The same from blocks, without an aggregate: rows are sliced from the values and put in the order of ``longitudes``, which
    is looked up once a block. A grid that has a label twice is an error."""
    twice = (F.size(F.array_distinct("lats")) < F.size("lats")) | (F.size(F.array_distinct("lons")) < F.size("lons"))
    at = F.transform(F.array(*[F.lit(float(x)) for x in longitudes]), lambda x: F.array_position("lons", x).cast("int"))
    at = F.when(twice, F.raise_error(F.lit("duplicate cell")).cast("array<int>")).otherwise(at)
    rows = blocks.withColumn("_at", at).withColumn("_n", F.size("lons")).select(*keys, "_at", "_n", "values", F.posexplode("lats").alias("_row", "latitude"))
    own = F.transform("_at", lambda j: F.when(j > 0, F.get("values", F.col("_row") * F.col("_n") + j - 1)))
    rows = rows.select(*keys, "latitude", own.alias("_own"))
    columns = [B.missing(F.get("_own", i)).alias(label(x)) for i, x in enumerate(longitudes)]
    return rows.select(*keys, "latitude", *columns).orderBy(*keys, F.desc("latitude"))


def tensors(blocks: DataFrame) -> DataFrame:
    """cycle, date, run, lead (if there is one), tensor, channel, level_idx, n_lat, n_lon, values: blocks in the models' order, rows from the north."""
    blocks = B.lat_descending(blocks)
    lead = ["lead"] if "lead" in blocks.columns else []
    keep = ["cycle", "date", "run", *lead, "tensor", "channel", "level_idx", F.size("lats").alias("n_lat"), F.size("lons").alias("n_lon"), "values"]
    order = lambda names: (F.array_position(F.array(*map(F.lit, names)), F.col("variable")) - 1).cast("int")
    low = blocks.where(F.col("level").isNull() & F.col("variable").isin(*B.SURFACE)).withColumn("tensor", F.lit("surface")).withColumn("channel", order(B.SURFACE)).withColumn("level_idx", F.lit(None).cast("int"))
    high = B.geopotential(B.select_levels(blocks)).where(F.col("variable").isin(*B.UPPER)).withColumn("tensor", F.lit("upper")).withColumn("channel", order(B.UPPER))
    return low.select(*keep).unionByName(high.select(*keep))


def tensor_shape(tensors_: DataFrame) -> DataFrame:
    return tensors_.groupBy("cycle", "tensor").agg(F.count_distinct("channel").alias("n_channel"), F.count_distinct("level_idx").alias("n_level"), F.max("n_lat").alias("n_lat"), F.max("n_lon").alias("n_lon"))
