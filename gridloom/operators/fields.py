"""Field blocks: one row for each cycle, variable and level, with the grid's values in an array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = (1000, 925, 850, 700, 600, 500, 400, 300, 250, 200, 150, 100, 50)
SURFACE, UPPER_RAW, UPPER = ("msl", "u10", "v10", "t2m"), ("q", "t", "u", "v"), ("z", "q", "t", "u", "v")
DROPPED = ("heightAboveGround", "meanSea", "entireAtmosphere", "soilLayer")
GRAVITY = 9.80665


def missing(c: Column) -> Column:
    """NaN as null, which built-in aggregates skip."""
    return F.when(~F.isnan(c), c)


def drop_coords(blocks: DataFrame) -> DataFrame:
    return blocks.drop(*DROPPED)


def squeeze(blocks: DataFrame, keys: list[str], coordinate: str) -> DataFrame:
    """keys, n_labels, ok: whether the coordinate has one label in each field, so that it can be dropped."""
    return blocks.groupBy(*keys).agg(F.count_distinct(coordinate).alias("n_labels")).withColumn("ok", F.col("n_labels") <= 1)


def first_wins(blocks: DataFrame, keys: list[str] = ["cycle", "variable"]) -> DataFrame:  # noqa: B006
    """A variable comes whole from the dataset with the lowest ordinal that has it."""
    lowest = F.min("dataset_ord").over(Window.partitionBy(*keys))
    return blocks.withColumn("_low", lowest).where(F.col("dataset_ord") == F.col("_low")).drop("_low")


def geopotential(blocks: DataFrame) -> DataFrame:
    """gh as z, multiplied in single precision."""
    g = F.lit(GRAVITY).cast("float")
    values = F.when(F.col("variable") == "gh", F.transform("values", lambda x: x * g)).otherwise(F.col("values"))
    return blocks.withColumn("values", values).withColumn("variable", F.when(F.col("variable") == "gh", "z").otherwise(F.col("variable")))


def level_order() -> Column:
    return F.array(*[F.lit(float(x)) for x in LEVELS])


def select_levels(blocks: DataFrame) -> DataFrame:
    """Blocks on the listed levels with level_idx, their place in the list."""
    at = F.array_position(level_order(), F.col("level")).cast("int")
    return blocks.where(F.col("level").isin(*[float(x) for x in LEVELS])).withColumn("level_idx", at - 1)


def completeness(blocks: DataFrame, surface: tuple[str, ...] = SURFACE, upper: tuple[str, ...] = ("gh", *UPPER_RAW)) -> DataFrame:
    """cycle, n_fields, missing (sorted names) and complete: strict selection of variables and levels needs them all."""
    name = F.when(F.col("level").isNull(), F.col("variable")).otherwise(F.concat_ws("@", "variable", F.col("level").cast("int").cast("string")))
    want = F.array(*[F.lit(x) for x in (*surface, *(f"{v}@{p}" for v in upper for p in LEVELS))])
    out = blocks.groupBy("cycle").agg(F.collect_set(name).alias("have"))
    lost = F.array_sort(F.array_except(want, "have"))
    return out.select("cycle", F.size(F.array_intersect("have", want)).cast("long").alias("n_fields"), F.array_join(lost, ",").alias("missing"), (F.size(lost) == 0).alias("complete"))


def complete_only(blocks: DataFrame) -> DataFrame:
    good = completeness(blocks).where("complete").select("cycle")
    return blocks.join(good, "cycle", "left_semi")


def require_complete(blocks: DataFrame) -> DataFrame:
    """Fails at the first action where a cycle lacks a field, naming it."""
    bad = completeness(blocks)
    text = F.concat(F.lit("cycle "), F.col("cycle").cast("string"), F.lit(" lacks "), F.col("missing"))
    ok = bad.select("cycle", F.when(F.col("complete"), True).otherwise(F.raise_error(text).cast("boolean")).alias("_ok"))
    return blocks.join(ok, "cycle").where("_ok").drop("_ok")


def cells(blocks: DataFrame) -> DataFrame:
    """One row for each grid point: pos, latitude, longitude and value instead of the arrays."""
    n = F.size("lons")
    out = blocks.select("*", F.posexplode("values").alias("pos", "value"))
    out = out.withColumn("latitude", F.get("lats", F.floor(F.col("pos") / n).cast("int"))).withColumn("longitude", F.get("lons", F.col("pos") % n))
    return out.withColumn("value", missing(F.col("value"))).drop("values", "lats", "lons")


def box_cells(blocks: DataFrame, south: float, north: float, west: float, east: float) -> DataFrame:
    """``cells`` of the points in a box, its edges included: only these are exploded, picked by their rows and columns."""
    n = F.size("lons")
    places = lambda labels, low, high: F.filter(F.sequence(F.lit(0), F.size(labels) - 1), lambda i: F.get(labels, i).between(low, high))
    inside = F.flatten(F.transform(places("lats", south, north), lambda i: F.transform(places("lons", west, east), lambda j: i * n + j)))
    out = blocks.where((F.size("lats") > 0) & (n > 0)).select("*", F.explode(inside).alias("pos")).withColumn("value", missing(F.get("values", F.col("pos"))))
    out = out.withColumn("latitude", F.get("lats", F.floor(F.col("pos") / n).cast("int"))).withColumn("longitude", F.get("lons", F.col("pos") % n))
    return out.drop("values", "lats", "lons")


def regular_grid(blocks: DataFrame) -> DataFrame:
    """Blocks of reduced grids (``row_points``: points of each row, from 0 degrees around the globe) on a regular grid with as
    many longitudes as the longest row has; others, with null, stay as they are. Without the column nothing changes.

    Values between two points of a row are weighted by distance; the last point's neighbour is the first. A missing
    neighbour with a weight makes a missing value."""
    if "row_points" not in blocks.columns:
        return blocks
    points = F.col("row_points")
    n = F.array_max(points)
    start = F.transform(points, lambda p, i: F.aggregate(F.slice(points, 1, i), F.lit(0), lambda a, x: a + x))

    def point(p: Column, first: Column, j: Column) -> Column:
        at = j.cast("double") * p / n
        left = F.floor(at)
        weight = at - left
        a = F.get("values", (first + left % p).cast("int"))
        b = F.get("values", (first + (left + 1) % p).cast("int"))
        return F.when(weight == 0, a).otherwise((a + (b - a) * weight).cast("float"))

    row = lambda p, i: F.transform(F.sequence(F.lit(0), n - 1), lambda j: point(p, F.get(start, i), j))
    values = F.when(points.isNotNull(), F.flatten(F.transform(points, row))).otherwise(F.col("values"))
    lons = F.when(points.isNotNull(), F.transform(F.sequence(F.lit(0), n - 1), lambda j: j * F.lit(360.0) / n)).otherwise(F.col("lons"))
    return blocks.withColumn("values", values).withColumn("lons", lons).drop("row_points")


def align(cells_: DataFrame, keys: list[str] = ["cycle"]) -> DataFrame:  # noqa: B006
    """All variables and levels of a cycle on the union of its grid points, null where a dataset has none.

    Both sides of the product are distinct labels of one cycle, joined by cycle: the result is the dense grid itself.
    """
    points = cells_.select(*keys, "latitude", "longitude").distinct()
    names = cells_.select(*keys, "variable", "level").distinct()
    grid = points.join(names, keys)
    held = cells_.select(*keys, "variable", "level", "latitude", "longitude", "value")
    same = [F.col(f"g.{c}").eqNullSafe(F.col(f"h.{c}")) for c in (*keys, "variable", "level", "latitude", "longitude")]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return grid.alias("g").join(held.alias("h"), on, "left").select(*[F.col(f"g.{c}").alias(c) for c in (*keys, "variable", "level", "latitude", "longitude")], "h.value")


def align_blocks(blocks: DataFrame, keys: list[str] = ["cycle"]) -> DataFrame:  # noqa: B006
    """All blocks of a cycle on the union of its grids (rows from the north, columns from the least longitude), null where a
    block has no value. Labels match to a millionth of a degree.

    Works at block grain: a cycle's grids are gathered as distinct label arrays, one where all agree, and then the blocks
    pass unchanged; cells never cross a shuffle."""
    micro = lambda c: F.transform(c, lambda x: F.round(x * 1_000_000).cast("long"))
    union = lambda c: F.array_distinct(F.flatten(F.collect_set(micro(F.col(c)))))
    one = lambda c: F.count_distinct(c) == 1
    grids = blocks.groupBy(*keys).agg(union("lats").alias("_lats"), union("lons").alias("_lons"), (one("lats") & one("lons")).alias("_same"))
    out = blocks.join(grids, keys).withColumn("_lats", F.sort_array("_lats", asc=False)).withColumn("_lons", F.sort_array("_lons"))
    out = out.withColumn("_own_lats", micro("lats")).withColumn("_own_lons", micro("lons")).withColumn("_n", F.size("lons"))
    out = out.withColumn("_row", F.transform("_lats", lambda x: F.array_position("_own_lats", x))).withColumn("_column", F.transform("_lons", lambda x: F.array_position("_own_lons", x)))
    cell = lambda i, j: F.when((i > 0) & (j > 0), F.get("values", ((i - 1) * F.col("_n") + j - 1).cast("int")))
    lats, lons = F.col("_lats"), F.col("_lons")
    values = F.flatten(F.transform("_row", lambda i: F.transform("_column", lambda j: cell(i, j))))
    degrees = lambda c: F.transform(c, lambda x: x / 1_000_000)
    moved = lambda new, old: F.when(F.col("_same"), F.col(old)).otherwise(new).alias(old)
    new = {"values": moved(values, "values"), "lats": moved(degrees(lats), "lats"), "lons": moved(degrees(lons), "lons")}
    return out.select(*[new.get(c, F.col(c)) for c in blocks.columns])


def lat_descending(blocks: DataFrame) -> DataFrame:
    """Grid rows from north to south; nothing changes where they are already."""
    n, rows = F.size("lons"), F.size("lats")
    order = F.transform(F.array_sort(F.transform("lats", lambda x, i: F.struct((-x).alias("k"), i.alias("i")))), lambda s: s.i)
    turned = F.flatten(F.transform(order, lambda i: F.slice("values", i * n + 1, n)))
    down = F.forall(F.sequence(F.lit(1), F.greatest(rows - 1, F.lit(1))), lambda i: F.coalesce(F.get("lats", i) < F.get("lats", i - 1), F.lit(True)))
    return blocks.withColumn("values", F.when(down, F.col("values")).otherwise(turned)).withColumn("lats", F.sort_array("lats", asc=False))
