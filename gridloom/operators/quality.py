"""Verification of published cells, reductions and sample statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.plans.scratch import kept

DRIFT = 1e-4


def grid_diff(source: DataFrame, published: DataFrame, keys: list[str]) -> DataFrame:
    """keys, latitude, longitude, src, out, diff and mismatch (a side is missing); coordinates match to a millionth of a degree,
    null keys each other."""
    micro = lambda c: F.round(F.col(c) * 1_000_000).cast("long").alias(f"_{c}")
    side = lambda df, name: df.select(*keys, micro("latitude"), micro("longitude"), F.col("value").alias(name), F.lit(True).alias(f"_{name}"))
    at = [*keys, "_latitude", "_longitude"]
    both = side(source, "src").alias("s").join(side(published, "out").alias("o"), _matched("s", "o", at), "full_outer")
    both = both.select(*[F.coalesce(F.col(f"s.{c}"), F.col(f"o.{c}")).alias(c) for c in at], "src", "out", "_src", "_out")
    degrees = lambda c: (F.col(f"_{c}") / 1_000_000).alias(c)
    return both.select(*keys, degrees("latitude"), degrees("longitude"), "src", "out", F.abs(F.col("src") - F.col("out")).alias("diff"), (F.col("_src").isNull() | F.col("_out").isNull()).alias("mismatch"))


_MICRO = 1_000_000


def digests(cells: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key: n, held, total, low, high and a digest of its cells, in any order. Cells are summed up in their tasks; what crosses
    the network is a row for each key and task.

    The digest is the exclusive or of a 64-bit hash of every cell and the sum of another one: cells that differ, lack or
    occur twice change it. Coordinates count to a millionth of a degree, values by their bits."""
    micro = lambda c: F.round(F.col(c) * _MICRO).cast("long")
    cell = [micro("latitude"), micro("longitude"), F.col("value").cast("float"), F.col("value").isNull()]
    value = F.col("value").cast("double")
    rows = cells.select(*keys, value.alias("_v"), F.xxhash64(*cell).alias("_a"), F.xxhash64(F.lit(1), *cell).alias("_b"))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count("_v").alias("held"), F.sum("_v").alias("total"), F.min("_v").alias("low"), F.max("_v").alias("high"), F.bit_xor("_a").alias("mixed"), F.sum(F.shiftrightunsigned("_b", 32)).alias("summed")
    )


def compare(source: DataFrame, published: DataFrame, keys: list[str]) -> DataFrame:
    """``report`` of the difference of two tables of cells. Keys whose digests agree are told equal by them; only the cells of
    the others are matched one by one. Where all agree, no cell crosses the network.

    The digests of both sides, a row a key, are computed at once and kept in the shared folder."""
    on = _matched("s", "o", keys)
    both = digests(source, keys).alias("s").join(digests(published, keys).alias("o"), on, "full_outer")
    same = F.lit(True)
    for c in ("n", "held", "mixed", "summed"):
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"o.{c}"))
    both = both.select(*[F.coalesce(F.col(f"s.{c}"), F.col(f"o.{c}")).alias(c) for c in keys], same.alias("same"), F.col("s.n").alias("n"), F.col("s.held").alias("held"), F.col("s.total").alias("total"))
    both = kept(both, "digests")
    mean = F.col("total") / F.col("held")
    drift = F.when(F.col("held") > 0, F.lit(0.0))
    equal = both.where("same").select(*keys, "n", mean.alias("src_mean"), mean.alias("out_mean"), drift.cast("float").alias("max_abs_diff"), F.lit(0).cast("long").alias("n_mismatch"), drift.alias("mean_drift"), F.when(F.col("held") > 0, "ok").otherwise("no_data").alias("status"))
    unlike = both.where("not same").select(*keys)
    if unlike.isEmpty():
        return equal
    only = lambda df, name: df.alias("x").join(unlike.alias(name), _matched("x", name, keys), "left_semi")
    return equal.unionByName(report(grid_diff(only(source, "u"), only(published, "w"), keys), keys))


def _matched(a: str, b: str, keys: list[str]) -> Column:
    on = F.lit(True)
    for c in keys:
        on = on & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return on


def report(diff: DataFrame, keys: list[str]) -> DataFrame:
    """Means, drift, largest difference and status; keys without any value report no_data, an empty filter no rows."""
    out = diff.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(F.col("src").cast("double")).alias("src_mean"), F.avg(F.col("out").cast("double")).alias("out_mean"), F.max("diff").alias("max_abs_diff"), F.count(F.when(F.col("mismatch"), 1)).alias("n_mismatch"))
    drift = F.abs(F.col("src_mean") - F.col("out_mean"))
    status = F.when(drift.isNull(), "no_data").when(F.col("n_mismatch") > 0, "shape").when(drift > DRIFT, "drift").otherwise("ok")
    return out.withColumn("mean_drift", drift).withColumn("status", status)


@lru_cache
def t_table(most: int = 120) -> tuple[float, ...]:
    """Two-sided 95 % points of Student's t for 1 to ``most`` degrees of freedom, by bisection of the closed form."""

    def inside(t: float, df: int) -> float:
        angle = math.atan(t / math.sqrt(df))
        c, term, total = math.cos(angle), 1.0, 0.0
        if df % 2:
            term = c
            for j in range(3, df + 1, 2):
                total += term
                term *= c * c * (j - 1) / j
            return 2 / math.pi * (angle + math.sin(angle) * total)
        for j in range(2, df + 1, 2):
            total += term
            term *= c * c * (j - 1) / j
        return math.sin(angle) * total

    out = []
    for df in range(1, most + 1):
        low, high = 1.9, 13.0
        for _ in range(80):
            mid = (low + high) / 2
            low, high = (mid, high) if inside(mid, df) < 0.95 else (low, mid)
        out.append(round(low, 9))
    return tuple(out)


def t_critical(df: Column) -> Column:
    """From the table; above it the Cornish-Fisher expansion."""
    z = 1.959963984540054
    more = F.lit(z) + (z**3 + z) / 4 / df + (5 * z**5 + 16 * z**3 + 3 * z) / 96 / (df * df)
    return F.coalesce(F.get(F.array(*map(F.lit, t_table())), df.cast("int") - 1), more)


def sample_stats(samples: DataFrame, key: str, value: str) -> DataFrame:
    """mean, sample deviation, n and 95 % interval; one sample has deviation 0 and its mean as interval."""
    out = samples.groupBy(key).agg(F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"), F.count(value).alias("n"))
    half = F.when(F.col("n") > 1, t_critical(F.col("n").cast("double") - 1) * F.col("std") / F.sqrt("n")).otherwise(F.lit(0.0))
    return out.withColumn("ci_lower", F.col("mean") - half).withColumn("ci_upper", F.col("mean") + half)


def text_report(stats: DataFrame, key: str) -> DataFrame:
    """One fixed-width line a row."""
    return stats.select(key, F.format_string("%-16s %10d %14.3f %14.3f", F.col(key), F.col("n"), F.round("mean", 3), F.round("std", 3)).alias("line"))


def dim_mean(cells: DataFrame, keep: list[str]) -> DataFrame:
    return cells.groupBy(*keep).agg(F.avg(F.col("value").cast("double")).alias("mean"))


def write_report(stats: DataFrame, key: str, path: str) -> None:
    """The report as text below ``path``, its lines in the order of ``key``: one line for each method."""
    text_report(stats, key).orderBy(key).select("line").write.mode("overwrite").text(path)


#: Bytes of sums that a task holds before it sends them on.
HELD_BYTES = 256 << 20


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Element-wise sums and numbers of values of the blocks of a task, one row for each key, which is a JSON text."""
    sums: dict[str, list[np.ndarray]] = {}
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        nonlocal held
        for key in list(sums):
            total, n = sums.pop(key)
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([total.tobytes()]), pa.array([n.tobytes()])], names=["key", "total", "n"])
        held = 0

    for batch in batches:
        values, keys = batch.column(1), batch.column(0).to_pylist()
        flat, edge = values.values.to_numpy(zero_copy_only=False).astype(np.float64), values.offsets.to_numpy()
        for i, key in enumerate(keys):
            one = flat[edge[i] : edge[i + 1]]
            some = ~np.isnan(one)
            if key not in sums:
                sums[key] = [np.zeros(len(one)), np.zeros(len(one), np.int64)]
                held += 16 * len(one)
            sums[key][0] += np.where(some, one, 0.0)
            sums[key][1] += some
        if held > HELD_BYTES:
            yield from out()
    yield from out()


def _means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Means of the sums of all tasks, which come in order of their key."""
    last, total, n = None, None, None

    def mean() -> pa.RecordBatch:
        with np.errstate(invalid="ignore", divide="ignore"):
            flat = pa.array(np.where(n > 0, total / n, 0.0), mask=n == 0)
        return pa.RecordBatch.from_arrays([pa.array([last]), pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)], names=["key", "means"])

    for batch in batches:
        for key, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            a, b = np.frombuffer(a.as_buffer(), np.float64), np.frombuffer(b.as_buffer(), np.int64)
            if key != last:
                if last is not None:
                    yield mean()
                last, total, n = key, np.zeros(len(a)), np.zeros(len(b), np.int64)
            total, n = total + a, n + b
    if last is not None:
        yield mean()


def block_mean(blocks: DataFrame, keep: list[str]) -> DataFrame:
    """keep, latitude, longitude and mean of all blocks that agree in ``keep`` and in their grid: element-wise sums are held in each
    task, and a row for each key and task is shuffled, no cell. Missing values are skipped; a cell without any is null."""
    grid = F.struct(*keep, "lats", "lons")
    rows = blocks.select(F.to_json(grid, {"ignoreNullFields": "false"}).alias("key"), "values").mapInArrow(_sums, "key string, total binary, n binary")
    means = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_means, "key string, means array<double>")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.select(*keep, "lats", "lons").schema)
    out = means.select(F.from_json("key", kinds).alias("k"), F.posexplode("means").alias("pos", "mean"))
    n = F.size("k.lons")
    return out.select(*[F.col(f"k.{c}").alias(c) for c in keep], F.get("k.lats", F.floor(F.col("pos") / n).cast("int")).alias("latitude"), F.get("k.lons", F.col("pos") % n).alias("longitude"), "mean")


def binned_mean(rows: DataFrame, x: str, y: str, bins: int = 10) -> DataFrame:
    """bin, n and mean of y in equal-width bins of x that are closed on the right; empty bins stay."""
    edge = rows.agg(F.min(x).alias("low"), F.max(x).alias("high"))
    at = F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil((F.col(x) - F.col("low")) / ((F.col("high") - F.col("low")) / bins))))
    placed = rows.join(F.broadcast(edge), F.lit(True)).where(F.col(x).isNotNull()).withColumn("bin", F.when(F.col("high") > F.col("low"), at).otherwise(F.lit(1)).cast("int"))
    every = rows.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    sums = placed.groupBy("bin").agg(F.count(y).alias("n"), F.avg(y).alias("mean"))
    return every.join(sums, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "mean")


def row_sum(columns: list[str]) -> Column:
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return total
