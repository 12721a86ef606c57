import struct

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import keys as K
from gridloom.operators import fields as B
from gridloom.operators import quality as Q
from gridloom.operators import tidy as T
from gridloom.plans import fixtures as X
from gridloom.plans import job
from gridloom.plans import publish as P
from gridloom.plans.queries import QUERIES, SQL
from gridloom.sources import catalog as C
from gridloom.sources import grib, packing
from gridloom.streaming import arrivals

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "orders", "events", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == cols
    at = [list(want.columns).index(c) for c in cols]
    assert sorted(repr(tuple(r[c] for c in cols)) for r in df.collect()) == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())


def test_incomplete_cycle_is_an_error_that_names_the_field(spark):
    with pytest.raises(Exception, match="lacks"):
        B.require_complete(X.blocks(spark, SF)).count()


def test_duplicate_cell_is_an_error(spark):
    rows = spark.createDataFrame([(1.0, 0.0, 1.0), (1.0, 0.0, 2.0)], "latitude double, longitude double, value float")
    with pytest.raises(Exception, match="duplicate cell"):
        T.raster(rows, [0.0]).collect()


def test_all_fields_have_rasters_and_all_cycles_chunks(spark):
    blocks = X.blocks(spark, SF)
    rows = QUERIES["raster_pivot_all"](spark, SF).collect()
    assert len(rows) == 8 * blocks.count() and len({(r["cycle"], r["variable"], r["level"]) for r in rows}) == blocks.count()
    dates = {(r["date"], r["run"]) for r in B.complete_only(blocks).select("date", "run").collect()}
    got = QUERIES["union_chunks_all"](spark, SF)
    assert len(dates) > 1 and {(r["date"], r["run"]) for r in got.select("date", "run").distinct().collect()} == dates
    two = spark.createDataFrame([("a", 1.0, 0.0, 1.0), ("b", 1.0, 0.0, 2.0)], "variable string, latitude double, longitude double, value float")
    assert [tuple(r) for r in T.raster(two, [0.0], keys=("variable",)).collect()] == [("a", 1.0, 1.0), ("b", 1.0, 2.0)]


def test_bad_date(spark):
    rows = spark.createDataFrame([("20240230",)], "d string")
    assert rows.select(K.parse_date(F.col("d"))).first()[0] is None
    with pytest.raises(Exception):  # noqa: B017
        rows.select(K.parse_date(F.col("d"), strict=True)).collect()


def test_nan_is_missing(spark):
    rows = spark.createDataFrame([(float("nan"),), (2.0,)], "v double")
    assert rows.select(F.avg(B.missing(F.col("v")))).first()[0] == 2.0


def test_geopotential_is_single_precision(spark):
    got = {r["vec_id"]: r["values"] for r in B.geopotential(X.blocks(spark, SF).where("variable = 'gh'")).select("vec_id", "values").collect()}
    raw = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()}
    for k, v in got.items():
        assert np.array_equal(np.array(v, np.float32), np.array(raw[k], np.float32) * np.float32(9.80665))


def test_t_points():
    table = Q.t_table()
    assert [round(table[i], 3) for i in (0, 1, 2, 9, 29, 119)] == [12.706, 4.303, 3.182, 2.228, 2.042, 1.98]


def test_republishing_replaces_one_source_only(spark, tmp_path):
    base = str(tmp_path / "out")
    rows = T.consolidated(B.complete_only(X.blocks(spark, SF)), ("source_file",)).where("run = '00z'")
    P.publish(rows, base)
    n = P.read_published(spark, base).count()
    P.publish(rows.where("source_file = 'cycle-0.grib2'").limit(5), base)
    left = P.read_published(spark, base)
    assert left.where("source_file = 'cycle-0.grib2'").count() == 5
    assert left.where("source_file <> 'cycle-0.grib2'").count() == n - rows.where("source_file = 'cycle-0.grib2'").count()
    assert {r[0] for r in left.select("month").distinct().collect()} == {"01"}


def test_npy_round_trip(spark, tmp_path):
    t = T.tensors(B.complete_only(X.blocks(spark, SF))).where("cycle = 0")
    found = {r["tensor"]: r["path"] for r in P.export_npy(t, str(tmp_path)).collect()}
    data = np.load(found["upper"])
    row = t.where("tensor = 'upper' and channel = 2 and level_idx = 5").first()
    assert data.shape == (5, 13, 8, 8) and np.array_equal(data[2, 5].reshape(-1), np.array(row["values"], np.float32))


def _section(number, body):
    return struct.pack(">IB", len(body) + 5, number) + body


def _message(values, n_lat, n_lon, level, template=0):
    grid = bytearray(67)
    struct.pack_into(">BIBBH", grid, 0, 0, n_lat * n_lon, 0, 0, 0)
    struct.pack_into(">II", grid, 25, n_lon, n_lat)
    struct.pack_into(">IIBII", grid, 41, 90_000_000, 0, 48, (1 << 31) | 90_000_000, 270_000_000)
    low = float(np.float32(values.min()))
    packed = np.round((values - low) * 4).astype(">u2")
    # section numbers count bytes from the section's start, five before the body
    body = bytearray(29)
    struct.pack_into(">HHBB", body, 0, 0, 0, 0, 0)
    body[17] = 100
    struct.pack_into(">BI", body, 18, 0, level * 100)
    product = _section(4, bytes(body))
    packing = _section(5, struct.pack(">IHfHHBB", values.size, template, low, (1 << 15) | 2, 0, 16, 0))
    parts = _section(1, bytes(16)) + _section(3, bytes(grid)) + product + packing + _section(6, b"\xff") + _section(7, packed.tobytes())
    return b"GRIB\0\0\0\x02" + struct.pack(">Q", 16 + len(parts) + 4) + parts + b"7777"


def test_grib_scan(spark, tmp_path):
    values = np.arange(12, dtype=np.float64) / 4 + 200
    folder = tmp_path / "20240105" / "06z"
    folder.mkdir(parents=True)
    (folder / "20240105060000-0h-oper-fc.grib2").write_bytes(_message(values, 3, 4, 500) + _message(values, 3, 4, 850, template=41))
    rows = {r["level"]: r for r in grib.read_fields(spark, str(tmp_path)).collect()}
    assert rows[500.0]["date"] == "20240105" and rows[500.0]["run"] == "06z" and rows[500.0]["variable"] == "t"
    assert rows[500.0]["values"] == pytest.approx(values) and rows[500.0]["lons"] == [0.0, 90.0, 180.0, 270.0] and rows[500.0]["lats"] == [90.0, 0.0, -90.0]
    assert rows[850.0]["decode_error"] == "packing template 41"


def _two_leads(spark, base):
    """Two lead times of one run, each a complete cycle."""
    blocks = X.named_files(X.blocks(spark, SF).where("cycle < 2")).withColumn("date", F.lit("20240101")).withColumn("run", F.lit("06z"))
    lead = F.concat(F.lit("20240101060000-"), (F.col("cycle") * 6).cast("string"), F.lit("h-oper-fc.grib2"))
    job.write_files(blocks.withColumn("source_file", lead), base).collect()
    return blocks


def test_two_leads_of_a_run_stay_apart(spark, tmp_path):
    blocks = _two_leads(spark, f"{tmp_path}/in")
    got = job.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/npy").collect()
    assert sorted((r["lead"], r["n_fields"], r["n_rows"], r["status"]) for r in got) == [("0h", 69, 69 * 64, "ok"), ("6h", 69, 69 * 64, "ok")]
    assert all(r["bytes"] > 0 for r in got)
    want = {r["vec_id"]: r for r in B.geopotential(blocks).collect()}
    for cycle, lead in ((0, "0h"), (1, "6h")):
        data = np.load(f"{tmp_path}/npy/year=2024/month=01/day=01/run=06z/lead={lead}/input_upper.npy")
        assert data.shape == (5, 13, 8, 8)
        assert np.array_equal(data[0, 0].reshape(-1), np.array(want[69 * cycle + 4]["values"], np.float32))


def test_digits_in_the_path_above_are_no_date(spark, tmp_path):
    """Scratch folders have random names; eight digits in one aren't the files' date."""
    _two_leads(spark, f"{tmp_path}/a-f20481231e/18z/in")
    got = job.run(spark, f"{tmp_path}/a-f20481231e/18z/in", f"{tmp_path}/out").collect()
    assert {(r["date"], r["run"], r["status"]) for r in got} == {("20240101", "06z", "ok")}
    assert {tuple(r) for r in P.read_published(spark, f"{tmp_path}/out").select("date", "year", "month", "day", "run").distinct().collect()} == {("20240101", "2024", "01", "01", "06z")}
    below = grib.read_fields(spark, f"{tmp_path}/a-f20481231e/18z/in/20240101/06z").select("date", "run", "lead").distinct()
    assert {tuple(r) for r in below.collect()} == {("20240101", "06z", "0h"), ("20240101", "06z", "6h")}
    one = spark.read.format("binaryFile").load(f"{tmp_path}/a-f20481231e/18z/in/20240101/06z/*-0h-*").first()["path"]
    assert {tuple(r) for r in grib.read_fields(spark, one).select("date", "run").distinct().collect()} == {("20240101", "06z")}


def test_arriving_files_are_published_once(spark, tmp_path):
    _two_leads(spark, f"{tmp_path}/in")
    for _ in range(2):
        arrivals.ingest(spark, f"{tmp_path}/in", f"{tmp_path}/check", f"{tmp_path}/out")
    assert P.read_published(spark, f"{tmp_path}/out").count() == 2 * 69 * 64


def test_verify_fails_where_nothing_was_published(spark, tmp_path):
    _two_leads(spark, f"{tmp_path}/in")
    job.run(spark, f"{tmp_path}/in", f"{tmp_path}/out").collect()
    source = grib.read_merged(spark, f"{tmp_path}/in").withColumn("source_file", K.relative_key(F.col("source_file"), f"file:{tmp_path}/in"))
    rows = P.read_published(spark, f"{tmp_path}/out")
    assert {r["status"] for r in job.verify(source, rows).collect()} == {"ok"}
    with pytest.raises(Exception, match="nothing published for t2m"):
        job.verify(source, rows.where("variable <> 't2m'")).collect()


def test_an_incomplete_file_is_listed_but_not_published(spark, tmp_path):
    _two_leads(spark, f"{tmp_path}/in")
    one = X.named_files(X.blocks(spark, SF).where("cycle = 2 and not (variable = 'q' and level = 850)"))
    job.write_files(one, f"{tmp_path}/in").collect()
    (bad,) = [r for r in job.run(spark, f"{tmp_path}/in", f"{tmp_path}/out").collect() if r["status"] != "ok"]
    assert (bad["missing"], bad["n_rows"], bad["bytes"], bad["n_fields"]) == ("q@850", 0, 0, 68)


@pytest.mark.parametrize("width", [1, 7, 8, 12, 16, 24, 29, 32])
def test_packed_integers(width):
    r = np.random.default_rng(width)
    want = r.integers(0, 1 << width, 100)
    bits = "".join(format(int(x), f"0{width}b") for x in want)
    raw = int(bits + "0" * (-len(bits) % 8), 2).to_bytes(-(-len(bits) // 8), "big")
    assert np.array_equal(packing.integers(raw, 100, width), want)
    assert packing.packed_bits(want, width) == raw


def test_grid_templates_and_damage_are_reported(spark):
    good = grib.encode("t", 500.0, [90.0, 0.0], [0.0, 90.0], np.arange(4))
    at = good.index(struct.pack(">IB", 72, 3)) + 12
    other = good[:at] + b"\0\x1e" + good[at + 2 :]
    assert grib.message(other)["decode_error"] == "grid template"
    files = spark.createDataFrame([("a/20240105/06z/x-0h-y.grib2", good[:60] + good), ("b.grib2", b""), ("c.grib2", None)], "path string, content binary")
    rows = grib.decode(files).collect()
    assert [r["decode_error"] is None for r in rows].count(True) == 1 and len(rows) == 2


def test_missing_path_and_keys(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        C.listing(spark, str(tmp_path / "none"))
    row = spark.range(1).select(C.download_key(F.lit("20240101"), F.lit("12z"))).first()
    assert row[0] == "20240101/12z/ifs/0p25/oper/20240101120000-0h-oper-fc.grib2"


def test_sample_depends_on_the_seed_only(spark):
    objects = X.objects(spark, SF)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(C.sample(objects, 50)) == rows(C.sample(objects.repartition(3), 50)) != rows(C.sample(objects, 50, seed=8))
    assert C.sample(objects.limit(0), 5).count() == 0


def test_stretched_fields_are_decoded_whole(spark, tmp_path):
    """A few fields of the job's real kind: many points, differences, several blocks of a file in tasks of their own."""
    large = X.large_blocks(spark, SF, 121, 240).where("variable in ('t2m', 'gh')")
    job.write_files(X.named_files(large), f"{tmp_path}/in", "differences").collect()
    want = {(r["variable"], r["level"]): np.array(r["values"]) for r in large.collect()}
    got = {(r["variable"], r["level"]): np.array(r["values"]) for r in grib.read_merged(spark, f"{tmp_path}/in").collect()}
    assert len(want) == 14 == len(got) and all(np.abs(got[k] - want[k]).max() <= 2**-17 for k in want)


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_equal_names_in_two_folders_stay_apart(spark, tmp_path):
    """A file is told by its whole key; a rerun replaces that file only."""
    blocks = X.named_files(X.blocks(spark, SF).where("cycle < 1"))
    for folder, sign in (("a", 1.0), ("b", -1.0)):
        signed = blocks.withColumn("values", F.transform("values", lambda x: (x * F.lit(sign)).cast("float")))  # noqa: B023
        job.write_files(signed, f"{tmp_path}/in/{folder}").collect()
    got = {r["source_file"]: r for r in job.run(spark, f"{tmp_path}/in", f"{tmp_path}/out").collect()}
    name = "20240101/00z/20240101000000-0h-oper-fc.grib2"
    assert {k: (r["n_rows"], r["status"], r["bytes"] > 0) for k, r in got.items()} == {f"{x}/{name}": (69 * 64, "ok", True) for x in "ab"}
    sums = lambda: {r[0]: r[1] for r in P.read_published(spark, f"{tmp_path}/out").where("variable = 't2m'").groupBy("source_file").agg(F.sum("value")).collect()}
    first = sums()
    assert first[f"a/{name}"] == pytest.approx(-first[f"b/{name}"]) != 0
    job.run(spark, f"{tmp_path}/in/b", f"{tmp_path}/again").collect()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{tmp_path}/in/a")
    job.publish_files(files, f"{tmp_path}/out", root=f"file:{tmp_path}/in").collect()
    assert sums() == first


def test_a_job_leaves_no_scratch(spark, tmp_path):
    import os

    def left():
        base = spark.conf.get("spark.checkpoint.dir")
        return {x for x in os.listdir(base) if x.startswith(("fields", "merged", "archive"))}

    before = left()
    _two_leads(spark, f"{tmp_path}/in")
    assert job.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", default_date="20000101").count() == 2
    (tmp_path / "in" / "damaged-0h-x.grib2").write_bytes(b"no message")
    (bad,) = [r for r in job.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", default_date="20000101").collect() if r["status"] != "ok"]
    assert (bad["date"], bad["missing"], bad["n_rows"]) == ("20000101", "all", 0)
    assert left() == before


def test_merged_files_are_decoded_once(spark):
    # the result reads the merged fields, not the files again for each use
    out = QUERIES["merge_files"](spark, SF)
    assert "grib2" not in out._jdf.queryExecution().toString()


def test_blocks_are_published_as_their_rows(spark, tmp_path):
    blocks = B.complete_only(X.blocks(spark, SF))
    P.publish(T.consolidated(blocks, ("source_file",)), f"{tmp_path}/a")
    P.publish_blocks(blocks, f"{tmp_path}/b")
    a, b = (P.read_published(spark, f"{tmp_path}/{x}") for x in "ab")
    assert sorted(a.columns) == sorted(b.columns)
    assert a.exceptAll(b.select(a.columns)).count() == 0 == b.select(a.columns).exceptAll(a).count()
    plan = B.cells(blocks)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Generate")[0]


def test_small_fields_of_a_source_are_one_file(spark, tmp_path, monkeypatch):
    """Files grow with the sources, not with their fields or the tasks; fields of real size have files of their own."""
    blocks = B.complete_only(X.blocks(spark, SF)).repartition(7)
    n = blocks.select("source_file").distinct().count()
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 20)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        P.publish_blocks(blocks, f"{tmp_path}/a")
        monkeypatch.setattr(P, "LARGE", 64)
        P.publish_blocks(blocks, f"{tmp_path}/b")
    finally:
        for c, x in before.items():
            spark.conf.set(c, x)
    a, b = ({r["source_file"]: r["files"] for r in P.published_bytes(spark, f"{tmp_path}/{x}").collect()} for x in "ab")
    assert len(a) == len(b) == n and set(a.values()) == {1} and min(b.values()) > 10
    rows = [P.read_published(spark, f"{tmp_path}/{x}") for x in "ab"]
    assert rows[0].count() == n * 69 * 64 and rows[0].exceptAll(rows[1]).count() == 0 == rows[1].exceptAll(rows[0]).count()


def test_box_is_filtered_cells(spark):
    blocks = X.blocks(spark, SF)
    columns = ["vec_id", "pos", "latitude", "longitude", "value"]
    want = B.cells(blocks).where("latitude between -30 and 40 and longitude between 45 and 180").select(columns)
    got = B.box_cells(blocks, -30, 40, 45, 180).select(columns)
    assert got.count() == want.count() > 0 and want.exceptAll(got).count() == 0
    assert B.box_cells(blocks, 91, 95, 0, 1).count() == 0


def test_block_mean_is_the_mean_of_cells(spark):
    holes = X.blocks(spark, SF).withColumn("values", F.transform("values", lambda x, i: F.when((i % 5 == F.col("vec_id") % 5) | (i == 7), F.lit(float("nan"))).otherwise(x).cast("float")))
    keys = ["variable", "level", "latitude", "longitude"]
    want = {tuple(r[k] for k in keys): r["mean"] for r in Q.dim_mean(B.cells(holes), keys).collect()}
    got = {tuple(r[k] for k in keys): r["mean"] for r in Q.block_mean(holes.repartition(3), keys[:2]).collect()}
    assert got.keys() == want.keys() and all(got[k] == (pytest.approx(want[k]) if want[k] is not None else None) for k in want)
    assert sum(v is None for v in got.values()) > 0


def test_raster_of_blocks_is_that_of_cells(spark):
    blocks = X.blocks(spark, SF).where("vec_id < 80").withColumn("lons", F.reverse("lons"))
    lons, keys = [45.0 * i for i in range(9)], ("vec_id", "variable", "level")
    a, b = T.raster(B.cells(blocks), lons, keys=keys), T.raster_blocks(blocks, lons, keys=keys)
    assert a.columns == b.columns and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    with pytest.raises(Exception, match="duplicate cell"):
        T.raster_blocks(blocks.withColumn("lats", F.array(*[F.lit(1.0)] * 8)), lons, keys=keys).collect()


def _cells(spark, rows):
    return spark.createDataFrame(rows, "k string, level double, latitude double, longitude double, value float")


def test_compare_by_digests(spark):
    same = [("a", None, float(i), 0.0, float(i)) for i in range(5)]
    empty = [("n", 1.0, float(i), 0.0, None) for i in range(3)]
    moved = [("b", 2.0, float(i), 0.0, float(i)) for i in range(5)]
    source = _cells(spark, same + empty + moved + [("c", None, 0.0, 0.0, 1.0), ("d", None, 0.0, 0.0, 1.0), ("e", None, 0.0, 0.0, 1.0)])
    out = _cells(spark, same[::-1] + empty + [(*r[:4], r[4] + (r[2] == 3)) for r in moved] + [("c", None, 0.0, 0.0, 1.0)] * 2 + [("d", None, 1.0, 0.0, 1.0)])
    keys = ["k", "level"]
    columns = ["n", "src_mean", "out_mean", "max_abs_diff", "mean_drift", "status"]
    rows = lambda df: {(r["k"], r["level"]): tuple(r[c] for c in columns) for r in df.collect()}
    want, got = rows(Q.report(Q.grid_diff(source, out, keys), keys)), rows(Q.compare(source, out, keys))
    assert got == want
    assert [got[k][-1] for k in sorted(got, key=lambda k: k[0])] == ["ok", "drift", got["c", None][-1], "shape", "no_data", "no_data"]


def test_digests_of_large_fields(spark):
    cells = spark.range(300_000).selectExpr("'a' as k", "id / 1000 as latitude", "id % 1000 / 4 as longitude", "cast(id as float) as value")
    (row,) = Q.digests(cells, ["k"]).collect()
    (same,) = Q.digests(cells.repartition(5), ["k"]).collect()
    (other,) = Q.digests(cells.withColumn("value", F.when(F.col("value") == 7, 8.0).otherwise(F.col("value"))), ["k"]).collect()
    assert (row["mixed"], row["summed"]) == (same["mixed"], same["summed"]) != (other["mixed"], other["summed"]) and row["n"] == 300_000


def test_equal_sides_are_not_matched_cell_by_cell(spark):
    cells = B.cells(X.blocks(spark, SF)).select("source_file", "variable", "level", "latitude", "longitude", "value")
    plan = Q.compare(cells, cells.repartition(3), ["source_file", "variable", "level"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "_latitude" not in text and "Generate" not in text and {r["status"] for r in plan.collect()} == {"ok"}


def test_an_absent_field_is_an_error(spark, tmp_path):
    _two_leads(spark, f"{tmp_path}/in")
    job.run(spark, f"{tmp_path}/in", f"{tmp_path}/out").collect()
    source = grib.read_merged(spark, f"{tmp_path}/in").withColumn("source_file", K.relative_key(F.col("source_file"), f"file:{tmp_path}/in"))
    rows = P.read_published(spark, f"{tmp_path}/out")
    with pytest.raises(Exception, match="no field q2 in 20240101/06z/"):
        job.verify(source, rows, (("t2m", None), ("q2", None))).collect()
    changed = rows.withColumn("value", F.when((F.col("variable") == "t2m") & (F.col("latitude") == 90), F.col("value") + 1).otherwise(F.col("value")))
    assert sorted(r["status"] for r in job.verify(source, changed).collect()) == ["drift", "drift", "ok", "ok"]


def test_a_failed_tensor_write_leaves_nothing(spark, tmp_path):
    import os

    t = T.tensors(B.complete_only(X.blocks(spark, SF))).where("cycle < 2")
    with pytest.raises(Exception, match="lacks 1 fields"):
        P.export_npy(t.where("not (cycle = 1 and tensor = 'surface' and channel = 2)"), f"{tmp_path}/npy")
    assert not [f for _, _, names in os.walk(tmp_path / "npy") for f in names]
    P.export_npy(t, f"{tmp_path}/npy")
    P.export_npy(t.withColumn("values", F.transform("values", lambda x: -x)), f"{tmp_path}/npy")
    found = sorted(f for _, _, names in os.walk(tmp_path / "npy") for f in names)
    assert found == ["input_surface.npy"] * 2 + ["input_upper.npy"] * 2
    row = t.where("cycle = 1 and tensor = 'surface' and channel = 2").first()
    data = np.load(f"{tmp_path}/npy/year=2024/month=01/day=01/run=06z/input_surface.npy")
    assert data.shape == (4, 8, 8) and np.array_equal(data[2].reshape(-1), -np.array(row["values"], np.float32))


def test_only_accepted_attempts_are_moved(tmp_path):
    import pyarrow as pa

    writer = P.TensorWriter(f"file:{tmp_path}")
    rows = pa.RecordBatch.from_pydict({"file": ["a/x.npy"] * 4, "n_channel": [4] * 4, "n_level": pa.array([None] * 4, pa.int32()), "n_lat": [1] * 4, "n_lon": [2] * 4, "values": pa.array([[1.0, 2.0]] * 4, pa.list_(pa.float32()))})
    first, second = writer.write(iter([rows])), writer.write(iter([rows.slice(0, 2), rows.slice(2)]))  # two attempts of one task
    writer.commit([second])
    assert first.files[0][0] != second.files[0][0]
    assert [str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file()] == ["a/x.npy"] and np.load(tmp_path / "a/x.npy").shape == (4, 1, 2)
