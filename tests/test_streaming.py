import json
import time

import pytest
from pyspark.sql import functions as F

from gridloom.plans import fixtures as X
from gridloom.plans import job
from gridloom.plans import publish as P
from gridloom.streaming import cycles

SF = "/root/testdata/sf0.001"


def put(spark, tmp_path, where, part, cycle=0, sign=1.0):
    """A file with some fields of a cycle."""
    blocks = X.blocks(spark, SF).where(f"cycle = {cycle}").where(where).withColumn("values", F.transform("values", lambda x: (x * F.lit(sign)).cast("float")))
    name = F.concat("date", F.substring("run", 1, 2), F.lit(f"0000-0h-oper-{part}.grib2"))
    job.write_files(blocks.withColumn("source_file", name), f"{tmp_path}/in").collect()


def run(spark, tmp_path, **more):
    cycles.catch_up(spark, f"{tmp_path}/in", f"{tmp_path}/check", f"{tmp_path}/out", f"{tmp_path}/report", **more)
    return sorted((r["batch"], r["cycle"], r["event"], r["n_fields"], r["missing"].count("@") + (r["missing"] != "" and "@" not in r["missing"]), len(json.loads(r["files"]))) for r in spark.read.parquet(f"{tmp_path}/report").collect())


def published(spark, tmp_path):
    rows = P.read_published(spark, f"{tmp_path}/out")
    return {r[0]: r[1] for r in rows.groupBy("source_file").count().collect()}


def test_a_cycle_is_published_once_when_it_is_whole(spark, tmp_path):
    put(spark, tmp_path, "variable in ('gh', 'q', 't')", "b")
    put(spark, tmp_path, "level is null", "a", 1)
    assert run(spark, tmp_path) == [] and not (tmp_path / "out").exists()
    # in any order, with fields that came already
    put(spark, tmp_path, "variable in ('t', 'u', 'v') or level is null", "a")
    first = run(spark, tmp_path)  # restarted from the checkpoint
    assert [x[1:] for x in first] == [("20240101/00z/0h", "whole", 69, 0, 2)]
    assert published(spark, tmp_path) == {"20240101/00z/0h": 69 * 64}
    put(spark, tmp_path, "variable = 'q'", "c", sign=5.0)
    again = run(spark, tmp_path)
    assert [x[1:] for x in again if x not in first] == [("20240101/00z/0h", "repeated", 69, 0, 1)]
    rows = P.read_published(spark, f"{tmp_path}/out").where("variable = 'q' and isobaricInhPa = 1000").orderBy(F.desc("latitude"), "longitude").collect()
    assert [r["value"] for r in rows] == pytest.approx(X.blocks(spark, SF).where("cycle = 0 and variable = 'q' and level = 1000").first()["values"])
    put(spark, tmp_path, "level is not null", "d", 1)
    assert len(run(spark, tmp_path)) == 3 and published(spark, tmp_path) == {f"20240101/{r}/0h": 69 * 64 for r in ("00z", "06z")}


def test_a_late_cycle_is_reported_once(spark, tmp_path):
    put(spark, tmp_path, "not (variable = 'v' and level = 50)", "a")
    query = cycles.follow(spark, f"{tmp_path}/in", f"{tmp_path}/check", f"{tmp_path}/out", f"{tmp_path}/report", patience_ms=100, every="1 second")
    events = lambda: [(r["event"], r["missing"]) for r in spark.read.schema(cycles.EVENTS + ", batch int").parquet(f"{tmp_path}/report").orderBy("batch").collect()] if (tmp_path / "report").exists() else []
    try:
        for _ in range(60):
            if events():
                break
            time.sleep(1)
        time.sleep(3)
        assert events() == [("late", "v@50")] and not (tmp_path / "out").exists()
        put(spark, tmp_path, "variable = 'v' and level = 50", "b")
        for _ in range(60):
            if len(events()) > 1:
                break
            time.sleep(1)
        assert events() == [("late", "v@50"), ("whole", "")]
    finally:
        query.stop()
    assert published(spark, tmp_path) == {"20240101/00z/0h": 69 * 64}
