import pytest
from pyspark.sql import functions as F

from gridloom.operators import fields as B
from gridloom.plans import fixtures as X
from gridloom.plans import publish as P
from gridloom.plans.snapshots import Snapshots

SF = "/root/testdata/sf0.001"
NAME = "20240101/00z/x-0h.grib2"


def blocks(spark, key, sign=1.0):
    """A cycle as the source file ``key``, its values times ``sign``."""
    rows = B.complete_only(X.blocks(spark, SF)).where("cycle = 0").withColumn("source_file", F.lit(key))
    return rows.withColumn("values", F.transform("values", lambda x: (x * F.lit(sign)).cast("float")))


def sums(rows):
    return {r[0]: (r[1], r[2]) for r in rows.where("variable = 't2m'").groupBy("source_file").agg(F.count("*"), F.round(F.sum("value"), 3)).collect()}


def test_source_files_are_replaced_as_a_whole(spark, tmp_path):
    s = Snapshots(spark, str(tmp_path))
    both = blocks(spark, f"a/{NAME}").unionByName(blocks(spark, f"b/{NAME}", -1.0))  # one name, two keys
    assert s.publish(both) == 1
    first = sums(s.read())
    assert first[f"a/{NAME}"] == (64, -first[f"b/{NAME}"][1]) and len(first) == 2
    reader = s.read()  # planned before the rerun
    assert s.publish(blocks(spark, f"b/{NAME}", 3.0)) == 2
    assert sums(reader) == first == sums(s.read(1))
    now = sums(s.read())
    assert now[f"a/{NAME}"] == first[f"a/{NAME}"] and now[f"b/{NAME}"][1] == pytest.approx(-3 * first[f"b/{NAME}"][1], abs=0.01)
    assert s.read().count() == 2 * 69 * 64 and {r["n_rows"] for r in s.manifest().collect()} == {69 * 64}
    assert {r[0] for r in s.read().select("month").distinct().collect()} == {"01"}


def test_a_crash_before_the_swap_changes_nothing(spark, tmp_path, monkeypatch):
    s = Snapshots(spark, str(tmp_path))
    s.publish(blocks(spark, "a"))
    before = sums(s.read())

    def crash(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(Snapshots, "_rename", crash)
    with pytest.raises(KeyboardInterrupt):
        s.publish(blocks(spark, "a", 2.0))
    assert sums(s.read()) == before and s.numbers() == [1]
    monkeypatch.undo()
    assert s.publish(blocks(spark, "a", 2.0)) == 2
    assert len(s.vacuum()) == 2 and s.numbers() == [2]
    assert sums(s.read())["a"][1] == pytest.approx(2 * before["a"][1], abs=0.01)
    assert len([x for x in tmp_path.joinpath("data").iterdir() if x.name.startswith("version")]) == 1


def test_of_two_publications_one_fails(spark, tmp_path, monkeypatch):
    s = Snapshots(spark, str(tmp_path))
    plain = P.publish_blocks

    def slow(rows, base):
        plain(rows, base)
        monkeypatch.setattr(P, "publish_blocks", plain)
        Snapshots(spark, str(tmp_path)).publish(blocks(spark, "other"))  # meanwhile

    monkeypatch.setattr(P, "publish_blocks", slow)
    with pytest.raises(RuntimeError, match="another publication was first"):
        s.publish(blocks(spark, "mine"))
    assert set(sums(s.read())) == {"other"}
    s.publish(blocks(spark, "mine"))
    assert set(sums(s.read())) == {"other", "mine"}
