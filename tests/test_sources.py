import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from gridloom.operators import fields as B
from gridloom.plans import fixtures as X
from gridloom.plans import job
from gridloom.sources import grib, packing

SF = "/root/testdata/sf0.001"


def raw(*bits):
    text = "".join(bits)
    text += "0" * (-len(text) % 8)
    return int(text, 2).to_bytes(len(text) // 8, "big") if text else b""


# A block of four samples of four bits: three bits tell how it is coded.
SPLIT_0 = ("001", "1", "01", "001", "0001"), [0, 1, 2, 3]
SPLIT_1 = ("010", "001", "1", "01", "01", "1", "0", "1", "0"), [5, 0, 3, 2]
SPLIT_2 = ("011", "0001", "1", "01", "1", "11", "00", "10", "01"), [15, 0, 6, 1]
AS_IS = ("111", "1111", "0000", "1010", "0001"), [15, 0, 10, 1]
PAIRS = ("000", "1", "001", "0001"), [0, 1, 2, 0]
MORE_PAIRS = ("000", "1", "1", "000000001"), [0, 0, 1, 2]
ZEROS = ("000", "0", "1"), [0] * 4
THREE_ZEROS = ("000", "0", "001"), [0] * 12
FIVE_ZEROS = ("000", "0", "000001"), [0] * 20


@pytest.mark.parametrize("block", [SPLIT_0, SPLIT_1, SPLIT_2, AS_IS, PAIRS, MORE_PAIRS, ZEROS, THREE_ZEROS, FIVE_ZEROS])
def test_each_option_of_a_block(block):
    bits, want = block
    assert packing.rice_values(raw(*bits), len(want), 4, 0, 4, 128).tolist() == want
    # with others around it
    both = raw(*SPLIT_1[0], *bits, *AS_IS[0])
    assert packing.rice_values(both, 8 + len(want), 4, 0, 4, 128).tolist() == SPLIT_1[1] + want + AS_IS[1]


def test_the_rest_of_a_segment_is_zero():
    rest = raw(*SPLIT_0[0], "000", "0", "00001", *SPLIT_1[0])  # 63 blocks to the end of the segment of 64
    got = packing.rice_values(rest, 65 * 4, 4, 0, 4, 128)
    assert got[:4].tolist() == SPLIT_0[1] and not got[4:256].any() and got[256:].tolist() == SPLIT_1[1]
    short = raw(*SPLIT_0[0], "000", "0", "00001", *SPLIT_1[0])  # 7 blocks to the end of an interval of 8
    got = packing.rice_values(short, 9 * 4, 4, 0, 4, 8)
    assert not got[4:32].any() and got[32:].tolist() == SPLIT_1[1]


def test_a_reference_and_differences():
    # reference 5, then differences 1, -1, -4 as zigzag 2, 1, 7
    bits = ("001", "0101", "001", "01", "00000001")
    assert packing.rice_values(raw(*bits), 4, 4, 8, 4, 1).tolist() == [5, 6, 5, 1]
    # near the lower bound a difference beyond it is the number itself: from 1, 2 x 1 + 5 up
    assert packing.rice_values(raw("001", "0001", "00000001", "1", "1"), 4, 4, 8, 4, 1).tolist() == [1, 7, 7, 7]
    # near the upper bound, downwards
    assert packing.rice_values(raw("001", "1110", "00000001", "1", "1"), 4, 4, 8, 4, 1).tolist() == [14, 8, 8, 8]
    # zeros, pairs and plain samples with a reference
    assert packing.rice_values(raw("000", "0", "0111", "1"), 4, 4, 8, 4, 1).tolist() == [7, 7, 7, 7]
    assert packing.rice_values(raw("000", "1", "0111", "001", "1"), 4, 4, 8, 4, 1).tolist() == [7, 6, 6, 6]
    assert packing.rice_values(raw("111", "0111", "0010", "0000", "0001"), 4, 4, 8, 4, 1).tolist() == [7, 8, 8, 7]
    # a second interval has a reference of its own
    assert packing.rice_values(raw(*bits, *bits), 8, 4, 8, 4, 1).tolist() == [5, 6, 5, 1] * 2
    assert packing.rice_values(raw(*bits, "0" * (-len("".join(bits)) % 8), *bits), 8, 4, 8 | packing.PAD, 4, 1).tolist() == [5, 6, 5, 1] * 2


def test_restricted_ids():
    assert packing.rice_values(raw("01", "1", "01", "001", "0001"), 4, 4, packing.RESTRICTED, 4, 8).tolist() == [0, 1, 2, 3]
    assert packing.rice_values(raw("1", "11", "00", "10", "01"), 4, 2, packing.RESTRICTED, 4, 8).tolist() == [3, 0, 2, 1]


def signals(r, n, top):
    yield r.integers(0, top + 1, n)
    yield np.clip(np.cumsum(r.integers(-2, 3, n)) + top // 2, 0, top)
    yield np.where(r.random(n) < 0.99, top // 3, r.integers(0, top + 1, n))
    yield np.full(n, top)
    yield np.where(r.random(n) < 0.97, 0, r.integers(0, 2, n))


@pytest.mark.parametrize("width", [1, 2, 4, 5, 8, 9, 16, 17, 24, 32])
@pytest.mark.parametrize("flags", [0, 8, 8 | 16, 8 | 32, 14])
def test_rice_round_trip(width, flags):
    r = np.random.default_rng(width * 64 + flags)
    for block, interval in ((8, 4), (32, 128), (64, 70)):
        for x in signals(r, int(r.integers(1, 3000)), (1 << width) - 1):
            coded = packing.rice_bytes(x, width, flags, block, interval)
            assert np.array_equal(packing.rice_values(coded, len(x), width, flags, block, interval), x)


def test_cut_off_data_are_an_error():
    coded = packing.rice_bytes(np.random.default_rng(0).integers(0, 4000, 5000), 12)
    with pytest.raises(ValueError, match="cut off"):
        packing.rice_values(coded[: len(coded) // 2], 5000, 12, 8, 32, 128)
    with pytest.raises(ValueError, match="cut off"):
        packing.integers(b"\0" * 5, 100, 9)


@pytest.mark.parametrize("order", [0, 1, 2])
@pytest.mark.parametrize("missing", [0, 0.1, 0.9, 1])
def test_complex_round_trip(order, missing):
    r = np.random.default_rng(order)
    for n in (1, 2, 3, 31, 32, 33, 1000):
        x = np.cumsum(r.integers(-50, 51, n)) * r.integers(1, 1000)
        x -= x.min()
        gone = r.random(n) < missing
        head, data = packing.complex_section(x, gone, order)
        got, lost = packing.complex_values(head, data)
        assert np.array_equal(lost, gone) and np.array_equal(got[~gone], x[~gone])


def test_complex_groups_bit_by_bit():
    # two groups: reference 5 with width 2 and three numbers, reference 9 with width 0 and two numbers
    head = bytes([4, 0, 1, 0]) + struct.pack(">ff", 0, 0) + struct.pack(">IBBIBIB", 2, 0, 2, 1, 2, 2, 1)
    data = raw("0101", "1001") + raw("10", "00") + raw("1", "0") + raw("01", "11", "00")
    got, lost = packing.complex_values(head, data)
    assert got.tolist() == [6, 8, 5, 9, 9] and not lost.any()
    # the same with the highest number of a group, and the reference of an empty one, for missing values
    head = bytes([4, 0, 1, 1]) + head[4:]
    got, lost = packing.complex_values(head, raw("0101", "1111") + data[1:])
    assert lost.tolist() == [False, True, False, True, True]


FIELD = np.array([[1.5, 2.25, -3.0, 4.0], [0.5, 0.0, 7.0, 8.0], [9.0, 1.0, 2.0, 3.0]], np.float32)
LATS, LONS = [90.0, 0.0, -90.0], [0.0, 90.0, 180.0, 270.0]


@pytest.mark.parametrize("kind", sorted(grib.PACKINGS))
@pytest.mark.parametrize("holes", [False, True])
def test_packings_of_a_message(kind, holes):
    values = FIELD.reshape(-1).copy()
    if holes:
        values[[1, 7]] = np.nan
    row = grib.message(grib.encode("t", 500.0, LATS, LONS, values, kind, -4))
    assert row["decode_error"] is None and (row["variable"], row["level"], row["lats"], row["lons"]) == ("t", 500.0, LATS, LONS)
    assert np.array_equal(row["values"], values, equal_nan=True)
    nothing = grib.message(grib.encode("t", 500.0, LATS, LONS, np.full(12, np.nan), kind))
    assert np.isnan(nothing["values"]).all()


@pytest.mark.parametrize("mode", [0, 0x80, 0x10, 0x20, 0x30, 0xB0])
def test_scanning_modes(mode):
    lines = FIELD.copy()
    if mode & 0x80:
        lines = lines[:, ::-1]
    if mode & 0x20:
        lines = lines.T
    lines = lines.copy()
    if mode & 0x10:
        lines[1::2] = lines[1::2, ::-1]
    coded = grib.encode("t", 500.0, LATS, LONS, lines.reshape(-1))
    at = coded.index(struct.pack(">IB", 72, 3))
    coded = coded[: at + 71] + bytes([mode]) + coded[at + 72 :]
    if mode & 0x80:  # the first longitude is the east's
        west, east = coded[at + 50 : at + 54], coded[at + 59 : at + 63]
        coded = coded[: at + 50] + east + coded[at + 54 : at + 59] + west + coded[at + 63 :]
    row = grib.message(coded)
    assert row["lons"] == LONS and np.array_equal(row["values"], FIELD.reshape(-1))


def singles(packing_, data, count):
    """A codec."""
    return np.frombuffer(data, ">f4", count)


def test_unknown_packings_are_told_or_given_to_a_codec(spark, tmp_path):
    good = grib.encode("t", 500.0, LATS, LONS, FIELD.reshape(-1))
    at = good.index(b"\0\4\1", good.index(struct.pack(">IB", 12, 5)))
    other = good[:at] + b"\0\x28\1" + good[at + 3 :]
    assert grib.message(other)["decode_error"] == "packing template 40"
    (tmp_path / "x.grib2").write_bytes(other)
    codecs = {"40": "tests.test_sources:singles"}
    assert grib.read_fields(spark, str(tmp_path)).first()["decode_error"] == "packing template 40"
    assert np.array_equal(grib.read_fields(spark, str(tmp_path), codecs=codecs).first()["values"], FIELD.reshape(-1))
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert np.array_equal(grib.decode(files, codecs=codecs).first()["values"], FIELD.reshape(-1))


def test_gaussian_latitudes():
    for n in (1, 4, 32, 80):
        assert grib.gaussian_latitudes(n) == pytest.approx(np.degrees(np.arcsin(np.polynomial.legendre.leggauss(2 * n)[0]))[::-1], abs=1e-9)


def test_reduced_grid(spark, tmp_path):
    points = [4, 8, 8, 4]
    values = np.arange(24, dtype=np.float32)
    values[5] = np.nan
    (tmp_path / "x.grib2").write_bytes(grib.encode("t", 500.0, list(grib.gaussian_latitudes(2)), None, values, "rice", -4, row_points=points))
    block = B.regular_grid(grib.read_fields(spark, str(tmp_path))).first()
    assert block["lons"] == [45.0 * i for i in range(8)] and block["lats"] == pytest.approx(grib.gaussian_latitudes(2))
    got = np.array([np.nan if x is None else x for x in block["values"]]).reshape(4, 8)
    assert got[0].tolist() == [0, 0.5, 1, 1.5, 2, 2.5, 3, 1.5]
    assert np.array_equal(got[1], [4, np.nan, 6, 7, 8, 9, 10, 11], equal_nan=True)


class Counting:
    """A store whose reads are counted."""

    def __init__(self, inner):
        self.inner, self.bytes = inner, 0

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def open_input_file(self, path):
        file, outer = self.inner.open_input_file(path), self

        class File:
            def __enter__(self):
                return self

            def __exit__(self, *_):
                file.close()

            def seek(self, at):
                file.seek(at)

            def read(self, n):
                outer.bytes += n
                return file.read(n)

        return File()


def _big_file(folder, n=69, points=20_000):
    r = np.random.default_rng(1)
    lats, lons = np.linspace(90, -90, 100).tolist(), np.linspace(0, 358, points // 100).tolist()
    names = [("t", float(p)) for p in B.LEVELS] + [("gh", float(p)) for p in B.LEVELS] + [("q", float(p)) for p in B.LEVELS] + [("u", float(p)) for p in B.LEVELS] + [("v", float(p)) for p in B.LEVELS] + [("msl", None), ("t2m", None), ("u10", None), ("v10", None)]
    with open(folder / "20240105060000-0h-oper-fc.grib2", "wb") as f:
        for name, level in names[:n]:
            f.write(b"junk" + grib.encode(name, level, lats, lons, r.normal(0, 10, points), "rice", -8))
    return names


def test_only_the_wanted_message_is_read(tmp_path, monkeypatch):
    _big_file(tmp_path)
    size = (tmp_path / "20240105060000-0h-oper-fc.grib2").stat().st_size
    plain = grib.store
    stores = []

    def store(path, **more):
        inner, local = plain(path, **more)
        stores.append(Counting(inner))
        return stores[-1], local

    monkeypatch.setattr(grib, "store", store)
    names = StructType([StructField(x.split()[0], StringType()) for x in grib.MESSAGES.split(", ")])
    reader = grib.MessageReader({"path": f"file:{tmp_path}", "variables": "gh", "levels": "500.0"}, names)
    (part,) = reader.partitions()
    (row,) = [b.to_pylist()[0] for b in reader.read(part)]
    assert (row["variable"], row["level"], len(row["values"])) == ("gh", 500.0, 20_000)
    assert sum(s.bytes for s in stores) < size / 69 + 69 * 5 * grib.PEEK < size / 2
    # headers only
    stores.clear()
    heads = StructType([StructField("variable", StringType()), StructField("level", StringType())])
    reader = grib.MessageReader({"path": f"file:{tmp_path}"}, heads)
    assert len(list(reader.read(part))) == 69 and sum(s.bytes for s in stores) < 69 * 5 * grib.PEEK < size / 3


def test_ranges_of_a_file_hold_each_message_once(spark, tmp_path):
    names = _big_file(tmp_path, 30)
    rows = spark.read
    spark.dataSource.register(grib.GribSource)
    whole = spark.read.format("grib2").load(f"file:{tmp_path}").select("variable", "level", "offset", F.size("values").alias("n")).collect()
    assert sorted((r["variable"], r["level"]) for r in whole) == sorted(names[:30]) and {r["n"] for r in whole} == {20_000}
    parts = rows.format("grib2").option("split", 10_000).load(f"file:{tmp_path}").select("variable", "level", "offset", F.size("values").alias("n"))
    assert parts.rdd.getNumPartitions() > 30
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole))


def test_small_files_share_partitions(spark, tmp_path):
    one = grib.encode("t", 500.0, LATS, LONS, FIELD.reshape(-1))
    for i in range(300):
        (tmp_path / f"{i:03d}.grib2").write_bytes(one)
    rows = grib.messages(spark, str(tmp_path), columns=("source_file", "offset"))
    assert rows.rdd.getNumPartitions() <= 2 * grib._tasks(spark) < 300
    assert sorted(r["source_file"].rsplit("/", 1)[1] for r in rows.collect()) == [f"{i:03d}.grib2" for i in range(300)]
    ranges = [grib.Range(str(i), 0, n, n) for i, n in enumerate([5, 40 << 20, 60 << 20, 200 << 20, 3, 3])]
    packed = [[r.path for r in p.ranges] for p in grib._packed(ranges, 128 << 20, 1)]
    assert packed == [["0", "1", "2"], ["3"], ["4", "5"]] and [p.ranges for p in grib._packed([], 1, 1)] == [[]]


def test_predicates_of_a_query_reach_the_source(spark, tmp_path):
    _big_file(tmp_path, 20)
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key, "false")
    try:
        for on in ("true", "false"):
            spark.conf.set(key, on)
            df = grib.messages(spark, str(tmp_path)).where("variable = 't' and level in (500.0, 850.0)").select("variable", "level")
            assert sorted(map(tuple, df.collect())) == [("t", 500.0), ("t", 850.0)]
    finally:
        spark.conf.set(key, before)


def test_runs_and_missing_paths(spark, tmp_path):
    for run in ("00z", "06z"):
        (tmp_path / run).mkdir()
        (tmp_path / run / "a-0h-b.grib2").write_bytes(grib.encode("t2m", None, LATS, LONS, FIELD.reshape(-1)))
    assert [r["source_file"].split("/")[-2] for r in grib.messages(spark, str(tmp_path), runs=("06z",), levels=(None,), columns=("source_file",)).collect()] == ["06z"]
    with pytest.raises(Exception, match="none"):
        grib.messages(spark, str(tmp_path / "none")).collect()


def test_both_ways_of_reading_agree(spark, tmp_path):
    job.write_files(X.named_files(X.blocks(spark, SF).where("cycle < 2")), f"{tmp_path}/in", "differences").collect()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{tmp_path}/in")
    columns = ["variable", "level", "dataset_ord", "lats", "lons", "values", "date", "run", "lead"]
    rows = lambda df: sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    assert rows(grib.decode(files)) == rows(grib.read_fields(spark, f"{tmp_path}/in"))


def test_small_fields_share_a_batch_and_large_ones_do_not(tmp_path):
    names = StructType([StructField(x.split()[0], StringType()) for x in grib.MESSAGES.split(", ")])
    small = [grib.encode("t", float(p), LATS, LONS, FIELD.reshape(-1) + p) for p in B.LEVELS]
    (tmp_path / "a.grib2").write_bytes(b"".join(small) + small[0][:-30])
    (tmp_path / "b.grib2").write_bytes(small[0])
    reader = grib.MessageReader({"path": f"file:{tmp_path}", "tasks": "1"}, names)
    batches = [b for part in reader.partitions() for b in reader.read(part)]
    assert len(batches) == 1
    rows = batches[0].to_pylist()
    assert [r["level"] for r in rows] == [*map(float, B.LEVELS), None, float(B.LEVELS[0])]
    assert rows[-2]["values"] is None and rows[-2]["lats"] is None and "damaged" in rows[-2]["decode_error"]
    for r, p in zip([*rows[:-2], rows[-1]], [*B.LEVELS, B.LEVELS[0]], strict=True):
        assert r["lats"] == LATS and r["lons"] == LONS and r["row_points"] is None
        assert r["values"] == (FIELD.reshape(-1) + p).astype(np.float32).tolist()
    large = [{**grib._NOTHING, "values": np.zeros(grib.BATCH_POINTS, np.float32)} for _ in range(3)]
    assert [b.num_rows for b in grib._batches(iter(large), ["values"])] == [1, 1, 1]


def test_damage_is_reported_and_passed(spark, tmp_path):
    good = grib.encode("t", 500.0, LATS, LONS, FIELD.reshape(-1))
    (tmp_path / "x.grib2").write_bytes(good[:60] + good + good[:-30])
    rows = grib.messages(spark, str(tmp_path)).orderBy("offset").collect()
    assert [(r["offset"], r["decode_error"] is None) for r in rows] == [(0, False), (60, True), (60 + len(good), False)]


def test_a_public_bucket_is_read_without_credentials(tmp_path, monkeypatch):
    asked = []

    class Public:
        def __new__(cls, **options):
            asked.append(options)
            return grib.fs.SubTreeFileSystem(str(tmp_path), grib.fs.LocalFileSystem())

    monkeypatch.setattr(grib.fs, "S3FileSystem", Public)
    (tmp_path / "bucket").mkdir()
    (tmp_path / "bucket" / "x.grib2").write_bytes(grib.encode("t2m", None, LATS, LONS, FIELD.reshape(-1)))
    names = StructType([StructField("source_file", StringType()), StructField("variable", StringType())])
    reader = grib.MessageReader({"path": "s3a://bucket/x.grib2", "anonymous": "true", "region": "eu-central-1"}, names)
    (part,) = reader.partitions()
    assert [b.to_pylist() for b in reader.read(part)] == [[{"source_file": "s3a://bucket/x.grib2", "variable": "t2m"}]]
    assert asked == [{"anonymous": True, "region": "eu-central-1"}] * 2
