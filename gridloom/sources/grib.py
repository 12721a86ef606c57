"""GRIB2 files as field blocks. Values are decoded in the tasks that read them; what can't be decoded is reported in the row."""

from __future__ import annotations

import importlib
import json
import math
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from gridloom.functions import keys as K
from gridloom.sources import packing as P

#: Names of (discipline, category, number, type of level) (fixed values).
NAMES = {(0, 3, 1, 101): "msl", (0, 3, 0, 101): "msl", (0, 2, 2, 103): "u10", (0, 2, 3, 103): "v10", (0, 0, 0, 103): "t2m", (0, 3, 5, 100): "gh", (0, 1, 0, 100): "q", (0, 0, 0, 100): "t", (0, 2, 2, 100): "u", (0, 2, 3, 100): "v"}
#: A decoder of another packing: (section 5, section 7 without its header, number of values) -> values.
Codec = Callable[[bytes, bytes, int], np.ndarray]
SCHEMA = "source_file string, dataset_ord int, variable string, level double, lats array<double>, lons array<double>, row_points array<int>, values array<float>, decode_error string"
MESSAGES = "source_file string, offset long, variable string, level double, lats array<double>, lons array<double>, row_points array<int>, values array<float>, decode_error string"
#: Columns that need the grid, or also the data, of a message.
_GRID, _DATA = ("lats", "lons", "row_points", "decode_error"), ("values", "decode_error")
#: Bytes read at once where only headers are wanted, and of a file that make a partition.
PEEK, SPLIT = 2048, 128 << 20
#: A file of at most so many bytes is read at once; decoded fields share an Arrow batch up to so many points or rows.
SMALL, BATCH_POINTS, BATCH_ROWS = 1 << 16, 1 << 16, 1000
#: What opening a file costs, in bytes read.
OPEN = 1 << 20
#: Partitions that small files are packed into, about, where ``tasks`` isn't given.
TASKS = 64
_LISTS = {"lats": pa.float64(), "lons": pa.float64(), "row_points": pa.int32(), "values": pa.float32()}
_KINDS = {"dataset_ord": pa.int32(), "level": pa.float64(), "offset": pa.int64()}
_NOTHING = {"variable": None, "level": None, "lats": None, "lons": None, "row_points": None, "values": None, "decode_error": None}
PACKINGS = {"simple": 0, "complex": 2, "differences": 3, "ieee": 4, "rice": 42}

Read = Callable[[int, int], bytes]


@lru_cache
def gaussian_latitudes(n: int) -> tuple[float, ...]:
    """The 2n latitudes from north to south: roots of the Legendre polynomial of that degree, by Newton's method on all at once."""
    degree = 2 * n
    x = np.cos(math.pi * (np.arange(1, degree + 1) - 0.25) / (degree + 0.5))
    for _ in range(8):
        before, now = np.ones(degree), x
        for k in range(2, degree + 1):
            before, now = now, ((2 * k - 1) * x * now - (k - 1) * before) / k
        x = x - now * (x * x - 1) / (degree * (x * now - before))
    return tuple(np.degrees(np.arcsin(x)).tolist())


@lru_cache(maxsize=16)  # of the fields of a file most have one grid
def _grid(grid: bytes) -> tuple[dict, Callable[[np.ndarray], np.ndarray]]:
    """lats, lons and row_points of a regular or reduced grid, and how its values come to rows from west to east."""
    template = struct.unpack(">H", grid[12:14])[0]
    if template not in (0, 40):
        raise ValueError("grid template")
    n_lon, n_lat = struct.unpack(">II", grid[30:38])
    la1, lo1, la2, lo2 = P.signed(grid[46:50]), P.signed(grid[50:54]), P.signed(grid[55:59]), P.signed(grid[59:63])
    mode, each = grid[71], grid[10]
    if template == 40:
        n = struct.unpack(">I", grid[67:71])[0]
        lats = [x for x in gaussian_latitudes(n) if min(la1, la2) - 1500 <= x * 1e6 <= max(la1, la2) + 1500]
        if len(lats) != n_lat:
            raise ValueError("latitudes")
        lats = lats if la1 >= la2 else lats[::-1]
    else:
        lats = (np.linspace(la1, la2, n_lat) / 1e6).tolist()
    if each:  # rows have their own numbers of points
        if mode & 0xB0 or lo1:
            raise ValueError(f"scanning mode {mode} of a reduced grid")
        points = [int.from_bytes(grid[72 + i * each : 72 + (i + 1) * each], "big") for i in range(n_lat)]
        return {"lats": lats, "row_points": points}, lambda v: v
    if mode & 0x80:
        lo1, lo2 = lo2, lo1
    lons = (np.linspace(lo1, lo2 if lo2 >= lo1 else lo2 + 360_000_000, n_lon) / 1e6).tolist()

    def placed(v: np.ndarray) -> np.ndarray:
        down = bool(mode & 0x20)  # neighbours lie along a meridian
        v = v.reshape((n_lon, n_lat) if down else (n_lat, n_lon))
        if mode & 0x10:  # every other line runs back
            v = v.copy()
            v[1::2] = v[1::2, ::-1]
        v = v.T if down else v
        return (v[:, ::-1] if mode & 0x80 else v).reshape(-1)

    return {"lats": lats, "lons": lons}, placed


@lru_cache
def _codec(name: str) -> Codec:
    """The function ``module:name``, which the tasks can import."""
    module, function = name.split(":")
    return getattr(importlib.import_module(module), function)


def _values(packing: bytes, bitmap: bytes | None, data: bytes, codecs: dict[str, str]) -> np.ndarray:
    """All values in scanning order, NaN where they are missing."""
    count, template = struct.unpack(">IH", packing[5:11])
    if template in (0, 2, 3, 42):
        reference, binary, decimal, width = struct.unpack(">f", packing[11:15])[0], P.signed(packing[15:17]), P.signed(packing[17:19]), packing[19]
        gone = None
        if template == 0:
            x = P.integers(data, count, width)
        elif template == 42:
            x = P.rice_values(data, count, width, packing[21], packing[22], struct.unpack(">H", packing[23:25])[0])
        else:
            x, gone = P.complex_values(packing[19:], data)
        values = (reference + x * 2.0**binary) / 10.0**decimal
        if gone is not None and gone.any():
            values[gone] = np.nan
    elif template == 4 and packing[11] in (1, 2):
        values = np.frombuffer(data, ">f4" if packing[11] == 1 else ">f8", count).astype(np.float64)
    elif str(template) in codecs:
        values = np.asarray(_codec(codecs[str(template)])(packing, data, count), np.float64)
    else:
        raise ValueError(f"packing template {template}")
    if bitmap is not None:
        present = np.unpackbits(np.frombuffer(bitmap, np.uint8)).astype(bool)
        full = np.full(len(present), np.nan)
        full[np.flatnonzero(present)[: len(values)]] = values
        values = full
    return values


def fields(read: Read, at: int, columns: tuple[str, ...], wanted: Callable[[dict], bool] = lambda row: True, codecs: dict[str, str] = {}) -> Iterator[dict]:  # noqa: B006
    """The fields of the message at byte ``at`` that are ``wanted`` by variable and level. Sections that ``columns`` don't need
    aren't read. ``codecs``: functions (module:name) for packing templates that have no decoder here."""
    size, discipline = struct.unpack(">Q", read(at + 8, 8))[0], read(at + 6, 1)[0]
    end, pos, part = at + size - 4, at + 16, {}
    bitmap = None
    while pos < end:
        length, number = struct.unpack(">IB", read(pos, 5))
        if length < 5:
            raise ValueError("a section without length")
        if number in (3, 4, 5):
            part[number] = read(pos, length)
        elif number == 6:
            part[6] = (pos, length)
        elif number == 7:
            product = part[4]
            kind = product[22]
            row = dict(_NOTHING)
            row["variable"] = NAMES.get((discipline, product[9], product[10], kind), f"p{discipline}_{product[9]}_{product[10]}")
            scaled = struct.unpack(">I", product[24:28])[0] / 10 ** P.signed(product[23:24])
            row["level"] = scaled / 100 if kind == 100 else None
            if wanted(row):
                try:
                    if any(c in columns for c in (*_GRID, *_DATA)):
                        grid, placed = _grid(part[3])
                        row |= grid
                    if any(c in columns for c in _DATA):
                        start, n = part.get(6, (0, 0))
                        told = read(start + 5, 1)[0] if n else 255
                        bitmap = read(start + 6, n - 6) if told == 0 else bitmap if told == 254 else None
                        points = sum(grid["row_points"]) if "row_points" in grid else len(grid["lats"]) * len(grid["lons"])
                        values = _values(part[5], bitmap, read(pos + 5, length - 5), codecs)
                        if len(values) < points:
                            raise ValueError("data are cut off")
                        row["values"] = placed(values[:points]).astype(np.float32)
                except (struct.error, IndexError, ValueError) as e:
                    row["decode_error"] = str(e)
                yield row
        pos += length
    if pos != end:
        raise ValueError("its sections don't end where it does")


def message(raw: bytes, codecs: dict[str, str] = {}) -> dict:  # noqa: B006
    """The block of a message that has one field, or decode_error."""
    found = list(fields(lambda at, n: raw[at : at + n], 0, tuple(_NOTHING), codecs=codecs))
    return found[0] if found else _NOTHING | {"decode_error": "no field"}


def encode(variable: str, level: float | None, lats: list[float], lons: list[float] | None, values: np.ndarray, packing: str = "ieee", scale: int = -16, row_points: list[int] | None = None) -> bytes:
    """A message of one field on a regular grid, or on a reduced Gaussian one with ``row_points``.

    IEEE values in single precision are read back unchanged. Other packings (PACKINGS) hold whole multiples of 2**scale above
    the least value; missing values (NaN) are in a bitmap, or in complex packing among the numbers."""
    discipline, category, number, kind = next(k for k, v in NAMES.items() if v == variable)
    section = lambda no, body: struct.pack(">IB", len(body) + 5, no) + body
    micro = lambda x: P.to_signed(round(x * 1_000_000), 4)
    step = lambda x: abs(round((x[-1] - x[0]) / max(1, len(x) - 1) * 1_000_000))
    values, template = np.asarray(values, np.float32), PACKINGS[packing]
    north, reduced = lats[0] >= lats[-1], row_points is not None
    ends = (0.0, 360.0 - 360.0 / max(row_points)) if reduced else (lons[0], lons[-1])
    grid = struct.pack(">BIBBH", 0, len(values), 2 if reduced else 0, int(reduced), 40 if reduced else 0) + bytes([6]) + bytes(15) + struct.pack(">II", 0xFFFFFFFF if reduced else len(lons), len(lats)) + bytes(8)
    grid += micro(lats[0]) + micro(ends[0]) + bytes([48]) + micro(lats[-1]) + micro(ends[1])
    grid += struct.pack(">IIB", 0xFFFFFFFF if reduced else step(lons), len(lats) // 2 if reduced else step(lats), 0 if north else 0x40)
    grid += b"".join(struct.pack(">H", n) for n in row_points or ())
    product = struct.pack(">HHBB", 0, 0, category, number) + bytes(11) + struct.pack(">BBI", kind, 0, int(level * 100) if level is not None else 0) + bytes(6)
    gone = np.isnan(values)
    bits = section(6, b"\xff")
    if template not in (2, 3, 4) and gone.any():
        bits = section(6, b"\0" + np.packbits(~gone).tobytes())
    if template == 4:
        head, data, count = b"\1", values.astype(">f4").tobytes(), len(values)
    else:
        held = values[~gone].astype(np.float64)
        low = float(held.min(initial=math.inf)) if len(held) else 0.0
        x = np.floor((held - low) * 2.0**-scale + 0.5).astype(np.int64)
        width, count = int(x.max(initial=0)).bit_length(), len(held)
        head = struct.pack(">f", low) + P.to_signed(scale, 2) + P.to_signed(0, 2)
        if template == 0:
            head, data = head + bytes([width, 0]), P.packed_bits(x, width)
        elif template == 42:
            head, data = head + bytes([width, 0, P.PREPROCESS | 6, 32]) + struct.pack(">H", 128), P.rice_bytes(x, width, P.PREPROCESS | 6)
        else:
            full, count = np.zeros(len(values), np.int64), len(values)
            full[~gone] = x
            more, data = P.complex_section(full, gone, 2 if template == 3 else 0)
            head += more
    body = section(1, bytes(16)) + section(3, grid) + section(4, product) + section(5, struct.pack(">IH", count, template) + head) + bits + section(7, data)
    return b"GRIB\0\0" + bytes([discipline, 2]) + struct.pack(">Q", 16 + len(body) + 4) + body + b"7777"


def _column(rows: list[dict], name: str) -> pa.Array:
    values = [r[name] for r in rows]
    if name not in _LISTS:
        return pa.array(values, _KINDS.get(name, pa.string()))
    kind = _LISTS[name]
    ends = np.cumsum([0, *(0 if x is None else len(x) for x in values)]).tolist()
    # a null offset makes a null list
    offsets = pa.array([None if x is None else at for x, at in zip(values, ends, strict=False)] + ends[-1:], pa.int32())
    held = [np.asarray(x, kind.to_pandas_dtype()) for x in values if x is not None]
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(held) if held else [], kind))


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_column(rows, n) for n in names], names=names)


def _batches(rows: Iterator[dict], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Small decoded fields share a batch; a large field, or a row of headers only, has its own."""
    held, points = [], 0
    for row in rows:
        n = len(row["values"]) if row["values"] is not None else 0
        if held and points + n > BATCH_POINTS:
            yield _batch(held, names)
            held, points = [], 0
        held.append(row)
        points += n
        if "values" not in names or len(held) == BATCH_ROWS:
            yield _batch(held, names)
            held, points = [], 0
    if held:
        yield _batch(held, names)


def _decode(batches: Iterator[pa.RecordBatch], codecs: dict[str, str]) -> Iterator[pa.RecordBatch]:
    """A task holds one file and one batch of fields."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    yield from _batches(_decoded(batches, names, codecs), names)


def _decoded(batches: Iterator[pa.RecordBatch], names: list[str], codecs: dict[str, str]) -> Iterator[dict]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw, at, seen = content.as_py() or b"", 0, {}
            while (at := raw.find(b"GRIB", at)) >= 0:
                size = struct.unpack(">Q", raw[at + 8 : at + 16])[0] if len(raw) >= at + 16 else 0
                one = raw[at : at + size]
                try:
                    rows = list(fields(lambda a, n, one=one: one[a : a + n], 0, tuple(names), codecs=codecs))
                except (struct.error, IndexError, ValueError, KeyError) as e:
                    rows = [_NOTHING | {"decode_error": f"damaged message: {e}"}]
                for row in rows:
                    key = (row["variable"], row["level"])
                    seen[key] = seen.get(key, -1) + 1
                    yield row | {"source_file": path, "dataset_ord": seen[key]}
                # behind a damaged one the next may begin anywhere
                at += 4 if any((r["decode_error"] or "").startswith("damaged") for r in rows) else max(size, 4)


def _told(blocks: DataFrame, default_date: str, root: str = "") -> DataFrame:
    """With what the key below ``root`` tells: date, run and lead. A file is a cycle of its own, so lead times of one run stay apart."""
    date, run = K.path_date_run(F.col("source_file"), root, default_date)
    lead = F.split_part(K.base_name(F.col("source_file")), F.lit("-"), F.lit(2))
    return blocks.withColumn("date", date).withColumn("run", run).withColumn("lead", lead).withColumn("cycle", F.col("source_file"))


def decode(files: DataFrame, default_date: str = "19700101", codecs: dict[str, str] | None = None, root: str = "") -> DataFrame:
    """Blocks of GRIB2 files (path, content) below ``root``: a repeated field gets the next dataset_ord."""
    return _told(files.select("path", "content").mapInArrow(partial(_decode, codecs=codecs or {}), SCHEMA), default_date, root)


# Message by message, for stores that pyarrow opens


def store(path: str, anonymous: bool = False, region: str | None = None) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; an ``anonymous`` one sends no credentials to a public bucket."""
    path = re.sub(r"^s3[an]:", "s3:", path)
    if anonymous and path.startswith("s3:"):
        return fs.S3FileSystem(anonymous=True, region=region), re.sub(r"^s3:/*", "", path)
    return fs.FileSystem.from_uri(path) if re.match(r"\w+:/", path) else (fs.LocalFileSystem(), path)


class _Window:
    """Reads at any place, ``PEEK`` bytes at least; a SMALL file at once."""

    def __init__(self, file: pa.NativeFile, size: int) -> None:
        self.file, self.size, self.start, self.held = file, size, 0, b""

    def __call__(self, at: int, n: int) -> bytes:
        wanted = n
        if not (self.start <= at and at + n <= self.start + len(self.held)):
            start, n = (0, self.size) if self.size <= SMALL else (at, min(max(n, PEEK), max(self.size - at, 0)))
            if (start, n) != (self.start, len(self.held)):
                self.file.seek(start)
                self.start, self.held = start, self.file.read(n)
            return self.held[at - start : at - start + wanted]
        return self.held[at - self.start : at - self.start + n]


class Range:
    """The messages of a file that begin in a range of its bytes."""

    def __init__(self, path: str, start: int, stop: int, size: int) -> None:
        self.path, self.start, self.stop, self.size = path, start, stop, size


class Ranges(InputPartition):
    """Ranges that one task reads."""

    def __init__(self, ranges: list[Range]) -> None:
        self.ranges = ranges


def _packed(ranges: list[Range], most: int, tasks: int) -> list[Ranges]:
    """Neighbouring ranges by up to ``most`` bytes, in about ``tasks`` partitions where they are small. To open a file counts as OPEN bytes."""
    cost = [min(r.stop, r.size) - r.start + OPEN for r in ranges]
    limit, out, held = min(most, -(-sum(cost) // max(1, tasks))), [], 0
    for r, c in zip(ranges, cost, strict=True):
        if not out or held + c > limit:
            out.append(Ranges([]))
            held = 0
        out[-1].ranges.append(r)
        held += c
    return out or [Ranges([])]


def _begins(read: _Window, at: int) -> int:
    """The message's length, if one begins here: its last bytes are the end mark. 0 if none does, -1 if it is cut off."""
    head = read(at, 21)
    if len(head) < 21 or head[:4] != b"GRIB" or head[7] != 2 or head[20] != 1:
        return 0
    size = struct.unpack(">Q", head[8:16])[0]
    return size if 20 <= size <= read.size - at and read(at + size - 4, 4) == b"7777" else -1


class MessageReader(DataSourceReader):
    """Plans ranges of bytes of files, reads the headers of each message and the data of those that pass."""

    def __init__(self, options: dict, schema: StructType) -> None:
        self.path, self.names = options["path"], schema.fieldNames()
        self.access = {"anonymous": options.get("anonymous", "false") == "true", "region": options.get("region")}
        self.split, self.tasks = int(options.get("split", SPLIT)), int(options.get("tasks", TASKS))
        self.codecs = json.loads(options.get("codecs", "{}"))
        self.paths = json.loads(options["files"]) if "files" in options else None
        listed = lambda name: {x for x in options[name].split(",") if x} if name in options else None
        self.variables, levels, self.runs = listed("variables"), listed("levels"), listed("runs")
        self.levels = {None if x == "surface" else float(x) for x in levels} if levels is not None else None

    def partitions(self) -> list[InputPartition]:
        files, base = store(self.path, **self.access)
        if self.paths is not None:
            infos = files.get_file_info([store(p, **self.access)[1] for p in self.paths])
            return self._planned(infos)
        found = files.get_file_info(base)
        if found.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        infos = [found] if found.type == fs.FileType.File else files.get_file_info(fs.FileSelector(base, recursive=True))
        infos = [x for x in sorted(infos, key=lambda x: x.path) if x.type == fs.FileType.File and x.base_name.endswith(".grib2")]
        if self.runs is not None:
            run = K.root_date_run(base, "")[1]
            told = lambda path: (re.search(r"/(00z|06z|12z|18z)/", path[len(base.rstrip("/")) :].lower()) or ["", run])[1]
            infos = [x for x in infos if told(x.path) in self.runs]
        return self._planned(infos)

    def _planned(self, infos: list[fs.FileInfo]) -> list[InputPartition]:
        ranges = [Range(x.path, a, a + self.split, x.size) for x in infos for a in range(0, x.size, self.split)]
        return _packed(ranges, max(self.split, OPEN), self.tasks)

    def wanted(self, row: dict) -> bool:
        return (self.variables is None or row["variable"] in self.variables) and (self.levels is None or row["level"] in self.levels)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        yield from _batches((row for part in partition.ranges for row in self._read(part)), self.names)

    def _read(self, partition: Range) -> Iterator[dict]:
        files, _ = store(self.path, **self.access)
        prefix = self.path[: self.path.index(":") + 1] if re.match(r"\w+:/", self.path) else ""
        name = partition.path if not prefix else f"{prefix}{'' if prefix == 'file:' else '//'}{partition.path}"
        with files.open_input_file(partition.path) as file:
            read, at = _Window(file, partition.size), partition.start
            while at < min(partition.stop, partition.size):
                size = _begins(read, at)
                if size < 0:
                    yield _NOTHING | {"source_file": name, "offset": at, "decode_error": "damaged message: its end is missing"}
                if size <= 0:  # a range begins in the middle of a message, or bytes between two are no message
                    step = read(at + 1, PEEK).find(b"GRIB")
                    at += 1 + step if step >= 0 else max(min(PEEK, partition.size - at) - 3, 1)
                    continue
                try:
                    for row in fields(read, at, tuple(self.names), self.wanted, self.codecs):
                        yield row | {"source_file": name, "offset": at}
                except (struct.error, IndexError, ValueError, KeyError) as e:
                    yield _NOTHING | {"source_file": name, "offset": at, "decode_error": f"damaged message: {e}"}
                at += size


class PushingReader(MessageReader):
    """Also takes equality and IN predicates on variable and level from a query."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is None or f.attribute not in (("variable",), ("level",)):
                yield f
            elif f.attribute == ("variable",):
                self.variables = values if self.variables is None else self.variables & values
            else:
                self.levels = values if self.levels is None else self.levels & values


class GribSource(DataSource):
    """``spark.read.format("grib2")``: a row for each field of the .grib2 files at or below a path, which pyarrow can open.

    Options: variables, levels ("surface" for none) and runs, lists with commas of what to read; files, a JSON list of files
    instead of all below the path; split, bytes of a file to a
    partition; tasks, about how many partitions small files are packed into; codecs, a JSON map of packing templates to functions (module:name) that decode them in the tasks; anonymous and region, for a public bucket; pushdown, whether a query's own predicates on variable and level are tested on headers too. Columns are those of
    MESSAGES or a part given by ``.schema()``: without values and decode_error, no data section is read. Files may have any size.
    """

    @classmethod
    def name(cls) -> str:
        return "grib2"

    def schema(self) -> str:
        return MESSAGES

    def reader(self, schema: StructType) -> MessageReader:
        pushing = self.options.get("pushdown", "false") == "true"
        return (PushingReader if pushing else MessageReader)(dict(self.options), schema)


def messages(spark: SparkSession, path: str, variables: tuple[str, ...] | None = None, levels: tuple[float | None, ...] | None = None, runs: tuple[str, ...] | None = None, columns: tuple[str, ...] | None = None, codecs: dict[str, str] | None = None) -> DataFrame:
    """Rows of ``GribSource``. Predicates of the query itself reach it where spark.sql.python.filterPushdown.enabled is set."""
    spark.dataSource.register(GribSource)
    reader = spark.read.format("grib2").option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    reader = reader.option("tasks", _tasks(spark))
    if codecs:
        reader = reader.option("codecs", json.dumps(codecs))
    if variables is not None:
        reader = reader.option("variables", ",".join(variables))
    if levels is not None:
        reader = reader.option("levels", ",".join("surface" if x is None else repr(float(x)) for x in levels))
    if runs is not None:
        reader = reader.option("runs", ",".join(runs))
    if columns is not None:
        reader = reader.schema(", ".join(c for c in MESSAGES.split(", ") if c.split()[0] in columns))
    return reader.load(qualified(spark, path))


def _tasks(spark: SparkSession) -> int:
    return max(TASKS, 4 * spark.sparkContext.defaultParallelism)


def qualified(spark: SparkSession, path: str) -> str:
    """With its scheme; without one a path is on Spark's default file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()


def _opens(path: str) -> bool:
    return re.match(r"(file|s3a?|s3n|gs|hdfs|abfss?):", path) is not None


def read_fields(spark: SparkSession, path: str, default_date: str = "19700101", variables: tuple[str, ...] | None = None, levels: tuple[float | None, ...] | None = None, codecs: dict[str, str] | None = None) -> DataFrame:
    """Blocks of all GRIB2 files below ``path``, or of the chosen variables and levels: message by message where pyarrow opens
    the store, else a file as a whole (2 GB at most)."""
    path = qualified(spark, path)
    if _opens(path):
        rows = messages(spark, path, variables, levels, codecs=codecs)
        order = Window.partitionBy("source_file", "variable", "level").orderBy("offset")
        return _told(rows.withColumn("dataset_ord", (F.row_number().over(order) - 1).cast("int")).drop("offset"), default_date, path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.grib2").load(path)
    rows = decode(files, default_date, codecs, path)
    if variables is not None:
        rows = rows.where(F.col("variable").isin(*variables))
    if levels is not None:
        some = [float(x) for x in levels if x is not None]
        rows = rows.where(F.col("level").isin(*some) | (F.lit(None in levels) & F.col("level").isNull()))
    return rows


def read_files(spark: SparkSession, paths: list[str], default_date: str = "19700101", root: str = "") -> DataFrame:
    """Blocks of the files named, of one store, below ``root``."""
    if _opens(paths[0]):
        spark.dataSource.register(GribSource)
        rows = spark.read.format("grib2").option("files", json.dumps(paths)).option("tasks", _tasks(spark)).load(paths[0])
        order = Window.partitionBy("source_file", "variable", "level").orderBy("offset")
        return _told(rows.withColumn("dataset_ord", (F.row_number().over(order) - 1).cast("int")).drop("offset"), default_date, root)
    return decode(spark.read.format("binaryFile").load(paths), default_date, root=root)


def read_public(spark: SparkSession, bucket: str, date: str, run: str, prefix: str = "", lead: str = "0h", region: str | None = None) -> DataFrame:
    """Blocks of the file that a public archive has for a date and run (00z), read without credentials."""
    spark.dataSource.register(GribSource)
    key = spark.range(1).select(K.candidate_key(F.lit(prefix), F.lit(date), K.normalize_run(F.lit(run)), lead)).first()[0]
    reader = spark.read.format("grib2").option("anonymous", "true")
    rows = (reader.option("region", region) if region else reader).load(f"s3://{bucket}/{key}")
    order = Window.partitionBy("variable", "level").orderBy("offset")
    return _told(rows.withColumn("dataset_ord", (F.row_number().over(order) - 1).cast("int")).drop("offset"), date, f"s3://{bucket}")


def read_merged(spark: SparkSession, path: str, default_date: str = "19700101", variables: tuple[str, ...] | None = None, levels: tuple[float | None, ...] | None = None) -> DataFrame:
    """The merged dataset of each file: decoded fields without dropped coordinates, of the first dataset that has them, on
    one regular grid, from north to south."""
    return merged(read_fields(spark, path, default_date, variables, levels))


def merged(blocks: DataFrame, each: tuple[str, ...] = ("variable",)) -> DataFrame:
    """Decoded blocks merged by cycle: of datasets that have the same variable, or what ``each`` names, the first gives it."""
    from gridloom.operators import fields as B

    good = blocks.where("decode_error is null").drop("decode_error")
    return B.lat_descending(B.align_blocks(B.first_wins(B.drop_coords(B.regular_grid(good)), ["cycle", *each])))


def by_cycle(blocks: DataFrame, priority: Column | None = None) -> DataFrame:
    """Blocks of several files as datasets of one cycle, ``DATE/RUN/LEAD``, which becomes their source_file. Datasets are in the
    order of ``priority`` (of the file), then of the file's key, then as they are in the file.

    Only the names of files and datasets are ordered; blocks stay where they are and get their number by a join."""
    cycle = F.concat_ws("/", "date", "run", "lead")
    rank = priority if priority is not None else F.lit(0)
    names = blocks.select(cycle.alias("cycle"), "source_file", "dataset_ord", rank.alias("_rank")).distinct()
    order = Window.partitionBy("cycle").orderBy("_rank", "source_file", "dataset_ord")
    names = names.withColumn("_ord", (F.row_number().over(order) - 1).cast("int")).select("source_file", "dataset_ord", "_ord")
    out = blocks.join(names, ["source_file", "dataset_ord"]).withColumn("dataset_ord", F.col("_ord")).drop("_ord")
    return out.withColumn("cycle", cycle).withColumn("source_file", cycle)
