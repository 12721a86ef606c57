"""A Python data source for WARC archives, and the page archive that is written to and read from it."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from gridloom.llm._shared import new_path

SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_length long, payload binary, digest_ok boolean"
#: Columns that are known once the headers are parsed.
HEADERS = ("record_id", "record_type", "target_uri", "refers_to", "payload_digest")
READ, GROUP_BYTES, BATCH_BYTES = 1 << 20, 32 << 20, 8 << 20
#: Longest WARC header of a record.
HEAD_BYTES = 1 << 20
_GZIP = b"\x1f\x8b\x08"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    path = re.sub(r"^s3[an]:", "s3:", path)
    return fs.FileSystem.from_uri(path) if re.match(r"\w+:/", path) else (fs.LocalFileSystem(), path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(record: bytes, level: int) -> bytes:
    """One gzip member with the lengths of its compressed and raw bytes in an ``sl`` extra field, so that readers can skip it."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(record) + z.flush()
    size = 24 + len(body) + 8
    if size >> 32 or len(record) >> 32:
        return _GZIP + b"\0\0\0\0\0\0\xff" + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    return _GZIP + b"\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(record)) + body + struct.pack("<II", zlib.crc32(record), len(record))


def record(row: dict, date: str) -> bytes:
    """The record's bytes. A revisit has the HTTP headers, with the payload's length, but no payload."""
    payload = row["payload"] or b""
    one = lambda x: re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", x)
    length = row["payload_length"] if row["payload_length"] is not None else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if row["record_type"] == "revisit" else http + payload
    head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))), ("WARC-Payload-Digest", f"sha1:{row['payload_digest'] or digest(payload)}")]
    if row["target_uri"] is not None:
        head.append(("WARC-Target-URI", one(row["target_uri"])))
    if row["record_type"] == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<{row['refers_to']}>")]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    """Each task writes one file aside; the commit moves the files of tasks that ended well into place."""

    def __init__(self, path: str, date: str, level: int, overwrite: bool) -> None:
        self.path, self.date, self.level, self.overwrite, self.aside = path, date, level, overwrite, f"_aside-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = _store(self.path)
        name, out = f"part-{uuid.uuid4().hex}.warc.gz", None
        for batch in iterator:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if out is None:
                        store.create_dir(f"{base}/{self.aside}")
                        out = store.open_output_stream(f"{base}/{self.aside}/{name}", compression=None)
                    out.write(member(record(row, self.date), self.level))
        if out is None:
            return Written()
        out.close()
        return Written([name])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, base = _store(self.path)
        store.create_dir(base)
        if self.overwrite:
            for info in store.get_file_info(fs.FileSelector(base)):
                if info.type == fs.FileType.File and info.base_name.endswith(".warc.gz"):
                    store.delete_file(info.path)
        for name in (n for m in messages if m for n in m.files):
            store.move(f"{base}/{self.aside}/{name}", f"{base}/{name}")
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, base = _store(self.path)
        if store.get_file_info(f"{base}/{self.aside}").type == fs.FileType.Directory:
            store.delete_dir(f"{base}/{self.aside}")


class _File:
    """A forward reader that can skip and take back."""

    def __init__(self, store: fs.FileSystem, path: str) -> None:
        self.file, self.held = store.open_input_file(path), b""

    def peek(self, n: int) -> bytes:
        if len(self.held) < n:
            self.held += self.file.read(max(READ, n))
        return self.held[:n]

    def take(self, n: int) -> bytes:
        out = self.held[:n] if self.held else self.file.read(n)
        self.held = self.held[n:]
        return out

    def untake(self, raw: bytes) -> None:
        self.held = raw + self.held

    def skip(self, n: int) -> None:
        here = min(n, len(self.held))
        self.held = self.held[here:]
        if n > here:
            self.file.seek(n - here, 1)


class _Member:
    """The raw bytes of one gzip member. Of one that tells its length, what isn't read is skipped without inflating it."""

    def __init__(self, file: _File) -> None:
        self.file, self.z, start = file, zlib.decompressobj(31), file.peek(24)
        known = len(start) == 24 and start[3] == 4 and start[12:14] == b"sl"
        self.left = struct.unpack("<I", start[16:20])[0] if known else None

    def read(self) -> bytes:
        while not self.z.eof:
            data = self.z.unconsumed_tail
            if not data:
                data = self.file.take(65536 if self.left is None else min(65536, self.left))
                if not data:
                    raise EOFError("a member is cut off")
                self.left = None if self.left is None else self.left - len(data)
            got = self.z.decompress(data, 65536)
            if got:
                return got
        return b""

    def skip(self, n: int) -> int:
        return 0

    def alone(self) -> bool:
        """Whether what is left of the member needn't be read to find the next one."""
        return self.left is not None

    def finish(self) -> None:
        if self.left is None:
            while self.read():
                pass
            self.file.untake(self.z.unused_data)
        else:
            self.file.skip(self.left)


class _Plain:
    """The bytes of an uncompressed file."""

    def __init__(self, file: _File) -> None:
        self.file = file

    def read(self) -> bytes:
        return self.file.take(65536)

    def skip(self, n: int) -> int:
        self.file.skip(n)
        return n

    def alone(self) -> bool:
        return False

    def finish(self) -> None:
        pass


class _Bytes:
    """A window over a source of bytes."""

    def __init__(self, source: _Member | _Plain) -> None:
        self.source, self.held = source, bytearray()

    def more(self) -> bool:
        got = self.source.read()
        self.held += got
        return bool(got)

    def find(self, mark: bytes, most: int) -> int:
        """Where ``mark`` begins within the next ``most`` bytes, or -1; each byte is searched once."""
        seen = 0
        while (at := self.held.find(mark, seen, most)) < 0 and len(self.held) < most:
            seen = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                break
        return at

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def drop(self, n: int) -> None:
        while n > 0:
            here = min(n, len(self.held))
            del self.held[:here]
            n -= here
            if n:
                n -= self.source.skip(n)
                if n and not self.more():
                    return


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...] = ()


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType) -> None:
        self.path, self.names = path, [f.name for f in schema.fields]
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else ""
            if name in HEADERS and isinstance(f, EqualTo | StringStartsWith) and f.value is not None:
                self.tests.append(("prefix" if isinstance(f, StringStartsWith) else "in", name, (f.value,)))
            elif name in HEADERS and isinstance(f, In):
                self.tests.append(("in", name, tuple(f.value)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, base = _store(self.path)
        out, held, size = [], [], 0
        for info in sorted(store.get_file_info(fs.FileSelector(base, allow_not_found=True)), key=lambda x: x.path):
            if info.type == fs.FileType.File and info.base_name.endswith((".warc.gz", ".warc")):
                if held and size + info.size > GROUP_BYTES:
                    out.append(Files(tuple(held)))
                    held, size = [], 0
                held.append(info.path)
                size += info.size
        return [*out, Files(tuple(held))]

    def wanted(self, row: dict) -> bool:
        ok = lambda how, x, to: x is not None and (x.startswith(to) if how == "prefix" else x in to)
        return all(ok(how, row[name], to) for how, name, to in self.tests)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        kinds = {"payload_length": pa.int64(), "payload": pa.binary(), "digest_ok": pa.bool_()}
        rows: list[dict] = []
        size = 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in self.names], names=self.names)
        for path in partition.paths:
            for row in self.records(_File(store, path)):
                rows.append(row)
                size += 200 + len(row.get("payload") or b"")
                if size >= BATCH_BYTES:
                    yield batch()
                    rows, size = [], 0
        if rows:
            yield batch()

    def records(self, file: _File) -> Iterator[dict]:
        """The records of a file that pass, in members of their own, several in one, or uncompressed. Of others, and where
        no payload is asked for, nothing behind the headers is kept; nor inflated, if the member tells its length."""
        while start := file.peek(3):
            source = _Member(file) if start == _GZIP else _Plain(file)
            raw = _Bytes(source)
            while (row := self.record(raw)) is not None:
                if row:
                    yield row
                if source.alone():
                    break
            source.finish()

    def record(self, raw: _Bytes) -> dict | None:
        """The next record, empty if it isn't wanted; None at the end."""
        while raw.held[:2] == b"\r\n" or len(raw.held) < 2 and raw.more():
            if raw.held[:2] == b"\r\n":
                raw.drop(2)
        if not raw.held:
            return None
        end = raw.find(b"\r\n\r\n", HEAD_BYTES)
        if end < 0 or not raw.held.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        row = self.parse(raw.take(end + 4))
        size = row.pop("_block")
        if not self.wanted(row):
            if not raw.source.alone():
                raw.drop(size + 4)
            return {}
        while len(raw.held) < min(size, 5) and raw.more():
            pass
        if raw.held[:5] == b"HTTP/" and (http := raw.find(b"\r\n\r\n", size)) >= 0:
            told = re.search(rb"\r\ncontent-length: *(\d+)", raw.take(http + 4), re.IGNORECASE)
            size -= http + 4
            # a revisit has no payload: its headers tell the length of the other record's
            row["payload_length"] = int(told[1]) if told else size
        elif row["record_type"] != "revisit":
            row["payload_length"] = size
        if row["record_type"] != "revisit" and ("payload" in self.names or "digest_ok" in self.names):
            payload = raw.take(size)
            if len(payload) < size:
                raise EOFError("a record is cut off")
            row["payload"], size = payload, 0
            row["digest_ok"] = digest(payload) == row["payload_digest"] if row["payload_digest"] else None
        if not raw.source.alone():
            raw.drop(size + 4)
        return row

    @staticmethod
    def parse(raw: bytes) -> dict:
        head = dict(x.split(":", 1) for x in raw.decode("utf-8", "replace").split("\r\n")[1:] if ":" in x)
        head = {k.strip().lower(): v.strip() for k, v in head.items()}
        bare = lambda x: x[1:-1] if x and x[0] == "<" else x
        return {
            "record_id": bare(head.get("warc-record-id")), "record_type": head.get("warc-type"), "target_uri": bare(head.get("warc-target-uri")), "refers_to": bare(head.get("warc-refers-to")),
            "payload_digest": (head.get("warc-payload-digest") or "").removeprefix("sha1:") or None, "payload_length": None, "_block": int(head.get("content-length") or 0),
        }


class WarcSource(DataSource):
    """``spark.read.format("warc")``: the .warc.gz and .warc files of a folder. Of any record but a revisit the payload is the
    block, without the HTTP headers where it has them; transfer and content codings are left as they are. A path without
    scheme is a local one. Options: path; for writing also date and level.

    Columns are those of SCHEMA or a part of them given by ``.schema()``; without payload and digest_ok no payload is
    decoded. Equality, IN and prefix predicates on header columns are tested on a record's headers, before its payload.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], self.options.get("date", "1970-01-01T00:00:00Z"), int(self.options.get("level", "3")), overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known, and lets predicates reach it: Spark refuses readers that take them while this setting is off."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def to_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """The WARC record of each row of ``pages`` (page_id, url, html).

    Payloads of at least ``least`` bytes that are equal share one response, the row with the smallest page_id; others
    revisit it. Rows of one page_id that tie for it are all responses. Null html is an empty payload, null page_id sorts
    after all others, null url has no target. Control characters and spaces of a url are percent-encoded. Other columns are ignored.
    """
    page = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    page = page.withColumn("sha1", F.sha1("html")).withColumn("bytes", F.octet_length("html").cast("long"))
    # only digests that occur more than once are joined; a hot one's rows can be split, as they meet one row
    first = page.where(F.col("bytes") >= least).groupBy("sha1", "bytes").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("sha1").alias("f_sha1"), F.col("bytes").alias("f_bytes"), "first_id", F.lit(True).alias("repeated"))
    page = page.join(first, (F.col("sha1") == F.col("f_sha1")) & (F.col("bytes") == F.col("f_bytes")), "left")
    again = F.coalesce("repeated", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    urn = lambda c: F.concat(F.lit("urn:x-page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")))
    return page.select(
        urn("page_id").alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), F.col("url").alias("target_uri"), F.when(again, urn("first_id")).alias("refers_to"),
        base32(F.col("sha1")).alias("payload_digest"), F.col("bytes").alias("payload_length"), F.when(~again, F.col("html").cast("binary")).alias("payload"),
    )


def base32(hexed):
    """Base32 of a hex string of 40 digits."""
    five = lambda i: F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 10).cast("int")
    letter = lambda i, j: F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), F.shiftright(five(i), 15 - 5 * j).bitwiseAND(F.lit(31)) + 1, F.lit(1))
    return F.concat(*[letter(i, j) for i in range(8) for j in range(4)])


def page_archive(pages: DataFrame, path: str, least: int = 0) -> DataFrame:
    """Writes ``pages`` to archives under ``path`` and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to, digest_ok.

    Responses are decoded and their digests are checked; of revisits only the headers are read. Empty table: empty result.
    """
    spark = pages.sparkSession
    register(spark)
    to_records(pages, least).write.format("warc").option("path", path).option("date", "2024-01-01T00:00:00Z").mode("append").save()
    columns = [x.strip() for x in SCHEMA.split(",")]
    whole = spark.read.format("warc").option("path", path).schema(SCHEMA).load().where("record_type = 'response'")
    heads = spark.read.format("warc").option("path", path).schema(", ".join(columns[:6])).load().where("record_type = 'revisit'")
    ids = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) as bigint)")
    kept = ["record_id", "record_type", "refers_to", "payload_digest"]
    both = whole.select(*kept, F.octet_length("payload").cast("long").alias("payload_bytes"), "digest_ok").unionByName(heads.select(*kept, F.col("payload_length").alias("payload_bytes"), F.lit(None).cast("boolean").alias("digest_ok")))
    return both.select(ids("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", ids("refers_to").alias("refers_to"), "digest_ok")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), new_path(spark, "warc"))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha1(body) AS x FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x, payload_bytes) AS first_id FROM h)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((CAST(('0x' || substr(x, CAST(i // 4 * 5 + 1 AS BIGINT), 5)) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS BIGINT) + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN true END AS digest_ok
FROM f
"""
