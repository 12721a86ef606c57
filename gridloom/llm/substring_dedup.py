"""Incremental removal of repeated passages with a log-structured index of window fingerprints."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm._shared import bound_batches, materialize, new_path, remove, shuffles_dropped, text_chunks
from gridloom.llm._text import WIDE_TOO, Words

WIDTH = 13
GRAM = 5
#: Sub-partitions of a key for rows whose answer is known already, so that a hot key's rows spread out.
SALTS = 64
_LAST = np.iinfo(np.int64).max


def _prints(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each window: its hash, its text, its first word and its fingerprint, which is the least hash of its 5-grams.

    Equal windows have equal fingerprints, and neighbouring windows mostly share theirs, so that there is about one
    fingerprint for five windows.
    """
    full, text, at = words.windows(hashes, WIDTH)
    gram = np.full(len(hashes), np.uint64(2**64 - 1))
    some, _, where = words.windows(hashes, GRAM, 1)
    gram[where] = some
    low, have, want = gram, 1, WIDTH - GRAM + 1
    while have < want:
        step = min(have, want - have)
        if len(low) <= step:
            break
        low = np.minimum(low[:-step], low[step:])
        have += step
    return full, text, at, low[at] if len(at) else full


def _dealt(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, doc) pairs sorted, first of each key, whether the key has several docs here, and the pairs' places."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    key, doc, order = key[new], doc[new], order[new]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    group = np.cumsum(first) - 1
    many = np.bincount(group, minlength=1)[group] > 1 if len(key) else first
    return key, doc, first, many, order


def _salt(doc: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.where(first, 0, 1 + doc.astype(np.uint64) % np.uint64(SALTS)).astype(np.int32)


def _ids(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return pc.fill_null(batch.column(batch.schema.get_field_index(name)), int(_LAST)).to_numpy(zero_copy_only=False).astype(np.int64)


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], names=list(columns))


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's first document of a fingerprint stands for the chunk (salt 0); the others are known to share it."""
    for batch in text_chunks(batches, "text"):
        words = Words(batch.column(1))
        _, text, _, low = _prints(words, words.hashes())
        change = np.ones(len(low), bool)
        change[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1])
        key, doc, first, many, _ = _dealt(low[change].view(np.int64), _ids(batch, "doc_id")[text[change]])
        yield _batch(print=key, salt=_salt(doc, first), doc=doc, many=many)


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows under a document's shared fingerprints; those known to repeat a smaller document have many = true.

    A window is told by 96 bits of two independent hashes of its words: by 64 bits alone, some of 10^12 windows would meet others.
    Within a chunk of about 1 MB, where there are few, 64 bits tell which come twice."""
    for batch in text_chunks(batches, "text"):
        words = Words(batch.column(1))
        hashes = words.hashes()
        full, text, _, low = _prints(words, hashes)
        tag, _, _ = words.windows(hashes, WIDTH, 2, WIDE_TOO)
        lists = pc.fill_null(batch.column(2), [])
        size = np.asarray(pc.list_value_length(lists))
        spread = np.uint64(0x9E3779B97F4A7C15)
        have = np.asarray(lists.flatten()).astype(np.int64).view(np.uint64) * spread + np.repeat(np.arange(len(size)), size).astype(np.uint64)
        keep = np.isin(low * spread + text.astype(np.uint64), have)
        key, doc, first, _, at = _dealt(full[keep].view(np.int64), _ids(batch, "doc_id")[text[keep]])
        yield _batch(print=key, tag=(tag[keep][at] >> np.uint64(32)).astype(np.uint32).view(np.int32), salt=_salt(doc, first), doc=doc, many=~first)


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches, "text"):
        words = Words(batch.column(1))
        full, text, at = words.windows(words.hashes(), WIDTH)
        lists = pc.fill_null(batch.column(2), [])
        size = np.asarray(pc.list_value_length(lists))
        flat, edge = np.asarray(lists.flatten()).astype(np.int64).view(np.uint64), np.concatenate([[0], np.cumsum(size)])
        gone = np.zeros(len(words.starts) + 1, np.int32)
        for i in np.flatnonzero(size):
            own = slice(*np.searchsorted(text, [i, i + 1]))
            hit = at[own][np.isin(full[own], flat[edge[i] : edge[i + 1]])]
            gone[hit] += 1
            np.add.at(gone, hit + WIDTH, -1)
        gone = np.cumsum(gone[:-1]) > 0
        raw, sums, removed = words.data.tobytes(), [], np.zeros(batch.num_rows, np.int64)
        for i in range(batch.num_rows):
            a, b = words.first[i], words.first[i + 1]
            if size[i]:
                live = np.flatnonzero(~gone[a:b]) + a
                removed[i] = b - a - len(live)
                text_bytes = b" ".join([raw[s:e] for s, e in zip(words.starts[live].tolist(), words.ends[live].tolist(), strict=True)])
            else:
                text_bytes = b" ".join(raw[words.starts[a] : words.ends[b - 1]].split()) if b > a else b""
            sums.append(hashlib.sha256(text_bytes).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words.counts.astype(np.int64)), pa.array(removed), pa.array(sums, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


_ROWS = "print long, salt int, doc long, many boolean"
_WINDOWS = "print long, tag int, salt int, doc long, many boolean"


class SubstringIndex:
    """Removes words that lie in a window of 13 words which also starts in a document with a smaller doc_id.

    The index holds sorted immutable runs, one for each batch that was appended: (fingerprint, document) rows, bucketed
    by fingerprint, in the shared folder. ``append`` writes the batch's run, merges it with the older runs by fingerprint, and verifies: the
    windows under fingerprints that several documents share are compared by 96 bits of independent hashes of all 13
    words, and a window's smallest document is found. With more than ``fanout`` runs the index is compacted to one.

    With a ``path`` in the shared store the index outlives its session: after each batch the runs, their folders and their number
    of buckets are written to the next manifest below it, and opening the path again goes on from the last one that is
    whole; without, runs lie in the scratch folder until ``close``.

    Batches must come in ascending order of doc_id; ``history`` gives the texts of all documents appended so far.
    Null text has no words; null doc_id counts as the largest. Rows of equal doc_id don't repeat each other. Empty
    batches give an empty result. Other columns are ignored.
    """

    def __init__(self, spark: SparkSession, fanout: int = 4, path: str | None = None) -> None:
        self.spark, self.fanout, self.runs, self.buckets = spark, fanout, [], 0
        self.paths: dict[str, str] = {}
        self.path, self.number = path.rstrip("/") if path else None, 0
        bound_batches(spark)
        if self.path:
            self._open()

    def _open(self) -> None:
        """Takes up the runs of the last manifest; tables that this session doesn't know are made known."""
        files = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        store = files.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        path = lambda name: self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        found = [x.getPath().getName() for x in store.listStatus(files)] if store.exists(files) else []
        numbers = sorted(int(x[9:]) for x in found if x.startswith("manifest-") and store.exists(path(f"{x}/_SUCCESS")))
        if not numbers:
            return
        self.number = numbers[-1]
        for row in self.spark.read.parquet(f"{self.path}/manifest-{self.number}").orderBy("place").collect():  # a row for each run, fanout + 1 at most
            name, self.buckets = row["name"], row["buckets"]
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (print LONG, salt INT, doc LONG, many BOOLEAN, shared BOOLEAN) USING parquet CLUSTERED BY (print, salt) SORTED BY (print, salt, doc) INTO {self.buckets} BUCKETS LOCATION '{row['path']}'")
            self.runs.append(name)
            self.paths[name] = row["path"]

    def _save(self, old: list[str]) -> None:
        """Writes the next manifest; only then the runs that it doesn't have any more, and the manifest before, go."""
        if self.path:
            rows = [(i, name, self.paths[name], self.buckets) for i, name in enumerate(self.runs)]
            self.spark.createDataFrame(rows, "place int, name string, path string, buckets int").coalesce(1).write.parquet(f"{self.path}/manifest-{self.number + 1}")
            if self.number:
                remove(self.spark, f"{self.path}/manifest-{self.number}")
            self.number += 1
        self._drop(old)

    def _write_run(self, rows: DataFrame) -> str:
        """A table in buckets by key, each sorted: runs of one index are merge-joined without another shuffle."""
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions")) if not self.buckets else self.buckets
        self.buckets = n
        by = Window.partitionBy("print", "salt")
        rows = rows.repartition(n, "print", "salt").withColumn("shared", F.col("many") | (F.col("salt") > 0) | (F.count("*").over(by) > 1))
        name = f"gridloom_run_{uuid.uuid4().hex}"
        self.paths[name] = f"{self.path}/{name}" if self.path else new_path(self.spark, "substring-run")
        with shuffles_dropped(self.spark):
            rows.write.bucketBy(n, "print", "salt").sortBy("print", "salt", "doc").option("path", self.paths[name]).saveAsTable(name)
        return name

    def _drop(self, runs: list[str]) -> None:
        for name in runs:
            self.spark.sql(f"DROP TABLE {name}")
            remove(self.spark, self.paths.pop(name))

    def close(self) -> None:
        """Drops all runs; of an index with a path only what this session knows of them."""
        for name in self.runs if self.path else []:
            self.spark.sql(f"DROP TABLE {name}")
        if not self.path:
            self._drop(self.runs)
        self.runs = []

    def compact(self) -> None:
        """Merges all runs into one."""
        self._save(self._merged())

    def _merged(self) -> list[str]:
        """Replaces the runs by one and returns the old ones, which are still there."""
        if len(self.runs) < 2:
            return []
        merged = reduce(DataFrame.unionByName, [self.spark.table(r).select("print", "salt", "doc", "many") for r in self.runs])
        old, self.runs = self.runs, [self._write_run(merged)]
        return old

    def _candidates(self, new: str) -> tuple[DataFrame, DataFrame | None]:
        """(doc, print) of the batch's, and of older, documents with a fingerprint that the batch shares with others."""
        run = self.spark.table(new)
        found, older = run.where("shared").select("doc", "print"), None
        keys = ["print", "salt"]
        lead = run.where("salt = 0")
        for r in self.runs:
            old = self.spark.table(r)
            front = old.where("salt = 0")
            found = found.unionByName(lead.join(front.select(*keys), keys, "left_semi").select("doc", "print"))
            met = front.join(lead.select(*keys), keys, "left_semi")
            # documents that a chunk's first one stood for
            rest = old.where("salt > 0").join(met.where("many").select("print").distinct(), "print", "left_semi")
            both = met.select("doc", "print").unionByName(rest.select("doc", "print"))
            older = both if older is None else older.unionByName(both)
        return found, older

    def append(self, batch: DataFrame, history: DataFrame | None = None) -> DataFrame:
        """doc_id, n_words, n_removed and kept_sha256 (of the kept words joined by a space) for each row of ``batch``."""
        docs = batch.select("doc_id", "text")
        new = self._write_run(docs.mapInArrow(_fingerprint_rows, _ROWS))
        key = F.coalesce("doc_id", F.lit(int(_LAST)))
        keyed = docs.withColumn("doc", key)
        listed = lambda rows: rows.groupBy("doc").agg(F.collect_set("print").alias("prints"))
        under = lambda texts, rows: texts.join(listed(rows), "doc").select("doc_id", "text", "prints").mapInArrow(_window_rows, _WINDOWS)
        found, older = self._candidates(new)
        windows = under(keyed, found)
        if older is not None and history is not None:
            windows = windows.unionByName(under(history.select("doc_id", "text").withColumn("doc", key), older))
        least = F.min("doc").over(Window.partitionBy("print", "tag", "salt"))
        gone = windows.withColumn("least", least).where(F.col("many") | (F.col("doc") > F.col("least"))).groupBy("doc").agg(F.collect_set("print").alias("windows"))
        out = keyed.join(gone, "doc", "left").select("doc_id", "text", "windows").mapInArrow(_kept_rows, "doc_id long, n_words long, n_removed long, kept_sha256 string")
        out = materialize(out, "substring-kept")
        self.runs.append(new)
        self._save(self._merged() if len(self.runs) > self.fanout else [])
        return out


def remove_repeats(docs: DataFrame, batches: int = 3, fanout: int = 2) -> DataFrame:
    """Appends ``docs`` to a new index in ``batches`` ranges of doc_id, which is dropped afterwards; the result doesn't
    depend on their number. With the default numbers the last batch is merged with two runs, and then all are compacted."""
    docs = docs.select("doc_id", "text")
    cuts = docs.select(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000).alias("c")).first()["c"] if batches > 1 else []
    index, edges, out, before = SubstringIndex(docs.sparkSession, fanout), [None, *sorted(set(cuts or [])), None], None, None
    try:
        for low, high in zip(edges, edges[1:], strict=False):
            part = F.lit(True)
            if low is not None:
                part = part & ((F.col("doc_id") > low) | F.col("doc_id").isNull())
            if high is not None:
                part = part & (F.col("doc_id") <= high)
            done = index.append(docs.where(part), before)
            before = docs.where(F.col("doc_id") <= high) if high is not None else None
            out = done if out is None else out.unionByName(done)
    finally:
        index.close()
    return out


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH w AS (SELECT coalesce(doc_id, 9223372036854775807) AS doc, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws, row_number() OVER () AS r FROM documents),
s AS (SELECT r, doc, unnest(range(1, len(ws) - 11)) AS i, ws FROM w WHERE len(ws) >= 13),
k AS (SELECT r, doc, i, sha256(array_to_string(ws[i:i + 12], ' ')) AS h FROM s),
m AS (SELECT h, min(doc) AS first FROM k GROUP BY h),
g AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS j FROM k JOIN m USING (h) WHERE k.doc > m.first),
a AS (SELECT r, list(j) AS gone FROM g GROUP BY r),
o AS (SELECT doc_id, ws, list_filter(range(1, len(ws) + 1), lambda j: NOT list_contains(coalesce(gone, []), j)) AS live FROM w LEFT JOIN a USING (r))
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - len(live) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_transform(live, lambda j: ws[j]), ' '), '')) AS kept_sha256 FROM o
"""
