"""Cycles whose fields arrive in several files: each is published once, when it is whole, and reported when it is late."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructField, StructType, StringType

from gridloom.operators import fields as B
from gridloom.plans import job
from gridloom.sources import grib

#: Names of all fields of a whole cycle.
WANTED = (*B.SURFACE, *(f"{v}@{p}" for v in ("gh", *B.UPPER_RAW) for p in B.LEVELS))
EVENTS = "cycle string, event string, n_fields long, missing string, files string"


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fields of files, by their messages' headers."""
    schema = StructType([StructField(c, StringType()) for c in ("source_file", "variable", "level")])
    for batch in batches:
        for path in batch.column(0).to_pylist():
            reader = grib.MessageReader({"path": path, "split": 1 << 62}, schema)
            rows = [r for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()]
            names = [r["variable"] if r["level"] is None else f"{r['variable']}@{int(r['level'])}" for r in rows if r["variable"]]
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(names), pa.string()), pa.array(names, pa.string())], names=["path", "field"])


def arriving_fields(spark: SparkSession, path: str, default_date: str = "19700101") -> DataFrame:
    """A stream of cycle, field and path: the fields of GRIB2 files that arrive below ``path``. Only headers are read."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").option("pathGlobFilter", "*.grib2").option("recursiveFileLookup", "true").schema(schema).load(path)
    fields = files.select("path").mapInArrow(_heads, "source_file string, field string")
    told = grib._told(fields, default_date, grib.qualified(spark, path))
    return told.select(F.concat_ws("/", "date", "run", "lead").alias("cycle"), "field", F.col("source_file").alias("path"))


def cycle_events(fields: DataFrame, patience_ms: int, keep_ms: int, wanted: tuple[str, ...] = WANTED) -> DataFrame:
    """cycle, event, n_fields, missing and files (a JSON list) of a stream of cycle, field and path. Events: whole, once, with the
    first field that completes the cycle; late, once, if it isn't whole ``patience_ms`` after its first field, even if it is
    later; repeated, for files that bring fields of a cycle that was whole.

    A cycle's state is the names of its fields and files, at most one for each. That of a whole cycle is forgotten
    ``keep_ms`` after its last file; files that come still later begin it anew. Fields may come in any order and more than once."""
    all_of = set(wanted)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        held = json.loads(state.get[0]) if state.exists else {"fields": [], "files": [], "since": now, "whole": False, "late": False}
        event, told = None, held["files"]
        if state.hasTimedOut:
            if held["whole"]:
                state.remove()
                return
            event, held["late"] = "late", True
        else:
            seen, files = set(held["fields"]), set()
            for frame in frames:
                seen |= set(frame["field"]) & all_of
                files |= set(frame["path"])
            if held["whole"]:
                event, told = "repeated", sorted(files)
            else:
                held["fields"], held["files"] = sorted(seen), sorted(files | set(held["files"]))
                told = held["files"]
                if seen >= all_of:
                    event, held["whole"] = "whole", True
        state.update((json.dumps(held),))
        if held["whole"]:
            state.setTimeoutDuration(keep_ms)
        elif not held["late"]:
            state.setTimeoutDuration(max(1, held["since"] + patience_ms - now))
        if event:
            missing = ",".join(sorted(all_of - set(held["fields"])))
            yield pd.DataFrame({"cycle": [key[0]], "event": [event], "n_fields": [len(held["fields"])], "missing": [missing], "files": [json.dumps(told)]})

    return fields.groupBy("cycle").applyInPandasWithState(step, EVENTS, "held string", "append", GroupStateTimeout.ProcessingTimeTimeout)


def follow(spark: SparkSession, path: str, checkpoint: str, base: str, report: str, tensor_base: str | None = None, patience_ms: int = 6 * 3600_000, keep_ms: int = 30 * 86_400_000, every: str = "10 minutes") -> StreamingQuery:
    """Publishes each cycle that becomes whole to ``base`` and writes all events to ``report``, a folder of Parquet files.

    ``every``: how often arriving files are looked for, and late cycles. State and progress are in ``checkpoint``: after a restart nothing is forgotten, and a batch that is run again replaces what it published and
    reported. A batch names as many files as arrived since the one before, at most."""
    events = cycle_events(arriving_fields(spark, path), patience_ms, keep_ms)

    def handle(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        files = sorted({f for r in batch.where("event = 'whole'").select("files").collect() for f in json.loads(r["files"])})
        if files:
            job.publish_cycles(grib.read_files(spark, files, root=grib.qualified(spark, path)), base, tensor_base)
        batch.write.mode("overwrite").parquet(f"{report}/batch={number}")  # what is reported has been published
        batch.unpersist()

    return events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def catch_up(spark: SparkSession, path: str, checkpoint: str, base: str, report: str, **more: object) -> None:
    """``follow`` until there are no more files. Timers run with every batch, so Spark itself wouldn't end such a query; the first
    batch without files may be one that was planned before a restart, the second has looked for them."""
    query, empty = follow(spark, path, checkpoint, base, report, **more, every="1 second"), set()
    try:
        while query.isActive and len(empty) < 2:
            done = query.lastProgress
            if done and done["numInputRows"] == 0:
                empty.add(done["batchId"])
            time.sleep(0.1)
        if query.exception():
            raise query.exception()
    finally:
        query.stop()
