"""The registered forecast queries and their SQL."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import keys as K
from gridloom.operators import fields as B
from gridloom.operators import quality as Q
from gridloom.operators import tidy as T
from gridloom.plans import fixtures as X
from gridloom.plans import job as J
from gridloom.plans import publish as P
from gridloom.plans.scratch import Scratch, kept, scratch_path
from gridloom.plans.snapshots import Snapshots
from gridloom.sources import catalog as C
from gridloom.sources import grib as G

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _with(fixture: str, select: str) -> str:
    return f"WITH {fixture} {select}"


CELLS = ["cycle", "variable", "level", "latitude", "longitude"]
_TIDY = "level AS \"isobaricInhPa\", latitude, longitude, variable, value, date, run"
_COMPLETE = "JOIN full_ USING (cycle)"


@query(_with(X.FIELDS_SQL, "SELECT cycle, variable, level, CAST(pos AS INTEGER) AS pos, latitude, longitude, value FROM c"))
def field_flatten(spark, d):
    return B.cells(X.blocks(spark, d)).select("cycle", "variable", "level", "pos", "latitude", "longitude", "value")


@query(_with(X.FIELDS_SQL, "SELECT cycle, level, CAST(pos AS INTEGER) AS pos, value FROM z WHERE variable = 'z'"))
def geopotential(spark, d):
    return B.cells(B.geopotential(X.blocks(spark, d).where("variable = 'gh'"))).select("cycle", "level", "pos", "value")


@query(_with(X.FIELDS_SQL, "SELECT vec_id, variable, level, CAST(list_position([1000,925,850,700,600,500,400,300,250,200,150,100,50], CAST(level AS INTEGER)) - 1 AS INTEGER) AS level_idx FROM b WHERE level IS NOT NULL"))
def level_select(spark, d):
    return B.select_levels(X.blocks(spark, d)).select("vec_id", "variable", "level", "level_idx")


@query(_with(X.FIELDS_SQL, "SELECT cycle, date, run, count(*) AS n, round(avg(value::DOUBLE), 6) AS mean_z, max(value) AS max_z FROM z WHERE variable = 'z' AND level = 500 GROUP BY ALL"))
def z500(spark, d):
    z = B.cells(B.geopotential(X.blocks(spark, d).where("variable = 'gh' AND level = 500")))
    return z.groupBy("cycle", "date", "run").agg(F.count("*").alias("n"), F.round(F.avg(F.col("value").cast("double")), 6).alias("mean_z"), F.max("value").alias("max_z"))


@query(_with(X.FIELDS_SQL, "SELECT vec_id, CAST(pos AS INTEGER) AS pos, value FROM c WHERE latitude BETWEEN -30 AND 40 AND longitude BETWEEN 45 AND 180"))
def bbox_slice(spark, d):
    return B.box_cells(X.blocks(spark, d), -30, 40, 45, 180).select("vec_id", "pos", "value")


@query(_with(X.FIELDS_SQL, "SELECT vec_id, CAST(pos AS INTEGER) AS pos, latitude, value FROM c"))
def lat_desc(spark, d):
    """From fields turned upside down."""
    b = X.blocks(spark, d)
    up = b.withColumn("lats", F.reverse("lats")).withColumn("values", F.flatten(F.transform(F.sequence(F.lit(7), F.lit(0), F.lit(-1)), lambda i: F.slice("values", i * 8 + 1, 8))))
    return B.cells(B.lat_descending(up)).select("vec_id", "pos", "latitude", "value")


@query(_with(X.FIELDS_SQL, "SELECT vec_id, variable FROM b"))
def drop_coords(spark, d):
    b = X.blocks(spark, d).select("vec_id", "variable").withColumn("heightAboveGround", F.lit(2.0)).withColumn("meanSea", F.lit(0.0))
    return B.drop_coords(b)


@query(_with(X.FIELDS_SQL, """, w AS (SELECT cycle, variable || coalesce('@' || CAST(level AS INTEGER), '') AS name FROM b),
e AS (SELECT unnest(['msl','u10','v10','t2m']) AS name UNION ALL SELECT v || '@' || p FROM (SELECT unnest(['gh','q','t','u','v']) AS v), (SELECT unnest([1000,925,850,700,600,500,400,300,250,200,150,100,50]) AS p)),
y AS (SELECT cycle FROM b GROUP BY cycle), m AS (SELECT y.cycle, string_agg(e.name, ',' ORDER BY encode(e.name)) AS missing FROM y, e WHERE (y.cycle, e.name) NOT IN (SELECT cycle, name FROM w) GROUP BY y.cycle)
SELECT y.cycle, (SELECT count(DISTINCT name) FROM w WHERE w.cycle = y.cycle) AS n_fields, coalesce(missing, '') AS missing, missing IS NULL AS complete FROM y LEFT JOIN m USING (cycle)"""))
def completeness(spark, d):
    return B.completeness(X.blocks(spark, d))


@query(_with(X.FIELDS_SQL, "SELECT variable, level, count(DISTINCT run) AS n_labels, count(DISTINCT run) <= 1 AS ok FROM b GROUP BY ALL"))
def squeeze_check(spark, d):
    return B.squeeze(X.blocks(spark, d), ["variable", "level"], "run")


@query(_with(X.FIELDS_SQL, f"SELECT {_TIDY} FROM c {_COMPLETE} WHERE level IS NULL"))
def tidy_surface(spark, d):
    return T.surface(B.complete_only(X.blocks(spark, d)))


@query(_with(X.FIELDS_SQL, f"SELECT {_TIDY} FROM z {_COMPLETE} WHERE level IS NOT NULL"))
def tidy_upper(spark, d):
    return T.upper(B.complete_only(X.blocks(spark, d)))


def _published(spark, d):
    path = scratch_path(spark, "published")
    P.publish_blocks(B.complete_only(X.blocks(spark, d)), path)
    return P.read_published(spark, path)


@query(_with(X.FIELDS_SQL, f"SELECT {_TIDY}, date[:4] AS year, date[5:6] AS month, date[7:8] AS day, source_file FROM z {_COMPLETE}"))
def tidy_consolidated(spark, d):
    """Written in partitions and read back."""
    return _published(spark, d)


@query(_with(X.FIELDS_SQL, f"SELECT {_TIDY.replace('value', 'CASE WHEN cycle % 2 = 0 THEN CAST(-value AS FLOAT) ELSE value END AS value')}, date[:4] AS year, date[5:6] AS month, date[7:8] AS day, source_file FROM z {_COMPLETE}"))
def snapshot_rows(spark, d):
    """All complete cycles are published as a snapshot, and every other one again, negated, as the next."""
    snapshots, blocks = Snapshots(spark, scratch_path(spark, "snapshots")), B.complete_only(X.blocks(spark, d))
    snapshots.publish(blocks)
    snapshots.publish(blocks.where("cycle % 2 = 0").withColumn("values", F.transform("values", lambda x: -x)))
    return snapshots.read()


@query(_with(X.FIELDS_SQL, f"SELECT run, variable, latitude, longitude, value FROM z {_COMPLETE} WHERE run = '06z' AND (variable = 't2m' OR (variable = 'z' AND level = 500))"))
def tidy_scan_filter(spark, d):
    rows = _published(spark, d).where("run = '06z'").where("variable = 't2m' OR (variable = 'z' AND isobaricInhPa = 500)")
    return rows.select("run", "variable", "latitude", "longitude", "value")


def _chunks(b):
    return T.surface(b).unionByName(T.upper(b, ("z",))).unionByName(T.upper(b, B.UPPER_RAW))


@query(_with(X.FIELDS_SQL, f"SELECT {_TIDY} FROM z {_COMPLETE}"))
def union_chunks_all(spark, d):
    """The chunks of all complete cycles."""
    return _chunks(B.complete_only(X.blocks(spark, d)))


@query("SELECT lat, lon, 'msl' AS variable, msl AS value FROM (SELECT l_orderkey AS lat, l_linenumber AS lon, min(l_quantity) AS msl, min(l_extendedprice) AS u10, min(l_discount) AS v10, min(l_tax) AS t2m FROM lineitem GROUP BY ALL) UNION ALL SELECT lat, lon, v, x FROM (SELECT l_orderkey AS lat, l_linenumber AS lon, unnest(['u10','v10','t2m']) AS v, unnest([min(l_extendedprice), min(l_discount), min(l_tax)]) AS x FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def unpivot_surface(spark, d):
    wide = X.surface_rows(spark, d).groupBy("lat", "lon").agg(*[F.min(v).alias(v) for v in B.SURFACE])
    return T.unpivot(wide, ["lat", "lon"], list(B.SURFACE))


@query("SELECT l_orderkey AS lat, l_linenumber AS lon, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_cells(spark, d):
    return T.duplicates(X.surface_rows(spark, d), ["lat", "lon"])


@query(_with(X.FIELDS_SQL, ", l AS (SELECT DISTINCT cycle, level FROM b WHERE level IS NOT NULL) SELECT cycle, variable, c.level, CAST(pos AS INTEGER) AS pos, value FROM c WHERE level IS NOT NULL UNION ALL SELECT c.cycle, variable, l.level, CAST(pos AS INTEGER), value FROM c JOIN l ON l.cycle = c.cycle WHERE c.level IS NULL"))
def broadcast_long(spark, d):
    return T.broadcast_long(X.blocks(spark, d)).select("cycle", "variable", "level", "pos", "value")


@query(_with(X.FIELDS_SQL, "SELECT cycle, variable, level, latitude, " + ", ".join(f"max(CASE WHEN longitude = {45 * i} THEN value END) AS lon_{45 * i}" for i in range(8)) + " FROM c GROUP BY cycle, variable, level, latitude"))
def raster_pivot_all(spark, d):
    """All fields."""
    return T.raster_blocks(X.blocks(spark, d), [45.0 * i for i in range(8)], keys=("cycle", "variable", "level"))


def _tensor_rows(spark, d, which):
    t = T.tensors(B.complete_only(X.blocks(spark, d))).where(F.col("tensor") == which)
    return t.select("cycle", "channel", "level_idx", F.posexplode("values").alias("pos", "value"))


@query(_with(X.FIELDS_SQL, f"SELECT cycle, CAST(list_position(['msl','u10','v10','t2m'], variable) - 1 AS INTEGER) AS channel, CAST(NULL AS INTEGER) AS level_idx, CAST(pos AS INTEGER) AS pos, value FROM c {_COMPLETE} WHERE level IS NULL"))
def tensor_surface(spark, d):
    return _tensor_rows(spark, d, "surface")


@query(_with(X.FIELDS_SQL, f"SELECT cycle, CAST(list_position(['z','q','t','u','v'], variable) - 1 AS INTEGER) AS channel, CAST(list_position([1000,925,850,700,600,500,400,300,250,200,150,100,50], CAST(level AS INTEGER)) - 1 AS INTEGER) AS level_idx, CAST(pos AS INTEGER) AS pos, value FROM z {_COMPLETE} WHERE level IS NOT NULL"))
def tensor_upper(spark, d):
    return _tensor_rows(spark, d, "upper")


@query(_with(X.FIELDS_SQL, "SELECT cycle, CASE WHEN level IS NULL THEN 'surface' ELSE 'upper' END AS tensor, count(DISTINCT variable) AS n_channel, count(DISTINCT level) AS n_level, CAST(8 AS INTEGER) AS n_lat, CAST(8 AS INTEGER) AS n_lon FROM b GROUP BY ALL"))
def tensor_shape(spark, d):
    return T.tensor_shape(T.tensors(X.blocks(spark, d)))


_MERGED = """, k AS (SELECT *, list_position(['msl','u10','v10','t2m','gh','q','t','u','v'], variable) AS no FROM c),
u AS (SELECT 0 AS dataset_ord, cycle, variable, level, latitude, longitude, value FROM k WHERE no % 3 <> 0 AND NOT (vec_id % 5 = 0 AND pos < 8)
      UNION ALL SELECT 1, cycle, variable, level, latitude, longitude, CAST(-value AS FLOAT) FROM k),
v AS (SELECT cycle, variable, min(dataset_ord) AS low FROM u GROUP BY ALL),
w AS (SELECT u.* FROM u JOIN v ON u.cycle = v.cycle AND u.variable = v.variable AND u.dataset_ord = v.low)"""


@query(_with(X.FIELDS_SQL, _MERGED + " SELECT dataset_ord, cycle, variable, level, latitude, longitude, value FROM w"))
def merge_first_wins(spark, d):
    return B.cells(B.first_wins(X.overlapping(spark, d))).select("dataset_ord", *CELLS, "value")


@query(_with(X.FIELDS_SQL, _MERGED + """, p AS (SELECT DISTINCT cycle, latitude, longitude FROM w), n AS (SELECT DISTINCT cycle, variable, level FROM w)
SELECT n.cycle, n.variable, n.level, p.latitude, p.longitude, w.value FROM p JOIN n ON p.cycle = n.cycle
LEFT JOIN w ON w.cycle = n.cycle AND w.variable = n.variable AND w.level IS NOT DISTINCT FROM n.level AND w.latitude = p.latitude AND w.longitude = p.longitude"""))
def merge_align(spark, d):
    return B.cells(B.align_blocks(B.first_wins(X.overlapping(spark, d)))).select(*CELLS, "value")


def _qa_cells(spark, d):
    """Cells, and the same with a known change: shifted for vec_id % 3 = 1, a point lost for vec_id % 10 = 4."""
    src = B.cells(X.blocks(spark, d))
    out = src.withColumn("value", F.when(F.col("vec_id") % 3 == 1, F.col("value") + F.lit(0.5).cast("float")).otherwise(F.col("value"))).where("NOT (vec_id % 10 = 4 AND pos = 0)")
    return src, out


_QA = """, s AS (SELECT vec_id, variable, level, pos, latitude, longitude, value AS src, CASE WHEN vec_id % 10 = 4 AND pos = 0 THEN NULL WHEN vec_id % 3 = 1 THEN (value + 0.5::FLOAT)::FLOAT ELSE value END AS out_,
 vec_id % 10 = 4 AND pos = 0 AS mismatch FROM c)"""
_QA_ROW = """SELECT vec_id, count(*) AS n, round(avg(src::DOUBLE), 6) AS src_mean, round(avg(out_::DOUBLE), 6) AS out_mean, max(abs(src - out_)) AS max_abs_diff,
 CASE WHEN count(*) FILTER (mismatch) > 0 THEN 'shape' WHEN abs(avg(src::DOUBLE) - avg(out_::DOUBLE)) > 1e-4 THEN 'drift' ELSE 'ok' END AS status FROM s"""


def _qa(spark, d, test):
    src, out = _qa_cells(spark, d)
    r = Q.report(Q.grid_diff(src.where(test), out.where(test), ["vec_id"]), ["vec_id"])
    return r.select("vec_id", "n", F.round("src_mean", 6).alias("src_mean"), F.round("out_mean", 6).alias("out_mean"), "max_abs_diff", "status")


@query(_with(X.FIELDS_SQL, _QA + " SELECT vec_id, latitude, longitude, src, out_ AS \"out\", abs(src - out_) AS diff, mismatch FROM s"))
def qa_diff_grid(spark, d):
    return Q.grid_diff(*_qa_cells(spark, d), ["vec_id"])


@query(_with(X.FIELDS_SQL, _QA + " " + _QA_ROW + " WHERE variable = 't2m' GROUP BY vec_id"))
def qa_surface(spark, d):
    return _qa(spark, d, "variable = 't2m'")


@query(_with(X.FIELDS_SQL, _QA + " " + _QA_ROW + " WHERE variable = 'gh' AND level = 500 GROUP BY vec_id"))
def qa_upper(spark, d):
    return _qa(spark, d, "variable = 'gh' AND level = 500")


@query(_with(X.OBJECTS_SQL, "SELECT key, modified FROM g WHERE key LIKE '%.grib2' ORDER BY modified DESC, encode(key) LIMIT 1"))
def latest_object(spark, d):
    return C.latest(X.objects(spark, d)).select("key", "modified")


_ARGUMENTS = "CASE WHEN event_id % 3 = 0 THEN key WHEN event_id % 3 = 1 THEN ' ' END"


@query(_with(X.OBJECTS_SQL, f""", n AS (SELECT key AS newest FROM g WHERE key LIKE '%.grib2' ORDER BY modified DESC, encode(key) LIMIT 1)
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN key WHEN event_id % 2 = 0 THEN 'ecmwf/' || date || '/' || run || '/ifs/0p25/oper/' || date || run[:2] || '0000-0h-oper-fc.grib2' ELSE newest END AS source_key FROM g, n"""))
def resolve_source(spark, d):
    o = X.objects(spark, d)
    even = F.col("event_id") % 2 == 0
    arguments = o.select("event_id", F.expr(_ARGUMENTS).alias("key"), F.lit("/ecmwf/").alias("prefix"), F.when(even, K.key_date(F.col("key"), "19700101")).otherwise("").alias("date"), K.key_run(F.col("key")).alias("run"))
    return C.resolve(arguments, o).select("event_id", "source_key")


@query(_with(X.OBJECTS_SQL, "SELECT event_id, 'x/y/' || date || '/' || run || '/ifs/0p25/oper/' || date || run[:2] || '0000-0h-oper-fc.grib2' AS candidate FROM g"))
def candidate_key(spark, d):
    o = X.objects(spark, d)
    return o.select("event_id", K.candidate_key(F.lit("/x/y/"), K.key_date(F.col("key"), "19700101"), K.key_run(F.col("key"))).alias("candidate"))


@query(_with(X.OBJECTS_SQL, "SELECT event_id, date, run FROM g"))
def key_date_run(spark, d):
    return X.objects(spark, d).select("event_id", K.key_date(F.col("key"), "19700101").alias("date"), K.key_run(F.col("key")).alias("run"))


@query(_with(X.OBJECTS_SQL, "SELECT string_split(name, '-')[2] AS lead, name[:8] AS name_date, count(*) AS n_files FROM g WHERE key LIKE '%.grib2' GROUP BY ALL"))
def batch_catalog(spark, d):
    return C.by_lead(X.objects(spark, d))


_RAW_RUN = "CASE event_id % 5 WHEN 0 THEN ' 06Z ' WHEN 1 THEN '12' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE '18z' END"


@query(f"SELECT event_id, CASE WHEN r = '' THEN '00z' WHEN r LIKE '%z' THEN r ELSE r || 'z' END AS run FROM (SELECT event_id, lower(trim(coalesce({_RAW_RUN}, ''))) AS r FROM events)")
def normalize_run(spark, d):
    return X.objects(spark, d).select("event_id", K.normalize_run(F.expr(_RAW_RUN)).alias("run"))


_RAW_DATE = "CASE event_id % 4 WHEN 0 THEN '20240230' WHEN 1 THEN '2024-01-05' ELSE '202401' || lpad(CAST(1 + event_id % 28 AS {t}), 2, '0') END"


@query(f"SELECT event_id, CASE WHEN regexp_full_match(r, '[0-9]{{8}}') THEN CAST(try_strptime(r, '%Y%m%d') AS DATE) END AS day FROM (SELECT event_id, {_RAW_DATE.format(t='VARCHAR')} AS r FROM events)")
def parse_date(spark, d):
    return X.objects(spark, d).select("event_id", K.parse_date(F.expr(_RAW_DATE.format(t="STRING"))).alias("day"))


@query(_with(X.OBJECTS_SQL, "SELECT event_id, regexp_replace(name, '\\.[^.]+$', '') || '.parquet' AS name FROM g"))
def output_name(spark, d):
    return X.objects(spark, d).select("event_id", K.output_name(F.col("key")).alias("name"))


@query(_with(X.OBJECTS_SQL, "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '20240110' ELSE date END AS date, CASE WHEN event_id % 3 = 0 THEN '06z' ELSE run END AS run FROM g"))
def effective_run(spark, d):
    date, run = K.effective_date_run(F.col("key"), F.expr("CASE WHEN event_id % 2 = 0 THEN '20240110' ELSE '' END"), F.expr("CASE WHEN event_id % 3 = 0 THEN '06' END"), "19700101")
    return X.objects(spark, d).select("event_id", date.alias("date"), run.alias("run"))


_PREFIX = "'out/year=' || date[:4] || '/month=' || date[5:6] || '/day=' || date[7:8] || '/run=' || run AS prefix"


@query(_with(X.OBJECTS_SQL, f"SELECT event_id, {_PREFIX} FROM g"))
def publish_layout(spark, d):
    o = X.objects(spark, d)
    return o.select("event_id", K.partition_prefix(F.lit("/out/"), K.parse_date(K.key_date(F.col("key"), "19700101"), strict=True), K.key_run(F.col("key"))).alias("prefix"))


@query(_with(X.OBJECTS_SQL, f"SELECT event_id, {_PREFIX} FROM g"))
def publish_layout_slice(spark, d):
    return X.objects(spark, d).select("event_id", K.sliced_prefix(F.lit("out"), K.key_date(F.col("key"), "19700101"), K.key_run(F.col("key"))).alias("prefix"))


@query(_with(X.FIELDS_SQL, f"SELECT source_file, date, run, count(*) AS n_rows, count(value) AS n_values, count(DISTINCT variable) AS n_variables, 'ok' AS status FROM z {_COMPLETE} GROUP BY ALL"))
def run_manifest(spark, d):
    return P.manifest(T.consolidated(B.complete_only(X.blocks(spark, d)), ("source_file",)))


_T = "[" + ", ".join(map(repr, Q.t_table())) + "]"
_STATS = """SELECT event_type AS method, avg(value) AS mean, coalesce(stddev_samp(value), 0) AS std, count(value) AS n FROM (SELECT * FROM events WHERE event_id <= 100) GROUP BY event_type"""


@query(f"SELECT method, round(mean, 6) AS mean, round(std, 6) AS std, n, round(mean - h, 5) AS ci_lower, round(mean + h, 5) AS ci_upper FROM (SELECT *, CASE WHEN n > 1 THEN list_extract({_T}, n - 1) * std / sqrt(n) ELSE 0 END AS h FROM ({_STATS.replace('(SELECT * FROM events WHERE event_id <= 100)', '(SELECT event_type || (event_id % (SELECT greatest(1, count(*) // 200) FROM events)) AS event_type, value FROM events)')}))")
def sample_stats(spark, d):
    """Samples by type and a number that leaves about 40 to each, within the table of critical values."""
    e = spark.read.parquet(f"{d}/events.parquet")
    k = e.agg(F.greatest(F.lit(1), F.floor(F.count("*") / 200)).alias("k"))
    e = e.join(F.broadcast(k), F.lit(True)).select(F.concat("event_type", (F.col("event_id") % F.col("k")).cast("string")).alias("method"), "value")
    s = Q.sample_stats(e, "method", "value")
    return s.select("method", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "n", F.round("ci_lower", 5).alias("ci_lower"), F.round("ci_upper", 5).alias("ci_upper"))


@query("SELECT event_type AS method, format('{:<16s} {:>10d} {:>14.3f} {:>14.3f}', event_type, count(value), round(avg(value), 3), round(stddev_samp(value), 3)) AS line FROM events GROUP BY event_type")
def bench_report(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select(F.col("event_type").alias("method"), "value")
    return Q.text_report(Q.sample_stats(e, "method", "value"), "method")


@query("SELECT format('{:<16s} {:>10d} {:>14.3f} {:>14.3f}', event_type, count(value), round(avg(value), 3), round(stddev_samp(value), 3)) AS line FROM events GROUP BY event_type")
def bench_report_file(spark, d):
    """The report as a text file, read back."""
    e = spark.read.parquet(f"{d}/events.parquet").select(F.col("event_type").alias("method"), "value")
    path = scratch_path(spark, "report")
    Q.write_report(Q.sample_stats(e, "method", "value"), "method", path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(_with(X.FIELDS_SQL, "SELECT variable, level, latitude, longitude, round(avg(value::DOUBLE), 6) AS mean FROM c GROUP BY ALL"))
def dim_mean(spark, d):
    return Q.block_mean(X.blocks(spark, d), CELLS[1:3]).select(*CELLS[1:], F.round("mean", 6).alias("mean"))


@query(_with(X.FIELDS_SQL, "SELECT variable, max(value) AS max_value FROM c GROUP BY variable"))
def global_max(spark, d):
    return B.cells(X.blocks(spark, d)).groupBy("variable").agg(F.max("value").alias("max_value"))


@query("""WITH e AS (SELECT min(value) AS low, max(value) AS high FROM events), p AS (SELECT CAST(greatest(1, least(10, ceil((value - low) / ((high - low) / 10)))) AS INTEGER) AS bin, event_id FROM events, e),
s AS (SELECT bin, count(event_id) AS n, avg(event_id) AS mean FROM p GROUP BY bin) SELECT CAST(r AS INTEGER) AS bin, coalesce(n, 0) AS n, round(mean, 6) AS mean FROM range(1, 11) t(r) LEFT JOIN s ON s.bin = r""")
def binned_mean(spark, d):
    return Q.binned_mean(spark.read.parquet(f"{d}/events.parquet"), "value", "event_id").withColumn("mean", F.round("mean", 6))


@query("SELECT l_orderkey AS lat, l_linenumber AS lon, round(coalesce(CASE WHEN l_quantity < 10 THEN NULL ELSE l_quantity END, 0) + coalesce(l_extendedprice, 0) + coalesce(l_discount, 0) + coalesce(l_tax, 0), 4) AS total FROM lineitem")
def row_sum(spark, d):
    rows = X.surface_rows(spark, d).withColumn("msl", F.when(F.col("msl") >= 10, F.col("msl")))
    return rows.select("lat", "lon", F.round(Q.row_sum(list(B.SURFACE)), 4).alias("total"))


@query("SELECT o_orderkey, CAST(TRY_CAST(string_split(o_orderpriority, '-')[1] AS DOUBLE) AS FLOAT) AS head, CAST(TRY_CAST(o_orderpriority AS DOUBLE) AS FLOAT) AS whole FROM orders")
def coerce_numeric(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return orders.select("o_orderkey", T.coerce(F.split_part("o_orderpriority", F.lit("-"), F.lit(1))).alias("head"), T.coerce(F.col("o_orderpriority")).alias("whole"))


@query(_with(X.OBJECTS_SQL, """, n AS (SELECT key, row_number() OVER (ORDER BY md5(key)[1:2], encode(key)) - 1 AS no FROM g WHERE key LIKE '%.grib2')
SELECT r AS draw, key FROM range(1000) t(r) JOIN n ON n.no = CAST('0x' || md5('7:' || r)[1:12] AS BIGINT) % (SELECT count(*) FROM n)"""))
def sample_files(spark, d):
    return C.sample(X.objects(spark, d), 1000)


@query()
def export_npy(spark, d):
    """Tensor files of all complete cycles, streamed by tasks and moved into place by the commit."""
    return P.export_npy(T.tensors(B.complete_only(X.blocks(spark, d))), scratch_path(spark, "npy"))


def _archive(spark, d, base, packing="ieee"):
    """Writes the blocks' cycles as GRIB2 files into a shared folder."""
    J.write_files(X.named_files(X.blocks(spark, d)), base, packing).write.format("noop").mode("overwrite").save()


_NAME = "strftime(DATE '2024-01-01' + CAST(cycle // 4 AS INTEGER), '%Y%m%d') || run[:2] || '0000-0h-oper-fc.grib2'"
_named = lambda df: df.withColumn("source_file", K.base_name(F.col("source_file")))


def _job(spark, d, packing="ieee"):
    base = scratch_path(spark, "job")
    with Scratch(spark) as scratch:
        archive = scratch.path("archive")
        _archive(spark, d, archive, packing)
        J.run(spark, archive, base)
    return _named(P.read_published(spark, base))


_JOB = f"SELECT {_TIDY}, date[:4] AS year, date[5:6] AS month, date[7:8] AS day, {_NAME} AS source_file FROM z {_COMPLETE}"


@query(_with(X.FIELDS_SQL, _JOB))
def forecast_job(spark, d):
    """Files are written, decoded, merged, published and read back."""
    return _job(spark, d)


#: The fields as a packing holds them: whole multiples of 2**-16 above each one's least value.
_PACKED_SQL = X.FIELDS_SQL.replace("z AS (", """k AS (SELECT * EXCLUDE low REPLACE (CAST(low + floor((value::DOUBLE - low) * 65536 + 0.5) / 65536 AS FLOAT) AS value) FROM (SELECT *, min(value::DOUBLE) OVER (PARTITION BY vec_id) AS low FROM c)),
z AS (""").replace("END AS value) FROM c)", "END AS value) FROM k)")


@query(_with(_PACKED_SQL, _JOB))
def forecast_job_simple(spark, d):
    """The same over files in simple packing."""
    return _job(spark, d, "simple")


@query(_with(_PACKED_SQL, _JOB))
def forecast_job_complex(spark, d):
    """The same over files in complex packing."""
    return _job(spark, d, "complex")


@query(_with(_PACKED_SQL, _JOB))
def forecast_job_differences(spark, d):
    """The same over files in complex packing of second differences."""
    return _job(spark, d, "differences")


@query(_with(_PACKED_SQL, _JOB))
def forecast_job_rice(spark, d):
    """The same over files in block-adaptive entropy coding."""
    return _job(spark, d, "rice")


@query(_with(_PACKED_SQL, f"SELECT {_NAME} AS source_file, date, run, count(*) AS n, round(avg(value::DOUBLE), 6) AS mean_z, max(value) AS max_z FROM z WHERE variable = 'z' AND level = 500 GROUP BY ALL"))
def z500_messages(spark, d):
    """One message of 69 is read from each file: the others' headers only."""
    archive = scratch_path(spark, "archive")
    _archive(spark, d, archive, "rice")
    z = B.cells(B.geopotential(_named(G.read_fields(spark, archive, variables=("gh",), levels=(500,)))))
    return z.groupBy("source_file", "date", "run").agg(F.count("*").alias("n"), F.round(F.avg(F.col("value").cast("double")), 6).alias("mean_z"), F.max("value").alias("max_z"))


_ROWS = "[4, 8, 8, 12, 12, 8, 8, 4]"


@query(_with(X.FIELDS_SQL, f""", g AS (SELECT unnest({_ROWS}) AS p, unnest(range(8)) AS row),
h AS (SELECT *, CAST(sum(p) OVER (ORDER BY row) - p AS INTEGER) AS first FROM g),
a AS (SELECT *, j * p / 12.0::DOUBLE AS x FROM h, (SELECT unnest(range(12)) AS j)),
w AS (SELECT row, j, x - floor(x) AS weight, first + CAST(floor(x) AS INTEGER) % p AS l, first + (CAST(floor(x) AS INTEGER) + 1) % p AS r FROM a)
SELECT {_NAME} AS source_file, variable, level, CAST(row AS INTEGER) AS row, j * 30.0::DOUBLE AS longitude, CAST(embedding[l + 1] + (embedding[r + 1] - embedding[l + 1]) * weight AS FLOAT) AS value FROM b, w"""))
def reduced_grid(spark, d):
    """Files on a reduced Gaussian grid, read and interpolated to a regular one."""
    points = F.array(*[F.lit(n) for n in json.loads(_ROWS)])
    lats = F.array(*[F.lit(x) for x in G.gaussian_latitudes(4)])
    blocks = X.named_files(X.blocks(spark, d)).withColumn("lats", lats).withColumn("row_points", points)
    archive = scratch_path(spark, "archive")
    J.write_files(blocks, archive).write.format("noop").mode("overwrite").save()
    cells = B.cells(_named(B.regular_grid(G.read_fields(spark, archive))))
    return cells.select("source_file", "variable", "level", F.floor(F.col("pos") / 12).cast("int").alias("row"), "longitude", "value")


_DEALT = """, k AS (SELECT *, list_position(['msl','u10','v10','t2m','gh','q','t','u','v'], variable) AS no FROM c),
u AS (SELECT 0 AS o, * FROM k WHERE no % 3 <> 0 AND NOT (vec_id % 5 = 0 AND pos < 8) UNION ALL SELECT 1, * REPLACE (CAST(-value AS FLOAT) AS value) FROM k WHERE no % 2 = 0 UNION ALL SELECT 2, * REPLACE (CAST(2 * value AS FLOAT) AS value) FROM k),
v AS (SELECT cycle, variable, min(o) AS low FROM u GROUP BY ALL), w AS (SELECT u.* FROM u JOIN v ON u.cycle = v.cycle AND u.variable = v.variable AND u.o = v.low),
p AS (SELECT DISTINCT cycle, latitude, longitude FROM w), n AS (SELECT DISTINCT cycle, date, run, variable, level FROM w)"""


@query(_with(X.FIELDS_SQL, _DEALT + """ SELECT n.date || '/' || n.run || '/0h' AS cycle, n.variable, n.level, p.latitude, p.longitude, w.value FROM p JOIN n ON p.cycle = n.cycle
LEFT JOIN w ON w.cycle = n.cycle AND w.variable = n.variable AND w.level IS NOT DISTINCT FROM n.level AND w.latitude = p.latitude AND w.longitude = p.longitude"""))
def merge_files(spark, d):
    """Cycles that lie in three files each: the first file that has a variable gives it, on the union of the grids."""
    with Scratch(spark) as scratch:
        archive = scratch.path("archive")
        J.write_files(X.dealt(spark, d), archive, "ieee").write.format("noop").mode("overwrite").save()
        fields = scratch.keep(G.read_fields(spark, archive), "fields")  # decoded once: the names and the merge read these
        merged = kept(G.merged(scratch.keep(G.by_cycle(fields), "cycles")), "merged")
    return B.cells(merged).select(*CELLS, "value")


@query(_with(X.FIELDS_SQL, f"""SELECT {_NAME} AS source_file, date, run, '0h' AS lead, n_fields, CASE WHEN n_fields = 69 THEN 'ok' ELSE 'incomplete' END AS status, CAST(0 AS BIGINT) AS n_errors,
 CAST(CASE WHEN n_fields = 69 THEN 69 * 64 ELSE 0 END AS BIGINT) AS n_rows, CAST(CASE WHEN n_fields = 69 THEN 9 ELSE 0 END AS BIGINT) AS n_variables, n_fields = 69 AS has_bytes
 FROM (SELECT cycle, date, run, count(*) AS n_fields FROM b GROUP BY ALL)"""))
def job_manifest(spark, d):
    """The job's manifest: an incomplete file has no rows."""
    with Scratch(spark) as scratch:
        archive = scratch.path("archive")
        _archive(spark, d, archive)
        m = J.run(spark, archive, scratch.path("job"))
    return _named(m).select("source_file", "date", "run", "lead", "n_fields", "status", "n_errors", "n_rows", "n_variables", (F.col("bytes") > 0).alias("has_bytes"))


@query(_with(X.FIELDS_SQL, f"""SELECT {_NAME} AS source_file, variable, level AS "isobaricInhPa", count(*) AS n, round(avg(value::DOUBLE), 6) AS src_mean, CAST(0 AS FLOAT) AS max_abs_diff, 'ok' AS status
 FROM z {_COMPLETE} WHERE variable = 't2m' OR (variable = 'z' AND level = 500) GROUP BY ALL"""))
def verify_published(spark, d):
    """Published rows against the fields of the files."""
    archive, base = scratch_path(spark, "archive"), scratch_path(spark, "job")
    _archive(spark, d, archive)
    J.run(spark, archive, base)
    merged = kept(G.read_merged(spark, archive), "source")  # decoded once
    blocks = B.complete_only(merged).withColumn("source_file", K.relative_key(F.col("source_file"), G.qualified(spark, archive)))
    r = _named(J.verify(blocks, P.read_published(spark, base)))
    return r.select("source_file", "variable", "isobaricInhPa", "n", F.round("src_mean", 6).alias("src_mean"), "max_abs_diff", "status")
