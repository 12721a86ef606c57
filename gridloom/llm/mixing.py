"""Mixing sources to target weights by Pareto order sampling; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm._shared import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Buckets for each power of e of a rank, by which a source's prefix sums are split over tasks, and parts of a source's
#: rows in joins with the table of sources; no result depends on them.
BUCKETS, SALTS = 800, 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """One row a source: source_size, target. Words of all sources are shared by weight; a source gets at most ``most``
    times its own size and the excess goes to the others by weight.

    The limits are met by filling sources in the order of limit / weight: those whose limit lies below their share are
    capped, the rest share what is left. Only the table of sources (one row each) is ordered as a whole.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_docs"))
    every = Window.partitionBy(F.lit(0))
    place = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long"))
    by = every.orderBy((F.lit(most) * F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.lit(most) * F.sum("source_size").over(before), F.lit(0)))
    per = per.withColumn("heavy", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # the first source that isn't capped, in that order, fixes the share of a unit of weight for it and all later ones
    free = F.col("left") * F.col("weight") <= F.lit(most) * F.col("source_size") * F.col("heavy")
    per = per.withColumn("share", F.min(F.when(free, F.struct(F.lit(most) * F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source", "left", "heavy"))).over(every))
    capped = ~free & (F.col("share").isNull() | (F.col("heavy") > F.col("share.heavy")))
    target = F.when(capped, (F.lit(most) * F.col("source_size")).cast("double")).otherwise((F.col("weight") * F.col("share.left")).cast("double") / F.col("share.heavy"))
    return per.select("source", "source_size", "source_docs", F.coalesce(target, F.lit(0.0)).alias("target"))


def _with_source(rows: DataFrame, sources: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the columns that ``sources`` has for their source. A source's rows are dealt to SALTS tasks, each of
    which gets the source's one row, so that a hot source doesn't meet in one task."""
    parts = sources.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("source", "_source")
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS)).cast("int"))
    here = (F.col("_part") == F.col("_salt")) & F.col("source").eqNullSafe(F.col("_source"))
    return rows.join(parts, here, how).drop("_source", "_salt", "_part")


def uniform(*key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the key only: reruns agree."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("null")) for k in key])), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 8, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken for every row of ``docs`` (doc_id, text, source), and the
    columns ``keep`` of the row.

    Every document gets floor(target / source_size) certain whole copies. What is left of the target, R words, is a
    Pareto order sample: documents are ranked by random odds u / (1 - u) over inclusion odds p / (1 - p) and taken in that
    order until R words are reached; the last one only when that comes nearer to R. The inclusion probability is
    p = o / (1 + o) with o = R / (source_size - R) times the document's size over the source's mean size: R / source_size for
    a document of mean size, more for longer ones, always below 1, so no document but by whole copies is certain. Ranks
    are split into buckets whose sums are added up first, so no task sorts a source.

    Null text or no words: size 0, nothing taken. Null source: a source of its own, last in order. Null doc_id: the
    text's hash stands for it in the random number. Equal rows: each counts; ties in rank go by doc_id, then size, then the
    columns ``keep``. Empty table: empty result. Other columns are ignored.
    """
    drawn = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce("text", F.lit("")))))
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), uniform(drawn, seed=seed).alias("u"), *keep)
    sizes = materialize(sizes, "mix-sizes")
    targets = materialize(source_targets(sizes, weights, most), "mix-targets")
    rows = _with_source(sizes, targets)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rows = rows.withColumn("copies", copies.cast("long")).withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    u = F.col("u")
    odds = F.col("rest") / (F.col("source_size") - F.col("rest")) * (F.col("size") * F.col("source_docs") / F.col("source_size"))
    rows = rows.withColumn("rank", F.when((F.col("rest") > 0) & (F.col("size") > 0), u / (1 - u) / odds))
    rows = rows.withColumn("bucket", F.floor(F.lit(BUCKETS) * F.log("rank")).cast("int"))
    sums = rows.where("rank is not null").groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
    so_far = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
    edge = sums.where("before <= rest and before + words > rest").groupBy("source").agg(F.min(F.struct("bucket", "before")).alias("e")).select("source", F.col("e.bucket").alias("edge"), F.col("e.before").alias("before"))
    rows = _with_source(rows, edge, "left")
    # documents of the bucket in which R is reached, one bucket of each source, are ordered among themselves
    within = Window.partitionBy("source", "edge").orderBy("rank", "doc_id", "size", *keep).rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.where("bucket = edge").withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    inner = inner.withColumn("hit", (F.col("rest") > F.col("start")) & ((F.col("start") + F.col("size") - F.col("rest")) <= (F.col("rest") - F.col("start")))).drop("start")
    outer = rows.where("not (bucket <=> edge) or bucket is null").withColumn("hit", F.coalesce(F.col("rank").isNotNull() & (F.col("edge").isNull() | (F.col("bucket") < F.col("edge"))), F.lit(False)))
    both = outer.unionByName(inner)
    taken = F.col("size") * (F.col("copies") + F.col("hit").cast("long"))
    return both.select("doc_id", "size", "source_size", "target", (F.col("copies") + F.col("hit").cast("long")).alias("copies"), taken.alias("taken"), "source", *keep)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken", "copies")


SQL = r"""
WITH s AS (SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, ''))) AS key, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS source_docs FROM s GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM p),
o AS (SELECT *, 3 * source_size / weight AS ratio FROM w),
c AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER b, 0) AS BIGINT) AS remain,
             CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS BIGINT) AS heavy FROM o
      WINDOW b AS (ORDER BY ratio, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT max(heavy) AS heavy FROM c WHERE remain * weight <= 3 * source_size * heavy),
g AS (SELECT c.remain, c.heavy FROM c, f WHERE c.heavy = f.heavy),
t AS (SELECT source, source_size, source_docs,
             CASE WHEN c.heavy > g.heavy THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(weight * g.remain AS DOUBLE) / g.heavy END AS target FROM c, g),
r AS (SELECT doc_id, s.source, size, source_size, source_docs, target,
             CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole,
             (CAST(('0x' || substr(md5('8:' || key), 1, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, target - whole * source_size AS rest FROM r),
k AS (SELECT *, CASE WHEN rest > 0 AND size > 0 THEN u / (1 - u) / (rest / (source_size - rest) * (CAST(size * source_docs AS DOUBLE) / source_size)) END AS rank FROM q),
z AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM k),
h AS (SELECT *, CASE WHEN rank IS NOT NULL AND rest > start AND start + size - rest <= rest - start THEN 1 ELSE 0 END AS hit FROM z)
SELECT doc_id, size, source_size, target, CAST(size * (whole + hit) AS BIGINT) AS taken, whole + hit AS copies FROM h
"""
