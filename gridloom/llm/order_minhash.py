"""Order MinHash fingerprints; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm._shared import materialize

#: A token is a run of at most 16 code points that are no space; longer runs are cut, so text without spaces has tokens too.
TOKEN = r"[^\x20\x09-\x0D]{1,16}"
K = 3
#: Permutations, and the minimal k-mers that are selected under each.
PERMUTATIONS, LEAST = 8, 2
#: Permutations that one 40-bit hash gives, by rotation, and the bits of a rotation.
ROTATIONS, TURN = 4, 10
#: Rows between two cuts of the descending order, about.
RANGE_ROWS = 2048
#: Positions of k-mers in a text; more share the last one.
_POS = (1 << 24) - 1
#: Doublings by which a k-mer's occurrences are counted: up to 2^20 in one text, more share the last numbers.
DOUBLINGS = 20


def _kmer(x: Column) -> Column:
    return F.shiftright(x, 24)


def _packed(h: Column, pos: Column) -> Column:
    return h.bitwiseAND(F.lit(~_POS)).bitwiseOR(F.least(pos.cast("long"), F.lit(_POS)))


def _hashed(seed: int):
    """The packed k-mer with another hash, its position kept."""
    return lambda x: F.xxhash64(_kmer(x), F.lit(seed)).bitwiseAND(F.lit(~_POS)).bitwiseOR(x.bitwiseAND(F.lit(_POS)))


def _doubled(counts: Column, step: int) -> Column:
    return F.transform(counts, lambda x, i: x + F.when(x == step, F.get(counts, i - step)).otherwise(F.lit(0)))


def with_signature(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``, the text's signature: an array of PERMUTATIONS ints, empty for a text without tokens or null.

    K-mers of three tokens (all tokens, where there are fewer) get their occurrence number in the text. Under each
    permutation the LEAST minimal (k-mer, occurrence) are selected and put in the order that they have in the text; the
    hash of this tuple is the permutation's entry. A permutation orders by a 40-bit hash, rotated: four come from one hash.
    """
    kept = df.columns
    t, s, c, m = (f"_omh_{x}" for x in "tscm")
    df = df.withColumn(t, F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKEN), F.lit(0)))
    tokens = F.col(t)
    packed = _packed
    many = F.transform(F.sequence(F.lit(0), F.size(tokens) - K), lambda i: packed(F.xxhash64(*[F.get(tokens, i + j) for j in range(K)]), i))
    few = F.array(packed(F.xxhash64(tokens), F.lit(0)))
    df = df.withColumn(s, F.when(F.size(tokens) >= K, F.sort_array(many)).when(F.size(tokens) > 0, few)).drop(t)
    a = F.col(s)
    df = df.withColumn(c, F.transform(a, lambda x, i: ((i > 0) & (_kmer(x) == _kmer(F.get(a, i - 1)))).cast("int")))
    df = df.withColumn(m, F.array_max(c))
    for r in range(DOUBLINGS):  # c: equal k-mers before this one, looked up 2^r places back as long as a run is longer
        more, n = F.col(m) >= (1 << r), F.col(c)
        longer = _doubled(n, 1 << r)
        df = df.withColumn(f"{c}_", F.when(more, longer).otherwise(n))
        df = df.withColumn(m, F.when(more, F.array_max(f"{c}_")).otherwise(F.col(m))).drop(c).withColumnRenamed(f"{c}_", c)
    n = F.col(c)
    numbered = F.sort_array(F.transform(a, lambda x, i: F.when(F.get(n, i) == 0, x).otherwise(packed(F.xxhash64(_kmer(x), F.get(n, i)), x.bitwiseAND(F.lit(_POS))))))
    df = df.withColumn(t, F.when(F.col(m) > 0, numbered).otherwise(a)).drop(s, c, m)
    slices = (1 << TURN) - 1
    n = F.size(t)
    # of n hashes, about eight times as many as are wanted have a leading slice below this
    below = F.least(F.lit(slices + 1), F.ceil(F.lit((slices + 1) * 8 * LEAST) / F.greatest(n, F.lit(1)))).cast("long")
    df = df.withColumn(m, below)
    entries = []
    for j in range(PERMUTATIONS // ROTATIONS):
        df = df.withColumn(f"{s}{j}", F.transform(t, _hashed(j)))
        for r in range(ROTATIONS):
            entries.append(_entry(F.col(f"{s}{j}"), F.col(m), r))
    empty = F.array().cast("array<int>")
    return df.withColumn(out, F.when(n > 0, F.array(*entries)).otherwise(empty)).select(*kept, out)


def _entry(hashes: Column, below: Column, turn: int) -> Column:
    """The entry of the permutation that orders the packed ``hashes`` by their bits from slice ``turn`` on."""
    low, width = 24 + TURN * turn, 24 + 40
    leading = lambda x: F.shiftrightunsigned(x, low).bitwiseAND(F.lit((1 << TURN) - 1))
    few = F.filter(hashes, lambda x: leading(x) < below)
    chosen = F.when(F.size(few) >= LEAST, few).otherwise(hashes)

    def turned(x: Column) -> Column:  # the slice to the top of the 40 bits, position below
        if turn == ROTATIONS - 1:
            return x
        up = TURN * (ROTATIONS - 1 - turn)
        front = F.shiftleft(x.bitwiseAND(F.lit((1 << (width - up)) - 1 - _POS)), up)
        back = F.shiftrightunsigned(x, width - up).bitwiseAND(F.lit((1 << up) - 1))
        return front.bitwiseOR(F.shiftleft(back, 24)).bitwiseOR(x.bitwiseAND(F.lit(_POS)))

    sign = F.lit(-(1 << 63))
    order = lambda x: turned(x).bitwiseXOR(sign)  # noqa: E731  longs are sorted as signed
    least = F.slice(F.sort_array(F.transform(chosen, order)), 1, LEAST)
    placed = lambda x: F.shiftleft(x.bitwiseAND(F.lit(_POS)), 39).bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(sign), 25))
    bits = F.transform(F.sort_array(F.transform(least, placed)), lambda x: x.bitwiseAND(F.lit((1 << 39) - 1)))
    return F.xxhash64(F.array_join(F.transform(bits, lambda x: F.hex(x)), ",")).bitwiseAND(F.lit((1 << 31) - 1)).cast("int")


def as_text(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x.cast("long")), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries; two empty signatures are alike, an empty one and another aren't."""
    equal = F.size(F.filter(F.transform(a, lambda x, i: x == F.get(b, i)), lambda x: F.coalesce(x, F.lit(False))))
    both = (F.size(a) == 0) & (F.size(b) == 0)
    return F.when(both, F.lit(1.0)).otherwise(equal / F.lit(float(PERMUTATIONS)))


def with_next(docs: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """Adds ``next``, a struct of ``columns`` of the next row in descending ``order`` (nulls last), the first one's after the last.

    Ids are dealt to ranges between percentiles; a range's first row is also given to the range above it, so that a
    window within each range finds all successors. Ranges are ordered within 64 parts of the ids.
    """
    key = F.coalesce(F.col(order).cast("long"), F.lit(-(1 << 63)))
    steps = 64
    found = docs.select(F.percentile_approx(key, [i / steps for i in range(steps + 1)], 10_000).alias("c"), F.count("*").alias("n")).first()
    cuts = sorted(set(found["c"] or []))
    fine = max(1, -(-found["n"] // RANGE_ROWS // max(1, len(cuts))))
    at = F.array(*[F.lit(x) for x in cuts]) if cuts else F.array().cast("array<long>")
    coarse = F.size(F.filter(at, lambda c: c <= key))
    low, high = F.get(at, coarse - 1), F.get(at, coarse)
    part = F.floor((key - low).cast("double") / (high - low).cast("double") * fine)
    span = F.coalesce(F.least(F.greatest(part, F.lit(0)), F.lit(fine - 1)), F.lit(0))
    safe = F.when((low > -(1 << 62)) & (high < (1 << 62)), span).otherwise(F.lit(0))  # no overflow of the differences
    rows = docs.withColumn("_key", key).withColumn("_range", coarse.cast("long") * fine + safe)
    heads = rows.groupBy("_range").agg(F.max("_key").alias("_head")).withColumn("_part", F.floor(F.col("_range") / fine))
    # the range above is the next one of the same part; above a part's last one it is the first one of the next part
    firsts = dict(heads.groupBy("_part").agg(F.min("_range")).collect())  # a row for each part, ``steps`` + 2 at most
    after, following = {}, min(firsts.values(), default=0)
    for part, first in sorted(firsts.items(), reverse=True):
        after[part], following = following, first
    over = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in after.items() for x in pair]), F.col("_part")) if after else F.lit(None).cast("long")
    above = F.coalesce(F.lead("_range").over(Window.partitionBy("_part").orderBy("_range")), over).alias("_above")
    # a table, whose size Spark knows when it plans: it broadcasts the heads where they are small, and else joins by key
    heads = materialize(heads.select(F.col("_range").alias("_of"), "_head", above), "ranges")
    rows = rows.join(heads, (F.col("_range") == F.col("_of")) & (F.col("_key") == F.col("_head")), "left").drop("_of")
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("ghost"))
    ghost = F.when(F.col("_above").isNotNull(), F.struct(F.col("_above").alias("r"), F.lit(True).alias("ghost")))
    rows = rows.withColumn("_at", F.explode(F.array_compact(F.array(own, ghost)))).withColumn("_r", F.col("_at.r")).withColumn("_ghost", F.col("_at.ghost"))
    w = Window.partitionBy("_r").orderBy("_ghost", F.desc("_key"), *columns)
    out = rows.select(*docs.columns, "_r", "_ghost", "_key").withColumn("next", F.lead(F.struct(*columns)).over(w))
    return out.where(~F.col("_ghost")).select(*docs.columns, "next")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next for every row.

    The edited text has its last third (rounded down, code points) replaced by as many first code points of the next
    document's text, or all it has. Null text is empty; a text without tokens has the empty fingerprint, which is like
    itself only. Rows with equal doc_id are ordered by text, rows without doc_id come last. A single row is its own next.
    Equal texts have equal fingerprints. Empty table: empty result. Other columns are ignored.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(with_signature(rows, "text", "sig"), "doc_id", ["text", "sig"])
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - cut), F.col("next.text").substr(F.lit(1), cut))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sig", F.col("next.sig").alias("next_sig"), edited.alias("edited"))
    rows = with_signature(rows, "edited", "edited_sig")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), as_text(F.col("sig")).alias("fingerprint"),
        as_text(F.col("edited_sig")).alias("edited_fingerprint"), likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
