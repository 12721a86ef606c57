"""Exact Jaccard join of the documents' word n-gram sets, answered by the sets' components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm._shared import Scratch, bound_batches, text_chunks
from gridloom.llm._text import Words, mix
from gridloom.llm.components import components, roots

#: Frequent n-grams whose counts order the others after them: a bound on what is broadcast; results don't depend on it.
COMMON = 1 << 19
#: N-grams of several chunks that are counted together before those that occur in one set only are dropped.
COUNTED = 1_500_000
#: Postings that a task sorts at once, about; an n-gram of at least so many sets is dealt with apart, by rows.
LIST_ROWS, LONG_LIST = 1 << 17, 1 << 16
#: Entries of a list's block of one size band in which sets look for likely links.
BLOCK_ROWS = 4096
#: 64-bit words of a set's signature, in which each n-gram flips one bit.
SIGNATURE = 8
#: Bits of the table of wanted texts, which is broadcast (1 MB): texts beyond the wanted ones that it lets through do no harm.
WANTED_BITS = 1 << 23
_POSTING = np.dtype([("gram", "<i8"), ("id", "<i8"), ("n", "<i4"), ("place", "<i4")])
_SIGNATURE = [f"s{i}" for i in range(SIGNATURE)]


class Sets:
    """The distinct k-grams of some texts: text i has the sorted ``grams[first[i]:first[i + 1]]``."""

    def __init__(self, column: pa.Array, k: int) -> None:
        words = Words(column, lower=True)
        hashes = words.hashes()
        gram, text, _ = words.windows(hashes, k, 4)
        short = np.flatnonzero((words.counts > 0) & (words.counts < k))
        if len(short):
            whole = [self._whole(hashes[words.first[i] : words.first[i + 1]]) for i in short]
            gram, text = np.concatenate([gram, mix(np.array(whole, np.uint64))]), np.concatenate([text, short])
        order = np.argsort(gram)
        kind = np.uint16 if len(words.counts) < 1 << 16 else np.int64  # 16-bit keys are sorted by radix
        order = order[np.argsort(text[order].astype(kind), kind="stable")]
        gram, text = gram[order], text[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])
        self.grams, self.text = gram[new], text[new]
        self.first = np.searchsorted(self.text, np.arange(len(words.counts) + 1))
        self.sizes = np.diff(self.first)

    @staticmethod
    def _whole(hashes: np.ndarray) -> int:
        """Of a text with fewer words than k."""
        return (len(hashes) + sum(int(x) * pow(0xD6E8FEB86659FD93, j + 1, 1 << 64) for j, x in enumerate(hashes))) % (1 << 64)

    def ids(self) -> np.ndarray:
        """A 64-bit id of each set: equal sets have equal ids; 0 for the empty set."""
        out = np.zeros(len(self.sizes), np.uint64)
        full = np.flatnonzero(self.sizes)
        if len(full):
            sums = np.add.reduceat(mix(self.grams ^ np.uint64(0xA0761D6478BD642F)), self.first[full])
            out[full] = mix(sums + self.sizes[full].astype(np.uint64))
        return out.view(np.int64)

    def signatures(self) -> np.ndarray:
        """SIGNATURE words of each set. Two sets' signatures differ in at most as many bits as n-grams are in one only."""
        bits, out = 64 * SIGNATURE, np.zeros((len(self.sizes), SIGNATURE), np.int64)
        for low in range(0, len(out), 4096):
            high = min(low + 4096, len(out))
            a, b = self.first[low], self.first[high]
            at = (self.text[a:b] - low) * bits + (self.grams[a:b] >> np.uint64(40)).astype(np.int64) % bits
            odd = (np.bincount(at, minlength=(high - low) * bits) & 1).astype(np.uint8)
            out[low:high] = np.packbits(odd, bitorder="little").view(np.int64).reshape(-1, SIGNATURE)
        return out


def _scan(k: int):
    """A row of each text (doc_id, n, id, signature), and rows (gram, sets) of n-grams that several sets have."""

    def counted(grams: list[np.ndarray], rows: int) -> pa.RecordBatch:
        gram, count = np.unique(np.concatenate(grams), return_counts=True)
        keep = count >= max(2, rows // 2500)
        none = pa.nulls(int(keep.sum()), pa.int64())
        found = [pa.array(gram[keep].view(np.int64)), pa.array(count[keep].astype(np.int64))]
        return pa.RecordBatch.from_arrays([none] * (3 + SIGNATURE) + found, names=_SCANNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = rows = 0
        for batch in text_chunks(batches, "text"):
            sets = Sets(batch.column(1), k)
            signature, none = sets.signatures(), pa.nulls(batch.num_rows, pa.int64())
            heads = [batch.column(0), pa.array(sets.sizes.astype(np.int64)), pa.array(sets.ids())]
            heads += [pa.array(np.ascontiguousarray(signature[:, i])) for i in range(SIGNATURE)]
            yield pa.RecordBatch.from_arrays([*heads, none, none], names=_SCANNED)
            held.append(sets.grams)
            size, rows = size + len(sets.grams), rows + batch.num_rows
            if size >= COUNTED:
                yield counted(held, rows)
                held, size, rows = [], 0, 0
        if held:
            yield counted(held, rows)

    return run


_SCANNED = ["doc_id", "n", "id", *_SIGNATURE, "gram", "sets"]


def _postings(k: int, percent: int, common, buckets: int):
    """Each set's first n-grams, frequent ones last (two sets that link share one of these), packed by bucket of n-grams.
    Those of long lists are packed apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, weight = common.value
        for batch in text_chunks(batches, "text"):
            sets = Sets(batch.column(0), k)
            ids, gram, text = sets.ids(), sets.grams.view(np.int64), sets.text
            rank = np.zeros(len(gram), np.int64)
            if len(key) and len(gram):
                at = np.minimum(np.searchsorted(key, gram), len(key) - 1)
                rank = np.where(key[at] == gram, weight[at], 0)
            heavy = np.flatnonzero(rank)  # few; the others are in order already, by text and n-gram
            order = np.concatenate([np.flatnonzero(rank == 0), heavy[np.lexsort((gram[heavy], rank[heavy]))]])
            order = order[np.argsort(text[order].astype(np.uint16 if len(ids) < 1 << 16 else np.int64), kind="stable")]
            place = np.arange(len(gram)) - sets.first[text]
            _, one = np.unique(ids, return_index=True)  # equal sets of a chunk once
            take = np.zeros(len(ids), bool)
            take[one] = True
            n = sets.sizes[text]
            keep = take[text] & (place <= n - -(-percent * n // 100))
            rows = np.empty(int(keep.sum()), _POSTING)
            rows["gram"], rows["id"], rows["n"], rows["place"] = gram[order][keep], ids[text[keep]], n[keep], place[keep]
            bucket = ((rows["gram"].view(np.uint64) >> np.uint64(33)).astype(np.int64) % buckets).astype(np.int32)
            bucket[rank[order][keep] >= LONG_LIST] = -1
            sort = np.argsort(bucket, kind="stable")
            bucket, rows = bucket[sort], rows[sort]
            cut = np.flatnonzero(np.diff(bucket, prepend=np.int32(-2)))
            packed = [rows[a:b].tobytes() for a, b in zip(cut, [*cut[1:], len(rows)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cut], pa.int32()), pa.array(packed, pa.binary())], names=["bucket", "rows"])

    return run


_LIST = "gram long, id long, n int, place int, m long"


def _list_rows(rows: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.ascontiguousarray(rows[c])) for c in ("gram", "id", "n", "place")]
    return pa.RecordBatch.from_arrays([*columns, pa.array(m.astype(np.int64))], names=["gram", "id", "n", "place", "m"])


def _bucket_lists(percent: int):
    """The lists of a bucket's n-grams, by size; entries without a neighbour of a size that could link are left out."""

    def run(table: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(x.as_buffer(), _POSTING) for x in table.column("rows")])
        rows = rows[np.lexsort((rows["id"], rows["n"], rows["gram"]))]
        gram, ident, n = rows["gram"], rows["id"], rows["n"].astype(np.int64)
        new = np.ones(len(rows), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (ident[1:] != ident[:-1])
        rows, gram, n = rows[new], gram[new], n[new]
        near = (gram[1:] == gram[:-1]) & (n[:-1] * 100 >= n[1:] * percent)
        close = np.zeros(len(rows), bool)
        close[1:] |= near
        close[:-1] |= near
        group = np.cumsum(np.concatenate([[0], gram[1:] != gram[:-1]]))
        m = np.bincount(group, minlength=1)[group]
        return pa.Table.from_batches([_list_rows(rows[close], m[close])])

    return run


def _long_lists(common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, weight = common.value
        for batch in batches:
            for packed in batch.column(0):
                rows = np.frombuffer(packed.as_buffer(), _POSTING)
                yield _list_rows(rows, weight[np.searchsorted(key, rows["gram"])])

    return run


def _grams(k: int, wanted):
    """id and n-grams of the sets of texts whose key is among the wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) & np.uint64(WANTED_BITS - 1)
            hit = (bits[(key >> np.uint64(6)).astype(np.int64)] >> (key & np.uint64(63))) & np.uint64(1)
            for part in text_chunks(iter([batch.filter(pa.array(hit.astype(bool)))]), "text"):
                sets = Sets(part.column(1), k)
                grams = [sets.grams[a:b].tobytes() for a, b in zip(sets.first, sets.first[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(sets.ids()), pa.array(grams, pa.binary())], names=["id", "grams"])

    return run


def _common_size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        both, size = [], []
        for x, y in zip(left, right, strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both.append(len(np.intersect1d(x, y, assume_unique=True)))
            size.append(len(x) + len(y))
        cols = [batch.column(0), batch.column(1), pa.array(both, pa.int64()), pa.array(size, pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=["a", "b", "both", "sizes"])


class JaccardJoin:
    """Links document sets whose intersection is at least ``percent`` % of their union, and finds the components of the links.

    Equal sets become one node first. Prefix lists of rare n-grams hold each node with its size and position. A list is
    cut into blocks, by component and band of sizes: only blocks of one band or of neighbouring bands meet (the band is
    part of the join's key), and of these, blocks are skipped whose sizes, positions or signatures rule out a link.

    Relations between sets spare the rest. Each set is compared with the head of its block, or with the neighbour it
    shares most lists with; linked sets get one component, and a pair within a component needs no answer of its own.
    Between components that meet in a list, the representatives are compared first; as Jaccard distance is a metric, a
    member's answers follow from its representative's: pairs whose distance bound excludes a link are skipped, only the
    undecided are compared.
    """

    def __init__(self, docs: DataFrame, k: int = 4, percent: int = 85) -> None:
        self.docs, self.k, self.percent = docs.select("doc_id", "text"), k, percent
        self.near = 1 - percent / 100
        self.spark = docs.sparkSession
        self.scratch = Scratch(self.spark, "jaccard")
        bound_batches(self.spark)

    def _fits(self, n: Column, m: Column) -> Column:
        """Sizes n <= m allow a link."""
        return n * 100 >= m * self.percent

    def _room(self, most: Column, n: Column, m: Column) -> Column:
        """Whether ``most`` common n-grams make a link of sets of at least n and m."""
        return most * (100 + self.percent) >= (n + m) * self.percent

    def _enough(self, shared: Column, low: Column, high: Column) -> Column:
        """Whether sets of ``low`` <= ``high`` n-grams whose prefixes share so many can link: beyond its prefix, a set of
        n has less than ``percent`` % of n left."""
        p = self.percent
        return shared * (100 * (100 + p)) >= low * (100 * p) - high * (p * p)

    def _band(self, n: Column) -> Column:
        """Sizes that allow a link lie in one band or in neighbouring ones."""
        width = max(math.log(100 / self.percent), 0.01) * 1.0001
        return F.floor(F.log(n.cast("double")) / width).cast("int")

    def _linked(self) -> Column:
        return F.col("both") * (100 + self.percent) >= F.col("sizes") * self.percent

    def _scanned(self) -> tuple[DataFrame, DataFrame]:
        """heads (doc_id, n, id, signature) of all rows, and frequent (gram, sets)."""
        types = [f"{c} long" for c in _SCANNED]
        scanned = self.scratch.keep(self.docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scan(self.k), ", ".join(types)), "scan")
        heads, counts = scanned.where("n is not null").drop("gram", "sets"), scanned.where("n is null")
        frequent = counts.groupBy("gram").agg(F.sum("sets").alias("sets")).orderBy(F.desc("sets"), "gram").limit(COMMON)
        return heads, frequent

    def _lists(self, heads: DataFrame, frequent: DataFrame) -> DataFrame:
        """gram, id, n, place, m: the prefix lists of n-grams that some sets of fitting sizes share; m is a list's length."""
        table = frequent.toArrow()  # at most COMMON rows
        key, weight = (table.column(c).to_numpy() for c in ("gram", "sets"))
        order = np.argsort(key)
        common = self.spark.sparkContext.broadcast((key[order], weight[order]))
        total = heads.agg(F.sum("n")).first()[0] or 0
        buckets = max(256, total * (100 - self.percent) // 100 // LIST_ROWS)
        posts = self.docs.select("text").mapInArrow(_postings(self.k, self.percent, common, buckets), "bucket int, rows binary")
        posts = self.scratch.keep(posts, "postings")
        short = posts.where("bucket >= 0").groupBy("bucket").applyInArrow(_bucket_lists(self.percent), _LIST)
        long = posts.where("bucket < 0").select("rows").mapInArrow(_long_lists(common), _LIST)
        long = long.groupBy("gram", "id").agg(*[F.min(c).alias(c) for c in ("n", "place", "m")])
        lists = self.scratch.keep(short.unionByName(long), "lists")
        self.scratch.drop("postings")
        common.destroy()
        return lists

    def _likely(self, lists: DataFrame) -> DataFrame:
        """a, b: for each set one more central one that it may link with, the head of its blocks or that before it in them,
        by the number of lists; the head counts more, so that links make stars rather than chains.

        Central are sets of many and long lists, as what near copies have in common has. A list's block of one size band
        has about BLOCK_ROWS sets."""
        central = lists.groupBy("id").agg(F.sum("m").alias("w"))
        parts = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("m") / BLOCK_ROWS)))).cast("long")
        w = Window.partitionBy("gram", "salt", "band").orderBy(F.desc("w"), "id")
        rows = lists.join(central, "id").withColumn("salt", F.pmod(F.xxhash64("id"), parts)).withColumn("band", self._band(F.col("n")))
        rows = rows.withColumn("head", F.first(F.struct("id", "n")).over(w)).withColumn("last", F.lag(F.struct("id", "n")).over(w)).where("last is not null")
        sides = F.array(F.struct("head.*", F.lit(1).alias("h"), F.lit(0).alias("l")), F.struct("last.*", F.lit(0).alias("h"), F.lit(1).alias("l")))
        pairs = rows.select(F.col("id").alias("b"), F.col("n").alias("m"), F.inline(sides).alias("a", "n", "h", "l"))
        pairs = pairs.groupBy("a", "b").agg(F.sum("h").alias("h"), F.sum("l").alias("l"), F.first(F.least("n", "m")).alias("n"), F.first(F.greatest("n", "m")).alias("m"))
        # neighbours in some lists aren't in all that they share
        pairs = pairs.where(self._fits(F.col("n"), F.col("m")) & self._enough(F.greatest("h", "l") * 4, F.col("n"), F.col("m")))
        best = F.max_by("a", F.struct(F.greatest(F.col("h") * 1.25, "l"), "a"))
        return self.scratch.keep(pairs.groupBy("b").agg(best.alias("a")).select("a", "b"), "likely")

    def _sets(self, heads: DataFrame, ids: DataFrame) -> DataFrame:
        """id, grams of the sets ``ids``, from one text of each. Texts are found by a table of bits, without a shuffle of texts."""
        key = F.xxhash64("doc_id")
        holders = heads.where("n > 0").groupBy("id").agg(F.min(key).alias("key")).join(ids.distinct(), "id", "left_semi")
        bit = F.col("key").bitwiseAND(F.lit(WANTED_BITS - 1))
        words = holders.select(F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        table = np.zeros(WANTED_BITS // 64, np.uint64)  # at most as many rows
        table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
        wanted = self.spark.sparkContext.broadcast(table)
        found = self.docs.select(key.alias("key"), "text").mapInArrow(_grams(self.k, wanted), "id long, grams binary")
        sets = self.scratch.keep(found.dropDuplicates(["id"]), "sets")
        wanted.destroy()
        return sets

    def _compare(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """a, b, both, sizes for each distinct pair of ids."""
        pairs = pairs.select("a", "b").distinct().join(sets.select(F.col("id").alias("a"), F.col("grams").alias("x")), "a")
        pairs = pairs.join(sets.select(F.col("id").alias("b"), F.col("grams").alias("y")), "b").select("a", "b", "x", "y")
        return self.scratch.keep(pairs.mapInArrow(_common_size, "a long, b long, both long, sizes long"), "pairs")

    def _marks(self, heads: DataFrame) -> DataFrame:
        """id and signature of each set."""
        return heads.where("n > 0").groupBy("id").agg(*[F.first(c).alias(c) for c in _SIGNATURE])

    def _differ(self, other: str = "y") -> Column:
        """Bits in which the signatures of rows x and y (or ``other``) differ."""
        out = F.lit(0)
        for s in _SIGNATURE:
            out = out + F.bit_count(F.col(f"x.{s}").bitwiseXOR(F.col(f"{other}.{s}")))
        return out

    def _named(self, lists: DataFrame, comps: DataFrame) -> DataFrame:
        named = lists.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        return self.scratch.keep(named.select("gram", "id", "n", "place", "comp"), "named")

    def _meet(self, named: DataFrame, heads: DataFrame, radius: DataFrame) -> DataFrame:
        """a, b: components of which some sets may link, by the blocks of lists in which they meet.

        A representative's signature stands for its component: it differs from a member's in at most ``apart`` bits."""
        p = self.percent
        blocks = named.withColumn("band", self._band(F.col("n"))).groupBy("gram", "comp", "band").agg(
            F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("place")).alias("rest"), F.max("place").alias("place"))
        several = blocks.groupBy("gram").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("gram")
        blocks = blocks.join(several, "gram", "left_semi")
        blocks = blocks.join(self._marks(heads).withColumnRenamed("id", "comp"), "comp").join(radius.select("comp", "apart"), "comp", "left").fillna(0, ["apart"])
        blocks = self.scratch.keep(blocks, "blocks")
        x = blocks.withColumn("at", F.explode(F.array(F.col("band"), F.col("band") + 1))).alias("x")
        y = blocks.alias("y")
        both = lambda f, c: f(F.col(f"x.{c}"), F.col(f"y.{c}"))
        sum_of = lambda c: F.col(f"x.{c}") + F.col(f"y.{c}")
        alike = (self._differ() - sum_of("apart")) * (100 + p) <= sum_of("high") * (100 - p)
        order = F.when(F.col("x.band") == F.col("y.band"), F.col("x.comp") < F.col("y.comp")).otherwise(F.col("x.comp") != F.col("y.comp"))
        fit = self._fits(F.col("x.high"), F.col("y.low")) & self._fits(F.col("y.high"), F.col("x.low"))
        room = self._room(both(F.least, "place") + both(F.least, "rest"), F.col("x.low"), F.col("y.low"))
        pairs = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.at") == F.col("y.band")) & order & fit & room & alike)
        pairs = pairs.groupBy(F.col("x.comp").alias("a"), F.col("y.comp").alias("b"), F.col("x.band").alias("i"), F.col("y.band").alias("j")).agg(
            F.count("*").alias("c"), F.max(both(F.least, "rest")).alias("rest"), F.min("x.low").alias("n"), F.min("y.low").alias("m"), F.max(both(F.greatest, "high")).alias("high"))
        pairs = pairs.where(self._enough(F.col("c"), F.least("n", "m"), F.col("high")) & self._room(F.col("rest"), F.col("n"), F.col("m")))
        return self.scratch.keep(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "meet")

    def _undecided(self, heads: DataFrame, spokes: DataFrame, open_: DataFrame, radius: DataFrame) -> DataFrame:
        """a, b, x_comp, y_comp: pairs of members of the ``open_`` components that may still link, by distances from the
        representatives, sizes and signatures.

        A member meets another component only where the other's sizes, and its representative's signature less the bits in
        which members differ from that, leave room for a link: else each member of a large component would be a row for each
        of the components around it."""
        involved = open_.select(F.explode(F.array("a", "b")).alias("comp")).distinct()
        member = spokes.select("comp", "id", "d").join(involved, "comp", "left_semi")
        member = member.unionByName(involved.select("comp", F.col("comp").alias("id"), F.lit(0.0).alias("d")))
        sizes = heads.where("n > 0").groupBy("id").agg(F.first("n").alias("n"))
        member = self.scratch.keep(member.join(sizes, "id").join(self._marks(heads), "id"), "members")
        # only members far enough from their representative, towards the other component, can have a link
        span = member.groupBy("comp").agg(F.min("n").alias("low"), F.max("n").alias("high"))
        other = member.where("id = comp").select("comp", *_SIGNATURE).join(span, "comp").join(radius.select("comp", "apart"), "comp", "left").fillna(0, ["apart"])
        x, y, o = member.alias("x"), member.alias("y"), open_.join(other.withColumnRenamed("comp", "b"), "b").alias("o")
        far = F.col("o.d") - F.col("x.d")
        near = far - F.col("o.r_b") <= self.near + 1e-9
        room = self._fits(F.col("x.n"), F.col("o.low")) & self._fits(F.col("o.high"), F.col("x.n"))
        alike = (self._differ("o") - F.col("o.apart")) * (100 + self.percent) <= (F.col("x.n") + F.col("o.high")) * (100 - self.percent)
        ahead = x.join(o, (F.col("x.comp") == F.col("o.a")) & near & room & alike)
        ahead = ahead.select("id", "n", *[f"x.{s}" for s in _SIGNATURE], F.col("x.comp").alias("comp"), F.col("o.b").alias("to"), far.alias("gap")).alias("x")
        on = (F.col("x.to") == F.col("y.comp")) & self._fits(F.least("x.n", "y.n"), F.greatest("x.n", "y.n")) & (F.col("x.gap") - F.col("y.d") <= self.near + 1e-9)
        on = on & (self._differ() * (100 + self.percent) <= (F.col("x.n") + F.col("y.n")) * (100 - self.percent))
        return ahead.join(y, on).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.comp").alias("x_comp"), F.col("y.comp").alias("y_comp"))

    def _between(self, heads: DataFrame, named: DataFrame, comps: DataFrame, sets: DataFrame) -> DataFrame:
        """a, b: components that a link joins."""
        distance = 1 - F.col("both") / (F.col("sizes") - F.col("both"))
        spokes = self._compare(comps.where("id <> comp").select(F.col("comp").alias("a"), F.col("id").alias("b")), sets)
        spokes = spokes.select(F.col("a").alias("comp"), F.col("b").alias("id"), distance.alias("d"), (F.col("sizes") - 2 * F.col("both")).alias("apart"))
        radius = spokes.groupBy("comp").agg(F.max("d").alias("r"), F.max("apart").alias("apart"))
        meet = self._meet(named, heads, radius)
        met = meet.select(F.explode(F.array("a", "b")).alias("id"))
        sets = sets.unionByName(self._sets(heads, met.join(sets.select("id"), "id", "left_anti")))
        first = self._compare(meet, sets)
        open_ = first.where(~self._linked()).withColumn("d", distance)
        for side in "ab":
            open_ = open_.join(radius.select(F.col("comp").alias(side), F.col("r").alias(f"r_{side}")), side, "left").fillna(0.0, [f"r_{side}"])
        open_ = open_.where("r_a + r_b > 0").where(F.col("d") - F.col("r_a") - F.col("r_b") <= self.near + 1e-9).select("a", "b", "d", "r_b")
        last = self.scratch.keep(self._undecided(heads, spokes, self.scratch.keep(open_, "open"), radius), "undecided")
        found = self._compare(last, sets).where(self._linked()).select("a", "b")
        found = last.join(found, ["a", "b"]).select(F.col("x_comp").alias("a"), F.col("y_comp").alias("b"))
        return first.where(self._linked()).select("a", "b").unionByName(found)

    def run(self) -> DataFrame:
        """doc_id, n_shingles and component_id, the smallest doc_id reachable by links."""
        heads, frequent = self._scanned()
        lists = self._lists(heads, frequent)
        likely = self._likely(lists)
        sets = self._sets(heads, likely.select(F.explode(F.array("a", "b")).alias("id")))
        first = self._compare(likely, sets).where(self._linked())
        comps = roots(first, "b", "a", self.scratch)
        links = self._between(heads, self._named(lists, comps), comps, sets)
        merged = components(links, "a", "b", self.scratch).select(F.col("id").alias("comp"), F.col("comp").alias("root"))
        ids = heads.where("n > 0").groupBy("id").agg(F.min("doc_id").alias("low")).join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        ids = ids.join(merged, "comp", "left").withColumn("root", F.coalesce("root", "comp"))
        least = ids.groupBy("root").agg(F.min("low").alias("component_id"))
        named = self.scratch.keep(ids.select("id", "root").join(least, "root").select("id", "component_id"), "named-sets")
        rows = heads.select("doc_id", "n", "id").join(named, "id", "left")
        alone = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
        return self.scratch.finish(rows.select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id")))


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id for each row of ``docs`` (doc_id, text).

    Words are runs of bytes other than space and 0x09-0x0D, A-Z in lower case. A text with fewer than k words has one
    n-gram, all its words; null or wordless text has none and links with nothing. Rows with one doc_id count as rows of
    their own; a null doc_id is the smallest only where all others are null too. Empty table: empty result. Other
    columns are ignored.
    """
    return JaccardJoin(docs, k, percent).run()


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
             ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM s),
p AS (SELECT doc_id, n, t FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY f, t) AS i FROM (SELECT *, count(*) OVER (PARTITION BY t) AS f FROM e)) WHERE i <= n - (85 * n + 99) // 100 + 1),
c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM p a JOIN p b ON a.t = b.t AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)),
i AS (SELECT c.a, c.b, any_value(na) + any_value(nb) AS z, count(*) AS x FROM c JOIN e u ON u.doc_id = c.a JOIN e v ON v.doc_id = c.b AND v.t = u.t GROUP BY c.a, c.b),
l AS (SELECT a, b FROM i WHERE 185 * x >= 85 * z),
d AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, d.b FROM r JOIN d ON d.a = r.b),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id FROM s JOIN m ON m.a = s.doc_id
"""
