"""Phrase collocations by set-oriented mining over persisted occurrence relations."""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm._shared import Scratch, bound_batches, give_back
from gridloom.llm._text import buffer

#: Bytes of one language's text that make a chunk of the relations, and bytes of all languages that a task gathers before
#: it writes them; only bound memory, no result depends on them.
CHUNK_BYTES, HELD_BYTES = 1 << 22, 1 << 24
#: Rounds in which the pairs of a length are counted: half of them lies in a shuffle at once.
ROUNDS = 2
#: Parts into which a language's candidates are dealt before its first ones are chosen.
SALTS = 64
LONGEST = 4

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_TEXTS = "chunk long, lang string, words array<string>, counts array<int>, places binary"
_RELATION = "chunk long, places binary, ids binary"
_COUNTED = "chunk long, heads binary, tails binary, ids binary, sums binary"


def _places(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of some texts, and the texts as places in them; -1 stands between two pieces."""
    data, off = buffer(texts)
    data = _LOWER[data]
    kind = _KIND[data]
    solid = kind == 0
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    some = off[1:] > off[:-1]
    edge = off[:-1][some]
    begin[edge] = solid[edge]
    edge = off[1:][some] - 1
    end[edge] = solid[edge]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    size = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=size[1:])
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(size), pa.py_buffer(data[solid])]).dictionary_encode()
    at = words.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    cut = np.cumsum(kind == 2)
    piece = cut[starts] if len(starts) else starts
    text = np.searchsorted(off, starts, "right")
    new = np.flatnonzero((piece[1:] != piece[:-1]) | (text[1:] != text[:-1])) + 1
    return words.dictionary.cast(pa.string()), np.insert(at, new, -1)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of one language each, as distinct words, their counts and the word at every place."""
    base, made = TaskContext.get().partitionId() << 32, 0
    held: dict[str, list] = {}

    def chunk(lang: str) -> pa.RecordBatch:
        nonlocal made
        texts = held.pop(lang)[1]
        words, places = _places(pa.concat_arrays(texts))
        counts = np.bincount(places[places >= 0], minlength=len(words)).astype(np.int32)
        made += 1
        one = lambda flat: pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)
        return pa.RecordBatch.from_arrays([pa.array([base + made]), pa.array([lang]), one(words), one(pa.array(counts)), pa.array([_packed(places)])], names=["chunk", "lang", "words", "counts", "places"])

    for batch in batches:
        lang = pc.fill_null(batch.column(0), "und")
        for name in pc.unique(lang).to_pylist():
            texts = batch.column(1).filter(pc.equal(lang, name))
            mine = held.setdefault(name, [0, []])
            for start in range(0, len(texts), 64):  # long texts fill a chunk soon
                part = texts.slice(start, 64)
                mine[0] += part.nbytes
                mine[1].append(part)
                if mine[0] >= CHUNK_BYTES:
                    yield chunk(name)
                    mine = held.setdefault(name, [0, []])
        if sum(x[0] for x in held.values()) >= HELD_BYTES:
            for name in list(held):
                if held[name][1]:
                    yield chunk(name)
    for name in list(held):
        if held[name][1]:
            yield chunk(name)
    give_back()


def _joined(places: np.ndarray, n: int) -> np.ndarray:
    """A code for the groups at each place and the next one: the relation merge-joined with itself by piece and adjacent
    position. -1 where a side has none; places are sorted and pieces kept apart, so the match is the neighbour."""
    left, right = places[:-1].astype(np.int64), places[1:].astype(np.int64)
    return np.where((left >= 0) & (right >= 0), left * max(n, 1) + right, -1)


def _pairs(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
    """A row for each distinct pair of a chunk's groups that lie at adjacent positions, with its number of occurrences; of the
    pairs whose turn it is."""
    for batch in batches:
        for chunk, raw, known in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            ids = _unpacked(known)
            code = _joined(_unpacked(raw), len(ids))
            code, n = np.unique(code[code >= 0], return_counts=True)
            left, right = ids[code // max(len(ids), 1)] if len(code) else code, ids[code % max(len(ids), 1)] if len(code) else code
            mine = (left + right) % ROUNDS == turn
            left, right, n = left[mine], right[mine], n[mine]
            for a in range(0, len(n), 1 << 16):
                part = slice(a, a + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(left[part]), pa.array(right[part]), pa.array(np.full(len(left[part]), chunk)), pa.array(n[part].astype(np.int32))], names=["head", "tail", "chunk", "n"])
    give_back()


#: Entries that a task gathers before it writes a row for each chunk.
_GATHER = 1 << 19


class _Counter:
    """Sums of the pairs of a task, which come in order; what is frequent goes back to its chunks.

    A pair's rows wait until ``least`` occurrences are known, so fewer than that many; from then on they pass."""

    def __init__(self, least: int, turn: int) -> None:
        self.least, self.base, self.made = least, turn << 60 | TaskContext.get().partitionId() << 33, 0
        self.found, self.groups, self.size = [], [], 0

    def _out(self, keys: list[np.ndarray], chunk: np.ndarray | None) -> pa.RecordBatch:
        if chunk is None:
            cuts, chunk, name = [0, len(keys[0])], np.zeros(1, np.int64), [None]
        else:
            order = np.argsort(chunk, kind="stable")
            keys, chunk = [k[order] for k in keys], chunk[order]
            cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
            name = chunk[cuts[:-1]].tolist()
        columns = [pa.array([_packed(k[a:b], True) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()) for k in keys]
        columns += [pa.nulls(len(name), pa.binary())] * (4 - len(columns))
        return pa.RecordBatch.from_arrays([pa.array(name, pa.int64()), *columns], names=["chunk", "heads", "tails", "ids", "sums"])

    def _flush(self) -> Iterator[pa.RecordBatch]:
        if self.found:
            chunk, *keys = (np.concatenate(x) for x in zip(*self.found, strict=True))
            if len(chunk):
                yield self._out(keys, chunk)
        if self.groups:
            keys = [np.concatenate(x) for x in zip(*self.groups, strict=True)]
            if len(keys[0]):
                yield self._out(keys, None)
        self.found, self.groups, self.size = [], [], 0

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] | None = None  # head, tail, chunk, n of the pair that may go on; one row of chunk -1, if it is frequent
        known = -1
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                rows = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
            elif waiting is None:
                break
            else:
                rows = [np.empty(0, np.int64)] * 4
            if waiting is not None:
                rows = [np.concatenate(x) for x in zip(waiting, rows, strict=True)]
            head, tail, chunk, n = rows
            if not len(head):
                continue
            first = np.concatenate([[0], np.flatnonzero((np.diff(head) != 0) | (np.diff(tail) != 0)) + 1])
            sums = np.add.reduceat(n, first)
            good = sums >= self.least
            ids = np.full(len(first), -1, np.int64)
            ids[good] = self.base + self.made + np.arange(good.sum())
            self.made += int(good.sum())
            if known >= 0:
                ids[0] = known
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(head))))
            keep = good[of] & (chunk >= 0)
            self.found.append((chunk[keep], head[keep], tail[keep], ids[of[keep]]))
            closed = good.copy()
            if batch is not None:  # the last pair may go on
                closed[-1], last = False, slice(first[-1], None)
                known = int(ids[-1]) if good[-1] else -1
                one = lambda x: np.array([x], np.int64)
                waiting = [one(head[-1]), one(tail[-1]), one(-1), one(sums[-1])] if good[-1] else [x[last] for x in rows]
            else:
                waiting = None
            self.groups.append((head[first[closed]], tail[first[closed]], ids[closed], sums[closed]))
            self.size += int(keep.sum())
            if self.size >= _GATHER:
                yield from self._flush()
            if batch is None:
                break
        yield from self._flush()
        give_back()


def _count(batches: Iterator[pa.RecordBatch], least: int, turn: int) -> Iterator[pa.RecordBatch]:
    return _Counter(least, turn)(batches)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in zip(*[batch.column(i) for i in range(4)], strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(_unpacked(x)) for x in row], names=["head", "tail", "id", "f"])


def _packed(x: np.ndarray, steps: bool = False) -> bytes:
    """Integers, or the steps between them, in as few bytes as they need, compressed byte by byte of their significance."""
    x = np.diff(np.asarray(x, np.int64), prepend=0) if steps else np.asarray(x, np.int64)
    low, high = (int(x.min()), int(x.max())) if len(x) else (0, 0)
    size = next(n for n in (1, 2, 4, 8) if -(1 << (8 * n - 1)) <= low and high < 1 << (8 * n - 1))
    planes = x.astype(f"<i{size}").view(np.uint8).reshape(-1, size).T
    return bytes([size, steps]) + zlib.compress(planes.tobytes(), 1)


def _unpacked(raw: pa.Scalar) -> np.ndarray:
    raw = raw.as_buffer()
    size, steps = raw[0], raw[1]
    x = np.ascontiguousarray(np.frombuffer(zlib.decompress(memoryview(raw)[2:]), np.uint8).reshape(size, -1).T).view(f"<i{size}").reshape(-1).astype(np.int64)
    return np.cumsum(x) if steps else x


def _relation(chunk: int, places: np.ndarray, ids: np.ndarray) -> pa.Table:
    return pa.table({"chunk": pa.array([chunk]), "places": pa.array([_packed(places)]), "ids": pa.array([_packed(ids, True)])})


_EMPTY = pa.schema([("chunk", pa.int64()), ("places", pa.binary()), ("ids", pa.binary())]).empty_table()


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _word_relation(found: pa.Table, texts: pa.Table) -> pa.Table:
    """A chunk's occurrences of frequent words."""
    if not found.num_rows or not texts.num_rows:
        return _EMPTY
    places = _unpacked(texts.column("places")[0])
    local, ids = _column(found, "local"), _column(found, "id")
    new = np.full(max(int(local.max()), int(places.max(initial=-1))) + 2, -1, np.int64)
    new[local] = np.arange(len(local))
    return _relation(texts.column("chunk")[0].as_py(), new[places], ids)  # place -1 takes the last one, which is -1


def _longer_relation(found: pa.Table, held: pa.Table) -> pa.Table:
    """A chunk's occurrences of frequent groups that are one word longer than those of ``held``."""
    if not found.num_rows or not held.num_rows:
        return _EMPTY
    ids, places = _unpacked(held.column("ids")[0]), _unpacked(held.column("places")[0])
    order = np.argsort(ids)
    given = lambda name: np.concatenate([_unpacked(x) for x in found.column(name)])
    local = lambda name: order[np.searchsorted(ids, given(name), sorter=order)]
    code = local("heads") * len(ids) + local("tails")
    by = np.argsort(code)
    here = _joined(places, len(ids))
    at = np.minimum(np.searchsorted(code[by], here), len(code) - 1)
    return _relation(held.column("chunk")[0].as_py(), np.where(code[by][at] == here, by[at], -1), given("ids"))


def _numbered(groups: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """With a number for each row, written so that it stays."""
    return scratch.keep(groups.withColumn("id", F.monotonically_increasing_id()), label)


def frequent_phrases(docs: DataFrame, scratch: Scratch, least: int = 30, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n), and for each length the groups of words that occur ``least`` times or more in a language: id, lang, phrase,
    f, heads and tails (occurrences of its first and last 1, 2, ... words, itself included), head and tail (ids of its
    first and last words but one).

    Set-oriented mining: the relation of a length holds the occurrences of its frequent groups, sorted by text, piece and
    position, in chunks of some MB of one language. It is merge-joined with itself by piece and adjacent position; pairs
    are counted in the chunk, then sorted and counted over all chunks, where a pair has a row for each chunk at most; the
    frequent ones go back to their chunks, whose relation is semi-joined with them: the next relation. Groups are told by numbers given to their words' text, never by hashes. Relations and
    counts are tables in the shared folder.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    texts = scratch.keep(docs.select("lang", "text").mapInArrow(_encode, _TEXTS), "texts")
    words = texts.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("local", "w")).select("chunk", "lang", "local", F.col("w.words").alias("phrase"), F.col("w.counts").cast("long").alias("n"))
    total = texts.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    total = scratch.keep(total, "totals")
    frequent = _numbered(words.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least), scratch, "groups")
    none = F.lit(None).cast("long")
    frequent = frequent.select("id", "lang", "phrase", "f", F.array("f").alias("heads"), F.array("f").alias("tails"), none.alias("head"), none.alias("tail"))
    found = words.join(frequent.select("lang", "phrase", "id"), ["lang", "phrase"]).select(F.col("chunk").alias("of"), "local", "id")
    found = scratch.keep(found, "found")  # the words' shuffles go before the texts are dealt
    held = scratch.keep(found.groupBy("of").cogroup(texts.select("chunk", "places").groupBy("chunk")).applyInArrow(_word_relation, _RELATION), "relation-1")
    scratch.drop("texts")
    scratch.drop("found")
    levels = [frequent]
    for length in range(2, longest + 1):
        counted = None
        for turn in range(ROUNDS):
            pairs = held.mapInArrow(partial(_pairs, turn=turn), "head long, tail long, chunk long, n int")
            sums = pairs.repartition("head", "tail").sortWithinPartitions("head", "tail").mapInArrow(partial(_count, least=least, turn=turn), _COUNTED)
            sums = scratch.keep(sums, f"pairs-{length}")
            counted = sums if counted is None else counted.unionByName(sums)
        new = counted.where("chunk is null").select("heads", "tails", "ids", "sums").mapInArrow(_groups, "head long, tail long, id long, f long")
        side = lambda which, key: frequent.select(F.col("id").alias(which), "lang", "phrase", key) if which == "head" else frequent.select(F.col("id").alias(which), F.col("phrase").alias("last"), key)
        groups = new.join(side("head", "heads"), "head").join(side("tail", "tails"), "tail")
        last = F.substring_index("last", " ", -1)
        grown = lambda c: F.concat(F.col(c), F.array("f")).alias(c)
        frequent = scratch.keep(groups.select("id", "lang", F.concat_ws(" ", "phrase", last).alias("phrase"), "f", grown("heads"), grown("tails"), "head", "tail"), "groups")
        levels.append(frequent)
        if length < longest:
            left = counted.where("chunk is not null").select(F.col("chunk").alias("of"), "heads", "tails", "ids")
            longer = left.groupBy("of").cogroup(held.groupBy("chunk")).applyInArrow(_longer_relation, _RELATION)
            held = scratch.keep(longer, f"relation-{length}")
        scratch.drop(f"pairs-{length}")
        scratch.drop(f"relation-{length - 1}")
    return total, levels


def collocations(docs: DataFrame, least: int = 30, longest: int = LONGEST, keep: int = 2000, inside: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``keep`` best phrases of 2 to ``longest`` words.

    Texts (letters A-Z lower-cased) are cut into pieces at . , ; : ! ? and line breaks, pieces into words at spaces and
    tabs. a: the phrase's occurrences within pieces, overlaps included, ``least`` or more; l and r: those of its two parts at
    the cut with the lowest score floor(2000000 a / (l + r)), of equal ones the first; n: the language's words. A phrase
    that lies inside a longer one with ``inside`` % of its occurrences or more is left out, even if that one is.

    Null text: no words. Null lang: und. Repeated rows count as often as they come. Ties are ranked by a, then by the
    phrase's bytes. Long texts are handled whole; no words, no rows; empty table: empty result. Other columns are ignored.
    Sums and products are exact (decimals).
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    total, levels = frequent_phrases(docs, scratch, least, longest)
    rows, around = [], []
    wide = lambda c: c.cast("decimal(20,0)")
    above: DataFrame | None = None
    for length in range(longest, 1, -1):
        groups = levels[length - 1]
        cuts = []
        for k in range(1, length):
            left, right = F.get("heads", k - 1), F.get("tails", length - k - 1)
            score = F.call_function("div", wide(F.col("f")) * F.lit(2_000_000).cast("decimal(7,0)"), wide(left + right))
            cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
        cut = F.array_min(F.array(*cuts))
        best = groups.withColumn("cut", cut)
        # the most frequent candidate around each group, handed down from the longer ones to their first and last parts
        most = None
        if above is not None:
            parts = above.select(F.explode(F.array("head", "tail")).alias("id"), "most")
            most = parts.groupBy("id").agg(F.max("most").alias("around"))
        best = best.join(most, "id", "left") if most is not None else best.withColumn("around", F.lit(None).cast("long"))
        above = best.select("head", "tail", F.greatest("f", "around").alias("most"))
        clear = F.col("around").isNull() | (wide(F.col("around")) * 100 < wide(F.col("f")) * inside)
        rows.append(best.where(clear).select("lang", "phrase", F.col("f").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"), "id"))
    every = rows[0]
    for more in rows[1:]:
        every = every.unionByName(more)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    first = every.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= keep)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= keep)
    out = first.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return scratch.finish(out)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
t AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, list_aggregate(ws[i:i + k - 1], 'string_agg', ' ') AS phrase FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE k > 1),
s AS (SELECT c.lang, c.k, c.phrase, c.a, cut, x.f AS l, y.f AS r, (2000000 * c.a) // (x.f + y.f) AS score
      FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:cut], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[cut + 1:], ' ')),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM s) WHERE o = 1),
i AS (SELECT lang, phrase, max(a) AS around FROM (SELECT lang, array_to_string(ws[x:x + m - 1], ' ') AS phrase, a FROM
      (SELECT *, unnest(range(1, k - m + 2)) AS x FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k)) GROUP BY ALL),
q AS (SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE around IS NULL OR 100 * around < 80 * b.a),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM q)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score FROM z JOIN t USING (lang) WHERE rank <= 2000
"""
