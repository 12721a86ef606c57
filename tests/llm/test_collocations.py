import random
import re
from collections import Counter, defaultdict

import pytest

from gridloom.llm import collocations as C


def brute(rows, least, keep, inside=80, longest=4):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, count in f.items():
        good = {g: a for g, a in count.items() if len(g) > 1 and a >= least}
        around = Counter()
        for g, a in good.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    around[g[i : i + m]] = max(around[g[i : i + m]], a)
        found = []
        for g, a in good.items():
            score, _, l, r = min((2_000_000 * a // (count[g[:k]] + count[g[k:]]), k, count[g[:k]], count[g[k:]]) for k in range(1, len(g)))
            if 100 * around[g] < inside * a:
                found.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:keep], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def got(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


def texts(seed, n, words="ab Ab c d é the of x-1  y".split(" ")):
    r = random.Random(seed)
    ends = [" ", "  ", "\t", ". ", ",", "\n", "\r\n", " ; ", "\x0b"]
    weights = [12, 1, 1, 1, 1, 1, 1, 1, 1]
    for _ in range(n):
        yield r.choice(["en", "en", "en", "de", None]), "".join(r.choice(words) + r.choices(ends, weights)[0] for _ in range(r.randint(0, 60)))


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    rows = list(texts(seed, 80))
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert got(C.collocations(df, least=6, keep=25)) == brute(rows, 6, 25) != []


def test_chunks_do_not_change_the_result(spark, monkeypatch):
    rows = list(texts(7, 120)) + [("en", "ab c d the " * 500), ("en", None), (None, ""), ("de", " \t.,\n")]
    df = spark.createDataFrame(rows, "lang string, text string")
    want = brute(rows, 8, 40)
    assert got(C.collocations(df.coalesce(1), least=8, keep=40)) == want
    assert got(C.collocations(df.repartition(16), least=8, keep=40)) == want


def test_places_are_chunked_by_size(monkeypatch):
    import pyarrow as pa

    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 5

    monkeypatch.setattr(C, "TaskContext", Task)
    monkeypatch.setattr(C, "CHUNK_BYTES", 50)
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de", None] * 40), pa.array(["a b. A c"] * 120)], names=["lang", "text"])
    chunks = [b.to_pylist()[0] for b in C._encode(iter([batch, batch]))]
    assert sum(sum(c["counts"]) for c in chunks) == 4 * 240 and {c["lang"] for c in chunks} == {"en", "de", "und"}
    assert len({c["chunk"] for c in chunks}) == len(chunks) > 3


def test_packed_numbers():
    import numpy as np
    import pyarrow as pa

    for x in ([], [0], [-1, 127], [-1, 128, 3], [2**40, 5, -7], [1 << 60 | 5 << 33, (1 << 60 | 5 << 33) + 1]):
        for steps in (False, True):
            assert C._unpacked(pa.scalar(C._packed(np.array(x, np.int64), steps), pa.binary())).tolist() == x


def test_empty_table_repeated_rows_and_clashing_names(spark):
    assert C.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert C.collocations(spark.createDataFrame([(None, None)], "lang string, text string")).count() == 0
    rows = [("en", "Big apple pie")] * 31 + [("en", "apple tart")] * 40
    wide = spark.createDataFrame([(*r, 1, "z", 2.0) for r in rows], "lang string, text string, n int, phrase string, score double")
    assert got(C.collocations(wide)) == brute(rows, 30, 2000)
    # "big apple" and "apple pie" lie in "big apple pie" with all their occurrences
    assert [r[2] for r in got(C.collocations(wide))] == ["apple tart", "big apple pie"] or [r[2] for r in got(C.collocations(wide))] == ["big apple pie", "apple tart"]


def test_products_beyond_64_bits_are_exact(spark):
    from pyspark.sql import functions as F

    big = spark.range(1).select(F.lit(9 * 10**15).alias("f"))
    score = big.select(F.call_function("div", F.col("f").cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(7,0)"), (F.col("f") + F.col("f") + 1).cast("decimal(20,0)")).alias("s")).first()["s"]
    assert score == 2_000_000 * 9 * 10**15 // (18 * 10**15 + 1)
