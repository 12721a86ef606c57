"""Every operator and stage on nulls, empty and very long texts, repeated rows, empty tables and columns of clashing names."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridloom.llm import language, maxscore, mixing, ngram_join, order_minhash, pieces, secrets_scan, substring_dedup, surrogates, warc

BASE = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, for columns of the caller's.
CLASH = ["_row", "_copies", "_key0", "_k0", "_part", "_salt", "_pii_text", "_gone", "_range", "key", "comp", "component_id", "id", "n", "size", "copies", "taken", "rank", "bucket", "next", "sig", "path", "host", "domain", "url", "declared", "own", "rejected", "findings", "n_candidates", "clean", "ids", "n_ids", "print", "windows", "entity", "mention"]
SECRET = "AKIA" + "Q7" * 8


@pytest.fixture(scope="module")
def odd(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 8)))
    long = " ".join(word() for _ in range(30_000))
    prose = [" ".join(word() for _ in range(r.randint(30, 80))) for _ in range(12)]
    texts = [None, "", " \t\n", "x", long, long + f" mail ann@example.com or Mr Stone; secret_key={SECRET}", "y" * 200_000, "é" * 40_000, "日本語 " * 9_000, *prose, prose[0], prose[1]]
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[9], rows[9], (None, prose[2], "en", "a", 0), (None, prose[2], "en", "a", 0), (3, prose[3], None, None, None), (None,) * 5, (None,) * 5]
    return spark.createDataFrame(rows, BASE).repartition(3)


@pytest.fixture(scope="module")
def model(odd):
    return secrets_scan.fit(odd)


def _clashing(df):
    return df.select("*", *[F.lit("theirs").alias(c) for c in CLASH])


def _sorted(df):
    return sorted(map(repr, map(tuple, df.collect())))


def _operators(model):
    return {
        "surrogates": lambda d: surrogates.replace_entities(d, "k").select("doc_id", "text"),
        "jaccard": lambda d: ngram_join.jaccard_components(d).select("doc_id", "n_shingles", "component_id"),
        "language": lambda d: language.keep_identified(d).select("doc_id", "text", "lang", "source"),
        "secrets": lambda d: secrets_scan.scan(d, model, ["doc_id"]),
        "masked": lambda d: secrets_scan.mask_secrets(d).select("doc_id", "text", "n_chars"),
        "fingerprints": order_minhash.fingerprints,
        "substrings": substring_dedup.remove_repeats,
        "mixing": lambda d: mixing.mix_sources(d).drop("copies"),
        "pieces": pieces.encode,
    }


@pytest.mark.parametrize("name", ["surrogates", "jaccard", "language", "secrets", "masked", "fingerprints", "substrings", "mixing", "pieces"])
def test_odd_rows(odd, model, name):
    operator = _operators(model)[name]
    plain = operator(odd)
    rows = _sorted(plain)
    assert name == "language" or len(rows) == odd.count()
    assert rows == _sorted(operator(_clashing(odd).repartition(5)))
    none = operator(_clashing(odd).limit(0))
    assert none.count() == 0 and none.columns == plain.columns


def test_odd_rows_mean_what_is_stated(odd, model):
    out = surrogates.replace_entities(odd, "k").where("doc_id = 5").collect()
    assert len(out) == 2 and len({r["text"] for r in out}) == 1 and not re.search("ann@|Stone", out[0]["text"])
    hidden = secrets_scan.scan(odd, model, ["doc_id"]).where("doc_id = 5").collect()
    assert len(hidden) == 2 and all(SECRET not in r["clean"] and r["clean"].endswith("secret_key=[SECRET]") for r in hidden)
    kept = language.keep_identified(odd)
    assert kept.where("text is null or trim(text) = ''").count() == 0
    coded = pieces.encode(odd)
    assert coded.where("not exact").count() == 0 and coded.where("doc_id = 0").first()["n_ids"] == 0


def test_repeated_and_odd_pages(spark, tmp_path):
    rows = [(1, "http://a.de/", "<p>x y z</p>" * 40_000, 0), (1, "http://a.de/", "<p>x y z</p>" * 40_000, 0), (2, None, None, 1), (3, "::", "", 2), (None, None, None, 3), (4, "http://b/ c\x00", "<p>x y z</p>" * 40_000, 4), (4, None, "other", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type int").withColumns({c: F.lit("theirs") for c in ("payload", "sha1", "bytes", "refers_to", "host", "text", "declared")})
    got = warc.page_archive(pages, str(tmp_path / "w")).collect()
    assert Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got) == {(1, "response", None): 2, (2, "response", None): 1, (3, "revisit", 2): 1, (None, "revisit", 2): 1, (4, "revisit", 1): 1, (4, "response", None): 1}
    names, table = language.fit(language.page_rows(pages).select("text", F.col("declared").alias("lang")))
    assert language.identify(language.page_rows(pages), ["page_id"], names, table).count() == len(rows)


def test_vectors_with_ties_and_clashing_names(spark):
    rows = [(i, [1.0, 0.0] if i % 2 else [0.5, 0.5], 0, 0, 0, 0) for i in range(101)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, shard int, asks int, query_id int, rank int")
    got = maxscore.top_k(df).collect()
    assert {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 50, 100)} == {q: [x for x in range(7) if x != q][:5] for q in (0, 50, 100)}


def test_stages_on_odd_rows(spark, odd):
    import corpus_pipeline as c

    theirs = _clashing(odd)
    for _, stage in c.STAGES[:-1]:
        out = stage(spark, theirs, "")
        assert out.columns == theirs.columns
        rows = out.collect()
        assert all(r[x] == "theirs" for r in rows for x in CLASH)
        if stage is c.drop_near_duplicates:
            one = rows
        assert stage(spark, theirs.limit(0), "").count() == 0
        assert sorted(repr(tuple(r[x] for x in odd.columns)) for r in rows) == _sorted(stage(spark, odd, ""))
    # of repeated rows one stays, rows without words all do
    assert sum(r["doc_id"] == 9 for r in one) == 1 and sum(r["doc_id"] is None and r["text"] is None for r in one) == 2
    assert c.encode(spark, theirs.limit(0), "").count() == 0


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _mixed(rows):
    """Rows as often as the mix takes them, by the definition: source by source, document by document."""
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    order = sorted(by, key=lambda s: (s is None, s))
    total, weight, size = {}, {}, lambda r: len(_words(r["text"]))
    for i, s in enumerate(order):
        total[s], weight[s] = sum(map(size, by[s])), (5, 2, 1)[i % 3]
    left, live, target = sum(total.values()), list(order), {}
    while live:
        heavy = sum(weight[s] for s in live)
        capped = [s for s in live if left * weight[s] / heavy > 3 * total[s]]
        for s in capped or live:
            target[s] = 3 * total[s] if capped else left * weight[s] / heavy
        left -= sum(target[s] for s in capped)
        live = [s for s in live if s not in target]
    out = []
    for s in order:
        whole = int(target[s] // total[s]) if total[s] else 0
        rest, at = target[s] - whole * total[s], 0
        ranked = []
        for r in by[s]:
            out += [r] * whole
            u = (int(hashlib.md5(f"8:{r['doc_id']}".encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)
            if rest > 0 and size(r):
                ranked.append((u / (1 - u) / (rest / (total[s] - rest) * size(r) * len(by[s]) / total[s]), r["doc_id"], r))
        for _, _, r in sorted(ranked, key=lambda x: x[:2]):
            if rest > at and at + size(r) - rest <= rest - at:
                out.append(r)
            at += size(r)
    return out


def test_the_pipeline_is_that_of_brute_force(spark):
    """The fitted models are taken as given; what the stages do with them is done anew, row by row."""
    import pyarrow as pa
    import sentencepiece

    import corpus_pipeline as c
    from tests.llm.test_operators import _brute_components

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, table = language.fit(docs)
    rows = [r.asDict() for r in docs.collect()]
    # language ID: documents whose trigrams fit no known language go
    import numpy as np

    norm = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    n, own, share, ll, count = len(names), [], [], [], []
    for r in rows:
        code, _ = language._codes(pa.array([r["text"]], pa.string()))
        code = code[code >= 0]
        ll.append(table[:, code].astype(np.float64).sum(1))
        count.append(len(code))
        said = (r["lang"] or "").lower().split("-")[0]
        known = said in names
        own.append(ll[-1] * language.TEMPER + (np.array([math.log(language.DECLARED if x == said else (1 - language.DECLARED) / (n - 1)) for x in names]) if known else 0))
        share.append(norm(own[-1]))
    of = defaultdict(lambda: np.zeros(n))
    for r, s in zip(rows, share, strict=True):
        of[r["source"]] = of[r["source"]] + s
    whole = sum(share) + 1.0
    smooth = lambda s, u: (s + language.SMOOTH * u) / (s.sum() + language.SMOOTH)
    p = np.exp(table.astype(np.float64))
    mean, spread = (p * np.log(p)).sum(1), np.sqrt((p * np.log(p) ** 2).sum(1) - (p * np.log(p)).sum(1) ** 2)
    kept = []
    for i, r in enumerate(rows):
        rest = of[r["source"]] - share[i]  # a source is its own domain
        post = norm(own[i] + np.log(smooth(rest, smooth(rest, whole / whole.sum()))))
        best = int(post.argmax())
        floor = mean[best] - min(language.MARGIN, (mean[best] - np.log(p[best]).min()) / 2)
        if count[i] and post[best] >= 0.5 and ll[i][best] / count[i] >= floor - language.ERRORS * spread[best] / math.sqrt(count[i]):
            kept.append(r)
    assert 0.95 * len(rows) <= len(kept)
    # near duplicates: one of each group
    kept = [r for r, (d, _, low) in zip(kept, _brute_components([(r["doc_id"], r["text"]) for r in kept], 5, 80), strict=True) if d == low]
    # secrets: outermost accepted candidates of each text on its own
    model = secrets_scan.fit(spark.createDataFrame(kept, docs.schema))
    for r in kept:
        raw, end, out = (r["text"] or "").encode(), 0, b""
        for _, s, e, assigned, _ in secrets_scan._each(pa.RecordBatch.from_arrays([pa.array([r["text"]], pa.string())], names=["text"]), 0):
            if s >= end and model.score(secrets_scan.features(*secrets_scan._context(raw, s, e), assigned, r["source"] or "", model.words, model.pairs)) >= 0.5:
                out, end = out + raw[end:s] + b"[SECRET]", e
        r["text"] = r["text"] and (out + raw[end:]).decode()
    coder = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    want = Counter((r["doc_id"], tuple(coder.encode(r["text"] or "")), hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in _mixed(kept))
    got = Counter((r["doc_id"], tuple(r["ids"]), r["decoded_sha256"]) for r in c.run(spark, sf).collect())
    assert got == want


def test_the_pipeline_on_an_empty_table(spark, odd, tmp_path):
    import corpus_pipeline as c

    odd.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert c.run(spark, str(tmp_path)).count() == 0
