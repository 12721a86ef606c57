"""Language identification that fuses text likelihoods, declared language, address suffix and host priors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm._shared import bound_batches, free, materialize, text_chunks
from gridloom.llm._text import Words, buffer

#: Hashed byte trigrams of a language model, and languages that a task counts at once (128 KB each).
TRIGRAMS, COUNTED = 1 << 14, 128
#: A text is in a language if its mean log likelihood of a trigram is at most so far below the expected one, and so many
#: standard errors for its length. For a model of few rows, half the way to trigrams it hasn't seen counts, if that is less.
MARGIN, ERRORS = 1.6, 3.0
#: Overlapping trigrams are no independent evidence: their log likelihoods count by this much.
TEMPER = 0.2
#: Chances that a declared language, or one that the address tells, is the text's.
DECLARED, ADDRESS = 0.85, 0.7
#: Pages' worth of the domain's (or of all) languages in a host's (or a domain's) prior.
SMOOTH = 8.0
#: Second labels under which a country registers names, so that a domain has three labels (fixed values).
SECOND = ("ac", "co", "com", "edu", "go", "gob", "gov", "gouv", "ne", "net", "nom", "or", "org")
#: Country suffixes that tell a language (fixed values).
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en", "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl", "ru": "ru", "jp": "ja"}


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code of each trigram of bytes (ASCII letters in lower case, digits and signs alike) and its text; -1 where there is none."""
    data, off = buffer(column)
    table = np.arange(256, dtype=np.uint32)
    table[65:91] += 32
    plain = np.ones(256, bool)
    plain[97:123] = plain[65:91] = plain[128:] = False
    table[plain] = 32
    b = table[data]
    code = np.full(len(b), -1, np.int64)
    if len(b) > 2:
        joined = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
        joined = (joined ^ (joined >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        code[:-2] = ((joined >> np.uint32(8)) % np.uint32(TRIGRAMS)).astype(np.int64)
        blank = b == 32
        code[:-2][blank[:-2] & blank[1:-1] | blank[1:-1] & blank[2:]] = -1
        ends = off[1:][off[1:] > off[:-1]]
        code[np.maximum(ends - 1, 0)] = -1
        code[np.maximum(ends - 2, 0)] = -1
    return code, off


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's trigrams by language."""
    held: dict[str, np.ndarray] = {}

    def told() -> pa.RecordBatch:
        kinds, table = list(held), np.concatenate(list(held.values()))
        some = np.flatnonzero(table)
        return pa.RecordBatch.from_arrays([pa.array([kinds[i] for i in some // TRIGRAMS], pa.string()), pa.array((some % TRIGRAMS).astype(np.int32)), pa.array(table[some])], names=["lang", "code", "n"])

    for batch in text_chunks(batches, "text"):
        code, off = _codes(batch.column(0))
        names = np.array(batch.column(1).to_pylist(), object)
        home = np.repeat(np.arange(len(names)), np.diff(off))[code >= 0]
        code = code[code >= 0]
        kinds, own = np.unique(names.astype(str), return_inverse=True)
        lang = own[home]
        for i, kind in enumerate(kinds.tolist()):
            if kind not in held and len(held) >= COUNTED:
                yield told()
                held.clear()
            held.setdefault(kind, np.zeros(TRIGRAMS, np.int64))
            held[kind] += np.bincount(code[lang == i], minlength=TRIGRAMS)
    if held:
        yield told()


def code_of(declared: Column) -> Column:
    """A declared language's first subtag in lower case; null where there is none."""
    return F.nullif(F.lower(F.split(F.trim(declared), "[-_]")[0]), F.lit(""))


def fit(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """All labelled languages and their trigram log likelihoods, from all rows of ``labelled`` (text, lang). As much probability
    as trigrams seen once have goes to those not seen."""
    bound_batches(labelled.sparkSession)
    labelled = labelled.select("text", code_of(F.col("lang")).alias("lang")).where("text is not null and lang is not null")
    counts = labelled.mapInArrow(_counted, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "language-counts").toArrow()  # at most languages x TRIGRAMS rows
    names = sorted(pc.unique(counts["lang"]).to_pylist())
    table = np.zeros((len(names), TRIGRAMS))
    table[pc.index_in(counts["lang"], pa.array(names, pa.string())).to_numpy(), counts["code"].to_numpy()] = counts["n"].to_numpy()
    total, new = table.sum(1, keepdims=True), np.maximum(1, (table == 0).sum(1, keepdims=True))
    unseen = np.clip(((table == 1).sum(1, keepdims=True) + 1) / (total + 1), 0.01, 0.9)
    return names, np.log(np.where(table > 0, (1 - unseen) * table / total, unseen / new)).astype(np.float32)


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in text_chunks(batches, "text"):
            at = batch.schema.get_field_index("text")
            code, off = _codes(batch.column(at))
            good = code >= 0
            edge = np.concatenate([[0], np.cumsum(good)])[off]
            code, n = code[good], np.diff(edge)
            sums = np.zeros((len(table), len(n)))
            full = np.flatnonzero(n)
            if len(full):
                for i, row in enumerate(table):
                    sums[i, full] = np.add.reduceat(row[code].astype(np.float64), edge[:-1][full])
            words = Words(batch.column(at)).counts
            cols = [batch.column(i) for i in range(batch.num_columns) if i != at]
            lists = pa.FixedSizeListArray.from_arrays(pa.array(sums.T.reshape(-1)), len(table)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*cols, lists, pa.array(n.astype(np.int64)), pa.array(words.astype(np.int64))], names=[*(x for x in batch.schema.names if x != "text"), "ll", "trigrams", "words"])

    return run


def _normal(logs: Column) -> Column:
    """Probabilities of an array of logs."""
    top = F.array_max(logs)
    exps = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(exps, lambda x: x / F.aggregate(exps, F.lit(0.0), lambda a, b: a + b))


def identify(rows: DataFrame, key: list[str], names: list[str], table: np.ndarray) -> DataFrame:
    """key columns, lang, posterior, text_lang, rejected for each row of ``rows`` (key columns, text, declared, url, host).

    Languages' log odds add up: the text's trigrams, the declared language, the language that the address' suffix or
    path tells, and the host's prior. Priors are shares of languages over a host's rows, smoothed by those of its domain,
    which are smoothed by those of all rows; the rows' own posteriors without priors are summed by grouped aggregation.
    A row's own posterior is taken out of its host's and domain's sums, so that no evidence counts twice.
    A row is rejected, with lang und, where text has no letters in a row of three, no language reaches one half, or the
    text is too unlikely under its language for one of the model's. Null or empty text, url, host or declared language are no evidence; rows without host share one. Languages that the
    model doesn't know are no evidence. Without any fitted language all rows are rejected.
    """
    n = len(names)
    host = F.lower(F.coalesce(F.col("host"), F.expr("try_parse_url(url, 'HOST')"), F.lit("")))
    tail = F.split(host, r"\.")
    deep = F.coalesce((F.length(F.element_at(tail, -1)) == 2) & F.try_element_at(tail, F.lit(-2)).isin(*SECOND), F.lit(False))
    parts = F.when(deep, 3).otherwise(2)
    domain = F.array_join(F.slice(tail, F.greatest(F.size(tail) - parts + 1, F.lit(1)), parts), ".")
    told = F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair])
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^\w+://[^/]*/([a-z]{2,3})(?:[/?#]|$)", 1)
    address = F.when(path.isin(names or [""]), path).otherwise(F.try_element_at(told, F.element_at(tail, -1)))
    if not n:
        return rows.select(*key, F.lit("und").alias("lang"), F.lit(0.0).alias("posterior"), F.lit("und").alias("text_lang"), F.lit(True).alias("rejected"))
    shared = rows.sparkSession.sparkContext.broadcast(table)  # languages x TRIGRAMS numbers
    # key columns get names of their own meanwhile, so that they may be called as they like
    named = {c: f"_key{i}" for i, c in enumerate(key)}
    keys = ", ".join(f"`{named[f.name]}` {f.dataType.simpleString()}" for f in rows.select(*key).schema.fields)
    wanted = [*[F.col(c).alias(x) for c, x in named.items()], host.alias("host"), domain.alias("domain"), code_of(F.col("declared")).alias("declared"), address.alias("address"), "text"]
    scored = rows.select(*wanted).mapInArrow(_scored(shared), f"{keys}, host string, domain string, declared string, address string, ll array<double>, trigrams long, words long")
    key, back = list(named.values()), [F.col(x).alias(c) for c, x in named.items()]
    lang = F.array(*map(F.lit, names))

    def witness(column: str, trust: float, i: Column) -> Column:
        at = F.col(f"{column}_at")
        return F.when(at == 0, F.lit(0.0)).when(at == i + 1, F.lit(float(np.log(trust)))).otherwise(F.lit(float(np.log((1 - trust) / max(1, n - 1)))))

    for column in ("declared", "address"):
        scored = scored.withColumn(f"{column}_at", F.coalesce(F.array_position(lang, F.col(column)), F.lit(0)))
    own = F.transform("ll", lambda x, i: x * TEMPER + witness("declared", DECLARED, i) + witness("address", ADDRESS, i))
    scored = scored.withColumn("own", own).withColumn("share", _normal(F.col("own")))
    text_best = F.get(lang, (F.array_position("ll", F.array_max("ll")) - 1).cast("int"))
    scored = scored.select(*key, "host", "domain", "own", "share", F.when(F.col("trigrams") > 0, text_best).otherwise("und").alias("text_lang"), "ll", "trigrams")
    scored = materialize(scored, "language-scores")
    sums = [F.sum(F.get("share", F.lit(i))).alias(f"s{i}") for i in range(n)]
    hosts = materialize(scored.groupBy("host", "domain").agg(*sums), "language-hosts")
    again = [F.sum(f"s{i}").alias(f"s{i}") for i in range(n)]
    domains = hosts.groupBy("domain").agg(*again)
    total = hosts.agg(*again).first()
    whole = [float(x or 0.0) + 1.0 for x in total]
    whole = [x / sum(whole) for x in whole]

    def smoothed(sums: Column, under: Column) -> Column:
        """Shares of languages over the other rows, from sums of which the row's own share is taken out."""
        others = F.zip_with(sums, "share", lambda x, own: F.greatest(x - own, F.lit(0.0)))
        every = F.aggregate(others, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(others, under, lambda x, u: (x + SMOOTH * u) / (every + SMOOTH))

    both = lambda df: F.array(*[f"s{i}" for i in range(n)])
    domains = domains.select("domain", both(domains).alias("in_domain"))
    sums_of = materialize(hosts.select("host", "domain", both(hosts).alias("in_host")).join(domains, "domain").drop("domain"), "language-priors")
    out = scored.join(sums_of, "host").withColumn("over", smoothed(F.col("in_domain"), F.array(*map(F.lit, whole))))
    out = out.withColumn("prior", smoothed(F.col("in_host"), F.col("over")))
    post = _normal(F.zip_with("own", "prior", lambda x, p: x + F.log(p)))
    out = out.withColumn("post", post).withColumn("posterior", F.array_max("post"))
    p, t = np.exp(table.astype(np.float64)), table.astype(np.float64)
    mean = (p * t).sum(1)
    spread = np.sqrt(np.maximum(0.0, (p * t * t).sum(1) - mean * mean))
    floor = mean - np.minimum(MARGIN, (mean - t.min(1)) / 2)
    at = (F.array_position("post", F.col("posterior")) - 1).cast("int")
    of = lambda values: F.get(F.array(*[F.lit(float(x)) for x in values]), at)
    strange = F.get("ll", at) / F.col("trigrams") < of(floor) - ERRORS * of(spread) / F.sqrt("trigrams")
    rejected = (F.col("trigrams") == 0) | (F.col("posterior") < 0.5) | F.coalesce(strange, F.lit(False))
    best = F.get(lang, at)
    return out.select(*back, F.when(rejected, "und").otherwise(best).alias("lang"), F.round("posterior", 6).alias("posterior"), "text_lang", rejected.alias("rejected"))


def page_rows(pages: DataFrame) -> DataFrame:
    """page_id, text, declared, url, host of html pages: tags, scripts, styles and comments are no text."""
    html = F.coalesce("html", F.lit(""))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&\w{1,8};", " ")
    declared = F.nullif(F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]+(?:[-_]\w+)*)""", 1), F.lit(""))
    return pages.select("page_id", text.alias("text"), declared.alias("declared"), "url", F.lit(None).cast("string").alias("host"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, source, ...) that aren't rejected, all columns as they were.

    The model is fitted on declared languages; lang is the declared one and source stands for the host.
    """
    names, table = fit(docs)
    key = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text", F.col("lang").alias("declared"), F.lit(None).cast("string").alias("url"), F.col("source").alias("host"))
    found = identify(key, ["doc_id", "text_key"], names, table).where("rejected").select("doc_id", "text_key").distinct()
    a, b = free(docs, "_gone"), free(docs, "_gone_text")
    gone = materialize(found, "language-rejected").withColumnsRenamed({"doc_id": a, "text_key": b})
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(a)) & (F.xxhash64("text") == F.col(b)), "left_anti")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages; the trigram models come from the pages' texts and declared languages."""
    pages = page_rows(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    names, table = fit(pages.select("text", F.col("declared").alias("lang")))
    return identify(pages, ["page_id"], names, table)
