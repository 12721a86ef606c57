"""Secret scanning: candidates by form, false positives removed by a random forest."""

from __future__ import annotations

import math
import random
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm._shared import bound_batches, materialize, text_chunks
from gridloom.llm._text import buffer

#: Words of the dictionary, the most frequent ones; trees and their depth.
DICTIONARY, TREES, DEPTH = 20_000, 15, 6
#: Share of the fit's weight that the seed's findings have at least, however many others there are.
SEED_SHARE = 0.03
#: Bins of the forest, far more than STEPS has: from the square of it on Spark takes a sample of rows for its splits.
MAX_BINS = 4096
#: Shortest run of token characters with a digit that is a candidate, and shortest assigned value.
RUN, VALUE = 16, 8
_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_-"]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_NAMED = re.compile(rb"(?i)(?:pass(?:word|wd)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth(?:orization)?|bearer|credential|private[_-]?key)[\w-]{0,16}[\"']?\s{0,3}$")
_ASSIGNED = re.compile(rb"[=:]\s{0,3}[\"']?([^\s\"',;<>(){}]{8,})")
#: Published forms of credentials (fixed values).
_FORMS = re.compile(r"AKIA[0-9A-Z]{16}$|ASIA[0-9A-Z]{16}$|gh[pousr]_\w{36,}$|xox[abprs]-[\w-]{10,}$|sk_live_\w{16,}$|AIza[\w-]{35}$|glpat-[\w-]{20,}$|eyJ[\w-]{10,}$")
#: Where one starts in a run of token characters (to its end); the shortest has 13.
_PUBLISHED = re.compile(rb"(?<![0-9A-Za-z])(?:" + _FORMS.pattern.encode() + rb")")
_SHORTEST_FORM = 13
FEATURES = ("length", "entropy", "digits", "upper", "hex", "switches", "transition", "dictionary", "published form", "assigned", "credential word before", "quoted", "code path", "plain words around")


_PARTS = [i / 32 for i in range(33)]
#: Where the forest may split each feature: fixed steps, so that they depend on no sample.
STEPS = (
    [*range(8, 41), 48, 56, 64, 80, 96, 128, 192, 256, 512, 1024], [i / 8 for i in range(56)], _PARTS, _PARTS, [0.0], _PARTS, [-9 + i / 8 for i in range(65)],
    _PARTS, [0.0], [0.0], [0.0], [0.0], [0.0], _PARTS,
)


def candidates(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, int, bool]]:
    """Text, start, end (bytes in the text) and whether a credential word is assigned the value, in text order, longer ones first.

    Assigned values end at their delimiter. What lies in one is a candidate too, to be looked at when the whole is
    none: runs, and the parts of the value between further assignments, as in ``secret=..&token=..``."""
    token = _TOKEN[data]
    begin, end = token.copy(), token.copy()
    begin[1:] &= ~token[:-1]
    end[:-1] &= ~token[1:]
    full = off[1:] > off[:-1]
    begin[off[:-1][full]] = token[off[:-1][full]]
    end[off[1:][full] - 1] = token[off[1:][full] - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    digits = np.zeros(len(data) + 1, np.int32)
    np.cumsum(_DIGIT[data], out=digits[1:])
    keep = (ends - starts >= RUN) & (digits[ends] > digits[starts])
    found = dict.fromkeys(zip(starts[keep].tolist(), ends[keep].tolist(), strict=True), False)
    whole = data.tobytes()
    other = ~keep & (ends - starts >= _SHORTEST_FORM)
    for s, e in zip(starts[other].tolist(), ends[other].tolist(), strict=True):
        if m := _PUBLISHED.search(whole[s:e]):
            found[s + m.start(), e] = False
    signs = np.flatnonzero((data == 61) | (data == 58))
    home = np.searchsorted(off, signs, "right") - 1
    value, part = (0, 0), 0  # the last assigned value, and where its last part starts
    for s, t in zip(signs.tolist(), home.tolist(), strict=True):
        low, high = int(off[t]), int(off[t + 1])
        named = _NAMED.search(whole[max(low, s - 48) : s])
        if not named:
            continue
        if value[0] <= s < value[1] - 1:
            close = max(low, s - 48) + named.start()
            while close > part and not token[close - 1]:
                close -= 1
            if part > value[0]:
                found.pop((part, value[1]), None)
            if close - part >= VALUE:
                found[part, close] = True
            part = s + 1
            if value[1] - part >= VALUE:
                found[part, value[1]] = True
        elif m := _ASSIGNED.match(whole, s, high):
            value, part = m.span(1), m.start(1)
            found[value] = True
    for s, e in sorted(found, key=lambda x: (x[0], -x[1])):
        t = int(np.searchsorted(off, s, "right")) - 1
        yield t, s - int(off[t]), e - int(off[t]), found[s, e]


def features(value: str, before: str, after: str, assigned: bool, path: str, words: frozenset[str], pairs: dict[str, float]) -> list[float]:
    """FEATURES of a candidate with the text around it; ``pairs`` has log chances of two letters in ordinary words."""
    n = max(1, len(value))
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kind = lambda c: 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3
    low = value.lower()
    steps = [pairs.get(low[i : i + 2], -9.0) for i in range(n - 1)] or [-9.0]
    parts = [w for w in re.split(r"[^a-z]+", low) if w]
    near = re.findall(r"[^\W\d_]+", f"{before[-40:]} {after[:40]}".lower())
    return [
        float(n), entropy, sum(c.isdigit() for c in value) / n, sum(c.isupper() for c in value) / n, float(bool(re.fullmatch(r"[0-9a-fA-F]+", value))), sum(kind(a) != kind(b) for a, b in zip(value, value[1:], strict=False)) / n,
        sum(steps) / len(steps), sum(len(w) for w in parts if w in words and len(w) > 2) / n, float(bool(_FORMS.match(value))), float(assigned), float(bool(_NAMED.search(before[-48:].encode()[:-1] if before.endswith(("'", '"')) else before[-48:].encode()))),
        float(before[-1:] in ("'", '"')), float(bool(re.search(r"\.(?:py|js|ts|java|go|rb|ya?ml|json|env|conf|ini|sh)\b|config|\.git", path or ""))), sum(w in words for w in near) / max(1, len(near)),
    ]


def seed_findings(seed: int = 4, each: int = 60) -> list[tuple[str, str, str, bool, str, int]]:
    """Labelled findings of known kinds, drawn at random: value, before, after, assigned, path, label."""
    r = random.Random(seed)
    pick = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    mixed, upper, hexed = string.ascii_letters + string.digits, string.ascii_uppercase + string.digits, "0123456789abcdef"
    out = []
    for _ in range(each):
        quote = r.choice(['"', "'", ""])
        name = r.choice(["token", "password", "secret", "api_key"])
        out += [
            ("AKIA" + pick(upper, 16), "uses ", " here", False, "", 1), ("ghp_" + pick(mixed, 36), "with ", "", False, "a.sh", 1),
            (pick(hexed, r.choice([18, 32, 40])), f"{name} = {quote}", quote, True, "", 1), (pick(mixed, r.randint(12, 40)), f"{name}={quote}", quote, True, "config.yml", 1),
            (pick("0123456789", 16), "paid with ", " on", False, "", 0), (pick(hexed, 8) + "-" + "-".join(pick(hexed, 4) for _ in range(3)) + "-" + pick(hexed, 12), "id ", " of", False, "", 0),
            ("-".join(pick(string.ascii_lowercase, r.randint(3, 8)) for _ in range(3)) + f"-{r.randint(1, 99)}", "see ", " for", False, "", 0), (f"release_{r.randint(2000, 2030)}_{r.randint(1, 12)}_notes", "the ", " say", False, "", 0),
            (pick(string.ascii_lowercase, r.randint(8, 14)), f"{name}: ", " of the", True, "", 0), (pick(hexed, 40), "commit ", " fixes", False, "", 0),
        ]
    return out


def _label(value: str, assigned: bool) -> int:
    """Weak label of a finding in documents: a published form, or a value with digits assigned to a credential's name."""
    return int(bool(_FORMS.match(value)) or (assigned and any(c.isdigit() for c in value) and len(set(value)) >= 6))


def _context(raw: bytes, start: int, end: int) -> tuple[str, str, str]:
    cut = lambda b: b.decode("utf-8", "ignore")
    return cut(raw[start:end]), cut(raw[max(0, start - 64) : start]), cut(raw[end : end + 64])


def _each(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, int, int, bool, bytes]]:
    data, off = buffer(batch.column(at))
    now, raw = -1, b""
    for t, s, e, assigned in candidates(data, off):
        if t != now:
            now, raw = t, data[off[t] : off[t + 1]].tobytes()
        yield t, s, e, assigned, raw


def _outer(found: Iterator[tuple[int, int, int, bool, bytes]]) -> Iterator[tuple[int, int, int, bool, bytes]]:
    """Without what lies in another candidate."""
    now, last = -1, 0
    for x in found:
        if x[0] != now or x[1] >= last:
            now, last = x[0], x[2]
            yield x


def stepped(x: list[float]) -> list[int]:
    """How many of its STEPS each feature exceeds."""
    return [bisect_left(steps, v) for steps, v in zip(STEPS, x, strict=True)]


_BINNED = [f"f{i}" for i in range(len(FEATURES))]


def _found(shared):
    """The features of each candidate in steps, and its weak label; equal ones of a chunk are counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, logs = shared.value
        for batch in text_chunks(batches, "text"):
            count: Counter[tuple[int, ...]] = Counter()
            for t, s, e, assigned, raw in _outer(_each(batch, 0)):
                value, before, after = _context(raw, s, e)
                count[*stepped(features(value, before, after, assigned, batch.column(1)[t].as_py() or "", words, logs)), _label(value, assigned)] += 1
            cols = list(zip(*count, strict=True)) or [()] * (len(FEATURES) + 1)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in cols), pa.array(count.values(), pa.int64())], names=[*_BINNED, "label", "n"])

    return run


def _given(shared):
    """The same of labelled findings (value, before, after, assigned, path, label)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, logs = shared.value
        for batch in batches:
            rows = [(*stepped(features(r["value"] or "", r["before"] or "", r["after"] or "", bool(r["assigned"]), r["path"] or "", words, logs)), r["label"]) for r in batch.to_pylist()]
            cols = list(zip(*rows, strict=True)) or [()] * (len(FEATURES) + 1)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in cols), pa.array([1] * len(rows), pa.int64())], names=[*_BINNED, "label", "n"])

    return run


class Model:
    """Trees as nested tuples (feature, threshold, left, right) or leaves 0/1, and the dictionary's words and letter pairs."""

    def __init__(self, trees: list, words: frozenset[str], pairs: dict[str, float]) -> None:
        self.trees, self.words, self.pairs = trees, words, pairs

    def score(self, x: list[float]) -> float:
        votes = 0
        for node in self.trees:
            while isinstance(node, tuple):
                node = node[2] if x[node[0]] <= node[1] else node[3]
            votes += node
        return votes / len(self.trees)


def _tree(lines: list[str]):
    """A tree over steps, with the features' own thresholds."""
    head = lines.pop(0).strip()
    if head.startswith("Predict:"):
        return int(float(head.split(":")[1]))
    m = re.match(r"If \(feature (\d+) <= (\S+)\)", head)
    left = _tree(lines)
    lines.pop(0)
    steps = STEPS[int(m[1])]
    at = math.floor(float(m[2]))
    return (int(m[1]), float(steps[at]) if at < len(steps) else math.inf, left, _tree(lines))


def fit(docs: DataFrame, findings: DataFrame | None = None) -> Model:
    """A forest from labelled findings: those of ``findings`` (value, before, after, assigned, path, label), the seed's,
    and the weakly labelled ones of all ``docs``. The dictionary has the most frequent words of all documents.

    Findings are told by their features in steps; equal ones are one row with a weight, in whatever order they come. All trees
    see all of them and differ by the features that they may split. Spark takes a sample for its splits from 16 million
    distinct rows (``MAX_BINS`` squared) on; as no feature has more steps than it may have splits, each step counts."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select("text", F.col("source").cast("string").alias("path"))
    counted = rows.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,20}"), F.lit(0))).alias("w")).groupBy("w").count()
    counted = materialize(counted.orderBy(F.desc("count"), "w").limit(DICTIONARY), "words").collect()  # written first: else each task sends as many to the driver
    pairs: Counter[str] = Counter()
    for r in counted:
        for i in range(len(r["w"]) - 1):
            pairs[r["w"][i : i + 2]] += r["count"]
    total = max(1, sum(pairs.values()))
    words, logs = frozenset(r["w"] for r in counted), {k: math.log(v / total) for k, v in pairs.items()}
    shared = spark.sparkContext.broadcast((words, logs))  # bounded by DICTIONARY
    kinds = ", ".join(f"{c} int" for c in (*_BINNED, "label")) + ", n long"
    seen = rows.mapInArrow(_found(shared), kinds)
    if findings is not None:
        seen = seen.unionByName(findings.select("value", "before", "after", "assigned", "path", F.col("label").cast("int")).mapInArrow(_given(shared), kinds))
    seen = materialize(seen.groupBy(*_BINNED, "label").agg(F.sum("n").alias("n")), "findings")
    seed = seed_findings()
    weight = max(1, round(SEED_SHARE * (seen.agg(F.sum("n")).first()[0] or 0) / len(seed)))
    steps = zip(*[(*stepped(features(*x[:5], words, logs)), x[5], weight) for x in seed], strict=True)
    # as Arrow: a list of rows goes through Python workers of its own on the executors, which stay there beside the others
    seeded = spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in steps], names=[*_BINNED, "label", "n"])).to(seen.schema)
    labelled = seen.unionByName(seeded).groupBy(*_BINNED, "label").agg(F.sum("n").cast("double").alias("n"))
    frame = VectorAssembler(inputCols=_BINNED, outputCol="features").transform(labelled.withColumn("label", F.col("label").cast("double")))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=4, featureSubsetStrategy="onethird", bootstrap=False, weightCol="n", maxBins=MAX_BINS).fit(frame)
    shared.destroy()
    lines = [x for x in forest.toDebugString.split("\n") if re.match(r"\s*(If|Else|Predict)", x)]
    trees = []
    while lines:
        trees.append(_tree(lines))
    return Model(trees, words, logs)


_OUT = "n_candidates long, findings array<struct<start:int,end:int,score:double>>, clean string"


def _scan(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in text_chunks(batches, "text"):
            at = batch.schema.get_field_index("text")
            path = batch.column(batch.schema.get_field_index("path"))
            count = np.zeros(batch.num_rows, np.int64)
            hits: dict[int, list[tuple[int, int, float, bytes]]] = {}
            last, done = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for t, s, e, assigned, raw in _each(batch, at):
                if s >= last[t]:
                    count[t] += 1
                    last[t] = e
                if s < done[t]:
                    continue
                value, before, after = _context(raw, s, e)
                score = model.score(features(value, before, after, assigned, path[t].as_py() or "", model.words, model.pairs))
                if score >= threshold:
                    hits.setdefault(t, []).append((s, e, score, raw))
                    done[t] = e
            found, clean = [[] for _ in range(batch.num_rows)], batch.column(at)
            if hits:
                texts = clean.to_pylist()
                for t, spans in hits.items():
                    raw, out, last = spans[0][3], [], 0
                    for s, e, score, _ in spans:
                        a = len(raw[:s].decode("utf-8", "replace"))
                        found[t].append({"start": a, "end": a + len(raw[s:e].decode("utf-8", "replace")), "score": score})
                        out += [raw[last:s], b"[SECRET]"]
                        last = e
                    texts[t] = b"".join([*out, raw[last:]]).decode("utf-8", "replace")
                clean = pa.array(texts, pa.string())
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            keep = [i for i, x in enumerate(batch.schema.names) if x not in ("text", "path")]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(count), pa.array(found, kind), clean.cast(pa.string())], names=[*(batch.schema.names[i] for i in keep), "n_candidates", "findings", "clean"])

    return run


def scan(docs: DataFrame, model: Model, key: list[str], threshold: float = 0.5) -> DataFrame:
    """key columns, n_candidates, findings (start, end in code points; score) and clean, the text with findings replaced by [SECRET].

    Candidates are runs of 16 or more token characters with a digit, published forms with or without one, and values of 8
    or more, of any length, assigned to a credential's name; findings are those that at least ``threshold`` of the trees
    accept. Null text stays null and has no candidates. Overlapping candidates count once, the assigned one; where it
    isn't accepted as a whole, those in it are looked at. Equal rows get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by DICTIONARY, TREES and DEPTH
    # key columns get names of their own meanwhile, so that they may be called as they like
    named = {c: f"_key{i}" for i, c in enumerate(key)}
    keys = ", ".join(f"`{named[f.name]}` {f.dataType.simpleString()}" for f in docs.select(*key).schema.fields)
    rows = docs.select(*[F.col(c).alias(x) for c, x in named.items()], "text", F.col("source").cast("string").alias("path"))
    out = rows.mapInArrow(_scan(shared, threshold), f"{keys}, {_OUT}")
    clash = {"n_candidates", "findings", "clean"} & {c.lower() for c in key}
    if clash:
        raise ValueError(f"key columns can't be called {sorted(clash)}: the results are")
    return out.select(*[F.col(x).alias(c) for c, x in named.items()], "n_candidates", "findings", "clean")


def measure(model: Model, findings: list[tuple[str, str, str, bool, str, int]], threshold: float = 0.5) -> tuple[float, float]:
    """Precision and recall of the forest on labelled findings (value, before, after, assigned, path, label)."""
    told = [(model.score(features(*x[:5], model.words, model.pairs)) >= threshold, x[5] == 1) for x in findings]
    hits = sum(a and b for a, b in told)
    return hits / max(1, sum(a for a, _ in told)), hits / max(1, sum(b for _, b in told))


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets in text masked and n_chars counted anew; all rows and columns stay."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    names = {c: f"_k{i}" for i, c in enumerate(others)}
    rows = docs.select(*[F.col(c).alias(n) for c, n in names.items()], "text", F.col("source"))
    out = scan(rows, fit(docs), list(names.values()))
    kept = {c: F.col(names[c]).alias(c) for c in others} | {"text": F.col("clean").alias("text"), "n_chars": F.char_length("clean").cast("long").alias("n_chars")}
    return out.select(*[kept[c] for c in docs.columns])


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan(docs, fit(docs), ["doc_id"])
    return found.select("doc_id", "n_candidates", F.size("findings").cast("long").alias("n_secrets"), "findings", F.sha2("clean", 256).alias("clean_sha256"))
