import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from gridloom.llm import conversations as C

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), hashlib.md5(text.encode()).hexdigest())


def solve(rows):
    """Counts, cost, audit and repaired lines, by all strings of edits."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=order)
    seen, faults = set(), []
    for _, role, text in rows:
        if not text.strip(SPACE):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if text.rstrip(SPACE)[-1] in ".!?" else "truncated")
        seen.add((role, text))

    def step(state, letter):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, letter))

    @cache
    def best(i, state, inserts):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserts < 3:
            for who in ("user", "assistant"):
                if (to := step(state, who[0])) and (x := best(i, to, inserts + 1)):
                    found.append((x[0] + 3, "I" + x[1], (f"{who}:", *x[2])))
        if i < len(rows):
            _, role, text = rows[i]
            if x := best(i + 1, state, 0):
                found.append((x[0] + 4, "D" + x[1], x[2]))
            if faults[i] in ("", "truncated"):
                more = 3 * (faults[i] == "truncated")
                if (to := step(state, role[:1])) and (x := best(i + 1, to, 0)):
                    found.append((x[0] + more, "K" + x[1], (f"{role}:{text}", *x[2])))
                for who in ("user", "assistant"):
                    if (to := step(state, who[0])) and (x := best(i + 1, to, 0)):
                        found.append((x[0] + more + 3, "R" + x[1], (f"{who}:{text}", *x[2])))
        return min(found) if found else None

    cost, audit, lines = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return (gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def talks(seed, n, longest):
    r = random.Random(seed)
    texts = ["Fine.", "fine", "Why?", "go on", " \t", "", "x!  \n", None, "End. no", "é"]
    for c in range(n):
        for t in range(r.randint(1, longest)):
            turn = None if r.random() < 0.05 else t + r.choice([0, 0, 0, 1, 3])
            yield (None if c == 0 else c, turn, r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "u2"]), r.choice(texts))


COLUMNS = "conv_id long, turn long, role string, text string"
NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def by_talk(rows):
    out = {}
    for c, *row in rows:
        out.setdefault(c, []).append(row)
    return out


@pytest.mark.parametrize("seed,step", [(0, 64), (1, 1), (2, 2)])
def test_equals_all_edits(spark, monkeypatch, seed, step):
    monkeypatch.setattr(C, "STEP", step)  # blocks of few rows, so that conversations lie in many
    rows = list(talks(seed, 30, 9))
    got = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in C.repair_summaries(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert got == {c: solve(x)[0] for c, x in by_talk(rows).items()}


def test_a_long_conversation_is_split_over_tasks(spark):
    rows = [(7, t, ["user", "assistant"][(t + t // 50) % 2], f"turn {t % 700}." if t % 9 else f"open {t}") for t in range(3000)] + list(talks(3, 5, 6))
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    scratch = C.Scratch(spark, "test")
    blocks = C.plan_repairs(C._filled(df), scratch).where("key = '=7'").select("pid", "no", F.length("audit").alias("n")).collect()
    assert len({b["pid"] for b in blocks}) > 1 and max(b["n"] for b in blocks) < 1000
    scratch.clear()
    got = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in C.repair_summaries(df).collect()}
    want = {c: x for c, x in by_talk(rows).items() if c != 7}
    assert {c: x for c, x in got.items() if c != 7} == {c: solve(x)[0] for c, x in want.items()}
    # the long one in one block
    by = sorted(((t, r, x) for _, t, r, x in rows[:3000]), key=order)
    seen, codes = set(), bytearray()
    for _, role, text in by:
        codes.append(C._MUST if (role, text) in seen else {"u": 1, "a": 2}[role[0]] + 4 * (text[-1] not in ".!?"))
        seen.add((role, text))
    audit, _ = C._walk(bytes(codes), C._END, 0, True)
    assert got[7][NAMES.index("audit")] == audit


def test_turns_are_the_summarys_lines(spark):
    rows = list(talks(4, 12, 8))
    turns = C.repair_turns(spark.createDataFrame(rows, COLUMNS)).orderBy("conv_id", "seq").collect()
    lines = {}
    for r in turns:
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        assert len(lines[r["conv_id"]]) == r["seq"] + 1
    assert {c: tuple(x) for c, x in lines.items()} == {c: y for c, x in by_talk(rows).items() if (y := solve(x)[1])}


def test_damage(spark):
    rows = list(talks(5, 40, 6))
    got = sorted(map(repr, (tuple(r) for r in C.damaged(spark.createDataFrame(rows, COLUMNS)).collect())))
    want = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
        want += [row] * (0 if k == 0 else 2 if k == 3 else 1)
    assert got == sorted(map(repr, want))


def test_empty_table_lost_rows_and_clashing_names(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert C.repair_summaries(none).count() == 0 and C.repair_turns(none).count() == 0
    ids = spark.createDataFrame([(None,), (1,), (2,), (2,)], "conv_id long")
    rows = spark.createDataFrame([(1, None, "user", "Hi.", "k", 0, "x")], COLUMNS + ", key string, no int, audit string")
    got = sorted(C.repair_summaries(rows, ids).collect(), key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0))
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r)[1:] for r in got] == [(0, 0, 0, 0, 0, 0, "", empty), (0, 0, 0, 0, 0, 3, "KI", hashlib.sha256(b"user:Hi.\nassistant:").hexdigest()), (0, 0, 0, 0, 0, 0, "", empty)]


def test_very_long_text(spark):
    text = "word " * 400_000 + "."
    (r,) = C.repair_summaries(spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], COLUMNS)).collect()
    assert r["audit"] == "KK" and r["repaired_sha256"] == hashlib.sha256(f"user:{text}\nassistant:{text}".encode()).hexdigest()
