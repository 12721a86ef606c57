"""Least-cost structure repair of conversations by a square-root checkpointed dynamic programme."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm._shared import Scratch

SOLID = r"[^\x20\x09-\x0D]"
KEEP, REROLE, DELETE, INSERT, OPEN = 0, 3, 4, 3, 3
#: A conversation's blocks in a task grow by this many rows, so that n rows have about the root of n blocks, each with about
#: the root of n rows at most.
STEP = 64
_NEVER = 1 << 40
#: States are 0 nothing yet, 1 after system, 2 after user, 3 after assistant; 0 and 3 may end.
_NEXT = (2, 2, 3, 2)
#: Costs of ending in each state, with what has to be inserted.
_END = (0, 2 * INSERT, INSERT, 0)
_MUST = 8
_LEGAL = {(0, 1), (1, 2), (2, 1)}

Costs = tuple[int, int, int, int]


def _before(code: int, b: Costs) -> Costs:
    """Least costs from before a row to the end in each state, of those after it. code: the role's initial (0 s, 1 u, 2 a, 3
    other), 4 more for a truncated row, _MUST for one that has to go."""
    d0, d1, d2, d3 = b[0] + DELETE, b[1] + DELETE, b[2] + DELETE, b[3] + DELETE
    if code != _MUST:
        more, who = (OPEN if code & 4 else 0), code & 3
        user = b[2] + more + (KEEP if who == 1 else REROLE)
        other = b[3] + more + (KEEP if who == 2 else REROLE)
        d0, d1, d2, d3 = min(d0, user), min(d1, user), min(d2, other), min(d3, user)
        if who == 0:
            d0 = min(d0, b[1] + more + KEEP)
    y2, y3 = min(d2, d3 + INSERT), min(d3, d2 + INSERT)
    return min(d0, y2 + INSERT), min(d1, y2 + INSERT), y2, y3


def _kept(code: int, state: int) -> int | None:
    """The state after keeping a row, if that is allowed."""
    who = code & 3
    if code == _MUST or who == 3:
        return None
    if who == 0:
        return 1 if state == 0 else None
    return _NEXT[state] if _NEXT[state] == who + 1 else None


def _walk(codes: bytes, after: Costs, state: int, last: bool) -> tuple[str, int]:
    """The ASCII-least cheapest edits of a block from ``state`` on, and the state that they end in."""
    costs = [after]
    for code in reversed(codes):
        costs.append(_before(code, costs[-1]))
    costs.reverse()
    out = []
    for i, code in enumerate(codes):
        more = OPEN if code != _MUST and code & 4 else 0
        while True:
            now, then = costs[i][state], costs[i + 1]
            if then[state] + DELETE == now:
                out.append("D")
                break
            if costs[i][_NEXT[state]] + INSERT == now:
                out.append("I")
                state = _NEXT[state]
                continue
            kept = _kept(code, state)
            if kept is not None and then[kept] + more + KEEP == now:
                out.append("K")
                state = kept
            else:
                out.append("R")
                state = _NEXT[state]
            break
    while last and state in (1, 2):
        out.append("I")
        state = _NEXT[state]
    return "".join(out), state


def _matrix(codes: bytes) -> list[int]:
    """Least costs through a block from each state to each one."""
    columns = []
    for end in range(4):
        b: Costs = tuple(0 if s == end else _NEVER for s in range(4))
        for code in reversed(codes):
            b = tuple(min(x, _NEVER) for x in _before(code, b))
        columns.append(b)
    return [columns[end][start] for start in range(4) for end in range(4)]


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def _place() -> Column:
    """Turns in order, null first."""
    return F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("turn"))


def _filled(rows: DataFrame) -> DataFrame:
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select(_key().alias("key"), "conv_id", _place().alias("at"), space("role"), space("text"))
    return rows.withColumn("mark", F.md5("text"))


_ORDER = ["key", "at", "role", "mark"]
_BLOCKS = """key string, pid int, no int, at struct<known: boolean, turn: long>, role string, mark string, codes binary, whole boolean, matrix array<long>, blank long, duplicate long, truncated long,
 illegal long, low long, high long, turns long, first_who int, last_who int, first_turn long, last_turn long"""
_AT = pa.struct([("known", pa.bool_()), ("turn", pa.int64())])
_BLOCK_SCHEMA = pa.schema([
    ("key", pa.string()), ("pid", pa.int32()), ("no", pa.int32()), ("at", _AT), ("role", pa.string()), ("mark", pa.string()), ("codes", pa.binary()), ("whole", pa.bool_()), ("matrix", pa.list_(pa.int64())),
    *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "low", "high", "turns")], ("first_who", pa.int32()), ("last_who", pa.int32()), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of successive rows of a conversation; rows come in order, equal ones as one row with their number."""
    pid, block, rows, out, size, alone = TaskContext.get().partitionId(), None, [], [], 0, False

    def done(ends: bool) -> None:
        nonlocal block
        if block is not None:
            block["codes"] = bytes(block["codes"])
            block["whole"] = alone and ends and block["no"] == 0
            block["matrix"] = None if block["whole"] else _matrix(block["codes"])
            out.append(block)
        block = None

    last_key, first, no = None, True, 0
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for key, at, role, mark, who, code, n, blank, duplicate, truncated in zip(*columns, strict=True):
            if key != last_key:
                done(True)
                # what a task begins with may go on from the task before
                alone, first, no, last_key = not first, False, 0, key
            elif len(block["codes"]) >= STEP * (no + 1):
                done(False)
                no += 1
            turn = at["turn"] if at["known"] else None
            if block is None:
                block = {"key": key, "pid": pid, "no": no, "at": at, "role": role, "mark": mark, "codes": bytearray(), "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "low": turn, "high": turn,
                         "turns": int(turn is not None), "first_who": who, "last_who": who, "first_turn": turn, "last_turn": turn}
            else:
                block["illegal"] += (block["last_who"], who) not in _LEGAL
                if turn is not None and turn != block["last_turn"]:
                    block["turns"] += 1
                    block["low"] = turn if block["low"] is None else block["low"]
                    block["high"] = turn
            block["illegal"] += n - 1
            block["last_who"], block["last_turn"] = who, turn
            block["codes"].append(code)
            block["codes"] += bytes([_MUST]) * (n - 1)
            block["blank"] += blank
            block["duplicate"] += duplicate
            block["truncated"] += truncated
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema=_BLOCK_SCHEMA)
            out.clear()
    done(False)
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_BLOCK_SCHEMA)


def _checkpoints(frame: pd.DataFrame) -> pd.DataFrame:
    """Backward costs at the end of each block of one conversation, and what adds up over the edges of its blocks."""
    frame = frame.sort_values(["pid", "no"])
    b, vectors = _END, []
    for m in reversed(list(frame["matrix"])):
        vectors.append(list(b))
        b = tuple(min(int(m[4 * s + e]) + b[e] for e in range(4)) for s in range(4))
    illegal, shared, before = [0], [0], None
    for row in frame.itertuples():
        if before is not None:
            illegal.append(int((before.last_who, row.first_who) not in _LEGAL))
            shared.append(int(not pd.isna(row.first_turn) and not pd.isna(before.last_turn) and row.first_turn == before.last_turn))
        before = row
    out = frame[["key", "pid", "no"]].assign(after=vectors[::-1], seam=illegal, shared=shared, cost=[b[0]] + [0] * (len(frame) - 1), last=[False] * (len(frame) - 1) + [True])
    return out


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's edits, from every state that it may begin in."""
    for batch in batches:
        audits, ends, costs = [], [], []
        for codes, whole, after, last, cost in zip(*[batch.column(i).to_pylist() for i in (3, 4, 5, 6, 7)], strict=True):
            both = [_walk(codes, _END if whole else tuple(after), s, whole or last) for s in range(1 if whole else 4)]
            audits.append([a for a, _ in both])
            ends.append([e for _, e in both])
            if whole:
                cost, b = 0, _END
                for code in reversed(codes):
                    b = _before(code, b)
                cost = b[0]
            costs.append(cost)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(audits, pa.list_(pa.string())), pa.array(ends, pa.list_(pa.int32())), pa.array(costs, pa.int64())], names=["key", "pid", "no", "audits", "ends", "cost"])


def _entries(frame: pd.DataFrame) -> pd.DataFrame:
    """The state in which each block of one conversation begins."""
    frame = frame.sort_values(["pid", "no"])
    state, begin = 0, []
    for ends in frame["ends"]:
        begin.append(state)
        state = int(ends[state])
    return frame[["key", "pid", "no"]].assign(begin=begin)


def _facts(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Distinct rows in order with the code of the first copy, their number and their faults."""
    blank = ~F.col("text").rlike(SOLID)
    opened = ~F.regexp_extract("text", rf"({SOLID})[\x20\x09-\x0D]*\z", 1).isin(".", "!", "?")
    who = F.coalesce(F.array_position(F.array(*map(F.lit, "sua")), F.substring("role", 1, 1)), F.lit(0))
    who = F.when(who > 0, who - 1).otherwise(F.lit(3)).cast("int")
    facts = rows.select(*_ORDER, who.alias("who"), blank.alias("blank"), opened.alias("open")).groupBy(*_ORDER).agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("who", "blank", "open")])
    facts = scratch.keep(facts, "facts")
    again = facts.groupBy("key", "role", "mark").agg(F.count("*").alias("turns"), F.min("at").alias("begun")).where("turns > 1").drop("turns")
    facts = facts.join(again, ["key", "role", "mark"], "left")
    seen = F.coalesce(F.col("at") > F.col("begun"), F.lit(False))
    broken = ~F.col("blank") & ~seen & F.col("open")
    code = F.when(F.col("blank") | seen, F.lit(_MUST)).otherwise(F.col("who") + broken.cast("int") * 4)
    faults = [F.when(F.col("blank"), F.col("n")).otherwise(0), F.when(F.col("blank"), 0).otherwise(F.col("n") - 1 + seen.cast("int")), broken.cast("long")]
    return facts.select(*_ORDER, "who", code.alias("code"), "n", *[x.alias(c) for x, c in zip(faults, ("blanks", "duplicates", "truncated"), strict=True)])


def plan_repairs(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Blocks of all conversations in order with their edits; of a block: key, pid, no, at, role and mark of its first row,
    audit, cost (of its conversation, in its first block) and what is counted in it.

    ``rows`` as from ``_filled``. Rows are sorted over all tasks, so that a long conversation lies in many, and cut into
    blocks of about the root of its rows. A conversation in one block is done there. Of the others, each block gives its
    least costs between all states (4 x 4); one task a conversation goes through these, back to front, and stores the
    cost vector at each block's end, the checkpoint. Blocks are then recomputed from their checkpoints and walked forward from
    each of the four states, and the states are linked front to back.
    """
    spark = rows.sparkSession
    facts = _facts(rows, scratch)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    facts = scratch.keep(facts, "codes").repartitionByRange(n, *_ORDER).sortWithinPartitions(*_ORDER)
    blocks = scratch.keep(facts.mapInArrow(_blocks, _BLOCKS), "blocks")
    many = blocks.where("not whole")
    ends = many.select("key", "pid", "no", "matrix", "first_who", "last_who", "first_turn", "last_turn").groupBy("key").applyInPandas(_checkpoints, "key string, pid int, no int, after array<long>, seam long, shared long, cost long, last boolean")
    ends = scratch.keep(ends, "checkpoints")
    blocks = blocks.drop("matrix").join(ends, ["key", "pid", "no"], "left")
    walked = blocks.select("key", "pid", "no", "codes", "whole", "after", "last", F.coalesce("cost", F.lit(0)).alias("cost")).mapInArrow(_walks, "key string, pid int, no int, audits array<string>, ends array<int>, cost long")
    walked = scratch.keep(walked, "walks")
    begun = walked.where(F.size("ends") > 1).select("key", "pid", "no", "ends").groupBy("key").applyInPandas(_entries, "key string, pid int, no int, begin int")
    edits = walked.join(begun, ["key", "pid", "no"], "left").select("key", "pid", "no", F.get("audits", F.coalesce("begin", F.lit(0))).alias("audit"), F.col("cost").alias("paid"))
    blocks = blocks.drop("cost").join(edits, ["key", "pid", "no"])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return blocks.select("key", "pid", "no", "at", "role", "mark", "audit", F.col("paid").alias("cost"), "blank", "duplicate", "truncated", (F.col("illegal") + zero("seam")).alias("illegal"), "low", "high", (F.col("turns") - zero("shared")).alias("turns"))


_COUNTS = ("cost", "blank", "duplicate", "truncated", "illegal", "turns")


class _Conversation:
    """Follows one conversation's edits and rows in order."""

    def __init__(self) -> None:
        self.audit, self.at, self.state, self.low, self.high = [], 0, 0, None, None
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.letters: str = ""

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.at += 1
            self.state = _NEXT[self.state]
            yield "I", ("user", "assistant")[self.state - 2], ""

    def block(self, row: dict) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()
        self.letters, self.at = row["audit"], 0
        self.audit.append(row["audit"])
        for c in _COUNTS:
            self.counts[c] += row[c]
        if row["low"] is not None:
            self.low = row["low"] if self.low is None else min(self.low, row["low"])
            self.high = row["high"] if self.high is None else max(self.high, row["high"])

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()
        edit = self.letters[self.at]
        self.at += 1
        if edit == "K":
            self.state = 1 if role[:1] == "s" else _NEXT[self.state]
            yield "K", role, text
        elif edit == "R":
            self.state = _NEXT[self.state]
            yield "R", ("user", "assistant")[self.state - 2], text

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


def _merged(rows: DataFrame, blocks: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Rows and their edits, dealt by conversation and in order, a block before its first row. Text crosses the network once."""
    nothing = {c: F.lit(None).cast("long") for c in (*_COUNTS, "low", "high")}
    blank = {"text": F.lit(None).cast("string"), "audit": F.lit(None).cast("string"), **nothing}
    pick = lambda df, kind, *have: df.select(*_ORDER, F.lit(kind).alias("kind"), *[F.col(c) if c in have else blank[c].alias(c) for c in blank])
    every = pick(rows, 2, "text").unionByName(pick(blocks, 1, "audit", *nothing))
    if ids is not None:
        first = F.struct(F.lit(False).alias("known"), F.lit(0).cast("long").alias("turn"))
        some = ids.select(_key().alias("key")).distinct().select("key", first.alias("at"), F.lit("").alias("role"), F.lit("").alias("mark"))
        every = every.unionByName(pick(some, 0))
    return every.repartition("key").sortWithinPartitions(*_ORDER, "kind")


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Conversation, tuple[str, str, str] | None]]:
    """(key, conversation, repaired row), and with None at a conversation's end."""
    now, key = None, None
    for batch in batches:
        names = batch.schema.names
        for row in batch.to_pylist() if batch.num_rows < 64 else (r for i in range(0, batch.num_rows, 64) for r in batch.slice(i, 64).to_pylist()):
            if row[names[0]] != key or now is None:
                if now is not None:
                    for x in now.end():
                        yield key, now, x
                    yield key, now, None
                now, key = _Conversation(), row["key"]
            if row["kind"] == 1:
                for x in now.block(row):
                    yield key, now, x
            elif row["kind"] == 2:
                for x in now.row(row["role"], row["text"]):
                    yield key, now, x
    if now is not None:
        for x in now.end():
            yield key, now, x
        yield key, now, None


_SUMMARY = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _SUMMARY.split(", ")]
    kinds = pa.schema([(n, pa.string() if n in ("key", "audit", "repaired_sha256") else pa.int64()) for n in names])
    out, digest, n = [], hashlib.sha256(), 0
    for key, talk, row in _follow(batches):
        if row is not None:
            digest.update((f"\n{row[1]}:{row[2]}" if n else f"{row[1]}:{row[2]}").encode())
            n += 1
            continue
        gaps = talk.high - talk.low + 1 - talk.counts["turns"] if talk.low is not None else 0
        out.append({"key": key, "gaps": gaps, **{c: talk.counts[c] for c in _COUNTS[:5]}, "audit": "".join(talk.audit), "repaired_sha256": digest.hexdigest()})
        digest, n = hashlib.sha256(), 0
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema=kinds)
            out.clear()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=kinds)


_TURNS = "key string, seq long, edit string, role string, text string"


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("key", pa.string()), ("seq", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    out, seq = [], 0
    for key, _, row in _follow(batches):
        if row is None:
            seq = 0
            continue
        out.append({"key": key, "seq": seq, "edit": row[0], "role": row[1], "text": row[2]})
        seq += 1
        if len(out) >= 500:
            yield pa.RecordBatch.from_pylist(out, schema=kinds)
            out.clear()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=kinds)


def _named(out: DataFrame, like: DataFrame) -> DataFrame:
    """The conversation's id instead of the key."""
    kind = like.schema["conv_id"].dataType
    value = F.when(F.col("key") != "", F.substring(F.col("key"), 2, 1 << 30)).cast(kind)
    return out.select(value.alias("conv_id"), *[c for c in out.columns if c != "key"])


def repair_turns(rows: DataFrame) -> DataFrame:
    """The repaired turns of all conversations: conv_id, seq (from 0), edit (K kept, R with another role, I inserted), role and
    text.

    ``rows`` (conv_id, turn, role, text) are taken by turn, null first; of one turn by role, then by the MD5 of the text.
    Null role and text are one space; null conv_id is a conversation of its own. Each row's first fault counts: blank (no
    visible character), duplicate (role and text seen earlier), truncated (its last visible character is none of . ! ?).
    Kept rows cost nothing, another role (user or assistant) 3, an inserted empty turn 3, a deleted row 4; blank and
    duplicate rows have to go, and a truncated one that stays costs 3 more. The cheapest edits that give the role initials
    ``(s?(ua)+)?`` are made; of equally cheap ones those whose initials (D, I, K, R) come first in ASCII order. Repeated rows
    are duplicates of the first. Empty table: empty result. Other columns are ignored.
    """
    scratch = Scratch(rows.sparkSession, "repair")
    filled = _filled(rows)
    out = _merged(filled, plan_repairs(filled, scratch), None).mapInArrow(_turns, _TURNS)
    return _named(scratch.finish(out), rows)


def repair_summaries(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each conversation of ``rows`` and
    ``ids`` (which may have some without rows), repaired as by ``repair_turns``.

    gaps: turns that lack between the first and the last; illegal: neighbours whose role initials aren't su, ua or au; audit:
    the edits' initials in order; the hash is that of ``role:text`` lines of the repaired conversation. SHA-256 goes through a
    conversation from front to back by definition: its rows stream through one task, which holds none of them. No rows:
    zeros, an empty audit and the hash of nothing.
    """
    scratch = Scratch(rows.sparkSession, "repair")
    filled = _filled(rows)
    out = _merged(filled, plan_repairs(filled, scratch), ids).mapInArrow(_summaries, _SUMMARY)
    return _named(scratch.finish(out), rows)


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with known faults by crc32("conv_id:turn") % 20: 0 drops the row, 1 empties its text, 2
    takes out its . ! ?, 3 repeats it, 4 makes it the user's. Nulls are written as one space there, and in role and text."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_summaries(damaged(rows), rows.select("conv_id"))


_COSTLY = "struct_pack(c := {c}, a := {a}, t := {t})"


def _sql() -> str:
    pack = lambda c, a, t: _COSTLY.format(c=c, a=a, t=t)
    gone = [pack(f"b{s}.c + 4", f"'D' || b{s}.a", f"b{s}.t") for s in range(4)]

    def said(s: int, who: int, name: str) -> str:  # a row kept as, or turned into, who
        line = f"list_prepend(CASE WHEN who = {who} THEN role ELSE '{name}' END || ':' || text, b{s}.t)"
        return pack(f"b{s}.c + more + CASE WHEN who = {who} THEN 0 ELSE 3 END", f"CASE WHEN who = {who} THEN 'K' ELSE 'R' END || b{s}.a", line)

    user, assistant = said(2, 1, "user"), said(3, 2, "assistant")
    system = pack("b1.c + more", "'K' || b1.a", "list_prepend(role || ':' || text, b1.t)")
    after = [f"list_min([{gone[0]}, {user}] || CASE WHEN who = 0 THEN [{system}] ELSE [] END)", f"list_min([{gone[1]}, {user}])", f"list_min([{gone[2]}, {assistant}])", f"list_min([{gone[3]}, {user}])"]
    step = ", ".join(f"CASE WHEN must THEN {g} ELSE {x} END AS x{s}" for s, (g, x) in enumerate(zip(gone, after, strict=True)))
    more = lambda s, name: pack(f"{s}.c + 3", f"'I' || {s}.a", f"list_prepend('{name}:', {s}.t)")
    return rf"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
o AS (SELECT conv_id, coalesce('=' || conv_id, '') AS key, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS named FROM conversations),
h AS (SELECT o.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(named) + 1), lambda i: ascii(named[i]))), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS fault FROM o, crc),
d AS (SELECT key, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy FROM h WHERE fault <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM d),
m AS (SELECT *, row_number() OVER (PARTITION BY key, role, text ORDER BY i) > 1 AS seen, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS opened,
      coalesce(nullif(instr('sua', role[1]), 0), 4) - 1 AS who, lag(role) OVER (PARTITION BY key ORDER BY i) AS before FROM n),
f AS (SELECT *, blank OR seen AS must, CASE WHEN NOT blank AND NOT seen AND opened THEN 3 ELSE 0 END AS more FROM m),
r AS (SELECT key, max(i) + 1 AS i, {pack("0", "''", "CAST([] AS VARCHAR[])")} AS b0, {pack("6", "'II'", "['user:', 'assistant:']")} AS b1, {pack("3", "'I'", "['assistant:']")} AS b2, {pack("0", "''", "CAST([] AS VARCHAR[])")} AS b3 FROM f GROUP BY key
      UNION ALL
      SELECT key, i, least(x0, {more("y2", "user")}), least(x1, {more("y2", "user")}), y2, least(x3, {more("x2", "user")})
      FROM (SELECT *, least(x2, {more("x3", "assistant")}) AS y2 FROM (SELECT r.key, f.i, {step} FROM r JOIN f ON f.key = r.key AND f.i = r.i - 1))),
s AS (SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND seen) AS duplicate, count(*) FILTER (more > 0) AS truncated,
      count(*) FILTER (before IS NOT NULL AND coalesce(before[1] || role[1] NOT IN ('su', 'ua', 'au'), true)) AS illegal FROM f GROUP BY key),
e AS (SELECT key, b0.c AS cost, b0.a AS audit, b0.t AS lines FROM r WHERE i = 1),
c AS (SELECT DISTINCT conv_id, key FROM o)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
 CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256 FROM c LEFT JOIN s USING (key) LEFT JOIN e USING (key)
"""


SQL = _sql()
