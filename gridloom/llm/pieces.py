"""SentencePiece encoding in a stream, by Viterbi (unigram models) or merges (BPE models), and decoding."""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm._shared import bound_batches, text_chunks
from gridloom.llm._text import buffer

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Segments and pairs of parts that a worker remembers, twice at most; bounds its memory.
MEMO = 400_000
#: Bytes of the segments that are merged side by side.
SHORT = 64
#: Characters of a segment that are merged at once; longer ones are streamed. No result depends on it.
WINDOW = 512
#: Bytes of text whose distinct segments are encoded together; no result depends on it.
CHUNK = 1 << 20


class Vocabulary:
    """Pieces, scores and ids of a SentencePiece model file, in a form that is sent to tasks."""

    def __init__(self, path: str = MODEL) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = proto.ModelProto.FromString(model.serialized_model_proto()).trainer_spec
        if spec.model_type not in (spec.UNIGRAM, spec.BPE):
            raise ValueError(f"{path} is neither a unigram nor a BPE model")
        self.merges = spec.model_type == spec.BPE
        n = model.get_piece_size()
        self.byte_ids = [0] * 256
        self.pieces: dict[str, tuple[float, int]] = {}
        self.raw: list[bytes] = []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.raw.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                self.pieces[piece] = (model.get_score(i), i)
                self.raw.append(piece.replace(SPACE, " ").encode())
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_size = np.fromiter(map(len, self.raw), np.int64, n)
        self.raw_edge = np.cumsum(self.raw_size) - self.raw_size
        self.longest = max(map(len, self.pieces))
        self.unknown = min(s for s, _ in self.pieces.values()) - 10.0
        #: No piece runs into a space mark, so all paths meet there.
        self.meets = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.pieces)
        #: ASCII characters that no longer piece contains, so that all paths meet before and behind them.
        joined = set(chain.from_iterable(p for p in self.pieces if len(p) > 1))
        self.alone = np.array([b < 128 and b != 32 and chr(b) not in joined for b in range(256)])


def _spans(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all elements of the spans, one span behind the other, and the n + 1 offsets of the spans among them."""
    to = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(start - to[:-1], size) + np.arange(to[-1]), to


class Merges:
    """Which neighbours form a piece: a hash table from two symbols to the piece and its rank (least first, as its score is highest).

    Symbols are pieces, by id, and further characters that occur in pieces."""

    SLOTS = 1 << 20

    def __init__(self, pieces: dict[str, tuple[float, int]], size: int) -> None:
        self.symbol = {p: i for p, (_, i) in pieces.items()}
        for c in sorted(set(chain.from_iterable(pieces))):
            self.symbol.setdefault(c, size + len(self.symbol))
        rank = {x: i for i, x in enumerate(sorted({s for s, _ in pieces.values()}, reverse=True))}
        found = [
            (self.symbol[p[:i]] << 32 | self.symbol[p[i:]], rank[score], number)
            for p, (score, number) in pieces.items() for i in range(1, len(p)) if p[:i] in self.symbol and p[i:] in self.symbol
        ]
        pair, order, piece = (np.array(x, np.int64) for x in zip(*found, strict=True))
        self.key = np.full(self.SLOTS, -1, np.int64)
        self.rank, self.piece = np.zeros(self.SLOTS, np.int32), np.zeros(self.SLOTS, np.int32)
        slot, left = self._slot(pair), np.arange(len(pair))
        while len(left):
            free = left[self.key[slot[left]] < 0]
            self.key[slot[free]] = pair[free]  # of several for one slot the last stays
            own = left[self.key[slot[left]] == pair[left]]
            self.rank[slot[own]], self.piece[slot[own]] = order[own], piece[own]
            left = np.setdiff1d(left, own, assume_unique=True)
            slot[left] = (slot[left] + 1) % self.SLOTS
        #: The symbol of each code point; -1 for one that is in no piece, and for the mark, which stands for itself in texts.
        self.of = np.full(0x110000, -1, np.int32)
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.of[ord(c)] = i
        self.of[32], self.of[ord(SPACE)] = self.of[ord(SPACE)], -1

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        h = pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(44)).astype(np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each two symbols; rank NONE where they form none."""
        pair = left.astype(np.int64) << 32 | right
        pair[(left < 0) | (right < 0)] = -2
        slot = self._slot(pair)
        open_ = np.flatnonzero((self.key[slot] != pair) & (self.key[slot] >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % self.SLOTS
            seen = self.key[slot[open_]]
            open_ = open_[(seen != pair[open_]) & (seen >= 0)]
        hit = self.key[slot] == pair
        return np.where(hit, self.rank[slot], NONE), self.piece[slot]


NONE = np.int32(2**31 - 1)


class Encoder:
    """Ids of the segmentation with the highest sum of scores; of equal sums, that whose last piece starts first.

    A character that is no piece counts as unknown, 10 below the least score, and is written as bytes.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.memo: dict[bytes, bytes] = {}
        self.former: dict[bytes, bytes] = {}
        #: Each end of a piece, with the score and id where it is a piece itself; no longer piece ends where this has nothing.
        self.ends: dict[str, tuple[float, int] | None] = {p[i:]: None for p in vocabulary.pieces for i in range(1, len(p))} | vocabulary.pieces

    def stream(self, characters: Iterable[str]) -> Iterator[int]:
        """Viterbi over a stream of characters. Only positions since the last commit are kept: whenever the paths to all
        positions from which a piece can still start (as many as the longest piece has characters) meet in one boundary,
        the ids before it are final and leave the window."""
        v, longest, ends = self.v, self.v.longest, self.ends.get
        window, base = "", 0  # characters since position ``base``, the last committed boundary
        score, back = [0.0], [(-1, 0)]  # of each position since base: best sum, and (start, id; -1 for unknown)
        due = 2 * longest
        for c in characters:
            window += c
            i = len(window)
            best, at, piece = (score[-1] + v.unknown, i - 1, -1) if c not in v.pieces else (-math.inf, 0, -1)
            for start in range(i - 1, max(-1, i - 1 - longest), -1):
                hit = ends(window[start:i], 0)
                if hit == 0:
                    break
                if hit is not None and score[start] + hit[0] >= best:
                    best, at, piece = score[start] + hit[0], start, hit[1]
            score.append(best)
            back.append((at, piece))
            if i >= due:
                cut = self._meeting(back, i)
                due = i + longest
                if cut:
                    yield from self._path(window, back, cut)
                    window, base = window[cut:], base + cut
                    top = score[cut]
                    score = [x - top for x in score[cut:]]
                    back = [(max(a - cut, -1), p) for a, p in back[cut:]]
                    due -= cut
        yield from self._path(window, back, len(window))

    def _meeting(self, back: list[tuple[int, int]], i: int) -> int:
        """The last boundary that the paths to all live positions have in common."""
        live = set(range(max(0, i - self.v.longest + 1), i + 1))
        while len(live) > 1:
            live.add(back[max(live)][0])
            live.remove(max(live))
        return max(0, live.pop())

    def _path(self, window: str, back: list[tuple[int, int]], end: int) -> list[int]:
        out: list[int] = []
        while end > 0:
            start, piece = back[end]
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self.v.byte_ids[b] for b in reversed(window[start:end].encode("utf-8", "replace")))
            end = start
        return out[::-1]

    def segment(self, raw: bytes) -> bytes:
        """Ids of a segment as 32-bit numbers. A mark in the text, which decoding would take for a space, is written as bytes."""
        got = self.memo.get(raw) or self.former.get(raw)
        if got is None:
            mark = [self.v.byte_ids[b] for b in SPACE.encode()]
            ids: list[int] = []
            for i, part in enumerate(raw.decode().split(SPACE)):
                ids += [*(mark if i else []), *self.stream(part.replace(" ", SPACE))]
            got = array("i", ids).tobytes()
        if len(raw) <= 64:
            if len(self.memo) >= MEMO:
                self.former, self.memo = self.memo, {}
            self.memo[raw] = got
        return got

    def raw(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.v.raw.__getitem__, ids))

    def segments(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The segments of the texts, between boundaries that lie on every path, and the n + 1 edges of texts among them. Texts get a leading space."""
        texts = pc.fill_null(texts, "")
        data, off = buffer(pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, "")))
        begin = np.zeros(len(data), bool)
        if self.v.meets:
            begin = data == 32
            begin[1:] &= data[:-1] != 32
        alone = self.v.alone[data]
        begin |= alone
        begin[1:] |= alone[:-1]
        begin[off[:-1][off[1:] > off[:-1]]] = True
        starts = np.flatnonzero(begin)
        edges = np.append(starts, len(data))
        cut = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        return cut, np.searchsorted(starts, off)

    def batch(self, segments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments, one behind the other, and the n + 1 offsets of the segments among them."""
        ids = list(map(self.segment, segments.to_pylist()))
        edge = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))]) // 4
        return np.frombuffer(b"".join(ids), np.int32), edge

    def coded(self, texts: pa.Array) -> tuple[pa.ListArray, np.ndarray, np.ndarray]:
        """Ids of each text; the bytes that all decode to, and the n + 1 offsets of the texts in them. Each distinct
        segment is encoded once."""
        cut, first = self.segments(texts)
        coded = cut.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        flat, edge = self.batch(coded.dictionary)
        where, at = _spans(edge[code], np.diff(edge)[code])
        ids = flat[where]
        lists = pa.ListArray.from_arrays(pa.array(at[first].astype(np.int32)), pa.array(ids))
        where, to = _spans(self.v.raw_edge[ids], self.v.raw_size[ids])
        decoded, off = self.v.raw_bytes[where], to[at[first]]
        full = np.diff(off) > 0  # the leading space
        keep = np.ones(len(decoded), bool)
        keep[off[:-1][full]] = False
        return lists, decoded[keep], off - np.concatenate([[0], np.cumsum(full)])

    def encode(self, text: str) -> list[int]:
        return self.coded(pa.array([text]))[0][0].as_py()

    def decode(self, ids: Iterable[int]) -> str:
        return self.raw(ids).decode("utf-8", "replace")[1:]


class MergeEncoder(Encoder):
    """Ids of a BPE model, whose scores rank merges: of all neighbours that form a piece, those of the highest score are
    joined first, of equal ones the leftmost, until none form a piece. A character that is no piece is written as bytes."""

    def __init__(self, vocabulary: Vocabulary, window: int = WINDOW) -> None:
        self.v, self.window = vocabulary, window
        self.memo: dict[bytes, bytes] = {}
        self.former: dict[bytes, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.rank = {p: score for p, (score, _) in vocabulary.pieces.items() if len(p) > 1}
        self.merges = Merges(vocabulary.pieces, len(vocabulary.raw))

    def batch(self, segments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Short segments are merged side by side, long ones are streamed."""
        size = np.asarray(pc.binary_length(segments)).astype(np.int64)
        short = size <= SHORT
        flat, edge = self.side_by_side(segments.filter(pa.array(short)))
        if short.all():
            return flat, edge
        rest, to = super().batch(segments.filter(pa.array(~short)))
        count, start = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
        count[short], count[~short] = np.diff(edge), np.diff(to)
        start[short], start[~short] = edge[:-1], to[:-1] + len(flat)
        where, edge = _spans(start, count)
        return np.concatenate([flat, rest])[where], edge

    def side_by_side(self, segments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """One merge in each segment at a time: the pair of the best rank, the leftmost of equal ones, becomes a symbol
        until no pair is left."""
        raw, off = buffer(segments.cast(pa.large_binary()).cast(pa.large_string()))
        head = np.flatnonzero((raw & 0xC0) != 0x80)  # characters' first bytes
        wide = np.diff(np.append(head, len(raw)))
        point = raw[head].astype(np.int32)
        for n, mask in ((2, 0x1F), (3, 0x0F), (4, 0x07)):
            some = np.flatnonzero(wide == n)
            value = point[some] & mask
            for j in range(1, n):
                value = value << 6 | (raw[head[some] + j] & 0x3F)
            point[some] = value
        symbol, byte = self.merges.of[point], head
        home = np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(head, off)))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # symbols, first bytes and segments
        rank, piece = np.full(len(symbol), NONE), np.zeros(len(symbol), np.int32)
        inner = np.flatnonzero(home[1:] == home[:-1])
        rank[inner], piece[inner] = self.merges.look(symbol[inner], symbol[inner + 1])
        while len(symbol):
            new = np.flatnonzero(np.diff(home, prepend=-1))
            best = np.minimum.reduceat(rank.astype(np.int64) << 32 | np.arange(len(rank)), new)
            live = best >> 32 != NONE
            at = best[live] & 0xFFFFFFFF
            symbol[at], gone = piece[at], np.zeros(len(symbol), bool)
            gone[at + 1] = True
            ended = np.repeat(~live, np.diff(np.append(new, len(symbol))))
            done.append((symbol[ended], byte[ended], home[ended]))
            keep = ~(gone | ended)
            moved = np.cumsum(keep) - 1
            at = moved[at]
            symbol, byte, home, rank, piece = symbol[keep], byte[keep], home[keep], rank[keep], piece[keep]
            last = len(symbol) - 1
            for left in (at, at[at > 0] - 1):
                right = np.minimum(left + 1, last)
                r, p = self.merges.look(symbol[left], symbol[right])
                rank[left], piece[left] = np.where((right > left) & (home[left] == home[right]), r, NONE), p
        symbol, byte, home = (np.concatenate([x[i] for x in done] or [np.empty(0, np.int64)]) for i in range(3))
        order = np.argsort(byte)
        symbol, byte, home = symbol[order], byte[order], home[order]
        # characters that are no piece become bytes
        odd = (symbol < 0) | (symbol >= len(self.v.raw))
        count = np.where(odd, np.diff(np.append(byte, len(raw))), 1)
        where, to = _spans(byte, count)
        ids = np.repeat(symbol, count)
        spelled = np.repeat(odd, count)
        ids[spelled] = np.array(self.v.byte_ids, np.int32)[raw[where[spelled]]]
        return ids.astype(np.int32), to[np.searchsorted(home, np.arange(len(off)))]

    def merged(self, text: str) -> list[str]:
        get, none = self.rank.get, -math.inf
        parts = list(text)
        scores = [get(text[i : i + 2], none) for i in range(len(text) - 1)]
        while scores and (best := max(scores)) > none:
            i = scores.index(best)
            parts[i] += parts.pop(i + 1)
            del scores[i]
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], none)
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], none)
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether the parts stay as they are when merged side by side; ``left`` may be empty."""
        got = self.pairs.get((left, right))
        if got is None:
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            got = self.pairs[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return got

    def stream(self, characters: Iterable[str]) -> Iterable[int]:
        if isinstance(characters, str) and len(characters) <= self.window:
            out: list[int] = []
            for x in self.merged(characters):
                hit = self.v.pieces.get(x)
                out.extend((hit[1],) if hit else map(self.v.byte_ids.__getitem__, x.encode("utf-8", "replace")))
            return out
        return self.windowed(characters)

    def windowed(self, characters: Iterable[str]) -> Iterator[int]:
        """Merges over a stream of characters, of which only those since the last commit are kept.

        No merge crosses a boundary of the result, so what is before a boundary is merged as if alone; and parts are the
        result for their text just where each two neighbours fit, as the first merge across a boundary would happen between
        the two alone, too. So exactly one part ends each prefix: the one that fits the part that ends the prefix before it.
        Where the paths to all live positions meet, the ids before are final, as in Viterbi."""
        v, longest, pieces = self.v, self.v.longest, self.v.pieces.get
        window, due = "", 2 * longest
        last, back = [""], [(-1, 0)]  # of each position since the last commit: the part that ends there, and (start, id; -1 for unknown)
        for c in characters:
            window += c
            i = len(window)
            for start in range(max(0, i - longest), i):
                part = window[start:i]
                if (i - start == 1 or part in self.rank) and self.fits(last[start], part):
                    break
            last.append(part)
            back.append((start, pieces(part, (0, -1))[1]))
            if i >= due:
                cut = self._meeting(back, i)
                due = i + longest
                if cut:
                    yield from self._path(window, back, cut)
                    window, last = window[cut:], last[cut:]
                    back = [(max(a - cut, -1), p) for a, p in back[cut:]]
                    due -= cut
        yield from self._path(window, back, len(window))


def encoder(vocabulary: Vocabulary) -> Encoder:
    return MergeEncoder(vocabulary) if vocabulary.merges else Encoder(vocabulary)


_encoders: dict[str, Encoder] = {}


def _encode_rows(shared, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoders.get(key) or _encoders.setdefault(key, encoder(shared.value))
        for batch in text_chunks(batches, "text", CHUNK):
            lists, decoded, off = coder.coded(batch.column(1))
            data, to = buffer(batch.column(1))
            if len(data) == len(decoded) and np.array_equal(off, to) and np.array_equal(data, decoded):
                exact = [True] * batch.num_rows
            else:
                exact = [np.array_equal(decoded[off[i] : off[i + 1]], data[to[i] : to[i + 1]]) for i in range(batch.num_rows)]
            sums = [hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(off, off[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.list_value_length(lists).cast(pa.int64()), lists, pa.array(sums, pa.string()), pa.array(exact, pa.bool_())], names=["doc_id", "n_ids", "ids", "decoded_sha256", "exact"])

    return run


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_ids, ids, decoded_sha256 (of the text decoded from the ids) and exact (it is the text) for each row of ``docs``.

    The ids are those of the model, by merges or by Viterbi as its kind asks for. The text gets a leading space mark, as
    the model asks for; spaces become marks. Only a mark in the text itself differs: it is written as bytes, so that it
    isn't decoded to a space. Null and empty text have no ids.
    Long texts are encoded in a window of bounded size. Equal texts have equal ids. Other columns are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(Vocabulary(model))  # the size of a vocabulary
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_encode_rows(shared, model), "doc_id long, n_ids long, ids array<int>, decoded_sha256 string, exact boolean")


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
