"""Packed values of GRIB2 fields as arrays: simple, complex and block-adaptive entropy coding, decoded in array operations."""

from __future__ import annotations

import struct

import numpy as np

#: Fundamental sequence of a zero block that stands for the rest of a segment of 64 blocks.
_REST, _SEGMENT = 5, 64
#: Flags of the entropy coder (fixed values).
SIGNED, PREPROCESS, RESTRICTED, PAD = 1, 8, 16, 32


def signed(raw: bytes) -> int:
    """Sign and magnitude."""
    n = int.from_bytes(raw, "big")
    top = 1 << (8 * len(raw) - 1)
    return -(n - top) if n & top else n


def to_signed(x: int, size: int) -> bytes:
    return ((1 << (8 * size - 1) | -x) if x < 0 else x).to_bytes(size, "big")


def gather(raw: bytes | np.ndarray, start: np.ndarray, width: np.ndarray | int) -> np.ndarray:
    """Numbers of up to 32 bits that begin at the given bits, the highest bit first."""
    data = np.concatenate([np.frombuffer(raw, np.uint8), np.zeros(8, np.uint8)])
    at, held = start >> 3, np.zeros(start.shape, np.uint64)
    for j in range(5):  # five bytes hold any 32 bits
        held = held << np.uint64(8) | data[np.minimum(at + j, len(data) - 1)]
    width = np.asarray(width, np.int64)
    return (held >> (40 - width - (start & 7)).astype(np.uint64) & ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1))).astype(np.int64)


def integers(raw: bytes, count: int, width: int) -> np.ndarray:
    """``count`` numbers of ``width`` bits each."""
    if width > 32:
        raise ValueError(f"numbers of {width} bits")
    if len(raw) * 8 < count * width:
        raise ValueError("data are cut off")
    if width in (8, 16, 32):
        return np.frombuffer(raw, f">u{width // 8}", count).astype(np.int64)
    if not width:
        return np.zeros(count, np.int64)
    return gather(raw, np.arange(count, dtype=np.int64) * width, width)


def bits_of(values: np.ndarray, width: np.ndarray | int) -> np.ndarray:
    """The bits of numbers, each with its width, one after the other."""
    width = np.broadcast_to(np.asarray(width, np.int64), np.shape(values))
    ends = np.cumsum(width)
    owner = np.repeat(np.arange(len(values)), width)
    return (np.asarray(values, np.int64)[owner] >> (ends[owner] - 1 - np.arange(len(owner))) & 1).astype(np.uint8)


def packed_bits(values: np.ndarray, width: np.ndarray | int) -> bytes:
    return np.packbits(bits_of(values, width)).tobytes()


# Complex packing


def _undifferenced(x: np.ndarray, order: int, first: list[int], least: int) -> np.ndarray:
    """Numbers from their differences of first or second order."""
    x = x.copy()
    x[order:] += least
    x[:order] = first[: len(x)]
    if order == 1:
        return np.cumsum(x)
    if len(x) > 1:
        slopes = np.cumsum(np.concatenate([[x[1] - x[0]], x[2:]]))
        return np.concatenate([x[:1], x[0] + np.cumsum(slopes)])
    return x


def complex_values(head: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and whether they are missing, of complex packing with or without spatial differencing.

    ``head``: section 5 from its group reference width (octet 20) on; ``data``: section 7 without its header.
    """
    width, _, _, missing = head[0], head[1], head[2], head[3]
    groups, = struct.unpack(">I", head[12:16])
    base_width, width_bits = head[16], head[17]
    base_length, step, last, length_bits = struct.unpack(">IBIB", head[18:28])
    order, octets = (head[28], head[29]) if len(head) >= 30 else (0, 0)
    at, first, least = 0, [], 0
    if order:
        if order > 2:
            raise ValueError(f"differences of order {order}")
        first = [signed(data[i * octets : (i + 1) * octets]) for i in range(order)]
        least, at = signed(data[order * octets : (order + 1) * octets]), (order + 1) * octets

    def table(bits: int) -> np.ndarray:
        nonlocal at
        out = integers(data[at:], groups, bits)
        at += (groups * bits + 7) // 8
        return out

    references, widths, lengths = table(width), base_width + table(width_bits), base_length + step * table(length_bits)
    if groups:
        lengths[-1] = last
    if (widths > 32).any():
        raise ValueError("groups of more than 32 bits")
    owner = np.repeat(np.arange(groups), lengths)
    own = widths[owner]
    start = np.cumsum(own) - own
    if len(owner) and (len(data) - at) * 8 < start[-1] + own[-1]:
        raise ValueError("data are cut off")
    x = gather(data[at:], start, own) if len(owner) else np.zeros(0, np.int64)
    gone = np.zeros(len(x), bool)
    for k in range(missing):  # the highest number, or the two highest, stand for missing values
        gone |= np.where(own > 0, x == (1 << own) - 1 - k, references[owner] == (1 << width) - 1 - k)
    x = x + references[owner]
    if order:
        x[~gone] = _undifferenced(x[~gone], order, first, least)
    return x, gone


def complex_section(x: np.ndarray, missing: np.ndarray | None = None, order: int = 0, length: int = 32) -> tuple[bytes, bytes]:
    """Section 5 from octet 20 on and section 7 of whole numbers (from 0), in groups of ``length``."""
    missing = np.zeros(len(x), bool) if missing is None else missing
    held = x[~missing].astype(np.int64)
    first, least = held[:order].tolist(), 0
    first += [0] * (order - len(first))
    if order:
        held = np.concatenate([held[:order], np.diff(held, order)]) if len(held) > order else held
        least = int(held[order:].min(initial=0)) if len(held) > order else 0
        held = np.where(np.arange(len(held)) < order, 0, held - least)
    full = np.zeros(len(x), np.int64)
    full[~missing] = held
    any_missing = bool(missing.any())
    starts = np.arange(0, len(x), length)
    sizes = np.diff(np.append(starts, len(x)))
    owner = np.repeat(np.arange(len(starts)), sizes)
    big = 1 << 40
    low = np.minimum.reduceat(np.where(missing, big, full), starts) if len(x) else np.zeros(0, np.int64)
    high = np.maximum.reduceat(np.where(missing, -1, full), starts) if len(x) else low
    empty = high < 0
    low = np.where(empty, 0, low)
    spread = np.where(empty, 0, high - low)
    holes = np.add.reduceat(missing.astype(np.int64), starts) > 0 if len(x) else np.zeros(0, bool)
    mixed = holes & ~empty
    widths = np.array([int(s + m).bit_length() or int(m) for s, m in zip(spread.tolist(), mixed.tolist(), strict=True)], np.int64)  # room for the highest number
    width = max((int(low.max(initial=0)) + any_missing).bit_length(), 1)
    references = np.where(empty, (1 << width) - 1, low)
    own = widths[owner]
    packed = np.where(missing, (1 << own) - 1, full - low[owner])
    width_bits, length_bits = int(widths.max(initial=0)).bit_length(), 0
    octets = 0
    extra = b""
    if order:
        octets = max(max((abs(v).bit_length() + 8) // 8 for v in [*first, least]), 1)
        extra = b"".join(to_signed(v, octets) for v in [*first, least])
    head = bytes([width, 0, 1, int(any_missing)]) + struct.pack(">ff", 0, 0) + struct.pack(">IBBIBIB", len(starts), 0, width_bits, length, 1, int(sizes[-1]) if len(sizes) else 0, length_bits)
    data = extra + packed_bits(references, width) + packed_bits(widths, width_bits) + packed_bits(packed, own)
    return head + (bytes([order, octets]) if order else b""), data


# Block-adaptive entropy coding


def _id_bits(width: int, flags: int) -> int:
    if flags & RESTRICTED and width <= 4:
        return 1 if width <= 2 else 2
    return 3 if width <= 8 else 4 if width <= 16 else 5


def _unmapped(mapped: np.ndarray, width: int, span: int) -> np.ndarray:
    """Samples of intervals of ``span``, each of which begins with a sample, from mapped differences with the sample before.

    A mapped difference is a zigzag number as long as it lies within the distance to the nearer bound on both sides, which
    nearly all do; intervals with others are gone through one by one."""
    top = (1 << width) - 1
    full = np.zeros(-(-len(mapped) // span) * span, np.int64)
    full[: len(mapped)] = mapped
    rows = full.reshape(-1, span)
    steps = np.where(rows & 1, -((rows + 1) >> 1), rows >> 1)
    steps[:, 0] = rows[:, 0]
    out = np.cumsum(steps, axis=1)
    before = out[:, :-1]
    odd = ((rows[:, 1:] + 1) >> 1) > np.minimum(before, top - before)
    for i in np.flatnonzero(odd.any(axis=1)).tolist():
        # up to the first exception the sums hold
        at = int(np.argmax(odd[i])) + 1
        x, line = int(out[i, at - 1]), rows[i].tolist()
        for j in range(at, span):
            d, far = line[j], (top if x > top >> 1 else 0)
            if (d + 1) >> 1 <= (x ^ far):
                x += -((d + 1) >> 1) if d & 1 else d >> 1
            else:
                x = far ^ d
            out[i, j] = x
    return out.reshape(-1)[: len(mapped)]


def rice_values(data: bytes, count: int, width: int, flags: int, block: int, interval: int) -> np.ndarray:
    """``count`` samples of ``width`` bits: blocks of ``block`` samples, ``interval`` blocks to a reference sample.

    Only the blocks' headers are walked one after the other. A block's unary numbers end with the one bits after its
    header, found by their rank among all one bits of the section; numbers and low bits of all blocks are then gathered at once.
    """
    if flags & SIGNED:
        raise ValueError("signed samples")
    if not width or not count:
        return np.zeros(count, np.int64)
    if width > 32:
        raise ValueError(f"samples of {width} bits")
    ids, modelled = _id_bits(width, flags), bool(flags & PREPROCESS)
    raw = np.frombuffer(data, np.uint8)
    bits = np.unpackbits(raw)
    ones = np.flatnonzero(bits)
    rank = memoryview(np.concatenate([[0], np.cumsum(bits, dtype=np.int32)]).astype(np.int32))
    place = memoryview(ones)
    total, n_bits, n_ones = -(-count // block), len(bits), len(ones)
    tail = data + bytes(8)

    def number(at: int, size: int) -> int:
        return int.from_bytes(tail[at >> 3 : (at >> 3) + 6], "big") >> (48 - size - (at & 7)) & ((1 << size) - 1)

    # of each block: what it is (bits of a split, -1 zeros, -2 pairs, -3 as they are), its reference, rank and first bits
    kinds, references, ranks, unary, low = [], [], [], [], []
    at, done = 0, 0
    while done < total:
        if at >= n_bits:
            raise ValueError("data are cut off")
        refers = modelled and done % interval == 0
        if flags & PAD and done % interval == 0:
            at = (at + 7) & ~7
        code = number(at, ids)
        at += ids
        kind = code - 1
        if code == 0:
            kind = -2 if number(at, 1) else -1
            at += 1
        elif code == (1 << ids) - 1:
            kind = -3
        reference = -1
        if refers and kind != -3:
            reference = number(at, width)
            at += width
        if at > n_bits:
            raise ValueError("data are cut off")
        first, repeat = rank[at], 1
        if kind == -1:
            if first >= n_ones:
                raise ValueError("data are cut off")
            repeat = place[first] - at + 1
            at = place[first] + 1
            if repeat == _REST:
                repeat = min(interval - done % interval, _SEGMENT - done % interval % _SEGMENT)
            elif repeat > _REST:
                repeat -= 1
        elif kind == -3:
            low.append(at)
            unary.append(at)
            at += block * width
        else:
            codes = block // 2 if kind == -2 else block - refers
            if first + codes > n_ones:
                raise ValueError("data are cut off")
            unary.append(at)
            at = place[first + codes - 1] + 1 if codes else at
            low.append(at)
            if kind > 0:
                at += kind * codes
        if kind == -1:
            unary.append(0)
            low.append(0)
        kinds.append(kind)
        references.append(reference)
        ranks.append(first)
        done += repeat
        for _ in range(repeat - 1):
            kinds.append(-1)
            references.append(-1)
            ranks.append(0)
            unary.append(0)
            low.append(0)
    kinds, references, ranks, unary, low = (np.array(x[:total], np.int64) for x in (kinds, references, ranks, unary, low))
    out = np.zeros((total, block), np.int64)
    ends = np.append(ones, 0)

    def sequences(rows: np.ndarray, codes: int) -> np.ndarray:
        stops = ends[ranks[rows][:, None] + np.arange(codes)]
        begin = np.concatenate([unary[rows][:, None], stops[:, :-1] + 1], axis=1)
        return stops - begin

    for refers in (False, True):
        mine = (references >= 0) == refers
        rows, codes = np.flatnonzero(mine & (kinds >= 0)), block - refers
        if len(rows) and codes:
            k = kinds[rows][:, None]
            x = sequences(rows, codes) << k
            x += np.where(k > 0, gather(raw, low[rows][:, None] + np.arange(codes) * k, np.broadcast_to(k, x.shape)), 0)
            out[rows, int(refers) :] = x
    rows = np.flatnonzero(kinds == -2)
    if len(rows):
        m = sequences(rows, block // 2)
        both = (np.sqrt(8.0 * m + 1).astype(np.int64) - 1) // 2  # the sum of a pair: m lies between its triangular numbers
        both += ((both + 1) * (both + 2) // 2 <= m).astype(np.int64) - (both * (both + 1) // 2 > m).astype(np.int64)
        second = m - both * (both + 1) // 2
        out[rows, 0::2], out[rows, 1::2] = both - second, second
    rows = np.flatnonzero(kinds == -3)
    if len(rows):
        out[rows] = gather(raw, low[rows][:, None] + np.arange(block) * width, width)
    given = np.flatnonzero(references >= 0)
    out[given, 0] = references[given]
    flat = out.reshape(-1)[:count]
    return _unmapped(flat, width, block * interval) if modelled else flat


def rice_bytes(x: np.ndarray, width: int, flags: int = PREPROCESS, block: int = 32, interval: int = 128) -> bytes:
    """Samples coded with the shortest option of each block, as ``rice_values`` reads them."""
    top, ids, modelled = (1 << width) - 1, _id_bits(width, flags), bool(flags & PREPROCESS)
    x = np.asarray(x, np.int64)
    x = np.concatenate([x, np.full(-len(x) % block, x[-1] if len(x) else 0)])
    mapped = x.copy()
    if modelled:
        d, room = np.diff(x), np.minimum(x[:-1], top - x[:-1])
        zigzag = np.where(d < 0, -2 * d - 1, 2 * d)
        mapped[1:] = np.where(np.abs(d) <= room, zigzag, room + np.abs(d))
        mapped[:: block * interval] = x[:: block * interval]
    rows, out, pending, most = mapped.reshape(-1, block), [], [], (1 << ids) - 2

    def emit(value: int | np.ndarray, size: int | np.ndarray) -> None:
        out.append(bits_of(np.atleast_1d(value), size))

    def unary(values: np.ndarray) -> None:
        emit(np.ones(len(values), np.int64), values + 1)

    def zeros() -> None:
        """Writes the zero blocks that wait; they share a segment, and the first may have a reference."""
        if not pending:
            return
        start, n = pending[0], len(pending)
        emit(0, ids + 1)
        if modelled and start % interval == 0:
            emit(int(x[start * block]), width)
        rest = min(interval - start % interval, _SEGMENT - start % interval % _SEGMENT)
        unary(np.array([_REST - 1 if n == rest and n >= _REST else n - 1 if n < _REST else n]))
        pending.clear()

    for b, row in enumerate(rows):
        refers = modelled and b % interval == 0
        own = row[1:] if refers else row
        if refers or (b % interval) % _SEGMENT == 0:
            zeros()
        if flags & PAD and b % interval == 0 and b:
            zeros()
            out.append(np.zeros(-sum(map(len, out)) % 8, np.uint8))
        if not own.any():
            pending.append(b)
            continue
        zeros()
        even = np.concatenate([[0], own]) if refers else own
        first, second = np.minimum(even, 1 << 15)[0::2], np.minimum(even, 1 << 15)[1::2]
        pairs = (first + second) * (first + second + 1) // 2 + second
        costs = [(int((own >> k).sum()) + len(own) * (1 + k) + width * refers, k) for k in range(max(most, 0))]
        if own.max() < 1 << 15:
            costs.append((1 + int(pairs.sum()) + len(pairs) + width * refers, -2))
        costs.append((block * width, -3))
        _, kind = min(costs, key=lambda c: (c[0], -c[1]))
        if kind == -3:
            emit((1 << ids) - 1, ids)
            emit(row, width)
            continue
        emit(1 if kind == -2 else kind + 1, ids + 1 if kind == -2 else ids)
        if refers:
            emit(int(row[0]), width)
        if kind == -2:
            unary(pairs)
        else:
            unary(own >> kind)
            if kind:
                emit(own & ((1 << kind) - 1), kind)
    zeros()
    return np.packbits(np.concatenate(out)).tobytes() if out else b""
