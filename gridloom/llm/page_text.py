"""Main text of web pages by differencing with the page that is nearest by URL."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm._shared import Scratch, bound_batches, give_back, numbered
from gridloom.llm.html_lines import Line, lines

#: Pages looked at on either side of a page in the order of paths; the nearest that is no copy is its pair.
NEAR = 2
#: Pages of a block, which a task compares at once.
BLOCK = 256
#: Of the text of both pages, the share in common from which they count as copies of one page: they don't tell its frame.
COPY = 0.8
#: Bits of the longest table that an alignment keeps; longer ones are halved.
_TABLE = 1 << 26
_URL = re.compile(r"\s*[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#\s]+)([^?#\s]*)")
_ENDS = tuple(".!?…:;\"'”’»)]。！？؟।")


def _place(url: str | None) -> tuple[str, str]:
    m = _URL.match(url or "")
    return (m[1].lower(), m[2]) if m else ("", "")


def _rows(a: list[int], b: list[int]) -> list[int]:
    """Bit rows of the table of common lengths: the zeros below bit j of row i are the length for a[:i] and b[:j]."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, out = full, [full]
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        out.append(v)
    return out


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Common lengths of a with every b[:j]."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of both, in memory that is linear in their lengths."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, n, j, m = todo.pop()
        while i < n and j < m and a[i] == b[j]:
            out.append(i)
            i, j = i + 1, j + 1
        while i < n and j < m and a[n - 1] == b[m - 1]:
            n, m = n - 1, m - 1
            out.append(n)
        if i == n or j == m:
            continue
        if n - i > 1 and (n - i) * (m - j) > _TABLE:
            half = (i + n) // 2
            front, back = _lengths(a[i:half], b[j:m]), _lengths(a[half:n][::-1], b[j:m][::-1])
            cut = j + int(np.argmax(front + back[::-1]))
            todo += [(i, half, j, cut), (half, n, cut, m)]
            continue
        table, y = _rows(a[i:n], b[j:m]), m - j
        length = lambda x, k: k - (table[x] & ((1 << k) - 1)).bit_count()  # noqa: B023, E731
        x = n - i
        while x and y:
            if a[i + x - 1] == b[j + y - 1]:
                x, y = x - 1, y - 1
                out.append(i + x)
            elif length(x - 1, y) >= length(x, y - 1):
                x -= 1
            else:
                y -= 1
    return sorted(out)


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of ``a`` whose line is shared with ``b`` in the same order; lines that only one page has can't be."""
    mine = np.flatnonzero(np.isin(a, b))
    both = common(a[mine].tolist(), b[np.isin(b, a)].tolist())
    return mine[both]


_COMPACT = "mark string, host string, path string, hashes binary, sizes binary"


def _compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page with a host and lines: where it is, and its lines as hashes and lengths (below zero for furniture)."""
    for batch in batches:
        out = []
        for mark, url, html in zip(*[batch.column(i) for i in range(3)], strict=True):
            host, path = _place(url.as_py())
            if not host:
                continue
            found = lines(html.as_py() or "")
            if found:
                hashes = b"".join(hashlib.blake2b(x.text.encode("utf-8", "replace"), digest_size=8).digest() for x in found)
                sizes = np.array([len(x.text) if not x.furniture else -len(x.text) for x in found], np.int64)
                out.append((mark.as_py(), host, path, hashes, sizes.tobytes()))
        if out:
            kinds = (pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["mark", "host", "path", "hashes", "sizes"])
    give_back()


def _alike(a: str, b: str) -> int:
    """Code points that both begin with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def _pairs(table: pa.Table) -> pa.Table:
    """A block's pages with the places of the lines that they share with their pair."""
    table = table.sort_by("no")
    no, own = table.column("no").to_pylist(), table.column("own").to_pylist()
    mark, host, path = (table.column(c).to_pylist() for c in ("mark", "host", "path"))
    longs = lambda c: [np.frombuffer(x.as_buffer(), np.int64) for chunk in table.column(c).chunks for x in chunk]
    hashes, sizes = longs("hashes"), longs("sizes")
    out = []
    for i in range(len(no)):
        if not own[i]:
            continue
        others = [j for j in range(max(0, i - NEAR), min(len(no), i + NEAR + 1)) if j != i and host[j] == host[i] and abs(no[j] - no[i]) <= NEAR]
        for j in sorted(others, key=lambda j: (-_alike(path[i], path[j]), abs(j - i), j)):
            here = _shared(hashes[i], hashes[j])
            text = sizes[i].clip(0)
            if text[here].sum() >= COPY * text.sum() and text[here].sum() >= COPY * sizes[j].clip(0).sum() and text.any():
                continue  # a copy: what they share is the page itself
            if len(here):
                out.append((mark[i], here.astype(np.int32).tobytes()))
            break
    return pa.table({"mark": pa.array([x[0] for x in out], pa.string()), "shared": pa.array([x[1] for x in out], pa.binary())})


def _spoken(line: Line) -> bool:
    """A heading or a sentence, not a label such as "Share" or "Read more"."""
    return line.heading or line.text.endswith(_ENDS) or len(line.text.split()) >= 8 or len(line.text) >= 80


def main_lines(found: list[Line], shared: set[int]) -> list[str]:
    """The lines that are the page's text: no furniture, and not shared with the page's pair.

    Where article or main elements hold a quarter of the running text or more, only they count; their sentences and
    headings stay even if the pair has them too, as articles quote and repeat each other. Elsewhere a block that is mostly
    links is a menu."""
    running = [(i, x) for i, x in enumerate(found) if not x.furniture and (x.article or 2 * x.linked <= len(x.text))]
    told = sum(len(x.text) for _, x in running if x.article)
    only = told > 0 and 4 * told >= sum(len(x.text) for _, x in running)
    return [x.text for i, x in running if (x.article or not only) and (i not in shared or (x.article and _spoken(x)))]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, dropped = [], []
        for html, shared in zip(batch.column(2), batch.column(3), strict=True):
            found = lines(html.as_py() or "")
            places = set(np.frombuffer(shared.as_buffer(), np.int32).tolist()) if shared.is_valid else set()
            texts.append("\n".join(main_lines(found, places)).encode("utf-8", "replace").decode())
            dropped.append(len(places))
        n = [len(x) for x in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(dropped, pa.int64())], names=["page_id", "url", "text", "n_chars", "n_shared"])
    give_back()


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) and n_shared (lines that its pair has too) for every row of ``pages`` (page_id,
    url, html).

    Pages are cut into the lines of their blocks. Within each host, pages are ordered by URL path over all tasks; a page's
    pair is, of the two on either side, the one whose path begins most alike, and of equal ones the nearest, unless it is a copy. Their lines
    are aligned by a longest common subsequence, and shared lines go: they are the site's frame. What the markup itself tells
    to be furniture goes too, as menus and adverts that differ from page to page share no lines, and sentences that the markup
    tells to be the article's stay.

    Null html: empty text. Pages without a host have no pair; neither have those with copies only. Rows that repeat a url and
    html get the same text, whatever their page_id. Long pages are taken whole. Empty table: empty result. Other columns
    are ignored.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "page-text")
    rows = pages.select("page_id", "url", "html")
    mark = F.md5(F.concat_ws("\n", F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))))
    compact = scratch.keep(rows.select(mark.alias("mark"), "url", "html").mapInArrow(_compact, _COMPACT), "compact")
    one = compact.groupBy("host", "path", "mark").agg(F.first("hashes").alias("hashes"), F.first("sizes").alias("sizes"))
    placed = numbered(one, ["host", "path", "mark"], "no", scratch)
    # a block, and the pages next to it that its own are compared with
    block = F.floor(F.col("no") / BLOCK)
    at = F.array_distinct(F.array(*[F.floor((F.col("no") + d) / BLOCK) for d in (-NEAR, 0, NEAR)]))
    dealt = placed.withColumn("block", F.explode(F.filter(at, lambda b: b >= 0))).withColumn("own", F.col("block") == block)
    shared = scratch.keep(dealt.groupBy("block").applyInArrow(lambda table: _pairs(table), "mark string, shared binary"), "shared")
    scratch.drop("compact")
    out = rows.withColumn("mark", mark).join(shared, "mark", "left").select("page_id", "url", "html", "shared")
    kind = pages.schema["page_id"].dataType.simpleString()
    out = out.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long, n_shared long")
    return scratch.finish(out)


def op11_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
