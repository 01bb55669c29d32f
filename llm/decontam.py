"""Benchmark decontamination by the q-gram lemma.

Texts are compared as letters and digits, lower-cased, with one separator for
every run of other characters.  An item of ``m`` characters that lies in a text
with at most ``k`` edits shares at least ``m - q + 1 - k q`` q-grams with it, all
on ``k + 1`` neighbouring diagonals.  Matching q-grams of a text are counted per
item in diagonal bands of width ``2 (k + 1)`` that overlap by half, so such a run of
diagonals lies in one band; bands that reach the bound are kept, and an
alignment of the item inside the band (any start and end in the text) decides.
Counted are places of the text, not pairs of places: where a q-gram stands at
neighbouring places of an item (a run of one letter), it counts once for each band
that the run touches.  Counts are taken along the text in steps of ``STEP``, and a
band that the text has passed without reaching the bound is dropped, so memory does
not grow with the repetitions on either side.

The benchmark goes to the executors in blocks of at most ``BLOCK_CHARS``
characters, each block one pass over the documents; documents are never
shuffled.  Long texts are worked in pieces that overlap by more than an item, so
memory does not grow with their length.

Defined results: null or empty text, and null benchmark text, never match; an
item of fewer than ``q`` characters never does, a short one only without edits; an
item contained several times in a text is reported once, with its best place;
rows with equal or null ids are judged one by one; empty tables give no matches.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

Q = 10
ERROR = 0.08
BLOCK_CHARS = 2_000_000
PIECE = 1_500_000
FILTER_BITS = 22
STEP = 1_000_000     # counts held at once
BANDS = 2_000        # bands aligned at once
_B = np.uint64(0x9E3779B97F4A7C15)
_NORM: list[np.ndarray] = []


def _norm_table() -> np.ndarray:
    """By code point: lower-cased letter, mark or digit, or 0 for a separator."""
    if not _NORM:
        t = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if unicodedata.category(s)[0] in "LMN":
                low = s.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _NORM.append(t)
    return _NORM[0]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def normal(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(normalised characters, their places in ``codes``)."""
    c = _norm_table()[codes]
    keep = c != 0
    keep[1:] |= c[:-1] != 0
    at = np.flatnonzero(keep)
    return c[at], at


def grams(c: np.ndarray, q: int) -> np.ndarray:
    """Hash of every run of ``q`` characters, put together from runs of powers of two."""
    n = len(c) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    run, size = (c.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), 1
    out, done = np.zeros(n, np.uint64), 0
    power = lambda e: np.uint64(pow(int(_B), e, 1 << 64))
    while size <= q:
        if q & size:
            out = out * power(size) + run[done:done + n]
            done += size
        if size * 2 <= q:
            run = run[:len(run) - size] * power(size) + run[size:]
        size *= 2
    return out ^ (out >> np.uint64(29))


@dataclass
class Block:
    """Normalised items of a benchmark block and the index of their q-grams."""

    ids: list
    items: list[np.ndarray]
    k: np.ndarray
    bound: np.ndarray
    gram: np.ndarray    # sorted distinct hashes
    first: np.ndarray   # where a gram's runs of places start, one more at the end
    item: np.ndarray
    place: np.ndarray   # last place of a run
    more: np.ndarray    # places of the run before it
    seen: np.ndarray    # bit filter over the hashes


def index(rows: list[tuple[int, str]], q: int, error: float) -> Block:
    ids, items = [], []
    for item_id, text in rows:
        c, _ = normal(_codes(text))
        c = c[int(len(c) and c[0] == 0):len(c) - int(len(c) and c[-1] == 0)]
        if len(c) >= q:
            ids.append(item_id)
            items.append(c)
    m = np.array([len(c) for c in items], np.int64)
    k = np.minimum((m * error).astype(np.int64), (m - q) // q)
    h = np.concatenate([grams(c, q) for c in items]) if items else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(items)), np.maximum(m - q + 1, 0))
    place = np.concatenate([np.arange(len(c) - q + 1) for c in items]) if items else np.zeros(0, np.int64)
    order = np.argsort(h, kind="stable")  # the places of a gram stay in order of item and place
    h, item, place = h[order], item[order], place[order]
    last = np.append((h[1:] != h[:-1]) | (item[1:] != item[:-1]) | (place[1:] != place[:-1] + 1), True)[:len(h)]
    more = np.diff(np.flatnonzero(last), prepend=-1) - 1
    h, item, place = h[last], item[last], place[last]
    gram, first = np.unique(h, return_index=True)
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[gram & np.uint64((1 << FILTER_BITS) - 1)] = True
    return Block(ids, items, k, m - q + 1 - k * q, gram, np.append(first, len(h)), item, place, more, seen)


def _end(text: str, border: int, need: int) -> int:
    """Where a piece ends that goes on for ``need`` normalised characters behind ``border``, however stretched."""
    more = 4 * need
    while border + more < len(text) and len(normal(_codes(text[border:border + more]))[0]) < need:
        more *= 2
    return border + more


def _pieces(texts: list[str], overlap: int) -> Iterator[list[tuple[int, int, str]]]:
    """Groups of (row, start, piece of its text) of about ``PIECE`` characters; pieces of a text share ``overlap`` normalised ones."""
    group, size = [], 0
    for row, text in enumerate(texts):
        for start in range(0, max(1, len(text)), PIECE):
            piece = text[start:_end(text, start + PIECE, overlap)]
            group.append((row, start, piece))
            size += len(piece)
            if size >= PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


def _align(item: np.ndarray, text: np.ndarray, low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of the whole item against any part of ``text`` on diagonals ``low .. low + width - 1``, and where it ends.

    One row of the table at a time, for all bands ``low`` together; cells outside the text match nothing.
    """
    band = np.arange(width)
    cost = np.zeros((len(low), width), np.int32)
    for i, c in enumerate(item):
        j = low[:, None] + band + i
        inside = (j >= 0) & (j < len(text))
        step = cost + ~(inside & (text[np.clip(j, 0, len(text) - 1)] == c))
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(step - band, axis=1) + band
    end = cost.argmin(axis=1)
    return cost[np.arange(len(low)), end], np.clip(low + end + len(item), 0, len(text))


def _bands(block: Block, hit: np.ndarray, g: np.ndarray, unit_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, unit, band) that reach the bound, in this order, from the grams ``g`` at the places ``hit`` (in order).

    Band b holds the diagonals from ``b w`` to ``(b + 2) w - 1`` (``w = k + 1``), so a diagonal lies in two bands.
    """
    none = np.zeros(0, np.int64)
    if not len(hit):
        return none, none, none
    runs = block.first[g + 1] - block.first[g]
    upto = np.cumsum(runs)
    size = np.array([len(x) for x in block.items], np.int64)
    kept, open_keys, open_count, a = [], np.zeros((3, 0), np.int64), none, 0
    while a < len(hit):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + STEP // 4, side="right")))
        n = runs[a:b]
        entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(block.first[g[a:b]], n)
        item, where = block.item[entry], np.repeat(hit[a:b], n)
        width = block.k[item] + 1
        low = (where - block.place[entry]) // width - 1
        number = (where - block.place[entry] + block.more[entry]) // width - low + 1
        for i, j in _steps(number):
            m = number[i:j]
            band = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(low[i:j], m)
            keys = np.stack([np.repeat(item[i:j], m), np.repeat(unit_at[where[i:j]], m), band])
            keys, count = _counted(np.concatenate([open_keys, keys], axis=1), np.concatenate([open_count, np.ones(len(band), np.int64)]))
            # a place further on has a diagonal beyond the band
            passed = (keys[2] + 2) * (block.k[keys[0]] + 1) + size[keys[0]] < where[j - 1]
            kept.append(keys[:, passed & (count >= block.bound[keys[0]])])
            open_keys, open_count = keys[:, ~passed], count[~passed]
        a = b
    kept.append(open_keys[:, open_count >= block.bound[open_keys[0]]])
    keys = np.concatenate(kept, axis=1)
    return tuple(keys[:, np.lexsort((keys[2], keys[1], keys[0]))])


def _steps(number: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges whose numbers add up to about ``STEP``."""
    upto, a = np.cumsum(number), 0
    while a < len(number):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + STEP, side="right")))
        yield a, b
        a = b


def _counted(keys: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of ``keys``, counts added up."""
    order = np.lexsort(keys[::-1])
    keys, count = keys[:, order], count[order]
    first = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))[:keys.shape[1]]
    return keys[:, first], np.add.reduceat(count, first) if len(first) else count


def matches(block: Block, texts: list[str], q: int) -> list[tuple[int, int, int, int, int]]:
    """(row, number of the item, edits, start, end) of every item found; places are code points of the text."""
    if not block.items:
        return []
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    overlap = max(len(item) + int(k) for item, k in zip(block.items, block.k)) + 16
    for group in _pieces(texts, overlap):
        codes = _codes("\n".join(p for _, _, p in group))
        begin = np.concatenate([[0], np.cumsum([len(p) + 1 for _, _, p in group])])
        c, at = normal(codes)
        h = grams(c, q)
        hit = np.flatnonzero(block.seen[h & np.uint64((1 << FILTER_BITS) - 1)])
        g = np.searchsorted(block.gram, h[hit])
        same = (g < len(block.gram)) & (block.gram[np.minimum(g, len(block.gram) - 1)] == h[hit])
        hit, g = hit[same], g[same]
        item, unit, band = _bands(block, hit, g, np.searchsorted(begin, at, side="right") - 1)
        bounds = np.searchsorted(at, begin)
        cuts = np.flatnonzero(np.concatenate([[True], (item[1:] != item[:-1]) | (unit[1:] != unit[:-1]), [True]])) if len(item) else []
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            x, u = int(item[i]), int(unit[i])
            k, a, b = int(block.k[x]), bounds[u], bounds[u + 1]
            row, start, _ = group[u]
            for some in range(i, j, BANDS):  # along the text
                low = band[some:min(j, some + BANDS)] * (k + 1) - a
                edits, end = _align(block.items[x], c[a:b], low - k, 2 * (k + 1) + 2 * k)
                n = int(edits.argmin())
                if edits[n] <= k:
                    stop = int(end[n])
                    first = max(0, stop - len(block.items[x]))
                    place = lambda p: int(at[a + p] - begin[u] + start)  # noqa: E731, B023
                    found = (int(edits[n]), place(min(first, b - a - 1)), place(min(stop, b - a) - 1) + 1)
                    old = best.get((row, x))
                    if old is None or found < old:
                        best[row, x] = found
                if best.get((row, x), (1,))[0] == 0:
                    break  # no later place is better
    return [(row, x, *v) for (row, x), v in sorted(best.items())]


def _blocks(benchmark: DataFrame, q: int, error: float) -> Iterator[Block]:
    rows, size = [], 0
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    for item_id, text in items.toLocalIterator():
        rows.append((item_id, text))
        size += len(text)
        if size >= BLOCK_CHARS:
            yield index(rows, q, error)
            rows, size = [], 0
    if rows:
        yield index(rows, q, error)


_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def contamination(docs: DataFrame, benchmark: DataFrame, q: int = Q, error: float = ERROR) -> DataFrame:
    """``doc_id, item_id, edits, start, end`` of every benchmark item found in a document."""
    spark = docs.sparkSession
    ship(spark)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], "doc_id long, item_id long, edits long, start long, end long")
    for block in _blocks(benchmark, q, error):
        sent = spark.sparkContext.broadcast(block)  # at most BLOCK_CHARS characters and one item

        def run(batches, sent=sent):
            for batch in batches:
                ids = batch.column(0).to_pylist()
                found = matches(sent.value, [t or "" for t in batch.column(1).to_pylist()], q)
                rows = [(ids[r], sent.value.ids[x], e, a, b) for r, x, e, a, b in found]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], schema=_FOUND)

        out = out.unionByName(narrow.mapInArrow(run, "doc_id long, item_id long, edits long, start long, end long"))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, q: int = Q, error: float = ERROR) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, as they are."""
    ship(docs.sparkSession)
    for block in _blocks(benchmark, q, error):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            for batch in batches:
                found = {r[0] for r in matches(sent.value, [t or "" for t in batch.column("text").to_pylist()], q)}
                keep = np.ones(batch.num_rows, bool)
                keep[list(found)] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
