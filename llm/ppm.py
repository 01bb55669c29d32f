"""Prediction by partial matching: code length of every document under a byte-context trie.

The text of a document is its bytes with A-Z lower-cased, then one end symbol
(byte 0xFF, which no UTF-8 text holds).  A trie node is the run of bytes before a
symbol, at most ``order`` of them; its counts are of the symbols that followed it.
Coding a symbol starts at the longest context that was seen.  If the symbol
followed it, its probability is ``n / (T + D)`` (``n`` its count, ``T`` the
context's total, ``D`` its distinct symbols); else an escape with the estimate
``D / (T + D)`` leads to the context without its first byte, where all symbols of
the longer context are excluded from ``n``, ``T`` and ``D``.  Below order 0 the
symbols of the 256 not excluded are equally likely.

Pretrained (``ppm_scores``): contexts and counts come from all training documents.
As the counts of a context cover those of its longer contexts, the symbols
excluded at a context are those of the context one byte longer, so the code length
of a symbol depends on its run of ``order + 1`` bytes only (a run is one whole
number, six bytes in a long).  Each slice of documents counts its distinct runs;
the counts are summed per run over the corpus; the levels of the trie follow by
grouping runs by their last bytes, from order 0 up, in joins on the suffix and
windows over one context (at most 256 rows); and the code lengths of its runs go
back to each slice, which adds them up per document.  Words are counted the same
way for the unigram base.  Counts are exact, but words are told apart by 64 bits
of a hash.  Nothing of the corpus passes through the driver but three totals.

Adaptive (``adaptive_scores``): every document starts with an empty trie and
learns from each byte after coding it.

Defined results: null text counts as empty (one end symbol, one token); rows whose
``train`` is null do not teach; without training documents every symbol has
probability 1 / 256 and every token 2 (the base's formula for no token known); rows
with equal or null ids are scored one by one, by their own text; an empty table
stays empty.  Texts are read whole, in segments.  Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .common import cut_lineage, ship

ORDER = 5               # bytes of the longest context: a run is order + 1 <= 6 bytes
SLICE = 16 << 20        # bytes of text of one slice
SEGMENT = 1 << 20       # bytes worked at once
ENTRIES = 1_000_000     # runs or words of one counting task
PAD, END = 0xFE, 0xFF   # symbols that no UTF-8 text holds
END_TOKEN = np.uint64(0x5851F42D4C957F2D)

_U = np.uint64


# ---------------------------------------------------------------- packed sorted keys

def _pack(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys: their steps, byte plane by byte plane."""
    steps = np.diff(keys, prepend=_U(0)).astype("<u8")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view("<u8"), dtype=np.uint64)


def _zip(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def _unzip(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _range(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Counting task of every key."""
    return (((tv.mix64(keys) >> _U(32)) * _U(ranges)) >> _U(32)).astype(np.int64)


def _distinct(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, ``times`` summed."""
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times, first) if len(first) else times[:0]


# ---------------------------------------------------------------- runs of bytes

def _segments(lens: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(document, from, to) pieces, each list about ``SEGMENT`` bytes; a text's last piece has its end symbol."""
    out, now, size = [], [], 0
    for doc, n in enumerate(lens.tolist()):
        at = 0
        while True:
            stop = min(n, at + SEGMENT - size)
            now.append((doc, at, stop))
            size += stop - at + 1
            if size >= SEGMENT or len(now) == 1 << 16:
                out.append(now)
                now, size = [], 0
            if stop == n:
                break
            at = stop
    return [*out, now] if now else out


def _runs(data: np.ndarray, offs: np.ndarray, pieces: list[tuple[int, int, int]], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(run of ``order + 1`` bytes that ends with each symbol, index of its piece), in order; ``data`` is lower-cased."""
    size = sum(order + 1 + b - a for _, a, b in pieces)
    held, at = np.empty(size, np.uint8), 0
    symbols = np.empty(len(pieces), np.int64)
    for i, (doc, a, b) in enumerate(pieces):
        begin = int(offs[doc])
        before = min(order, a)
        held[at:at + order - before] = PAD
        held[at + order - before:at + order + b - a] = data[begin + a - before:begin + b]
        at += order + b - a
        ends = begin + b == offs[doc + 1]
        if ends:
            held[at] = END
            at += 1
        symbols[i] = b - a + ends
    held = held[:at]
    runs = np.zeros(at - order, np.uint64)
    for j in range(order + 1):
        runs <<= _U(8)
        runs |= held[j:j + len(runs)]
    keep = np.repeat(np.tile([True, False], len(pieces)), np.stack([symbols, np.full(len(pieces), order)], 1).reshape(-1))[:len(runs)]
    return runs[keep], np.repeat(np.arange(len(pieces)), symbols)


def _slice_row(ids: list, data: np.ndarray, lens: np.ndarray, train: np.ndarray, order: int) -> tuple:
    """A slice's documents, packed, with its distinct runs and words and how often training documents hold them."""
    offs = np.concatenate([[0], np.cumsum(lens)])
    lower = tv._LOWER[data]
    found = []
    for pieces in _segments(lens):
        runs, piece = _runs(lower, offs, pieces, order)
        teaches = train[np.array([p[0] for p in pieces])].astype(np.uint64)
        runs = np.sort((runs << _U(1)) | teaches[piece])
        flag = (runs & _U(1)).astype(np.int64)
        runs >>= _U(1)
        first = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]]))
        found.append((runs[first], np.add.reduceat(flag, first)))
    runs, run_times = _distinct(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
    found = [_distinct(words, train[doc].astype(np.int64)) for words, doc in _tokens(lower, offs)]
    words, word_times = _distinct(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
    return (ids, lens.tolist(), zstandard.compress(data.tobytes(), 3), _pack(runs), _zip(run_times.astype("<i8")), len(runs),
            _pack(words), _zip(word_times.astype("<i8")), len(words), int(word_times.sum()))


def _tokens(lower: np.ndarray, offs: np.ndarray):
    """(key of every word and of one end per document, its document), for about ``SEGMENT`` bytes of documents at a time."""
    a, docs = 0, len(offs) - 1
    while a < docs:
        b = min(max(a + 1, int(np.searchsorted(offs, offs[a] + SEGMENT, side="right")) - 1), docs)
        data, own = lower[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        starts, ends = tv.word_spans(data, own)
        words = tv.span_hashes(data, starts, ends, lower=False) if len(starts) else np.zeros(0, np.uint64)
        n, doc = np.diff(np.searchsorted(starts, own, side="left")), np.arange(a, b)
        yield np.concatenate([words, np.full(b - a, END_TOKEN)]), np.concatenate([np.repeat(doc, n), doc])
        a = b


_SLICE = ("ids array<long>, lens array<long>, texts binary, runs binary, run_times binary, n_runs long, "
          "words binary, word_times binary, n_words long, tokens long")


def _slices(docs: DataFrame, order: int) -> DataFrame:
    def run(batches):
        ids, parts, lens, train, size = [], [], [], [], 0

        def row():
            values = _slice_row(ids, np.concatenate(parts), np.concatenate(lens), np.concatenate(train), order)
            return pa.RecordBatch.from_arrays([
                pa.array([values[0]], pa.list_(pa.int64())), pa.array([values[1]], pa.list_(pa.int64())), *(pa.array([v], pa.binary()) for v in values[2:5]),
                pa.array([values[5]]), *(pa.array([v], pa.binary()) for v in values[6:8]), pa.array([values[8]]), pa.array([values[9]])],
                [c.split()[0] for c in _SLICE.split(", ")])

        for batch in batches:
            data, offs = tv.column_bytes(batch.column(1))
            teaches = batch.column(2).fill_null(False).to_numpy(zero_copy_only=False)
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(offs, offs[a] + SLICE - size, side="right")) - 1)
                b = min(b, batch.num_rows)
                ids.extend(batch.column(0).slice(a, b - a).to_pylist())
                parts.append(data[offs[a]:offs[b]].copy())
                lens.append(np.diff(offs[a:b + 1]))
                train.append(teaches[a:b])
                size += int(offs[b] - offs[a])
                a = b
                if a < batch.num_rows or size >= SLICE:
                    yield row()
                    ids, parts, lens, train, size = [], [], [], [], 0
        if ids:
            yield row()

    return cut_lineage(docs.mapInArrow(run, _SLICE).withColumn("slice", F.monotonically_increasing_id()))


# ---------------------------------------------------------------- corpus counts

def _split(table: DataFrame, keys: str, times: str, ranges: int) -> DataFrame:
    """``range, slice, keys, times``: every slice's keys, cut into counting tasks."""
    def run(batches):
        for batch in batches:
            for at, packed, counted in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                key, n = _unpack(packed), _unzip(counted, "<i8")
                of = _range(key, ranges)
                order = np.argsort(of, kind="stable")
                edges = np.searchsorted(of[order], np.arange(ranges + 1))
                for r in np.flatnonzero(np.diff(edges)).tolist():
                    own = order[edges[r]:edges[r + 1]]
                    yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([at], pa.int64()), pa.array([_pack(key[own])], pa.binary()),
                                                      pa.array([_zip(n[own])], pa.binary())], ["range", "slice", "keys", "times"])

    return table.select("slice", keys, times).mapInArrow(run, "range int, slice long, keys binary, times binary")


def _merged(group: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(keys of each row, sorted distinct keys of all, their counts)."""
    parts = [_unpack(x) for x in group["keys"].to_pylist()]
    return parts, *_distinct(np.concatenate(parts), np.concatenate([_unzip(x, "<i8") for x in group["times"].to_pylist()]))


def _count_words(table: DataFrame, ranges: int) -> DataFrame:
    """``slice, range, values, known``: counts of the slice's words; ``known``, once a range, its words with a count."""
    def run(group: pa.Table) -> pa.Table:
        parts, key, n = _merged(group)
        known = [int(np.count_nonzero(n)), *[0] * (len(parts) - 1)]
        return pa.table({"slice": group["slice"], "range": group["range"], "values": pa.array([_zip(n[np.searchsorted(key, p)]) for p in parts], pa.binary()),
                         "known": pa.array(known, pa.int64())})

    return _split(table, "words", "word_times", ranges).groupBy("range").applyInArrow(run, "slice long, range int, values binary, known long")


def _count_runs(table: DataFrame, ranges: int) -> DataFrame:
    """``range, run, n``: every run of the corpus with its count in training documents (0 if only others hold it)."""
    def run(group: pa.Table) -> pa.Table:
        _, key, n = _merged(group)
        return pa.table({"range": pa.array(np.full(len(key), group["range"][0].as_py(), np.int32)), "run": pa.array(key.view(np.int64)), "n": pa.array(n)})

    return _split(table, "runs", "run_times", ranges).groupBy("range").applyInArrow(run, "range int, run long, n long")


def code_lengths(runs: DataFrame, order: int) -> DataFrame:
    """``range, run, log_p`` (base 10) of every row of ``runs`` (``range, run, n``), level by level of the trie."""
    def level(depth: int) -> DataFrame:
        last = F.col("run").bitwiseAND(F.lit((1 << 8 * depth) - 1))
        return runs.groupBy(last.alias("run")).agg(F.sum("n").alias("n"))

    def ratio(a, b):
        return F.log10(a / b)

    top = level(1)  # at most 256 rows
    total = top.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t"), F.count_if(F.col("n") > 0).alias("d"))
    after = -F.log10(F.lit(256) - F.col("d"))
    held = top.crossJoin(F.broadcast(total)).select(
        "run", "n", "t", "d", after.alias("after"),
        F.when(F.col("n") > 0, ratio(F.col("n"), F.col("t") + F.col("d")))
        .when(F.col("t") > 0, ratio(F.col("d"), F.col("t") + F.col("d")) + after).otherwise(after).alias("start"))
    for depth in range(2, order + 2):
        own = level(depth) if depth <= order else runs
        below = held.select(F.col("run").alias("suffix"), *[F.col(c).alias(f"{c}1") for c in ("n", "t", "d", "after", "start")])
        both = own.withColumn("suffix", F.col("run").bitwiseAND(F.lit((1 << 8 * (depth - 1)) - 1))).join(below, "suffix")
        context = Window.partitionBy(F.shiftright("run", 8))
        seen = F.col("n") > 0
        both = both.select("*", F.sum("n").over(context).alias("t"), F.count_if(seen).over(context).alias("d"),
                           F.sum(F.when(seen, F.col("n1")).otherwise(0)).over(context).alias("excluded"))
        t, d = F.col("t1") - F.col("excluded"), F.col("d1") - F.col("d")  # of the shorter context, without this one's symbols
        after = F.when(seen, F.lit(None)).when(F.col("n1") > 0, ratio(F.col("n1"), t + d)).when(
            d > 0, ratio(d, t + d) + F.col("after1")).otherwise(F.col("after1"))
        both = both.withColumn("after", after)
        start = F.when(F.col("t") == 0, F.col("start1")).when(seen, ratio(F.col("n"), F.col("t") + F.col("d"))).otherwise(
            ratio(F.col("d"), F.col("t") + F.col("d")) + F.col("after"))
        held = both.withColumn("start", start)
    return held.select("range", "run", F.col("start").alias("log_p"))


def _priced(table: DataFrame, lengths: DataFrame, ranges: int) -> DataFrame:
    """``slice, range, values``: code length of every run of the slice, in order."""
    def run(key, group: pa.Table, model: pa.Table) -> pa.Table:
        run_of, log_p = model["run"].to_numpy(), model["log_p"].to_numpy()
        order = np.argsort(run_of)
        run_of, log_p = run_of[order], log_p[order]
        values = [_zip(log_p[np.searchsorted(run_of, _unpack(x).view(np.int64))]) for x in group["keys"].to_pylist()]
        return pa.table({"slice": group["slice"], "range": group["range"], "values": pa.array(values, pa.binary())})

    asked = _split(table, "runs", "run_times", ranges)
    return asked.groupBy("range").cogroup(lengths.groupBy("range")).applyInArrow(run, "slice long, range int, values binary")


def _gather(keys: np.ndarray, ranges: int, rows: list[tuple[int, bytes]], kind: str) -> np.ndarray:
    """Values of a slice's sorted keys from its rows (range, packed values)."""
    out, of = np.empty(len(keys), kind), _range(keys, ranges)
    for r, values in rows:
        out[of == r] = _unzip(values, kind)
    return out


def ppm_scores(docs: DataFrame, train: Column, order: int = ORDER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, n_known, train_tokens, base_score, score`` of every row; those with ``train`` teach.

    ``score`` is the base 10 logarithm of the text's probability in the trie,
    ``base_score`` the sum over its words and one end of their smoothed unigram
    logarithms.
    """
    if not 1 <= order <= 5:
        raise ValueError("a run of order + 1 bytes and its flag must fit a long: order is 1 to 5")
    ship(docs.sparkSession)
    table = _slices(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), train.alias("train")), order)
    total = table.agg(F.sum("n_runs"), F.sum("n_words"), F.sum("tokens")).first()
    run_ranges, word_ranges = (max(1, -(-(total[c] or 0) // ENTRIES)) for c in (0, 1))
    words = cut_lineage(_count_words(table, word_ranges))
    n_train, known = int(total[2] or 0), int(words.agg(F.sum("known")).first()[0] or 0)
    runs = cut_lineage(_count_runs(table, run_ranges))
    priced = _priced(table, code_lengths(runs, order), run_ranges)

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        own = next(r for r in rows if r["kind"] == 0)
        lens = np.array(own["lens"], np.int64)
        offs = np.concatenate([[0], np.cumsum(lens)])
        lower = tv._LOWER[np.frombuffer(zstandard.decompress(own["texts"]), np.uint8)] if offs[-1] else np.zeros(0, np.uint8)
        key = _unpack(own["runs"])
        value = _gather(key, run_ranges, [(r["range"], r["values"]) for r in rows if r["kind"] == 2], "<f8")
        score = np.zeros(len(lens))
        for pieces in _segments(lens):
            found, piece = _runs(lower, offs, pieces, order)
            found = np.sort((found << _U(16)) | piece.astype(np.uint64))  # runs of six bytes, 65,536 pieces at most
            piece = (found & _U(0xFFFF)).astype(np.int64)
            found >>= _U(16)
            first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
            price = value[np.searchsorted(key, found[first])]
            got = np.bincount(piece, np.repeat(price, np.diff(first, append=len(found))), minlength=len(pieces))
            np.add.at(score, [p[0] for p in pieces], got)
        key = _unpack(own["words"])
        count = _gather(key, word_ranges, [(r["range"], r["values"]) for r in rows if r["kind"] == 1], "<i8")
        log_p = np.log10((count + 0.5) / (n_train + 0.5 * (known + 1)))
        n = len(lens)
        tokens, taught, base = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
        for token, doc in _tokens(lower, offs):
            at = np.searchsorted(key, token)
            a, b = doc.min(), doc.max() + 1
            for out, weight in ((tokens, None), (taught, count[at] > 0), (base, log_p[at])):
                out[a:b] += np.bincount(doc - a, weight, minlength=b - a).astype(out.dtype)
        return pa.table({
            "doc_id": pa.array(own["ids"], pa.int64()), "n_bytes": pa.array(lens), "n_tokens": pa.array(tokens), "n_known": pa.array(taught),
            "train_tokens": pa.array(np.full(n, n_train, np.int64)),
            "base_score": pa.array(base), "score": pa.array(score)})

    columns = ("range", "values", "ids", "lens", "texts", "runs", "words")
    rows = [table.withColumns({"kind": F.lit(0), "range": F.lit(None).cast("int"), "values": F.lit(None).cast("binary")})]
    for kind, part in ((1, words), (2, priced)):
        empty = {c: F.lit(None).cast(table.schema[c].dataType) for c in columns[2:]}
        rows.append(part.withColumns({"kind": F.lit(kind), **empty}))
    rows = [r.select("slice", "kind", *columns) for r in rows]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy("slice").applyInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


# ---------------------------------------------------------------- adaptive

class Trie:
    """A byte-context trie of one document: for each context the counts of its symbols."""

    def __init__(self, order: int):
        self.order, self.nodes = order, {}

    def log_p(self, context: bytes, symbol: int) -> float:
        """Base 10 logarithm of the symbol's probability behind the context."""
        excluded, out = frozenset(), 0.0
        for n in range(len(context), -1, -1):
            counts = self.nodes.get(context[len(context) - n:])
            if not counts:
                continue
            live = {s: c for s, c in counts.items() if s not in excluded}
            if live:
                total = sum(live.values()) + len(live)
                if symbol in live:
                    return out + math.log10(live[symbol] / total)
                out += math.log10(len(live) / total)
            excluded = counts.keys()
        return out - math.log10(256 - len(excluded))

    def learn(self, context: bytes, symbol: int) -> None:
        for n in range(len(context) + 1):
            counts = self.nodes.setdefault(context[len(context) - n:], {})
            counts[symbol] = counts.get(symbol, 0) + 1


def adaptive_log_p(text: bytes, order: int = ORDER) -> float:
    """Base 10 logarithm of a text's probability in a trie that starts empty and learns from each byte."""
    trie, held, total = Trie(order), bytes([PAD]) * order + text.translate(tv._LOWER.tobytes()) + bytes([END]), 0.0
    for i in range(order, len(held)):
        total += trie.log_p(held[i - order:i], held[i])
        trie.learn(held[i - order:i], held[i])
    return total


def adaptive_scores(docs: DataFrame, order: int = ORDER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, score`` of every row, each by a trie of its own (memory and time grow with the text)."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                                              pa.array([adaptive_log_p(t, order) for t in texts], pa.float64())], ["doc_id", "n_bytes", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, score double")
