"""Sum-of-squares online packing of tokenised documents into fixed windows.

Each Spark task packs the documents of its own input partition as they stream
by, so nothing is shuffled and memory holds one Arrow batch, the level array
and the ids of the windows still open.  A document longer than a window first
fills whole windows; its remainder is one item.  An item of size ``s`` goes to
the fill level ``h`` (0: a new window) that minimises the sum of squares of
``N[1..size-1]``, the numbers of open windows at each level; of equally good
levels the fullest is taken.  When the input ends, the windows still open are
closed: the emptiest ones are cut into the gaps of the fullest, so at most one
sequence of each partition keeps padding.

Defined results: null or empty text is the end id alone; rows with equal or
null ids are packed like any other; an empty table gives no pieces.  Other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

GROUP_CHARS = 2_000_000
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")


class LevelPacker:
    """Windows of ``size`` tokens; ``place`` returns the windows that it completes."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)  # open windows at each fill level
        self.at: dict[int, list[list]] = {}         # the windows themselves, by level

    def _level(self, s: int) -> int:
        """Fill level whose window takes ``s`` more tokens at the least sum of squares."""
        n, size = self.count, self.size
        before, after = n[:size - s + 1], n[s:]
        cost = 2 * (after - before) + 2
        cost[0] = 2 * n[s] + 1
        cost[-1] = 1 - 2 * before[-1]
        none = before == 0
        none[0] = False
        cost[none] = np.iinfo(np.int64).max
        return len(cost) - 1 - int(cost[::-1].argmin())

    def place(self, item: tuple, s: int) -> list | None:
        if s == self.size:
            return [(item, s)]
        h = self._level(s)
        if h:
            window = self.at[h].pop()
            self.count[h] -= 1
        else:
            window = []
        window.append((item, s))
        if h + s == self.size:
            return window
        self.at.setdefault(h + s, []).append(window)
        self.count[h + s] += 1
        return None

    def close(self) -> Iterator[list]:
        """Pour the emptiest open windows into the gaps of the fullest, cutting items."""
        rest = [(h, w) for h in sorted(self.at, reverse=True) for w in self.at[h]]
        self.at, lo, hi = {}, 0, len(rest) - 1
        while lo < hi:
            fill, window = rest[lo]
            while fill < self.size and lo < hi:
                donor_fill, donor = rest[hi]
                (key, ids, start), s = donor.pop()
                take = min(s, self.size - fill)
                window.append(((key, ids[:take], start), take))
                fill += take
                donor_fill -= take
                if take < s:
                    donor.append(((key, ids[take:], start + take), s - take))
                rest[hi] = (donor_fill, donor)
                if not donor:
                    hi -= 1
            if fill < self.size:
                rest[lo] = (fill, window)
                break
            yield window
            lo += 1
        if lo <= hi and rest[lo][1]:
            yield rest[lo][1]


def _pieces(window: list, sequence: int) -> Iterator[tuple]:
    at = 0
    for ((doc_id, total), ids, start), s in window:
        yield doc_id, start, s, ids.tobytes(), total, sequence, at
        at += s


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                                      schema=schema)


_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _encoded(batches, code, end_id: int) -> Iterator[tuple]:
    """(doc_id, ids with the end id) of every row; texts are encoded a few million characters at a time."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        group, chars = [], 0
        for i, text in enumerate(batch.column(1)):
            group.append(text.as_py() or "")
            chars += len(group[-1])
            if chars > GROUP_CHARS or i == len(ids) - 1:
                for doc_id, got in zip(ids[i - len(group) + 1:i + 1], code.encode(group), strict=True):
                    yield doc_id, np.append(got, np.uint32(end_id)).astype("<u4")
                group, chars = [], 0


def pack(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids`` (little-endian uint32), ``doc_tokens, sequence_id, offset``."""
    ship(docs.sparkSession)

    def run(batches):
        from llm.tokens import encoder

        code, packer, out = encoder(vocabulary), LevelPacker(size), []
        sequence = TaskContext.get().partitionId() << 33
        for doc_id, ids in _encoded(batches, code, end_id):
            key = (doc_id, len(ids))
            for start in range(0, len(ids), size):
                part = ids[start:start + size]
                done = packer.place((key, part, start), len(part))
                if done:
                    out.extend(_pieces(done, sequence))
                    sequence += 1
            if len(out) >= 4000:
                yield _batch(out, _ARROW)
                out = []
        for done in packer.close():
            out.extend(_pieces(done, sequence))
            sequence += 1
            if len(out) >= 4000:
                yield _batch(out, _ARROW)
                out = []
        if out:
            yield _batch(out, _ARROW)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, PIECES)
