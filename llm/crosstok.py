"""Alignment of two tokenizers: byte overlaps and shared groups as products of sparse incidence matrices.

A is a byte-level merge vocabulary, B a piece vocabulary with byte fallback; both
encode a blank and then the text.  A token covers a range of bytes.  The incidence
matrices are in compressed sparse rows built by hand (``Csr``): tokens by bytes, and
tokens by groups, where the byte offsets at which tokens of both end cut the text
into groups.  A product row is made as Gustavson does it: for every entry (i, k) of
the left matrix, row k of the right one, scaled, is added to row i.  Tokens by
bytes, A times B transposed, gives the overlap links with their shared bytes;
tokens by groups gives the shared-group links.

No token crosses the border between a character that is no white space and a
blank, in either vocabulary, so such borders cut texts into chunks that are encoded,
cut into groups and linked by themselves.  A slice of documents does that for its
distinct chunks, all in one matrix; a document is a list of chunk numbers.  In the
group matrices a row is an id of a chunk (its equal tokens in one row, with counts),
so a product's entry is the number of links of an id pair.  A pair's documents are
counted per slice, then summed by Spark; the sums and whether they are the highest of
their A id go back to the slices, where they are added up per document.

Defined results: text that is null or empty, or whose joined token bytes differ
from the blank and the text in A or in B, has no tokens: zeros, and an empty
``groups_sha256``; rows with equal or null ids are treated one by one; an empty table
stays empty.  Texts are read whole, in stretches of chunks.  Other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, ship

SLICE = 8 << 20          # characters of one slice
STRETCH = 1 << 20        # characters of a text cut at once
BLOCK = 1 << 15          # characters encoded in one call
CHUNKS = 30_000          # chunks linked at once
EXPAND = 4_000_000       # products of entries held at once

_BORDER = re.compile(r"(?<=\S)(?= )")
_INNER = re.compile(r"\s(?= )|\s$")  # white space that keeps a text from a plain split at blanks
# Characters whose classes all versions of the split rule agree on.
_PLAIN = re.compile("[\x00-\u024f]*")


# ---------------------------------------------------------------- sparse matrices

@dataclass
class Csr:
    """Compressed sparse rows: the entries of row i are ``start[i]`` to ``start[i + 1]``."""

    start: np.ndarray
    column: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int) -> Csr:
        """From entries in any order, no two at one place."""
        order = np.lexsort((column, row))
        return Csr(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]), column[order], value[order])

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))

    def transposed(self, columns: int) -> Csr:
        return Csr.of(self.column, self.rows(), self.value, columns)

    def times(self, right: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, column, value) of the product, by rows; a bounded number of scaled rows is held at once."""
        width = np.diff(right.start)[self.column] if len(self.column) else np.zeros(0, np.int64)
        upto = np.concatenate([[0], np.cumsum(width)])
        out, i, rows = [], 0, len(self.start) - 1
        while i < rows:
            j = int(np.searchsorted(upto[self.start], upto[self.start[i]] + EXPAND, side="right")) - 1
            j = min(max(j, i + 1), rows)
            a, b = int(self.start[i]), int(self.start[j])
            n = width[a:b]
            entry = np.repeat(np.arange(a, b), n)
            at = np.arange(len(entry)) - np.repeat(upto[a:b] - upto[a], n) + right.start[self.column[entry]]
            row = np.repeat(np.arange(i, j), np.diff(self.start[i:j + 1]))[entry - a]
            value = self.value[entry] * right.value[at]
            out.append(_summed(row, right.column[at], value))
            i = j
        return tuple(np.concatenate([np.zeros(0, np.int64), *(o[c] for o in out)]) for c in range(3))


def _summed(row: np.ndarray, column: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries at one place added up, in order of row and column."""
    if not len(row):
        return row, column, value
    wide = int(column.max()) + 1
    key = row * wide + column
    if (key[1:] > key[:-1]).all():
        return row, column, value
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first] // wide, key[first] % wide, np.add.reduceat(value[order], first)


def byte_incidence(ends: np.ndarray) -> Csr:
    """Tokens by bytes, of tokens that follow one another and end at ``ends``."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]).astype(np.int64), np.arange(n), np.ones(n, np.int64))


def overlap_links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, bytes that both cover), from A times B transposed over bytes."""
    total = int(ends_a[-1]) if len(ends_a) else 0
    return byte_incidence(ends_a).times(byte_incidence(ends_b).transposed(total))


def group_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Byte offsets where a token of A and one of B both end."""
    return np.intersect1d(ends_a, ends_b, assume_unique=True)


def _by_id(row_key: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, Csr]:
    """(distinct row keys, their counts by groups)."""
    keys, row = np.unique(row_key, return_inverse=True)
    row, group, times = _summed(row.astype(np.int64), group.astype(np.int64), np.ones(len(row), np.int64)) if len(row) else (row, group, row)
    return keys, Csr.of(row, group, times, len(keys))


# ---------------------------------------------------------------- encoders

class ByteLevel:
    """A byte-level merge vocabulary: tokens with their bytes."""

    def __init__(self, path: str, ranks_path: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = True
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # fixed values: bytes that stand for themselves
        letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        size = self._whole.get_vocab_size()
        self.bytes = [bytes(letters[c] for c in t) if (t := self._whole.id_to_token(i) or "") and all(c in letters for c in t) else t.encode()
                      for i in range(size)]
        self._plain = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self._plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> list[int]:
        if self._plain is not None and _PLAIN.fullmatch(text):
            return self._plain(text)
        return self._whole.encode(text, add_special_tokens=False).ids


class Pieces:
    """A piece vocabulary that puts a blank before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._whole = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self._whole.get_piece_size()):
            p = self._whole.id_to_piece(i)
            self.bytes.append(bytes([int(p[3:5], 16)]) if self._whole.is_byte(i) else p.replace("▁", " ").encode())

    def encode(self, text: str) -> list[int]:
        """``text`` begins with the blank."""
        return self._whole.encode(text[1:])


_OPEN: dict[tuple, tuple] = {}


def _encoders(paths: tuple) -> tuple:
    """The two encoders of the vocabulary files with their token sizes, one set for each Python worker."""
    if paths not in _OPEN:
        made = ByteLevel(*paths[:3]), Pieces(paths[3])
        names = [b"%d%s" % (i, mark) for e in made for i in range(len(e.bytes)) for mark in (b",", b"|", b";", b"")]
        _OPEN[paths] = (*((e, np.array([len(b) for b in e.bytes], np.int64)) for e in made), (names, np.array([len(x) for x in names])))
    return _OPEN[paths]


def chunks(text: str) -> list[str]:
    """``text``, which begins with a blank, cut before blanks that follow no white space; white space at the end stays with the last chunk."""
    if _INNER.search(text) is None:
        return [" " + p for p in text[1:].split(" ")]
    parts = _BORDER.split(text)
    if len(parts) > 1 and not parts[-1].strip():
        last = parts.pop()
        parts[-1] += last
    return parts


def _stretches(text: str):
    """The blank and the text, cut at chunk borders into stretches of about ``STRETCH`` characters."""
    text, at = " " + text, 0
    while at < len(text):
        stop = min(len(text), at + STRETCH)
        while stop < len(text):
            stop = text.find(" ", stop)
            if stop < 0:
                stop = len(text)
            elif text[stop - 1].isspace() or not text[stop:stop + STRETCH].strip():
                stop += 1
            else:
                break
        yield text[at:stop]
        at = stop


def _encoded(texts: list[str], raw: list[bytes], encoder, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, tokens of each text, whether its joined token bytes are its own) of chunks (``raw``: in UTF-8); regular ones are encoded in long runs."""
    ids: list[np.ndarray] = []
    counts = np.zeros(len(texts), np.int64)
    good = np.ones(len(texts), bool)
    borders = np.cumsum([0, *map(len, raw)])
    single = [i for i, t in enumerate(texts) if t[-1].isspace()]
    cuts = np.unique(np.concatenate([[0, len(texts)], single, [i + 1 for i in single], np.searchsorted(borders, np.arange(0, borders[-1], BLOCK))]).astype(int)).tolist()
    todo = list(zip(cuts[:-1], cuts[1:], strict=True))[::-1]
    while todo:
        a, b = todo.pop()
        got = np.array(encoder.encode("".join(texts[a:b])), np.int64)
        if b"".join(map(encoder.bytes.__getitem__, got.tolist())) == b"".join(raw[a:b]):
            ends = np.concatenate([[0], np.cumsum(sizes[got])])
            own = borders[a:b + 1] - borders[a]
            at = np.searchsorted(ends, own)
            if (ends[at] == own).all():
                ids.append(got)
                counts[a:b] = np.diff(at)
                continue
        if b - a > 1:  # a chunk that does not come back: find it
            todo.extend([((a + b) // 2, b), (a, (a + b) // 2)])
        else:
            good[a] = False
    return np.concatenate([np.zeros(0, np.int64), *ids]), counts, good


# ---------------------------------------------------------------- slices

class _Numbered(dict):
    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def _linked_chunks(texts: list[str], paths: tuple) -> dict:
    """Of every chunk: tokens, groups, links, overlaps and the text of its groups; of all, the id pairs by chunk."""
    parts = [_linked_block(texts[a:a + CHUNKS], paths, a) for a in range(0, len(texts), CHUNKS)] or [_linked_block([], paths, 0)]
    out = {k: np.concatenate([p[k] for p in parts]) for k in parts[0] if k != "groups"}
    return out | {"groups": [g for p in parts for g in p["groups"]]}


def _linked_block(texts: list[str], paths: tuple, offset: int) -> dict:
    (enc_a, size_a), (enc_b, size_b), (names, sizes) = _encoders(paths)  # names: ids of A, then of B, with each mark behind them
    raw = [t.encode() for t in texts]
    (ids_a, n_a, good_a), (ids_b, n_b, good_b) = _encoded(texts, raw, enc_a, size_a), _encoded(texts, raw, enc_b, size_b)
    good = good_a & good_b
    n = len(texts)
    keep_a, keep_b = np.repeat(good[good_a], n_a[good_a]), np.repeat(good[good_b], n_b[good_b])
    ids_a, ids_b, n_a, n_b = ids_a[keep_a], ids_b[keep_b], np.where(good, n_a, 0), np.where(good, n_b, 0)
    ends_a, ends_b = np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b])
    ends = group_ends(ends_a, ends_b)
    group_a, group_b = np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)
    chunk_a, chunk_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
    last_a, last_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0  # of a group
    chunk_of_group = chunk_a[last_a]

    rows_a, by_group_a = _by_id(chunk_a << 32 | ids_a, group_a, len(ends))
    rows_b, by_group_b = _by_id(chunk_b << 32 | ids_b, group_b, len(ends))
    left, right, links = by_group_a.times(by_group_b.transposed(len(ends)))
    chunk = rows_a[left] >> 32
    pair = (rows_a[left] & 0xFFFFFFFF) << 32 | (rows_b[right] & 0xFFFFFFFF)
    over_a, _, _ = overlap_links(ends_a, ends_b)

    # the ids in the order of the groups' text, A before B, each with the mark behind it
    last_group = np.diff(chunk_of_group, append=-1) != 0  # of a chunk
    mark_a = np.where(last_a, 1, 0)
    mark_b = np.where(last_b, np.where(last_group[group_b], 3, 2), 0)
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    said = np.concatenate([4 * ids_a + mark_a, 4 * (ids_b + len(size_a)) + mark_b])[order]
    whole = b"".join(map(names.__getitem__, said.tolist()))
    upto = np.concatenate([[0], np.cumsum(sizes[said])])[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
    count = lambda c, w=None: np.bincount(c, w, minlength=n).astype(np.int64)
    return {"good": good, "n_a": n_a, "n_b": n_b, "n_groups": count(chunk_of_group), "n_links": count(chunk, links), "n_overlaps": count(chunk_a[over_a]),
            "groups": [whole[a:b] for a, b in zip(upto[:-1], upto[1:], strict=True)], "chunk": chunk + offset, "pair": pair, "links": links}


def _pack(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values, "<i8").tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<i8")


_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")
_SLICE = ("ids array<long>, " + ", ".join(f"{c} array<long>" for c in _COUNTS) + ", shas array<string>, "
          "held_start binary, held_chunk binary, held_times binary, chunk_start binary, chunk_pair binary, chunk_links binary, pairs array<long>, docs array<long>")


def _slice_row(ids: list, texts: list[str | None], paths: tuple) -> list:
    number = _Numbered()
    lists = [[np.array(list(map(number.__getitem__, chunks(s))), np.int32) for s in _stretches(t)] if t else [] for t in texts]
    made = _linked_chunks(list(number), paths)
    pairs, where = np.unique(made["pair"], return_inverse=True)
    by_pair = Csr.of(made["chunk"], where, made["links"], len(number))
    counts = {c: [] for c in _COUNTS}
    shas, held, docs = [], [], np.zeros(len(pairs), np.int64)
    size = np.diff(by_pair.start)
    for parts in lists:
        found, times = np.unique(np.concatenate([np.zeros(0, np.int32), *parts]), return_counts=True)
        if not len(found) or not made["good"][found].all():
            found, times, parts = found[:0], times[:0], []
        sha = hashlib.sha256()
        for i, part in enumerate(parts):
            sha.update((b";" if i else b"") + b";".join(map(made["groups"].__getitem__, part.tolist())))
        shas.append(sha.hexdigest() if parts else "")
        for c in _COUNTS:
            counts[c].append(int(made[c][found] @ times))
        held.append((found, times))
        n = size[found]
        entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(by_pair.start[found], n)
        docs[np.unique(by_pair.column[entry])] += 1
    start = np.cumsum([0, *(len(f) for f, _ in held)])
    join = lambda k: np.concatenate([np.zeros(0, np.int64), *(h[k] for h in held)])
    some = docs > 0  # pairs of chunks that only texts without tokens hold are no links
    place = np.cumsum(some) - 1
    column, links = by_pair.column, by_pair.value
    live = some[column] if len(column) else np.zeros(0, bool)
    chunk_start = np.concatenate([[0], np.cumsum(np.bincount(by_pair.rows()[live], minlength=len(number)))])
    return [ids, *(counts[c] for c in _COUNTS), shas, _pack(start), _pack(join(0)), _pack(join(1)), _pack(chunk_start), _pack(place[column[live]]),
            _pack(links[live]), pairs[some], docs[some]]


def _slices(docs: DataFrame, paths: tuple) -> DataFrame:
    names = [c.split()[0] for c in _SLICE.split(", ")]

    def row(ids, texts):
        v = _slice_row(ids, texts, paths)
        kinds = [*[pa.list_(pa.int64())] * 6, pa.list_(pa.string()), *[pa.binary()] * 6, *[pa.list_(pa.int64())] * 2]
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(v, kinds, strict=True)], names)

    def run(batches):
        ids, texts, size = [], [], 0
        for batch in batches:
            for at, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(at)
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size >= SLICE:
                    yield row(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield row(ids, texts)

    return cut_lineage(docs.mapInArrow(run, _SLICE).withColumn("slice", F.monotonically_increasing_id()))


def align(docs: DataFrame, a_path: str, b_path: str, a_ranks: str | None = None, a_pattern: str | None = None,
          doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, id pairs).

    Documents: ``doc_id``, tokens ``n_a`` and ``n_b``, ``n_groups``, ``n_links`` (shared group),
    ``n_overlaps`` (shared bytes), ``n_best`` (links whose pair is in as many documents as
    any pair of its A id), ``count_sum`` (documents of the pair, over links) and
    ``groups_sha256``.  Pairs: ``a, b, docs, best``.  ``a_ranks`` and ``a_pattern`` name the
    same vocabulary as ranks, which encodes plain text faster.
    """
    ship(docs.sparkSession)
    table = _slices(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")),
                    (a_path, a_ranks, a_pattern, b_path))
    asked = table.select(F.col("slice").alias("of"), F.explode(F.arrays_zip("pairs", "docs")).alias("p")).select(
        "of", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    counted = cut_lineage(asked.groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a", F.shiftright("pair", 32)))
    highest = counted.groupBy("a").agg(F.max("docs").alias("most"))
    counted = counted.join(highest, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    answer = asked.select("of", "pair").join(counted, "pair")

    def run(key, own: pa.Table, answers: pa.Table) -> pa.Table:
        rows = own.to_pylist()[0]
        pair = answers["pair"].to_numpy()
        order = np.argsort(pair)  # as the slice's sorted pairs
        docs_of, best = answers["docs"].to_numpy()[order], answers["best"].to_numpy()[order].astype(np.int64)
        start, at, links = _unpack(rows["chunk_start"]), _unpack(rows["chunk_pair"]), _unpack(rows["chunk_links"])
        per_chunk = lambda v: np.diff(np.concatenate([[0], np.cumsum(links * v[at])])[start]) if len(at) else np.zeros(len(start) - 1, np.int64)
        held_start, held, times = _unpack(rows["held_start"]), _unpack(rows["held_chunk"]), _unpack(rows["held_times"])
        per_doc = lambda v: np.diff(np.concatenate([[0], np.cumsum(times * v[held])])[held_start])
        got = [pa.array(rows["ids"], pa.int64()), *(pa.array(rows[c], pa.int64()) for c in _COUNTS), pa.array(per_doc(per_chunk(best)), pa.int64()),
               pa.array(per_doc(per_chunk(docs_of)), pa.int64()), pa.array(rows["shas"], pa.string())]
        return pa.table(got, ["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    slim = table.drop("pairs", "docs")
    out = slim.groupBy("slice").cogroup(answer.groupBy("of")).applyInArrow(
        run, "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", n_best long, count_sum long, groups_sha256 string")
    pairs = counted.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), "docs", "best")
    return out, pairs
