"""Exact near-duplicate classes: Jaccard similarity of word shingle sets, joined in prefix trees.

Candidates.  A document's set is the distinct ``size``-word shingles of its whole
text, as 64-bit hashes.  If two sets reach the threshold ``t``, the first
``|x| - ceil(t |x|) + l(x)`` hashes of each (``region``; ``l(x)`` a quarter of ``|x|``) share at
least ``l`` tokens.  The regions of a slice of documents are one row of a table
written once.  Tokens are counted per slice before the shuffle, by hash range,
so a token of a third of all documents arrives once per slice; only tokens of two
or more documents go back.  Within its region a set then needs a partner among its
rarest tokens (prefix filter, ascending document frequency): each of those that
others have too is a posting, and sets with a common posting are in one block.
Equal sets are one set from here on.

Order.  The tokens of all sets that have a block are counted over those sets, in
slices as above; every set is stored in that global order, rarest token first.

Join.  A block of bounded size is one chunk; a larger one is cut into chunks, sets
with the same least neighbour together.  One task holds the sets of a chunk in a
prefix tree (``trie``) and links them.  What is left are links between the chunks of
a large block, and those share a posting: in a few rounds one set per class and
posting is compared with the posting's first (a class is what is linked so far), which
joins the parts of large groups of copies.  Postings that still hold several classes
are joined in trees of their own, postings with the same members once; only a single
posting with more members than a chunk is met part by part.  So no step holds a
block, nothing is capped, and every link counts.

Defined results: a text with fewer words is one shingle of all of them; null text,
empty text and text without words have the empty set, which links with nothing;
rows with the same set are one class; ``component_id`` is the smallest ``doc_id``
of the class and of all that links reach (null only if all ids are null; for the
empty set the row's own); rows with equal ids are judged by their own text; an
empty table stays empty.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import cut_lineage, drop_table, free_names, ship
from .components import components

RANGE_TOKENS = 1_500_000   # tokens of one counting task
CHUNK_TOKENS = 1_500_000   # tokens and sets of one tree
CHUNK_SETS = 6_000
SLICE_BYTES = 8 << 20
SEGMENT_BYTES = 1 << 20
ROUNDS = 3                 # of comparing the classes of a posting by one set each


def _need(n, num: int, den: int):
    """Least overlap of a set of n with any similar set."""
    return -(-num * n // den)


def _reach(n):
    return np.maximum(1, n // 4)


def _pack(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of each token, in two planes."""
    return (tokens >> np.uint64(32)).astype("<u4").tobytes() + ((tokens >> np.uint64(16)) & np.uint64(0xFFFF)).astype("<u2").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    n = len(data) // 6
    return (np.frombuffer(data, "<u4", n).astype(np.uint64) << np.uint64(32)) | (
        np.frombuffer(data, "<u2", n, 4 * n).astype(np.uint64) << np.uint64(16))


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a sorted set."""
    if not len(s):
        return 0, 0
    a = int(tv.mix64(s).sum(dtype=np.uint64))
    b = int(tv.mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)) ^ len(s)
    return a - (1 << 64) * (a >> 63), b - (1 << 64) * (b >> 63)


def _shingles(column, size: int) -> list[np.ndarray]:
    """The shingle set of every row, about ``SEGMENT_BYTES`` of rows at a time."""
    _, offs = tv.column_bytes(column)
    out, a, rows = [], 0, len(offs) - 1
    while a < rows:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + SEGMENT_BYTES, side="right")) - 1)
        out.extend(tv.shingle_sets(column.slice(a, b - a), size))
        a = b
    return out


def _sets_table(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """One row per slice: per document id, text hash, set size and fingerprint; the regions of all, one after the other."""
    def run(batches):
        for batch in batches:
            _, offs = tv.column_bytes(batch.column(2))
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(offs, offs[a] + SLICE_BYTES, side="right")) - 1)
                part = batch.slice(a, b - a)
                sets = _shingles(part.column(2), size)
                n = np.array([len(s) for s in sets], np.int64)
                keep = np.where(n > 0, np.minimum(n, n - _need(n, num, den) + _reach(n)), 0)
                prints = [_fingerprint(s) for s in sets]
                tokens = np.concatenate([s[:k] for s, k in zip(sets, keep, strict=True)])
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([part.column(1).to_pylist()], pa.list_(pa.int64())),
                    pa.array([n.tolist()], pa.list_(pa.int64())), pa.array([[p[0] for p in prints]], pa.list_(pa.int64())),
                    pa.array([[p[1] for p in prints]], pa.list_(pa.int64())), pa.array([keep.tolist()], pa.list_(pa.int32())),
                    pa.array([_pack(tokens)], pa.binary())], ["ids", "keys", "n", "hi", "lo", "kept", "tokens"])
                a = b

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").cast("string").alias("text"))
    table = rows.mapInArrow(run, "ids array<long>, keys array<long>, n array<long>, hi array<long>, lo array<long>, kept array<int>, tokens binary")
    return cut_lineage(table.withColumn("slice", F.monotonically_increasing_id()))


def _upper(data: bytes) -> np.ndarray:
    """Whole tokens, their lowest 16 bits cleared as ``_pack`` does."""
    return np.frombuffer(data, "<u8") & ~np.uint64(0xFFFF)


def _shared(table: DataFrame, read=_unpack, width: int = 6) -> DataFrame:
    """``slice, tokens, counts``: the tokens of a slice that two or more documents hold, with their numbers of documents."""
    total = table.agg(F.sum(F.octet_length("tokens")).alias("b")).first().b or 0
    ranges = max(1, -(-int(total) // width // RANGE_TOKENS))

    def split(batches):
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                token, times = np.unique(read(data), return_counts=True)
                where = ((token >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                edges = np.searchsorted(where, np.arange(ranges + 1))
                full = [r for r in range(ranges) if edges[r + 1] > edges[r]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(full, pa.int32()), pa.array([at] * len(full), pa.int64()),
                    pa.array([_pack(token[edges[r]:edges[r + 1]]) for r in full], pa.binary()),
                    pa.array([np.minimum(times[edges[r]:edges[r + 1]], 65535).astype("<u2").tobytes() for r in full], pa.binary())],
                    ["range", "slice", "tokens", "counts"])

    def count(group: pa.Table) -> pa.Table:
        parts = [_unpack(x) for x in group["tokens"].to_pylist()]
        times = np.concatenate([np.frombuffer(x, "<u2") for x in group["counts"].to_pylist()]).astype(np.int64)
        every = np.concatenate(parts)
        token, back = np.unique(every, return_inverse=True)
        total = np.bincount(back, times).astype(np.int64)[back]
        ends = np.cumsum([len(p) for p in parts])
        rows = []
        for at, a, b in zip(group["slice"].to_pylist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            many = total[a:b] > 1
            if many.any():
                rows.append((at, _pack(every[a:b][many]), total[a:b][many].astype("<i8").tobytes()))
        return pa.table({"slice": pa.array([r[0] for r in rows], pa.int64()), "tokens": pa.array([r[1] for r in rows], pa.binary()),
                         "counts": pa.array([r[2] for r in rows], pa.binary())})

    blobs = table.select("slice", "tokens").mapInArrow(split, "range int, slice long, tokens binary, counts binary")
    return blobs.groupBy("range").applyInArrow(count, "slice long, tokens binary, counts binary")


def _each(batch) -> Iterator[dict]:
    """Rows of a batch, one at a time: a row is a slice of some megabytes."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def _postings(table: DataFrame, num: int, den: int) -> DataFrame:
    """``token, node`` of the rarest shared tokens of every set that may have a partner; ``node`` is 64 bits of its fingerprint."""
    def run(batches):
        for batch in batches:
            for row in _each(batch):
                n, kept = np.array(row["n"], np.int64), np.array(row["kept"], np.int64)
                tokens = _unpack(row["tokens"])
                token = np.concatenate([_unpack(x["tokens"]) for x in row["shared"]])
                count = np.concatenate([np.frombuffer(x["counts"], "<i8") for x in row["shared"]])
                order = np.argsort(token)
                token, count = token[order], count[order]
                at = np.minimum(np.searchsorted(token, tokens), len(token) - 1)
                times = np.where(token[at] == tokens, count[at], 1)
                begin = np.concatenate([[0], np.cumsum(kept)])
                least = _reach(_need(n, num, den))   # l() of the smallest possible partner
                nodes, posts, seen = [], [], set()
                for i in range(len(n)):
                    if not kept[i] or (row["hi"][i], row["lo"][i]) in seen:
                        continue
                    seen.add((row["hi"][i], row["lo"][i]))
                    t = times[begin[i]:begin[i + 1]]
                    prefix, single = int(kept[i] - least[i] + 1), int(np.count_nonzero(t == 1))
                    if single < prefix:
                        own = tokens[begin[i]:begin[i + 1]]
                        posts.append(own[np.lexsort((own, t))[single:prefix]])
                        nodes.extend([row["lo"][i]] * len(posts[-1]))
                if posts:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(posts).view(np.int64)), pa.array(nodes, pa.int64())], ["token", "node"])

    shared = _shared(table).groupBy("slice").agg(F.collect_list(F.struct("tokens", "counts")).alias("shared"))
    rows = table.select("slice", "n", "hi", "lo", "kept", "tokens").join(shared, "slice")
    return rows.mapInArrow(run, "token long, node long")


def _by_task(batches, keys: tuple[str, ...]):
    """Rows of each key (a partition sorted by its keys), as one list at a time."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != now and rows:
                yield now, rows
                rows = []
            now = key
            rows.append(row)
    if rows:
        yield now, rows


def _tree(rows: list[dict], num: int, den: int):
    from llm.trie import Group

    group = Group([np.frombuffer(r["tokens"], "<u8") for r in rows], num, den, [np.frombuffer(r["counts"], "<u4") for r in rows])
    return group, [rows[i] for i in group.order]


def _ordered(sets: DataFrame) -> DataFrame:
    """``sid, tokens, counts`` of all sets of the slices of ``sets``, rarest token first; ``counts`` over all these sets."""
    def run(batches):
        for batch in batches:
            for row in _each(batch):
                tokens = np.frombuffer(row["tokens"], "<u8")
                shared = row["shared"] or []
                token = np.concatenate([np.zeros(0, np.uint64), *(_unpack(x["tokens"]) for x in shared)])
                count = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x["counts"], "<i8") for x in shared)])
                order = np.argsort(token)
                token, count = np.append(token[order], np.uint64(0)), np.append(count[order], 1)
                upper = _upper(row["tokens"])
                at = np.searchsorted(token[:-1], upper)
                times = np.where(token[at] == upper, count[at], 1)
                ends = np.cumsum(row["n"]).tolist()
                out = []
                for a, b in zip([0, *ends[:-1]], ends, strict=True):
                    order = a + np.lexsort((tokens[a:b], times[a:b]))
                    out.append((tokens[order].tobytes(), times[order].astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(row["sids"], pa.int64()), *(pa.array([o[k] for o in out], pa.binary()) for k in range(2))],
                                                 ["sid", "tokens", "counts"])

    shared = _shared(sets, _upper, 8).groupBy("slice").agg(F.collect_list(F.struct("tokens", "counts")).alias("shared"))
    return sets.join(shared, "slice", "left").select("sids", "n", "tokens", "shared").mapInArrow(run, "sid long, tokens binary, counts binary")


def _linked(sets: DataFrame, posts: DataFrame, num: int, den: int) -> DataFrame:
    """``sid, label`` of every row of ``sets`` (``block, chunk, chunks, sid, node, tokens, counts``): equal labels for linked sets."""
    def chunks(batches):
        for _, rows in _by_task(batches, ("block", "chunk")):
            group, rows = _tree(rows, num, den)
            label = group.components()
            many = rows[0]["chunks"] > 1
            sid = [r["sid"] for r in rows]
            yield pa.RecordBatch.from_arrays([
                pa.array([r["chunk"] for r in rows], pa.int64()), pa.array(sid, pa.int64()), pa.array([r["node"] for r in rows], pa.int64()),
                pa.array([sid[i] for i in label], pa.int64()), *(pa.array([r[c] if many else None for r in rows], pa.binary()) for c in ("tokens", "counts"))],
                ["chunk", "sid", "node", "label", "tokens", "counts"])

    done = cut_lineage(sets.repartition("block", "chunk").sortWithinPartitions("block", "chunk").mapInArrow(
        chunks, "chunk long, sid long, node long, label long, tokens binary, counts binary"))
    live = done.where("tokens is not null")
    if not live.limit(1).count():  # every block was one chunk: no set has a partner elsewhere
        return done.select("sid", "label")
    edges = _across(live, posts, num, den)
    if edges is None:
        return done.select("sid", "label")
    last = components(edges)
    return done.select("sid", "label").join(last.select(F.col("node").alias("label"), "component"), "label", "left").select(
        "sid", F.coalesce("component", "label").alias("label"))


def _across(live: DataFrame, posts: DataFrame, num: int, den: int) -> DataFrame | None:
    """``a, b``: labels joined by links between the chunks of a block."""
    member = posts.join(live.select("node", "sid", "chunk", "label"), "node").select("token", "sid", "chunk", "label")

    def open_postings(rows: DataFrame) -> DataFrame:
        mixed = rows.groupBy("token").agg(F.min("label").alias("l"), F.max("label").alias("m"), F.min("chunk").alias("c"), F.max("chunk").alias("d"))
        return cut_lineage(rows.join(mixed.where("l <> m and c <> d").select("token"), "token"))

    def similar(batches):
        for batch in batches:
            near = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                inter = len(np.intersect1d(x, y, assume_unique=True))
                near.append(den * inter >= num * (len(x) + len(y) - inter))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    member, edges = open_postings(member), None
    for r in range(ROUNDS):
        if not member.limit(1).count():
            return edges
        one = member.groupBy("token", "label").agg(F.min(F.struct(F.xxhash64("sid", F.lit(r)).alias("h"), "sid", "chunk")).alias("x"))
        first = one.groupBy("token").agg(F.min(F.struct("x", "label")).alias("y"))
        pairs = one.join(first, "token").where("label <> y.label and x.chunk <> y.x.chunk").select(
            F.col("label").alias("a"), F.col("y.label").alias("b"), F.col("x.sid").alias("left"), F.col("y.x.sid").alias("right")).distinct()
        pairs = pairs.join(live.select(F.col("sid").alias("left"), F.col("tokens").alias("x")), "left").join(
            live.select(F.col("sid").alias("right"), F.col("tokens").alias("y")), "right").where(
            F.least(F.octet_length("x"), F.octet_length("y")) * den >= F.greatest(F.octet_length("x"), F.octet_length("y")) * num)
        found = cut_lineage(pairs.select("a", "b", "x", "y").mapInArrow(similar, "a long, b long").distinct())
        if not found.limit(1).count():
            continue
        edges = found if edges is None else edges.unionByName(found)
        of = cut_lineage(components(found))
        member = open_postings(member.join(of.select(F.col("node").alias("label"), "component"), "label", "left").select(
            "token", "sid", "chunk", F.coalesce("component", "label").alias("label")))

    held = member.groupBy("token").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("sid")).alias("h"), F.bit_xor(F.xxhash64("sid", F.lit(1))).alias("k"))
    once = held.groupBy("m", "h", "k").agg(F.min("token").alias("token")).select("token", F.ceil(F.col("m") / CHUNK_SETS).cast("int").alias("parts"))
    cells = member.join(once, "token").withColumn("own", F.pmod(F.xxhash64("sid"), "parts").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = cells.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "sid", "label").join(
        live.select("sid", "tokens", "counts"), "sid")

    def meet(batches):
        for _, rows in _by_task(batches, ("token", "i", "j")):
            group, rows = _tree(rows, num, den)
            label = [r["label"] for r in rows]
            group.classes(np.unique(label, return_inverse=True)[1])
            out = []
            for x in range(len(rows)):
                for y, _ in group.probe(x, all_sets=False):
                    if group.label[x] != group.label[y]:
                        out.append((label[x], label[y]))
                        group.join(x, y)
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(2)], ["a", "b"])

    met = cut_lineage(cells.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(meet, "a long, b long").distinct())
    return met if edges is None else edges.unionByName(met)


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``; sets link from a similarity of ``num / den``."""
    return _classes(docs, size, num, den).select("doc_id", "n_shingles", "component_id")


def _classes(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """``near_duplicates`` with the hash of each row's text (``key``) and the least set of its class (``root``)."""
    ship(docs.sparkSession)
    table = _sets_table(docs, size, num, den)
    rows = table.select(F.explode(F.arrays_zip("ids", "keys", "n", "hi", "lo")).alias("r")).select(
        F.col("r.ids").alias("doc_id"), F.col("r.keys").alias("key"), F.col("r.n").alias("n"), F.col("r.hi").alias("hi"), F.col("r.lo").alias("lo"))
    every = cut_lineage(_postings(table, num, den))
    # a passage's tokens are in the same sets: of the postings with the same members one is enough
    held = every.groupBy("token").agg(F.min("node").alias("b"), F.max("node").alias("z"), F.count("*").cast("int").alias("m"),
                                      F.bit_xor(F.xxhash64("node")).alias("h")).where("b <> z")
    posts = cut_lineage(every.join(held.groupBy("b", "z", "m", "h").agg(F.min("token").alias("token")).select("token", "b"), "token"))
    drop_table(every)
    edges = posts.select(F.col("node").alias("a"), "b").where("a <> b").distinct()
    blocks = components(edges).withColumnRenamed("component", "block")

    # one row per distinct set of a block, with a document that has it
    sets = rows.where("n > 0").join(blocks, F.col("lo") == F.col("node")).groupBy("hi", "lo", "n", "block").agg(
        F.min(F.struct("doc_id", "key")).alias("of"))
    sets = cut_lineage(sets.select("hi", "lo", "n", "block", "of.doc_id", "of.key").withColumn("sid", F.monotonically_increasing_id()))
    chunks = sets.groupBy("block").agg(F.ceil(F.greatest(F.sum("n") / CHUNK_TOKENS, F.count("*") / CHUNK_SETS)).cast("int").alias("chunks"),
                                       F.count("*").alias("m")).where("m > 1").drop("m")
    # sets of a large block go with their least neighbour; a neighbour with more than a chunk has chunks of its own
    least = edges.groupBy("a").agg(F.min("b").alias("lead"))
    placed = sets.join(chunks, "block").join(least, F.col("lo") == F.col("a"), "left").withColumn("lead", F.coalesce("lead", "lo")).drop("a")
    leads = placed.where("chunks > 1").groupBy("block", "lead").agg(
        F.ceil(F.greatest(F.sum("n") / CHUNK_TOKENS, F.count("*") / CHUNK_SETS)).cast("int").alias("own")).where("own > 1")
    placed = placed.join(leads, ["block", "lead"], "left").select(
        "block", "chunks", F.when(F.col("chunks") == 1, F.lit(0)).when(F.col("own") > 1, F.xxhash64("lead", F.pmod(F.xxhash64("sid"), "own")))
        .otherwise(F.pmod(F.xxhash64("lead"), 2 * F.col("chunks"))).alias("chunk"), "sid", "hi", "lo", F.col("doc_id").alias("id"), "key")
    placed = cut_lineage(placed)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").cast("string").alias("text"))
    # never a broadcast: the sets with a block grow with the documents
    found = texts.join(placed.hint("merge"), (texts.key == placed.key) & texts.doc_id.eqNullSafe(placed.id)).select("sid", "hi", "lo", "text")

    def again(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                got = _shingles(part.column(3), size)
                rows = [(i, s) for i, h, w, s in zip(*(part.column(k).to_pylist() for k in range(3)), got, strict=True) if _fingerprint(s) == (h, w)]
                if rows:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([[r[0] for r in rows]], pa.list_(pa.int64())), pa.array([[len(r[1]) for r in rows]], pa.list_(pa.int64())),
                        pa.array([np.concatenate([r[1] for r in rows]).astype("<u8").tobytes()], pa.binary())], ["sids", "n", "tokens"])

    slices = cut_lineage(found.mapInArrow(again, "sids array<long>, n array<long>, tokens binary").withColumn("slice", F.monotonically_increasing_id()))
    whole = placed.select("block", "chunk", "chunks", "sid", F.col("lo").alias("node")).join(_ordered(slices), "sid")
    linked = _linked(whole, posts, num, den)
    label = linked.groupBy("sid").agg(F.min("label").alias("label"))
    classes = cut_lineage(rows.where("n > 0").groupBy("hi", "lo").agg(F.min("doc_id").alias("least")))
    member = classes.join(sets.select("hi", "lo", "sid").join(label, "sid"), ["hi", "lo"])
    of_label = member.groupBy("label").agg(F.min("least").alias("component"), F.min(F.struct("hi", "lo")).alias("root"))
    of_class = cut_lineage(member.join(of_label, "label").select("hi", "lo", "component", "root"))
    for used in (posts, slices):
        drop_table(used)
    named = cut_lineage(classes.join(of_class, ["hi", "lo"], "left").select(
        "hi", "lo", F.coalesce("component", "least").alias("component"), F.coalesce("root", F.struct("hi", "lo")).alias("root")))
    return rows.join(named, ["hi", "lo"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        "key", "root")


def keep_one(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class one row of its smallest id (a null one counts as the
    largest; of several texts under that id, that of the smallest hash); every row with the empty set stays."""
    key, own, text_hash = free_names(docs, "key", "own", "text_hash")
    found = cut_lineage(_classes(docs, size, num, den))
    rows = docs.withColumn(key, F.xxhash64("text"))

    def of(chosen: DataFrame) -> DataFrame:
        chosen = chosen.select(F.col("doc_id").alias(own), F.col("key").alias(text_hash))
        return rows.join(chosen, (F.col(key) == F.col(text_hash)) & F.col("doc_id").cast("long").eqNullSafe(F.col(own)))

    least = found.where("n_shingles > 0").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key")).alias("r"))
    once = of(least.select("r.doc_id", "r.key")).dropDuplicates([own, key])
    return once.unionByName(of(found.where("n_shingles = 0").select("doc_id", "key").distinct())).select(*docs.columns)
