import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import llm.jaccard as J
from llm.components import components
from llm.trie import Group

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    """Counter of (doc_id, n_shingles, component_id) by comparing every pair that shares a shingle."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for i, s in enumerate(sets):
        for j, inter in Counter(j for g in s for j in holders[g]).items():
            if j < i and 100 * inter >= 80 * (len(s) + len(sets[j]) - inter):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return Counter((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(docs))


def got(df):
    return Counter(tuple(r) for r in J.near_duplicates(df).collect())


def documents():
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdef"), 3))
    passage = [word() for _ in range(60)]
    docs = []
    for base in range(12):
        text = [word() for _ in range(int(rng.integers(8, 220)))] + passage * int(rng.integers(0, 2))
        for _ in range(int(rng.integers(1, 14))):
            t = list(text)
            for _ in range(int(rng.integers(0, 6))):
                t[int(rng.integers(len(t)))] = word()
            docs.append(" ".join(t))
    docs += [None, "", " \n", "one", "ONE", "a b c d", "A b\tc  d", "a b c d e", "x" * 100_000, "w " * 30_000]
    rows = [(i, t) for i, t in enumerate(docs)]
    return [*rows, (None, docs[0]), (None, "lonely words of no other text here"), (3, docs[3]), (5, "other text than before under this id")]


def test_equals_brute_force(spark, frame):
    docs = documents()
    assert got(frame([(*d, 1, "x") for d in docs], "doc_id long, text string, n int, tokens string")) == brute(docs)


def test_many_chunks_tiles_and_members(spark, frame, monkeypatch):
    monkeypatch.setattr(J, "CHUNK_SETS", 3)
    monkeypatch.setattr(J, "RANGE_TOKENS", 500)
    monkeypatch.setattr(J, "SLICE_BYTES", 4000)
    docs = documents()
    assert got(frame(docs, "doc_id long, text string")) == brute(docs)


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert got(df) == want
    kept = {r.doc_id for r in J.keep_one(df).collect()}
    assert kept == {d for d, _, c in want if d == c}


def test_keep_one_and_empty_table(spark, frame):
    rows = [(1, None, "n"), (1, None, "n"), (2, "a b c d e f", "n"), (2, "a b c d e f", "n"), (3, "A b c d e f", None), (None, "a b c d e f", "m")]
    out = J.keep_one(frame(rows, "doc_id long, text string, block string"))
    assert out.columns == ["doc_id", "text", "block"]
    assert sorted(r.doc_id for r in out.collect()) == [1, 1, 2]
    assert J.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_keep_one_leaves_clashing_columns(spark, frame):
    rows = [(1, "a b c d e f", "k1", "i1", "s1", "x"), (2, "A b c d e f", "k2", "i2", "s2", "y"), (3, "", "k3", "i3", "s3", "z")]
    out = J.keep_one(frame(rows, "doc_id long, text string, key string, id string, some string, __key string"))
    assert sorted(tuple(r) for r in out.collect()) == [rows[0], rows[2]]


def test_tree_grows_below_the_square_on_unlinked_sets():
    """Shingles over a small vocabulary, and sets with 70 % of their tokens in common: no link, few comparisons."""
    rng = np.random.default_rng(4)
    common = rng.integers(0, 1 << 62, 140).astype(np.uint64)
    template = [np.unique(np.concatenate([common, rng.integers(0, 1 << 62, 60).astype(np.uint64)])) for _ in range(800)]
    group = Group(template)
    compared = []
    real = group._overlaps
    group._overlaps = lambda sets: compared.append(len(sets)) or real(sets)
    assert len(set(group.components().tolist())) == 800 and sum(compared) < 8 * 800


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {(r.node, r.component) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(x, find(x)) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_tree_finds_every_link(seed):
    rng = np.random.default_rng(seed)
    for _ in range(20):
        base = [rng.integers(0, 60, rng.integers(1, 30)) for _ in range(4)]
        sets = []
        for _ in range(int(rng.integers(1, 25))):
            b = base[rng.integers(4)].copy()
            b[rng.integers(0, len(b), 3)] = rng.integers(0, 60, 3)
            sets.append(np.unique(b).astype(np.uint64))
        group = Group(sets)
        s = [set(sets[i].tolist()) for i in group.order]
        for x in range(len(s)):
            want = {(y, len(s[x] & s[y])) for y in range(len(s)) if 100 * len(s[x] & s[y]) >= 80 * len(s[x] | s[y])}
            assert set(group.probe(x)) == want
