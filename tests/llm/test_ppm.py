import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import ppm

SCHEMA = "doc_id long, text string, teach boolean, slice long, kind int, run string"
LOWER = {c: c + 32 for c in range(65, 91)}


def symbols(text):
    return [0xFE] * 5 + list((text or "").translate(LOWER).encode()) + [0xFF]


def learn(counts, held, i):
    for n in range(6):
        counts.setdefault(tuple(held[i - n:i]), {}).setdefault(held[i], 0)
        counts[tuple(held[i - n:i])][held[i]] += 1


def cost(counts, held, i):
    """Logarithm of symbol ``i``, context by context, from the rules alone."""
    p, excluded = 1.0, set()
    for n in range(5, -1, -1):
        live = {s: c for s, c in counts.get(tuple(held[i - n:i]), {}).items() if s not in excluded}
        if not live:
            continue
        if held[i] in live:
            return math.log10(p * live[held[i]] / (sum(live.values()) + len(live)))
        p *= len(live) / (sum(live.values()) + len(live))
        excluded |= set(live)
    return math.log10(p / (256 - len(excluded)))


def plain(rows):
    counts, words, n = {}, {}, 0
    split = lambda t: [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))] + [None]
    for _, text, teach in rows:
        if teach:
            held = symbols(text)
            for i in range(5, len(held)):
                learn(counts, held, i)
            for w in split(text):
                words[w] = words.get(w, 0) + 1
                n += 1
    out = []
    for doc_id, text, _ in rows:
        held, tokens = symbols(text), split(text)
        base = sum(math.log10((words.get(w, 0) + 0.5) / (n + 0.5 * (len(words) + 1))) for w in tokens)
        out.append((doc_id, len(held) - 6, len(tokens), sum(w in words for w in tokens), n, base, sum(cost(counts, held, i) for i in range(5, len(held)))))
    return out


def check(frame, rows):
    df = frame([(*r, 3, 4, "x") for r in rows], SCHEMA)
    got = ppm.ppm_scores(df, F.col("teach"))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[6])
    got, want = sorted((tuple(r) for r in got.collect()), key=key), sorted(plain(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    np.testing.assert_allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)
    return got


def corpus(n, seed=1):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéß漢") for _ in range(r.randint(1, 6))) for _ in range(60)]
    return [(i, " ".join(r.choice(words).title() if r.random() < 0.1 else r.choice(words) for _ in range(r.randint(1, 60))), i % 5 != 1) for i in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_plain_version(frame, monkeypatch, small):
    if small:  # many slices and counting tasks
        monkeypatch.setattr(ppm, "SLICE", 300)
        monkeypatch.setattr(ppm, "ENTRIES", 500)
    check(frame, corpus(60))


def test_nulls_empty_long_and_repeated_rows(frame):
    rows = corpus(8) + [(100, None, True), (101, "", False), (102, "\n \t", True), (None, "abc abc", False), (None, None, None), (3, "other text", True),
                        (3, "other text", True), (103, "a" * 30_000, False), (104, "ab " * 9_000, True), (105, "\x00\U0001F600 zq", False)]
    check(frame, rows)


def test_nothing_taught_and_empty_table(frame):
    rows = [(1, "ab", False), (2, None, None)]
    got = check(frame, rows)
    assert [round(r[6], 9) for r in got] == [round(-3 * math.log10(256), 9), round(-math.log10(256), 9)]
    assert check(frame, []) == []


def test_more_training_text_shortens_held_out_code(frame):
    rows = corpus(80, 5)
    few = [(i, t, teach and i < 10) for i, t, teach in rows]
    score = lambda rs: sum(r.score for r in ppm.ppm_scores(frame([(*r, 1, 1, "") for r in rs], SCHEMA), F.col("teach")).collect() if r.doc_id % 5 == 1)
    assert score(rows) > score(few)


def test_pieces_of_a_long_text_keep_their_context(monkeypatch):
    texts = [b"hello world, hello there", b"", b"x" * 50, b"end"]
    data, lens = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts])
    offs = np.concatenate([[0], np.cumsum(lens)])
    def runs():
        out = []
        for pieces in ppm._segments(lens):
            run, piece = ppm._runs(data, offs, pieces, 5)
            out.extend((pieces[p][0], r) for r, p in zip(run.tolist(), piece.tolist(), strict=True))
        return out
    whole = runs()
    for size in (1, 2, 7, 20):
        monkeypatch.setattr(ppm, "SEGMENT", size)
        assert runs() == whole
    assert len(whole) == lens.sum() + 4


def test_adaptive(frame):
    texts = ["abracadabra", "", "Aaaa aaaa", None, "naïve café naïve café"]
    want = []
    for t in texts:
        counts, held, total = {}, symbols(t), 0.0
        for i in range(5, len(held)):
            total += cost(counts, held, i)
            learn(counts, held, i)
        want.append(total)
    got = ppm.adaptive_scores(frame([(i, t, True, 1, 1, "") for i, t in enumerate(texts)], SCHEMA)).orderBy("doc_id").collect()
    np.testing.assert_allclose([r.score for r in got], want, rtol=1e-9)


def test_probabilities_behind_a_context_add_up():
    trie, held = ppm.Trie(5), symbols("the theory of the thing then")
    for i in range(5, len(held)):
        trie.learn(bytes(held[i - 5:i]), held[i])
    for context in (b"of th", b" the ", b"zzzzz", b"\xfe\xfe\xfeth"):
        assert abs(sum(10 ** trie.log_p(context, s) for s in range(256)) - 1) < 1e-9
