import random
import re
import tracemalloc

from llm import decontam
from llm.decontam import ERROR, Q, contamination, decontaminate, index, matches

SF = "/root/testdata/sf0.001"


def norm(t):
    return re.sub(r"[\W_]+", " ", t.lower()).strip()


def least_edits(item, text):
    """Least edit distance of item to any part of text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        diag, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            diag, row[j] = row[j], min(diag + (c != d), row[j] + 1, row[j - 1] + 1)
    return min(row)


def edited(t, n, rng):
    t = list(t)
    for _ in range(n):
        i = rng.randrange(len(t))
        kind = rng.randrange(3)
        t[i:i + 1] = [[], [t[i], "q"], ["z"]][kind]
    return "".join(t)


def test_equals_full_alignment(spark, frame):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(["th", "an", "er", "on", "é"]) for _ in range(rng.randint(1, 3)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.randint(3, 25))) for i in range(8)] + [(50, None), (51, ""), (52, "short"), (53, "Größe 42, einmal!")]
    docs = []
    for i in range(40):
        x = items[i % 8][1]
        docs.append((i, text(20) + ". " + edited(x, rng.randint(0, 12), rng).upper() + "!\n" + text(20)))
    docs += [(100, None), (101, ""), (None, items[0][1]), (None, items[0][1]), (102, "die grösse  42 EINMAL"), (103, "x größe 42 - einmal y"),
             (104, items[3][1][:len(items[3][1]) // 2]), (105, items[3][1][len(items[3][1]) // 2:])]
    want = []
    for doc_id, t in docs:
        for item_id, x in items:
            c = norm(x or "")
            if len(c) >= Q:
                k = min(int(len(c) * ERROR), (len(c) - Q) // Q)
                e = least_edits(c, norm(t or ""))
                if e <= k:
                    want.append((doc_id, item_id, e))
    df = frame([(i, t, 0) for i, t in docs], "doc_id long, text string, edits int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(df, bench).collect()
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted([(r.doc_id, r.item_id, r.edits) for r in got], key=key) == sorted(want, key=key) and len(want) > 15
    bad = {d for d, _, _ in want}
    assert {r.doc_id for r in decontaminate(df, bench).collect()} == {d for d, _ in docs} - bad
    by_id = dict(docs)
    for r in got:
        if r.edits == 0 and r.doc_id is not None:
            assert norm(by_id[r.doc_id][r.start:r.end]) == norm(dict(items)[r.item_id])


def test_planted_passages_of_the_given_tables(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in contamination(docs, bench).collect()}
    texts = [(r.doc_id, norm(r.text or "")) for r in docs.collect()]
    whole = {(d, r.item_id) for r in bench.collect() for d, t in texts if norm(r.text) in t}
    assert whole and whole <= got and len(got) <= len(whole) + 2


def test_long_text_and_empty_tables(spark, frame):
    item = "one two three four five six seven eight nine ten eleven"
    far = "lorem " * 350_000
    df = frame([(1, far + item + far), (2, far), (3, far[:1_499_980] + item + far)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert sorted((r.doc_id, r.edits, r.start) for r in contamination(df, bench).collect()) == [(1, 0, len(far)), (3, 0, 1_499_980)]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert contamination(none, bench).count() == 0 and contamination(df, bench.where("false")).count() == 0
    assert decontaminate(df, bench.where("false")).count() == 3
    assert index([(1, "tiny")], Q, ERROR).items == []


def test_stretched_item_at_the_border_of_a_piece(monkeypatch):
    monkeypatch.setattr(decontam, "PIECE", 2000)
    item = "the quick brown fox jumps over the lazy dog while seven wizards boxed"
    block = index([(7, item)], Q, ERROR)
    for gap in (" ", " " * 300, "\n" + "-=" * 700 + "\n", " | " * 2000):
        for ahead in (1, 30, 200, 900, 1500, 1950, 1990, 1999, 2000, 3990):
            text = "z" * (ahead - 1) + "." + item.replace(" ", gap) + "." + "y" * 5000
            assert [(row, x, edits) for row, x, edits, *_ in matches(block, ["none", text, "zzzzz" + text], Q)] == [(1, 0, 0), (2, 0, 0)], (gap, ahead)


def test_repeated_letters_equal_full_alignment(monkeypatch):
    rng = random.Random(3)
    runs = lambda n: "".join(rng.choice("aab") * rng.choice((1, 2, 30, 80)) for _ in range(n))
    items = [(1, "a" * 60), (2, runs(5)[:200]), (3, "ab" * 40), (4, "a" * 40 + "b" * 40)]
    texts = ["a" * 59, "a" * 55, "b" * 90, "a" * 400, "ab" * 300, "a" * 45 + "b" * 50, *(runs(8) for _ in range(20))]
    kept = [(i, x) for i, x in items if len(x) >= Q]
    want = {(row, n) for row, t in enumerate(texts) for n, (_, x) in enumerate(kept)
            if least_edits(x, t) <= min(int(len(x) * ERROR), (len(x) - Q) // Q)}
    for step in (decontam.STEP, 50):
        monkeypatch.setattr(decontam, "STEP", step)
        assert {(row, n) for row, n, *_ in matches(index(items, Q, ERROR), texts, Q)} == want
    assert 20 < len(want) < len(kept) * len(texts)


def test_one_letter_item_and_text_stay_in_bounds():
    block = index([(1, "a" * 600), (2, "a" * 300 + "b" * 300)], Q, ERROR)
    tracemalloc.start()
    found = matches(block, ["a" * 1_500_000, "0" * 300_000], Q)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(row, x, edits, start) for row, x, edits, start, _ in found] == [(0, 0, 0, 0)] and peak < 1 << 30
