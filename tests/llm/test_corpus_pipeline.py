"""The stages' decisions against plain versions, each on what the stage before it kept."""

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from llm.decontam import ERROR, Q  # noqa: E402
from test_decontam import least_edits, norm  # noqa: E402
from test_jaccard import brute as classes  # noqa: E402
from test_linededup import brute as lines  # noqa: E402
from test_packing import check  # noqa: E402
from test_quality import brute as counts  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, workdir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, norm(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(f"{workdir}/{i}")
        docs = spark.read.parquet(f"{workdir}/{i}")
        rows = docs.collect()
        if name != "packing":
            assert docs.columns == COLUMNS
            after = {r.doc_id: r for r in rows}
            assert len(after) == len(rows)
        if name == "quality rules":
            for d, r in before.items():
                b = counts(r.text)
                if b[0] < 50 or 2 * b[4] > b[0]:
                    assert d not in after
            assert 0.5 * len(before) < len(after) < len(before) and all(after[d] == before[d] for d in after)
        elif name == "line dedup":
            want = {d: t for d, t, _, _ in lines([(r.doc_id, r.text) for r in before.values()], 10, 1)}
            assert {d: r.text for d, r in after.items()} == want
            assert all(r.n_chars == len(r.text) for d, r in after.items() if r.text != before[d].text)
        elif name == "n-gram Jaccard join":
            assert set(after) == {d for d, _, c in classes([(r.doc_id, r.text) for r in before.values()]) if d == c}
        elif name == "benchmark decontamination":
            grams = [{x[i:i + Q] for i in range(len(x) - Q + 1)} for _, x in bench]
            for d, r in before.items():
                t = norm(r.text)
                own = {t[i:i + Q] for i in range(len(t) - Q + 1)}
                hit = False
                for (_, x), g in zip(bench, grams, strict=True):
                    k = min(int(len(x) * ERROR), (len(x) - Q) // Q)
                    if len(g & own) >= len(g) - k * Q and g:  # the lemma, over the whole text
                        hit = hit or least_edits(x, t) <= k
                assert (d not in after) == hit
        else:
            check_rows(spark, stage, docs, before)


def check_rows(spark, stage, docs, before):
    from llm.packing import pack
    from llm.queries import vocabulary_path

    texts = [(d, r.text) for d, r in before.items()]
    again = pack(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), vocabulary_path()).collect()
    tokens, sequences = check(again, texts, 2048)
    assert sequences * 2048 - tokens < 2048
    got = docs.collect()
    assert sum(r.length for r in got) == tokens and {r.doc_id for r in got} == set(before)


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048

PLAIN = " ".join(f"word{i} of a longer text" for i in range(30))
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, PLAIN), (4, PLAIN), (4, PLAIN + " tail"), (None, PLAIN), (None, None), (5, "x" * 200_000), (6, "one two three\n" * 20_000),
       (7, "\x00 \U0001F600 ß"), (8, PLAIN.upper())]
MORE = "doc_id long, text string, lang string, source string, n_chars long, kept string, key string, n_dropped string, start string"


def odd(frame):
    return frame([(d, t, None, "s", 3, "own", "k", "n", "s") for d, t in ODD], MORE)


def texts_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_quality_stage_on_odd_rows(spark, frame):
    out = corpus_pipeline.quality_rules(spark, odd(frame), SF)
    assert out.columns == COLUMNS
    got = texts_of(out)
    assert not [t for _, t in got if not t or len(t.split()) < 50]
    assert [x for x in got if x[1] == PLAIN] in ([], sorted([(4, PLAIN), (4, PLAIN), (None, PLAIN)], key=repr))


def test_line_stage_on_odd_rows(spark, frame):
    out = corpus_pipeline.line_dedup(spark, odd(frame), SF)
    assert out.columns == COLUMNS
    got = texts_of(out)
    assert len(got) == len(ODD) and set(got) == {(d, t or "") for d, t, _, _ in lines(ODD, 10, 1)}


def test_near_duplicate_stage_on_odd_rows(spark, frame):
    got = texts_of(corpus_pipeline.near_duplicates(spark, odd(frame), SF))
    assert [d for d, t in got if t and t.lower().startswith("word0")] == [4]  # of equal and similar texts, with one id or several
    assert {(1, None), (2, ""), (3, " \n\t"), (None, None), (5, "x" * 200_000), (7, "\x00 \U0001F600 ß")} <= set(got)
    assert len(got) == 8


def test_decontamination_stage_on_odd_rows(spark, frame):
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if r.text and len(norm(r.text)) > 60)
    rows = [(d, t, None, "s", 3, "own", "k", "n", "s") for d, t in [*ODD, (20, item), (None, "a " + item), (21, PLAIN + " " + item.upper())]]
    out = corpus_pipeline.benchmark_decontamination(spark, frame(rows, MORE), SF)
    assert out.columns == COLUMNS and texts_of(out) == sorted(ODD, key=repr)


def test_packing_stage_on_odd_rows(spark, frame):
    rows = corpus_pipeline.packing(spark, odd(frame), SF).collect()
    for d in {d for d, _ in ODD}:
        parts = sorted((r.start, r.length, r.doc_tokens) for r in rows if r.doc_id == d)
        assert parts and all(n >= 1 for _, n, _ in parts)
    assert sum(r.length for r in rows) == sum({(r.doc_id, r.doc_tokens, k): r.doc_tokens for k, r in enumerate(rows) if r.start == 0}.values())


def test_stages_on_an_empty_table(spark):
    none = spark.createDataFrame([], MORE)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0, name
