"""Every id in exactly one piece, windows gapless, ids equal to the tokenizers library's own."""

from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.packing import LevelPacker, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["the cat sat", None, "", "a <|endoftext|> b", "ÉÀ don't  2024 x　ΑΣ ΣΑΣ. é İstanbul 漢字\x00\x1c",
         "word " * 5000, "same text", "same text", "\n\n \t", "x" * 300, "it's WE'LL ½²ª º", "🙂🙂 naïve"]


def ids_of(whole, text):
    return whole.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, docs, size):
    whole = Tokenizer.from_file(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, text in docs:
        got = sorted(by_doc[doc_id], key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in got]).tolist()
        assert ids == ids_of(whole, text)
        at = 0
        for r in got:
            assert (r.start, r.length, r.doc_tokens) == (at, len(r.ids) // 4, len(ids))
            at += r.length
    for got in by_sequence.values():
        at = 0
        for r in sorted(got, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size
    return sum(r.length for r in rows), len(by_sequence)


def test_pieces_cover_every_document(spark, frame):
    docs = list(enumerate(TEXTS))
    df = frame([(i, t, 0) for i, t in docs], "doc_id long, text string, length int")
    check(pack(df, PATH, size=64).collect(), docs, 64)


def test_null_ids_and_empty_table(spark, frame):
    rows = pack(frame([(None, "a b"), (None, "a b")], "doc_id long, text string"), PATH).collect()
    assert len(rows) == 2 and all(r.doc_id is None for r in rows)
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_little_padding_on_the_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    tokens, sequences = check(pack(df, PATH).collect(), docs, 2048)
    assert sequences * 2048 - tokens < 2048


@pytest.mark.parametrize("seed", [0, 1])
def test_level_choice_is_the_least_sum_of_squares(seed):
    rng = np.random.default_rng(seed)
    size, packer = 40, LevelPacker(40)
    for s in rng.integers(1, 40, 400).tolist():
        def total(h):
            n = packer.count.copy()
            if h:
                n[h] -= 1
            if h + s < size:
                n[h + s] += 1
            return int((n * n).sum())
        options = [h for h in range(size - s + 1) if h == 0 or packer.count[h]]
        assert total(packer._level(s)) == min(map(total, options))
        packer.place((None, None, 0), s)
