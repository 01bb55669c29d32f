import hashlib
import re

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm import crosstok

PATHS = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, P.path("piece_bpe_32k.model"))
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[3])
SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
LETTER = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in SHOWN)}


def tokens(text):
    """(id, bytes) lists of both, from whole texts."""
    a = [(i, bytes(LETTER[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        p = B.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) and B.is_byte(i) else p.replace("▁", " ").encode()))
    return a, b


def aligned(text):
    """Groups of (A ids, B ids), or none."""
    if not text:
        return []
    a, b = tokens(text)
    if not b"".join(t for _, t in a) == b"".join(t for _, t in b) == (" " + text).encode():
        return []
    groups, left, right, i = [], [], [], 0
    at_a, at_b, b = 0, 0, iter(b)
    for x, t in a:
        at_a += len(t)
        left.append(x)
        while at_b < at_a:
            y, u = next(b)
            at_b += len(u)
            right.append(y)
        if at_a == at_b:
            groups.append((left, right))
            left, right = [], []
    return groups


def plain(rows):
    per, docs_of = [], {}
    for _, text in rows:
        groups = aligned(text)
        links = [(x, y) for left, right in groups for x in left for y in right]
        per.append((groups, links))
        for pair in set(links):
            docs_of[pair] = docs_of.get(pair, 0) + 1
    most = {}
    for (x, _), n in docs_of.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for (doc_id, _), (groups, links) in zip(rows, per, strict=True):
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((doc_id, sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(links),
                    sum(docs_of[p] == most[p[0]] for p in links), sum(docs_of[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return out, docs_of, most


def check(frame, rows):
    df = frame([(*r, 1, "y") for r in rows], "doc_id long, text string, slice long, pair string")
    docs, pairs = crosstok.align(df, PATHS[0], PATHS[3], PATHS[1], PATHS[2])
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    key = lambda r: (r[0] is None, r)
    want, docs_of, most = plain(rows)
    got = [tuple(r[c] for c in names) for r in docs.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {(r.a, r.b): (r.docs, r.best) for r in pairs.collect()} == {p: (n, n == most[p[0]]) for p, n in docs_of.items()}


TEXTS = ["Hello world", "the cat sat on the mat, the end.", "naïve café — “quotes”", "漢字かな交じり文 with latin", "tab\tand\nnew\n\n lines  two   three ",
         " leading", "trailing   ", "   ", "\n", "x▁y", "a <|endoftext|> b <s> </s> <unk> <0x0A>", "\x00 nul \x85 next", "🙂🙂 é",
         "1234567890 12,345.67", "I'll don't we've", "word nbsp 　 wide", "zzzzzzzz" * 40, "def f(x):\n    return x  # done\n"]


@pytest.mark.parametrize("size", [None, 60])
def test_equals_plain_version(frame, monkeypatch, size):
    if size:  # many slices
        monkeypatch.setattr(crosstok, "SLICE", size)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(i + 100, t + " " + TEXTS[(i + 1) % len(TEXTS)]) for i, t in enumerate(TEXTS)]
    check(frame, [*rows, (50, None), (51, ""), (None, "null id"), (7, "same id"), (7, "same id"), (52, "long text " * 5000), (53, "q" * 20_000)])


def test_empty_table(frame):
    check(frame, [])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r ▁　ab1.,'"), st.characters(exclude_categories=("Cs",))), min_size=1, max_size=60))
def test_chunks_are_encoded_as_in_their_text(text):
    parts = crosstok.chunks(" " + text)
    assert "".join(parts) == " " + text
    (a, size_a), (b, size_b), _ = crosstok._encoders(PATHS)
    raw = [p.encode() for p in parts]
    ids_a, n_a, good_a = crosstok._encoded(parts, raw, a, size_a)
    ids_b, n_b, good_b = crosstok._encoded(parts, raw, b, size_b)
    left, right = tokens(text)
    assert good_a.all() and ids_a.tolist() == [i for i, _ in left]
    assert good_b.all() == (b"".join(t for _, t in right) == (" " + text).encode())
    if good_b.all():
        assert ids_b.tolist() == [i for i, _ in right]


def test_stretches_cut_at_chunk_borders(monkeypatch):
    for text in [*TEXTS, "a b " * 30, "x" * 40 + "  y", "w " + " " * 90]:
        whole = crosstok.chunks(" " + text)
        for size in (1, 5, 16):
            monkeypatch.setattr(crosstok, "STRETCH", size)
            parts = [c for s in crosstok._stretches(text) for c in crosstok.chunks(s)]
            assert "".join(parts) == " " + text and set(np.cumsum([len(c) for c in parts])) <= set(np.cumsum([len(c) for c in whole]))
    monkeypatch.undo()


def test_products_equal_dense_matrices(monkeypatch):
    g = np.random.default_rng(1)
    for expand in (crosstok.EXPAND, 3):
        monkeypatch.setattr(crosstok, "EXPAND", expand)
        left, right = g.integers(0, 3, (7, 9)) * (g.random((7, 9)) < 0.4), g.integers(0, 3, (9, 5)) * (g.random((9, 5)) < 0.4)
        sparse = lambda m: crosstok.Csr.of(*np.nonzero(m), m[np.nonzero(m)], len(m))
        row, column, value = sparse(left).times(sparse(right))
        dense = np.zeros((7, 5), int)
        dense[row, column] = value
        assert (dense == left @ right).all() and len(set(zip(row.tolist(), column.tolist(), strict=True))) == len(row)
        back = sparse(left).transposed(9)
        assert (np.diff(back.start) == (left != 0).sum(0)).all()


def test_overlap_links():
    a, b, shared = crosstok.overlap_links(np.array([2, 5, 6]), np.array([3, 4, 6]))
    assert list(zip(a.tolist(), b.tolist(), shared.tolist(), strict=True)) == [(0, 0, 2), (1, 0, 1), (1, 1, 1), (1, 2, 1), (2, 2, 1)]
    assert crosstok.group_ends(np.array([2, 5, 6]), np.array([3, 5, 6])).tolist() == [5, 6]
