"""Language identification: script ranges narrow the candidates, Viterbi labels spans of mixed text.

A word is a run of letters and marks; where its script changes it is cut, and scripts
written without blanks are cut into units of ``UNIT`` characters, so spans can
change inside a sentence of theirs.  Training counts character trigrams
(lower-cased, word borders included) per language into a fixed number of hash
buckets, and letters per script; the counts are summed inside each task and then
by Spark over all labelled documents, so the model has at most
``languages * (BUCKETS + scripts)`` numbers whatever the input.  A word's score
for a language is the sum of its trigrams' log probabilities; only languages
that write at least ``MIN_SHARE`` of their letters in the word's script are
candidates for it (a cut word keeps the trigrams of the whole one).  Viterbi over a document's words, with a fixed penalty for
each switch, gives every word a language.  All documents of a slice step through
their words together in numpy.

``lang_pred`` is the language of most letters, ``score`` its share of letters.

Defined results: null text or text without a letter is ``und`` with score 0; so
is every text if nothing was learned; a word in a script that no language writes
favours none; ties go to the language first in order; rows with null language
teach nothing; more than ``MAX_LANGS`` languages are an error (the model would not
fit the driver); rows with equal or null ids are judged one by one; an empty table
stays empty.  Texts are read whole, whatever their length; a long text is
scored in segments cut at word ends.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

BUCKETS = 1 << 16
MIN_SHARE = 0.001
SWITCH = 8.0
SLICE_CHARS = 3_000_000
UNIT = 4
MAX_LANGS = 500      # 65,536 numbers of 8 bytes each
UNSPACED = ("han", "kana", "thai", "lao", "khmer", "myanmar", "tibetan")  # fixed values: scripts without blanks between words

# First code point of each block of letters, with its script.
SCRIPTS = ((0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
           (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
           (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
           (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"),
           (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"),
           (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
           (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"),
           (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD800, "other"),
           (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"),
           (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"),
           (0x20000, "han"), (0x32000, "other"))
NAMES = sorted({s for _, s in SCRIPTS})

_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By code point: lower case, is a letter, is a letter or mark, script number."""
    if not _TABLES:
        lower = np.arange(0x110000, dtype=np.uint32)
        kind = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            s = chr(c)
            k = unicodedata.category(s)[0]
            if k in "LM":
                kind[c] = 2 if k == "L" else 1
                low = s.lower()
                if len(low) == 1:
                    lower[c] = ord(low)
        script = np.zeros(0x110000, np.uint8)
        for (a, name), b in zip(SCRIPTS, [*(a for a, _ in SCRIPTS[1:]), 0x110000], strict=True):
            script[a:b] = NAMES.index(name)
        _TABLES.update(lower=lower, letter=kind == 2, word=kind > 0, script=script)
    return _TABLES["lower"], _TABLES["letter"], _TABLES["word"], _TABLES["script"]


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by one line feed, and where each text starts (one more at the end)."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    joined = "\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32), np.concatenate([[0], np.cumsum(sizes)])


def _segments(word: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of about ``SLICE_CHARS`` characters that end between words."""
    out, a = [], 0
    while a < len(word):
        b = min(len(word), a + SLICE_CHARS)
        while b < len(word) and word[b] and word[b - 1]:
            b += 1
        out.append((a, b))
        a = b
    return out


def _trigrams(codes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Bucket of the trigram around every word character of the range, in order."""
    lower = _tables()[0]
    c = np.where(word, lower[codes], np.uint32(0))
    p = np.concatenate([np.zeros(1, np.uint32), c, np.zeros(1, np.uint32)])
    h = p[:-2] * np.uint32(0x9E3779B1) + p[1:-1] * np.uint32(0x85EBCA77) + p[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(16))[word]


def _runs(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray       # BUCKETS x languages, log probability
    candidate: np.ndarray   # scripts x languages


def learn(docs: DataFrame) -> Model:
    """Model of ``docs`` (``text, lang``): counts over all rows whose text and language are not null."""
    ship(docs.sparkSession)

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                by_lang.setdefault(lang, []).append(text.as_py())
            for lang, texts in by_lang.items():
                counts = total.setdefault(lang, np.zeros(BUCKETS + len(NAMES), np.int64))
                codes, _ = _codes(texts)
                _, letter, is_word, script = _tables()
                for a, b in _segments(is_word[codes]):
                    part = codes[a:b]
                    word = is_word[part]
                    counts[:BUCKETS] += np.bincount(_trigrams(part, word), minlength=BUCKETS)
                    counts[BUCKETS:] += np.bincount(script[part[letter[part]]], minlength=len(NAMES))
        for lang, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(counts[at])], ["lang", "bucket", "n"])

    if docs.where("lang is not null and text is not null").select("lang").distinct().limit(MAX_LANGS + 1).count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    counts = (docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
              .where("lang is not null and text is not null").mapInArrow(run, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))).toArrow()
    langs = sorted(set(counts["lang"].to_pylist()))
    grid = np.zeros((BUCKETS + len(NAMES), len(langs)))
    if langs:
        of = {lang: i for i, lang in enumerate(langs)}
        grid[counts["bucket"].to_numpy(), [of[x] for x in counts["lang"].to_pylist()]] = counts["n"].to_numpy()
    tri, letters = grid[:BUCKETS], grid[BUCKETS:]
    table = np.log((tri + 0.5) / (tri.sum(0) + 0.5 * BUCKETS)).astype(np.float32)
    return Model(langs, table, letters >= MIN_SHARE * np.maximum(letters.sum(0), 1))


def _units(inside: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where units start, script by character) of the characters of words that start at ``first``; a mark has the script before it."""
    _, letter, _, script = _tables()
    place = np.arange(len(inside))
    begins = np.zeros(len(inside), bool)
    begins[first] = True
    own = script[inside[np.maximum.accumulate(np.where(letter[inside] | begins, place, 0))]]
    begins[1:] |= own[1:] != own[:-1]
    since = place - np.maximum.accumulate(np.where(begins, place, 0))
    begins |= np.isin(own, [NAMES.index(n) for n in UNSPACED]) & (since % UNIT == 0)
    return np.flatnonzero(begins), own


def word_scores(model: Model, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, letters, scores by language) of every word of the code points."""
    _, letter, is_word, script = _tables()
    starts, ends, letters, scores = [], [], [], []
    for a, b in _segments(is_word[codes]):
        part = codes[a:b]
        word = is_word[part]
        s, e = _runs(word)
        if not len(s):
            continue
        inside, at = part[word], np.flatnonzero(word)
        first, own = _units(inside, np.concatenate([[0], np.cumsum(e - s)[:-1]]))
        s, e = at[first], at[np.append(first[1:], len(at)) - 1] + 1
        got = np.add.reduceat(model.table[_trigrams(part, word)], first, axis=0)
        allowed = model.candidate[own[first]]
        some = allowed.any(axis=1, keepdims=True)
        got = np.where(allowed, got, got.min(axis=1, keepdims=True) - 50)  # not a candidate: far below every candidate
        got = np.where(some, got, 0)
        starts.append(s + a)
        ends.append(e + a)
        letters.append(np.add.reduceat(letter[inside], first, dtype=np.int64))
        scores.append(got.astype(np.float32))
    if not starts:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros((0, len(model.langs)), np.float32)
    return tuple(map(np.concatenate, (starts, ends, letters, scores)))


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of every word; the words ``first[i]:first[i+1]`` are a document's.

    Documents are taken longest first, so those that still have a word at step
    ``t`` are always the front of the list.
    """
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    if not len(order):
        return np.zeros(0, np.int16)
    at, length = first[:-1][order], n[order]
    active = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")  # documents with more than t words
    value = scores[at].astype(np.float64)
    came = np.zeros(len(scores), np.int16)          # best state before the word, and which states came from there
    jump = np.zeros(scores.shape, bool)
    for t in range(1, length[0]):
        k = active[t]
        v = value[:k]
        best = v.argmax(axis=1)
        other = v[np.arange(k), best, None] - switch
        w = at[:k] + t
        came[w] = best
        jump[w] = other > v
        value[:k] = np.maximum(v, other) + scores[w]
    out = np.zeros(len(scores), np.int16)
    state = value.argmax(axis=1).astype(np.int16)   # the last word's state: values stay as they are after it
    for t in range(length[0] - 1, -1, -1):
        k = active[t]
        w = at[:k] + t
        out[w] = state[:k]
        if t:
            state[:k] = np.where(jump[w, state[:k]], came[w], state[:k])
    return out


def _groups(texts: list[str]) -> list[tuple[int, int]]:
    out, a, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= SLICE_CHARS:
            out.append((a, i + 1))
            a, size = i + 1, 0
    return [*out, (a, len(texts))] if a < len(texts) else out


def label(model: Model, texts: list[str], switch: float = SWITCH) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, score, spans as (start, end, language)) of each text."""
    if not model.langs:
        return [("und", 0.0, []) for _ in texts]
    out = []
    for a, b in _groups(texts):
        codes, begin = _codes(texts[a:b])
        starts, ends, letters, scores = word_scores(model, codes)
        first = np.searchsorted(starts, begin)
        path = viterbi(scores, first, switch)
        rows = np.repeat(np.arange(b - a), np.diff(first))
        weight = np.bincount(rows * len(model.langs) + path, letters, (b - a) * len(model.langs)).reshape(b - a, -1)
        change = np.flatnonzero(np.concatenate([[True], (path[1:] != path[:-1]) | (rows[1:] != rows[:-1])])) if len(path) else []
        spans: list[list] = [[] for _ in range(b - a)]
        for i, j in zip(change, [*change[1:], len(path)][:len(change)], strict=True):
            r = rows[i]
            spans[r].append((int(starts[i] - begin[r]), int(ends[j - 1] - begin[r]), model.langs[path[i]]))
        for r in range(b - a):
            total = weight[r].sum()
            if total:
                best = int(weight[r].argmax())
                out.append((model.langs[best], float(weight[r][best] / total), spans[r]))
            else:
                out.append(("und", 0.0, []))
    return out


def identify(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` of every row; spans are code point ranges with their language."""
    ship(docs.sparkSession)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                part = batch.slice(a, 2000)
                got = label(model, [t or "" for t in part.column(1).to_pylist()], switch)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                    pa.array([[{"start": s, "end": e, "lang": x} for s, e, x in g[2]] for g in got], span)],
                    ["doc_id", "lang_pred", "score", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>")
