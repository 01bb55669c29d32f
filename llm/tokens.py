"""Token ids of whole texts with a vocabulary file of the ``tokenizers`` library.

The vocabulary's normaliser turns white space into blanks and its pre-tokeniser
never crosses a blank, so a text may be cut at blanks and line feeds and each
distinct chunk encoded once per worker; a text's ids are then the joined ids of
its chunks.  Chunks of plain Latin characters skip the normaliser (it could
only lower-case them) and run through the same vocabulary as byte ranks in
``tiktoken``, which merges the same lowest-numbered pair first: the word-end
mark of the vocabulary becomes a zero byte at the end of each pre-token, and
every id is its own rank.  All other chunks, and every vocabulary without this
normaliser, take the ordinary ``encode`` of ``tokenizers``.  Tests hold the ids
against ``encode`` of the whole text.
"""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

CACHE_ENTRIES = 200_000  # about 45 MB; the cache starts anew beyond it

# The split rule of the word vocabulary, and the byte alphabet of byte-level merge models
# (fixed values: printable bytes stand for themselves, the rest follow from 256 on).
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Of characters below U+0250 without controls, blanks and U+0130, and the same split rule for them.
_PLAIN = re.compile(r"[\x21-\x7e\xa1-\u012f\u0131-\u024f]*")
_PLAIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\w\s]|_)+")


def _letter_bytes() -> dict[str, int]:
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranks(vocab: dict[str, int]) -> dict[bytes, int]:
    letters, out = _letter_bytes(), {}
    for token, i in vocab.items():
        end = token.endswith("</w>")
        stem = token[:-4] if end else token
        if all(c in letters for c in stem):
            out[bytes(letters[c] for c in stem) + b"\0" * end] = i
    return out


class Chunks(dict):
    """chunk -> its ids as little-endian uint32 bytes."""

    def __init__(self, path: str):
        super().__init__()
        self._whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex")
        self.cuts_at_blanks = kinds == ["NFC", "Replace", "Lowercase"] and split == _SPLIT
        if self.cuts_at_blanks:
            ranks = _ranks(spec["model"]["vocab"])
            self._ends_word = np.zeros(max(ranks.values()) + 1, bool)
            self._ends_word[[i for b, i in ranks.items() if b[-1] == 0 and len(b) > 1]] = True
            self._plain = tiktoken.Encoding("words", pat_str=r"[^\x00]*\x00", special_tokens={},
                                            mergeable_ranks=ranks)._core_bpe.encode_ordinary

    def __missing__(self, chunk: str) -> bytes:
        self[chunk] = got = np.array(self._whole.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        return got

    def learn(self, chunks: list[str]) -> None:
        """Encode new plain chunks together."""
        words = [_PLAIN_SPLIT.findall(c.lower()) for c in chunks]
        ids = np.array(self._plain("\0".join(["\0".join(w) for w in words]) + "\0"), "<u4")
        ends = np.flatnonzero(self._ends_word[ids]) + 1
        stop = (4 * ends[np.cumsum([len(w) for w in words]) - 1]).tolist()
        data, at = ids.tobytes(), 0
        for chunk, b in zip(chunks, stop, strict=True):
            self[chunk] = data[at:b]
            at = b

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if not self.cuts_at_blanks:
            return [np.asarray(e.ids, "<u4") for e in self._whole.encode_batch(texts, add_special_tokens=False)]
        if len(self) > CACHE_ENTRIES:
            self.clear()
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        new = set().union(*parts).difference(self)
        plain = [c for c in new if c and "<|" not in c and _PLAIN.fullmatch(c)]
        if plain:
            self.learn(plain)
        return [np.frombuffer(b"".join(map(self.__getitem__, p)), "<u4") for p in parts]


_OPEN: dict[str, Chunks] = {}


def encoder(path: str) -> Chunks:
    """The encoder of a vocabulary file, one for each Python worker."""
    if path not in _OPEN:
        _OPEN[path] = Chunks(path)
    return _OPEN[path]
