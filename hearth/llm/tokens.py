"""Ids of whole texts by a public tokenizer, one vocabulary piece at a time.

Byte-level BPE never merges across pre-tokens, and a space that is followed by a non-space always
starts one. A text is cut at such spaces, each distinct cut is encoded once and remembered (as
16-bit or 32-bit ids), and the text's ids are the concatenation. For the byte-level tokenizers a
missing cut is split by their own pattern and given to the tokenizer's model directly; any other
kind of tokenizer encodes whole texts. The memory is bounded: when the memo is full it becomes the
older half, whose cuts are taken over as they are met again (so frequent cuts are never encoded
twice), and the half before it is dropped; very long cuts are not remembered.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from hearth.llm.words import spans, strings

#: Remembered cuts in each of two halves, and the longest one remembered (characters).
MEMO = 500_000
LONGEST = 48
#: Cuts whose ids are gathered at once.
GATHERED = 1 << 16

#: The pattern that splits text before byte-level merges (a fixed value of these tokenizers).
PRE_TOKENS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_ODD = re.compile(r" (?=\s)")
_CUTS = re.compile(r"(?= \S)")
#: ``_ODD`` in Arrow's regular expressions.
_ODD_COLUMN = r" [\s\v\x1c-\x1f\x{85}\p{Z}]"


def _byte_letters() -> dict[int, int]:
    """Latin-1 code point -> the letter that stands for this byte in byte-level vocabularies:
    printable bytes stand for themselves, the others for code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return dict(zip(own, own, strict=True)) | {b: 256 + i for i, b in enumerate(rest)}


_LETTERS = _byte_letters()
_SPACE = chr(_LETTERS[0x20])


class WordMemo(dict):
    """cut -> ids as bytes, filled by the tokenizer on a miss."""

    def __init__(self, path: str, most: int = MEMO):
        super().__init__()
        self.most = most
        self.older: dict[str, bytes] = {}
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_bytes = (spec["model"]["type"] == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                         and pre.get("use_regex", True) and not spec.get("normalizer") and not spec["model"].get("dropout"))
        self.model = self.tokenizer.model
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.kind = np.dtype("=u2" if self.code == "H" else "=u4")

    def __missing__(self, cut: str) -> bytes:
        ids = self.older.get(cut)
        if ids is None:
            ids = self._encoded(cut)
        if len(cut) <= LONGEST:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[cut] = ids
        return ids

    def _encoded(self, cut: str) -> bytes:
        word = cut[1:] if cut[0] == " " else cut
        if word.isalpha():
            return self._merged(cut)
        if word[:-1].isalpha():  # a word and one mark: two pre-tokens
            return self[cut[:-1]] + self[cut[-1]]
        parts = PRE_TOKENS.findall(cut)
        return self._merged(cut) if len(parts) == 1 else b"".join([self[p] for p in parts])

    def _merged(self, part: str) -> bytes:
        """Ids of one pre-token, from the tokenizer's model."""
        if part.isascii() and part.isprintable():
            letters = part.replace(" ", _SPACE)
        else:
            letters = part.encode().decode("latin-1").translate(_LETTERS)
        return array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()

    def ids(self, text: str) -> np.ndarray:
        """The text's ids, as the tokenizer gives them for the whole text."""
        if not self.by_bytes:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)
        if _ODD.search(text):
            cuts = _CUTS.split(text)
        else:
            first, *rest = text.split(" ")
            cuts = [first, *[" " + c for c in rest]]
        get = self.__getitem__
        return np.frombuffer(b"".join([get(c) for c in cuts if c]), self.kind)


    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the n + 1 offsets of the texts' ids. Each
        distinct cut of the column is looked up once."""
        n = len(texts)
        texts = texts.fill_null("")
        odd = np.asarray(pc.match_substring_regex(texts, _ODD_COLUMN)) if self.by_bytes else np.ones(n, bool)
        lists = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        cuts = lists.flatten()
        coded = cuts.dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        # a text's first cut has no space in front, all others have lost theirs
        heads = bounds[:-1][np.diff(bounds) > 0]
        get = self.__getitem__
        found = [get(" " + c) for c in strings(coded.dictionary)]
        at[heads] = np.arange(len(found), len(found) + len(heads))
        found += [get(c) if c else b"" for c in strings(cuts.take(pa.array(heads)))]
        width = self.kind.itemsize
        widths = np.array([len(f) for f in found], np.int64) // width
        starts = np.cumsum(widths) - widths
        flat, count = np.frombuffer(b"".join(found), self.kind), widths[at]
        plain = np.concatenate([flat[:0], *[flat[spans(starts[at[i:i + GATHERED]], count[i:i + GATHERED])] for i in range(0, len(at), GATHERED)]])
        sizes = np.diff(np.concatenate([[0], np.cumsum(count)])[bounds])
        if not odd.any():
            return plain, np.concatenate([[0], np.cumsum(sizes)])
        rest = [self.ids(t) for t in strings(texts.filter(pa.array(odd)))]
        size, start = np.zeros(n, np.int64), np.zeros(n, np.int64)
        size[~odd], size[odd] = sizes, [len(r) for r in rest]
        start[~odd] = np.cumsum(sizes) - sizes
        start[odd] = np.cumsum(size[odd]) - size[odd] + len(plain)
        return np.concatenate([plain, *rest])[spans(start, size)], np.concatenate([[0], np.cumsum(size)])


_MEMOS: dict[str, WordMemo] = {}


def memo(path: str, most: int = MEMO) -> WordMemo:
    """This worker's memo for a tokenizer file, of ``most`` cuts in each half from now on."""
    found = _MEMOS.get(path)
    if found is None:
        found = _MEMOS[path] = WordMemo(path, most)
    if len(found) > most or len(found.older) > most:  # from a larger one
        found.clear()
        found.older = {}
    found.most = most
    return found
