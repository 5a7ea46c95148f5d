"""Vectorised words of whole texts: positions and 64-bit hashes straight from Arrow buffers.

A word is a maximal run of bytes of a class (a 256-entry table); A-Z are lower-cased. Hashes are
polynomial over the bytes of the word (mod 2**64, random byte values, then mixed), computed for
all words of a buffer with one running sum, so no Python object is made per word. Buffers are
read in fixed pieces and a word that crosses a piece boundary is joined again, so memory does not
depend on how long a text or a word is beyond 8 bytes per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
#: Texts handled at once inside an Arrow batch (bytes); a longer text is handled alone.
GROUP_BYTES = 1 << 21

_P = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def byte_class(*ranges: tuple[int, int], negate: bool = False) -> np.ndarray:
    """256-entry boolean table of the bytes in the inclusive ranges."""
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a:b + 1] = True
    return ~table if negate else table


#: ``[^\x20\x09-\x0D]+``: everything but ASCII white space.
SPACED = byte_class((0x20, 0x20), (0x09, 0x0D), negate=True)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing: digits, letters, all non-ASCII.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _byte_values() -> np.ndarray:
    v = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    v[0x41:0x5B] = v[0x61:0x7B]
    return v


_POW = _powers(_P, PIECE + 1)
_INV = _powers(pow(_P, -1, 1 << 64), PIECE + 1)
_VALUE = _byte_values()


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def arrow_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, off, data = texts.buffers()
    at = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = at[0] if len(at) else 0
    return buf[first:at[-1]] if len(at) else buf, at - first


def groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes (a longer row is alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = SPACED):
    """(starts, ends, hashes, row offsets): byte spans and hashes of all words, in order; words
    ``row_offsets[i]:row_offsets[i + 1]`` belong to row i. No word crosses a row."""
    n = len(buf)
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    starts, ends, raw = [], [], []
    open_at_end = False
    for p in range(0, n, PIECE):
        b = buf[p:p + PIECE]
        m = len(b)
        w = is_word[b]
        new = begins[p:p + m]
        first = w.copy()
        first[1:] &= ~w[:-1] | new[1:m]
        last = w.copy()
        last[:-1] &= ~w[1:] | new[1:m]
        s = np.flatnonzero(first)
        if len(s):
            e = np.flatnonzero(last) + 1
            c = np.zeros(m + 1, np.uint64)
            np.cumsum(_VALUE[b] * _POW[:m], out=c[1:])
            h = (c[e] - c[s]) * _INV[s]
            ends_open = bool(w[-1])
            if open_at_end and s[0] == 0 and not new[0]:  # goes on from the last piece
                before = int(ends[-1][-1] - starts[-1][-1])
                joined = (int(raw[-1][-1]) + int(h[0]) * pow(_P, before, 1 << 64)) & _MASK
                raw[-1][-1] = joined
                ends[-1][-1] = e[0] + p
                s, e, h = s[1:], e[1:], h[1:]
            if len(s):
                starts.append(s + p)
                ends.append(e + p)
                raw.append(h)
            open_at_end = ends_open
        else:
            open_at_end = False
    if not starts:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    s, e, h = np.concatenate(starts), np.concatenate(ends), mix(np.concatenate(raw))
    return s, e, h, np.searchsorted(s, offsets)


def word_hash(word: str) -> int:
    """The hash that :func:`words` gives this word."""
    b = np.frombuffer(word.encode(), np.uint8)
    h = 0
    for i, v in enumerate(_VALUE[b].tolist()):
        h = (h + v * pow(_P, i, 1 << 64)) & _MASK
    return int(mix(np.array([h], np.uint64))[0])


def strings(texts: pa.Array) -> list[str]:
    """A string column without nulls as a list (many times faster than its values one by one)."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... (counts[i] of them), one after the other."""
    before = np.cumsum(counts) - counts
    total = int(counts.sum())
    kind = np.int64 if total >= 1 << 30 or (len(starts) and int(starts.max()) >= 1 << 30) else np.int32
    out = np.repeat((starts - before).astype(kind), counts)
    out += np.arange(total, dtype=kind)
    return out
