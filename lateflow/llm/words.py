"""Words of a batch of texts as numpy arrays.

A word is a maximal run of bytes other than the ASCII white space 0x20 and 0x09-0x0D
(UTF-8 keeps those bytes for themselves, so byte runs are character runs), with A-Z in
lower case. Each word gets a 64-bit hash from a prefix sum over its bytes, so the cost
per character is a few array operations, however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: bytes hashed at a time: bounds the temporary arrays (about 40 bytes for each) and the
#: tables of powers that every Python worker keeps
SEGMENT = 1 << 16
#: bytes of text in one slice of rows, as far as whole texts allow
SLICE = 1 << 20

_STEP = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_STEP, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers (multiply and xor-shift rounds)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_STEP))
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse, 0 to n."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, SEGMENT + 1)
        with np.errstate(over="ignore"):
            tables = [np.cumprod(np.concatenate(([U64(1)], np.full(size, U64(b), U64))),
                                 dtype=U64) for b in (_STEP, _INVERSE)]
        if n > SEGMENT:  # one very long word: not kept
            return tables[0], tables[1]
        _powers[:] = tables
    return _powers[0], _powers[1]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, one after the other, and the n + 1 offsets.
    A null counts as an empty text."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1]
    at = at.astype(np.int64)
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]]
    return raw, at - at[0]


def row_slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges holding about ``size`` bytes of text each, at least one row."""
    _, at = text_buffer(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(at, at[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last
        first = last


class Words:
    """doc (row number), start and end (byte positions) and hash of every word."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw, self.offsets, self.n_docs = raw, offsets, len(offsets) - 1
        self.lower = _LOWER[raw]
        space = _SPACE[raw]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(len(raw), dtype=bool)
        if len(raw):
            before[0] = True
            np.logical_or(space[:-1], edge[1:-1], out=before[1:])
        self.start = np.flatnonzero(~space & before)
        after = np.empty(len(raw), dtype=bool)
        if len(raw):
            after[-1] = True
            np.logical_or(space[1:], edge[1:-1], out=after[:-1])
        self.end = np.flatnonzero(~space & after) + 1
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        self.hash = self.hashes(self.start, self.end)

    def hashes(self, start: np.ndarray, end: np.ndarray, data: np.ndarray | None = None):
        """Hashes of byte ranges, which are in order and do not overlap, in lower case or
        of ``data``."""
        data = self.lower if data is None else data
        out = np.empty(len(start), dtype=U64)
        first = 0
        with np.errstate(over="ignore"):
            while first < len(out):
                base = start[first]
                last = int(np.searchsorted(end, base + SEGMENT, side="right"))
                last = max(last, first + 1)
                part = data[base:end[last - 1]]
                up, down = _power_tables(len(part))
                total = np.empty(len(part) + 1, dtype=U64)
                total[0] = 0
                np.cumsum(_BYTE[part] * up[:len(part)], out=total[1:])
                s, e = start[first:last] - base, end[first:last] - base
                out[first:last] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U64))
                first = last
        return out

    def __len__(self) -> int:
        return len(self.start)

    def per_doc(self) -> np.ndarray:
        """Number of words of each row."""
        return np.bincount(self.doc, minlength=self.n_docs)

    def word(self, i: int) -> bytes:
        return self.lower[self.start[i]:self.end[i]].tobytes()


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit hash) of every run of ``size`` consecutive words of a row, in order;
    a row with fewer words, but some, gives its whole sequence as one."""
    with np.errstate(over="ignore"):
        w, doc, n = words.hash, words.doc, len(words)
        many = max(n - size + 1, 0)
        acc = np.zeros(many, dtype=U64)
        for k in range(size):
            acc += w[k:k + many] * U64((_STEP * (2 * k + 3)) & ((1 << 64) - 1) | 1)
        whole = doc[:many] == doc[size - 1:] if many else np.zeros(0, bool)
        out_doc, out = doc[:many][whole], mix(acc[whole])
        count = words.per_doc()
        few = np.flatnonzero((count > 0) & (count < size))
        if len(few):
            first = np.searchsorted(doc, few)
            short = np.zeros(len(few), dtype=U64)
            for k in range(size - 1):
                has = count[few] > k
                short[has] += w[first[has] + k] * U64(
                    (_STEP * (2 * k + 3)) & ((1 << 64) - 1) | 1)
            short = mix(short + count[few].astype(U64) * U64(0xD6E8FEB86659FD93))
            out_doc, out = np.concatenate((out_doc, few)), np.concatenate((out, short))
    return out_doc, out
