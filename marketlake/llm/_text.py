"""Words of whole texts as numpy arrays, for functions that run in ``mapInArrow`` tasks.

Texts are handled as UTF-8 bytes. Both word definitions of this package separate words by
ASCII bytes only, and every byte of a non-ASCII character is above 0x7F, so splitting bytes
and splitting characters give the same words. A batch is walked in slices of bounded text
size, so memory follows the slice (or the longest single text), not the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
U64 = np.uint64

#: lower-cases A-Z, leaves every other byte
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: bytes of words made of letters, digits and non-ASCII characters
ALNUM_WORD = np.zeros(256, dtype=bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x41:0x5B] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True

#: bytes of words separated by white space
SPACED_WORD = np.ones(256, dtype=bool)
SPACED_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: words above this many bytes are hashed one by one
LONG_WORD = 512

_SEED = (U64(0x2545F4914F6CDD1D), U64(0x9FB21C651E98DF25))
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=U64)
_MIX = (U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53))
_LEFT, _RIGHT = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)


def row_slices(batch: pa.RecordBatch, column: str = "text",
               limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with at most ``limit`` bytes of text, or one longer row."""
    offsets = text_bytes(batch.column(column))[1]
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = max(to, at + 1)
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows (null counts as empty)."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if raw[2] is None:
        return np.empty(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(raw[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """The words of the rows of one slice.

    ``start``/``end`` are byte positions in ``data``; row ``r`` has the words
    ``first[r]:first[r + 1]``.
    """

    def __init__(self, column: pa.Array, word_bytes: np.ndarray, lower: bool):
        data, offsets = text_bytes(column)
        self.data = LOWER[data] if lower else data
        self.offsets = offsets
        self.rows = len(offsets) - 1
        inside = word_bytes[data]
        before = np.zeros(len(data) + 1, dtype=bool)
        before[1:] = inside
        before[offsets] = False
        self.start = np.flatnonzero(inside & ~before[:-1])
        after = np.zeros(len(data) + 1, dtype=bool)
        after[:-1] = inside
        after[offsets] = False
        self.end = np.flatnonzero(inside & ~after[1:]) + 1
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(self.rows), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; ``which`` (0 or 1) picks one of two hash functions.

        Eight bytes of all words are taken up at a time; words above ``LONG_WORD`` bytes are
        digested one by one.
        """
        lens = self.end - self.start
        out = mix(lens.astype(U64) * _LEFT + _SEED[which])
        padded = np.concatenate((self.data, np.zeros(8, np.uint8)))
        eight = np.lib.stride_tricks.as_strided(padded.view(), (len(self.data) + 1, 8), (1, 1))
        left, at, which_words = lens, self.start, np.flatnonzero(lens <= LONG_WORD)
        while len(which_words):
            own = left[which_words]
            part = eight[at[which_words]].view("<u8").ravel() & _FIRST_BYTES[np.minimum(own, 8)]
            out[which_words] = mix((out[which_words] ^ part) * _RIGHT + _LEFT)
            left, at = left - 8, at + 8
            which_words = which_words[own > 8]
        for i in np.flatnonzero(lens > LONG_WORD):
            digest = hashlib.blake2b(self.word(i), digest_size=8, salt=bytes([which]))
            out[i] = int.from_bytes(digest.digest(), "little")
        return out

    def inside(self, width: int) -> np.ndarray:
        """Whether the window of ``width`` words from each word ends in the word's own row."""
        last = np.repeat(self.first[1:], np.diff(self.first))
        return np.arange(len(self)) + width <= last


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values."""
    h = h ^ (h >> U64(33))
    h *= _MIX[0]
    h ^= h >> U64(29)
    h *= _MIX[1]
    h ^= h >> U64(32)
    return h


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive values, by doubling; windows may cross rows.

    Returns ``len(h) - width + 1`` values (none if there are fewer than ``width``).
    """
    if len(h) < width:
        return np.empty(0, U64)
    done, done_len, power, power_len, left = None, 0, h, 1, width
    while left:
        if left & 1:
            if done is None:
                done = power
            else:
                n = min(len(done), len(power) - done_len)
                done = mix(done[:n] * _LEFT + power[done_len:done_len + n] * _RIGHT)
            done_len += power_len
        left >>= 1
        if left:
            n = len(power) - power_len
            power = mix(power[:n] * _LEFT + power[power_len:] * _RIGHT)
            power_len *= 2
    return done[:len(h) - width + 1]


def sliding(values: np.ndarray, span: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``span`` consecutive values."""
    if len(values) < span:
        return values[:0]
    size = 1
    while size * 2 <= span:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = span - size
    return pick(values[:len(values) - rest], values[rest:]) if rest else values


def list_column(values: np.ndarray, row: np.ndarray, rows: int) -> pa.ListArray:
    """Values with ascending rows as one list per row."""
    offsets = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def distinct_by_row(values: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row, and their rows in ascending order."""
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[new], row[new]
