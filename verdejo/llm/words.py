"""Words of Arrow text columns as numpy arrays: spans, hashes, windows.

Everything works on the UTF-8 bytes of a whole batch at once. Both word patterns in use
are unions of byte classes (all bytes of a non-ASCII character belong to words), so no
decoding is needed. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"


def _table(breaks: set[int]) -> np.ndarray:
    return np.array([b not in breaks for b in range(256)])


#: Bytes of ``[^\x20\x09-\x0D]+`` and of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
IN_WORD = _table(set(SPACES))
IN_ALNUM = _table({*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)})
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

CHUNK_BYTES = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def multipliers(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers, the same in every process."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(2 * seed + 1)) | np.uint64(1)


class Words:
    """Word spans of a batch of texts. ``first[i]:first[i + 1]`` are the words of text i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = IN_WORD, lower: bool = False):
        base = int(offsets[0])
        data = data[base:int(offsets[-1])]
        offsets = offsets.astype(np.int64) - base
        self.data = LOWER[data] if lower else data
        inside = in_word[self.data]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        edges = offsets[:-1]
        edges = edges[edges < len(data)]
        opens[edges] = inside[edges]  # a text never continues the word of the one before
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        ends = offsets[1:] - 1
        ends = ends[(ends >= 0) & (offsets[1:] > offsets[:-1])]
        closes[ends] = inside[ends]
        self.start = np.flatnonzero(opens)
        self.stop = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)

    def hashes(self, seed: int = 1) -> np.ndarray:
        """One 64-bit hash for each word, a function of its bytes alone."""
        if not len(self.start):
            return np.empty(0, dtype=np.uint64)
        out = np.empty(len(self.start), dtype=np.uint64)
        length = self.stop - self.start
        factors = multipliers(int(length.max()), seed)
        step = 1 << 18  # words at a time: the per-byte arrays stay small
        for a in range(0, len(out), step):
            b = min(a + step, len(out))
            size = length[a:b]
            heads = np.cumsum(size) - size
            within = np.arange(int(size.sum())) - np.repeat(heads, size)
            at = within + np.repeat(self.start[a:b], size)
            terms = (self.data[at].astype(np.uint64) + np.uint64(1)) * factors[within]
            out[a:b] = np.add.reduceat(terms, heads)
        return mix(out + length.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


def columns(batch: pa.RecordBatch, text: str, step: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Pieces of a batch of about ``step`` bytes of text: row range, bytes, offsets. No text is cut."""
    column = batch.column(batch.schema.get_field_index(text))
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.empty(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + step, side="right")) - 1)
        end = min(end, len(column))
        yield row, end, data, offsets[row:end + 1]
        row = end


def windows(hashes: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """Hash of the n words that start at each word; empty if there are fewer than n."""
    if len(hashes) < n:
        return np.empty(0, dtype=np.uint64)
    factors = multipliers(n, seed)
    size = len(hashes) - n + 1
    total = np.zeros(size, dtype=np.uint64)
    for j in range(n):
        total += hashes[j:j + size] * factors[j]
    return mix(total)


def cumulated(hashes: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and powers of an odd base; see ``span_hash``."""
    powers = np.cumprod(np.full(len(hashes) + 1, base, dtype=np.uint64)) * np.uint64(pow(base, -1, 1 << 64))
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers[:-1], out=sums[1:])
    return sums, powers


def span_hash(sums: np.ndarray, inverse: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of the words start..stop-1, the same wherever the words stand."""
    return mix((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64))
