"""Blocks of texts as numpy arrays: words, word hashes and n-gram hashes.

Spark deals the rows out; inside a task an Arrow batch is cut into blocks of a
few MB of text, and everything below is vectorised over such a block. A text
is its UTF-8 bytes, null is the empty text, and a word is a maximal run of
bytes other than space and \\x09-\\x0D.

Hashes are polynomial over the ring of 64-bit integers with an odd base. With
``prefix[i] = sum(value(byte_t) * BASE**t for t < i)`` the hash of any slice is
``(prefix[end] - prefix[start]) * BASE**-start``, so all slices of a block cost
two array operations. A final bit mix spreads the low bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_BASE_INVERSE = pow(BASE, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUES = np.random.Generator(np.random.PCG64(20240611)).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256)
_LOWER[ord("A"):ord("Z") + 1] += 32
_LOWER_VALUES = _VALUES[_LOWER]
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective spread of 64-bit values (multiply and shift)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _power_table(base: int, n: int) -> np.ndarray:
    """``base**i`` for i < n at least, grown by doubling and kept per process."""
    table = _powers.get(base)
    if table is None:
        table = np.ones(1, np.uint64)
    while len(table) < n:
        step = np.uint64(pow(base, len(table), 1 << 64))
        table = np.concatenate([table, table * step])
    if len(table) <= 2 * BLOCK_BYTES:
        _powers[base] = table
    return table[:n]


def undo_powers(n: int) -> np.ndarray:
    return _power_table(_BASE_INVERSE, n)


class Block:
    """Texts joined by newlines. ``doc_start``/``doc_end`` bound each text."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(texts)
        self.data = np.frombuffer(joined, np.uint8)
        self.bytes = joined
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.doc_end = np.cumsum(sizes + 1) - 1
        self.doc_start = self.doc_end - sizes
        self._prefix: dict[bool, np.ndarray] = {}

    def prefix(self, lower: bool) -> np.ndarray:
        if lower not in self._prefix:
            values = (_LOWER_VALUES if lower else _VALUES)[self.data]
            out = np.zeros(len(values) + 1, np.uint64)
            np.cumsum(values * _power_table(BASE, len(values)), out=out[1:])
            self._prefix[lower] = out
        return self._prefix[lower]

    def slice_hashes(self, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
        prefix = self.prefix(lower)
        undo = undo_powers(len(prefix))
        return mix((prefix[end] - prefix[start]) * undo[start])

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of each word, and ``first``: words of text i are
        ``first[i]:first[i + 1]``."""
        if not hasattr(self, "_words"):
            inside = np.zeros(len(self.data) + 2, np.int8)
            inside[1:-1] = ~_SPACE[self.data]
            edge = np.diff(inside)
            start = np.flatnonzero(edge == 1)
            end = np.flatnonzero(edge == -1)
            first = np.append(np.searchsorted(start, self.doc_start), len(start))
            self._words = start, end, first
        return self._words

    def word_hashes(self, lower: bool = True) -> np.ndarray:
        start, end, _ = self.words()
        return self.slice_hashes(start, end, lower)


def ngram_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on (meaningful while n words remain)."""
    total = np.zeros(len(word_hashes), np.uint64)
    factor = 1
    for j in range(n):
        factor = factor * 0xC2B2AE3D27D4EB4F & _MASK
        total[:len(word_hashes) - j] += word_hashes[j:] * np.uint64(factor)
    return mix(total)


def shingle_sets(block: Block, n: int = 5) -> list[np.ndarray]:
    """The sorted distinct n-word shingle hashes of each text; a text with
    fewer words has its whole sequence as one, a text without words none."""
    words = block.word_hashes()
    _, _, first = block.words()
    grams = ngram_hashes(words, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            own = ngram_hashes(words[a:b], b - a)[:1]
            out.append(mix(own + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def text_blocks(batches: Iterable[pa.RecordBatch], limit: int = BLOCK_BYTES,
                column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into runs of rows of about *limit* bytes of text.

    *column* arrives as binary (cast in Spark); null becomes the empty text.
    Only one run's texts are Python objects at a time.
    """
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        begin = 0
        while begin < len(ends):
            before = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit + 1, "right")))
            yield batch.slice(begin, end - begin), [v or b"" for v in values.slice(begin, end - begin).to_pylist()]
            begin = end


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
