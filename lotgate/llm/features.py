"""Hashed bag-of-n-gram features and sketches of fixed size over a table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import Block, column, mix, ngram_hashes

#: ASCII marks end a word like white space does; letters of any script stay.
_MARKS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
SLICES = 16


def hashed_grams(texts: list[bytes], buckets: int, orders: tuple[int, ...], plain: bool = True, stems: tuple[int, ...] = ()):
    """(text, bucket) of each n-gram occurrence of the given orders, and of the
    first bytes of longer words for each length in *stems*. With *plain*, words
    are runs of ASCII alphanumerics and non-ASCII characters, ASCII
    lower-cased; else runs between white space as they are."""
    block = Block([t.translate(_MARKS) for t in texts] if plain else texts)
    words = block.word_hashes(lower=plain)
    start, end, first = block.words()
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    last = first[1:][doc]
    docs, found = [], []
    for n in orders:
        inside = np.arange(len(words)) + n <= last
        docs.append(doc[inside])
        found.append((ngram_hashes(words, n)[inside] >> np.uint64(20)) % np.uint64(buckets))
    for length in stems:
        longer = end - start > length
        stem = block.slice_hashes(start[longer], start[longer] + length, plain)
        docs.append(doc[longer])
        found.append((mix(stem + np.uint64(length)) >> np.uint64(20)) % np.uint64(buckets))
    return np.concatenate(docs), np.concatenate(found).astype(np.int64)


def sliced(vector: np.ndarray, name: str) -> pa.RecordBatch:
    """A vector of fixed size as rows (name, slice, data)."""
    parts = np.split(np.ascontiguousarray(vector, np.float64), SLICES)
    return pa.RecordBatch.from_arrays(
        [pa.array([name] * SLICES), pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["name", "slice", "data"])


def _sum(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for x in column(batch, "data").to_pylist():
            x = np.frombuffer(x, np.float64)
            total = x.copy() if total is None else total + x
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([key[1].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                     ["name", "slice", "data"])


def summed(rows: DataFrame) -> dict[str, np.ndarray]:
    """Sums by name of the vectors that tasks gave by :func:`sliced`. What
    reaches the driver has the vectors' fixed size."""
    found: dict[str, dict[int, np.ndarray]] = {}
    for row in rows.groupBy("name", "slice").applyInArrow(_sum, "name string, slice int, data binary").collect():
        found.setdefault(row["name"], {})[row["slice"]] = np.frombuffer(row["data"], np.float64)
    return {name: np.concatenate([parts[i] for i in range(SLICES)]) for name, parts in found.items()}
