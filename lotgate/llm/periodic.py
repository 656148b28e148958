"""Periodic runs in texts: stretches of words that repeat with a period.

A *run* is a stretch of consecutive words with smallest period q, at least
``max(min_length, 2 * q)`` words long, that no neighbouring word extends.

Method
------
* *Harmonic grid.* A run of period q holds two neighbouring multiples of q, so
  the candidates are the pairs (kq, (k+1)q) for each q: n ln n in all. A pair
  stays if the words at it, or before it, agree for a few words, which every
  run's pair does.
* *Recompression.* Texts with candidates are rewritten into a run-length
  grammar (:mod:`recompression`); its longest common extensions to the right
  and left give each candidate's exact run. No suffix array is built.
* The least period of equal stretches is the run's. Pairs inside a known run of
  a divisor of q would give that run again and are not asked.

Words are compared as numbers of a dictionary of the task's words, so results
are exact. All is local to a text; Spark deals the texts out, and a task works
on blocks of a few MB. One text is held whole, at some hundred bytes a word.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import column, mix, text_blocks
from .recompression import Grammar

MIN_LENGTH = 12
TEXT_BYTES = 1 << 20
_AT_ONCE = 1 << 20


def _grams(symbols: np.ndarray, size: int) -> np.ndarray:
    """A hash of the *size* symbols from each place on."""
    out = np.zeros(len(symbols), np.uint64)
    for j in range(size):
        out[:len(symbols) - j] = out[:len(symbols) - j] * np.uint64(0xC2B2AE3D27D4EB4F) + symbols[j:].astype(np.uint64) + np.uint64(1)
    return mix(out)


def _grid(low: int, high: int, length: int):
    """(x, q) of the pairs (x, x + q) at neighbouring multiples of q, for q from
    *low* below *high*, a bounded number at a time; a single q comes as a slice."""
    q = low
    while q < high:
        if length // q > 4096:
            yield slice(0, max(0, (length - 1) // q * q), q), q
            q += 1
            continue
        some = np.arange(q, min(high, q + max(1, _AT_ONCE // max(1, length // q))))
        pairs = (length - 1) // some
        period = np.repeat(some, pairs)
        k = np.arange(len(period)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        yield k * period, period
        q = int(some[-1]) + 1


def _candidates(symbols: np.ndarray, forward: np.ndarray, back: np.ndarray, text: np.ndarray, low: int, high: int):
    xs, qs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x, q in _grid(low, high, len(text)):
        if isinstance(x, slice):
            a, b = slice(x.start, x.stop, q), slice(x.start + q, x.stop + q, q)
            at = np.flatnonzero((forward[a] == forward[b]) | (back[a] == back[b])) * q
            q = np.full(len(at), q)
        else:
            y = x + q
            some = np.flatnonzero((forward[x] == forward[y]) | (back[x] == back[y]))
            at, q = x[some], q[some]
        same = (text[at] == text[at + q]) & (symbols[at] == symbols[at + q])
        xs.append(at[same])
        qs.append(q[same])
    return np.concatenate(xs), np.concatenate(qs)


def runs_of(symbols: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, length, period), by start and period, of the runs in
    *symbols* (texts of symbols from 0 on, a distinct negative one around and
    between them)."""
    walls = np.flatnonzero(symbols < 0)
    longest = int(np.diff(walls).max(initial=1)) - 1
    text = np.cumsum(symbols < 0)
    size = min(4, max(1, -(-(-(-min_length // 2)) // 2)))
    forward = _grams(symbols, size)
    back = np.append(np.arange(size, dtype=np.uint64), forward)[:len(symbols)]  # of the symbols before
    found = [np.zeros((0, 3), np.int64)]
    grammar, place, inner = None, None, None
    known = np.zeros((3, len(symbols)), np.int32)  # of the longest run over each word: start, end, period
    low = 1
    while low <= longest // 2:
        high = min(2 * low, longest // 2 + 1)
        x, q = _candidates(symbols, forward, back, text, low, high)
        s, e, p = known[0][x], known[1][x], known[2][x]
        ask = ~((p > 0) & (q % np.maximum(p, 1) == 0) & (x + q < e) & (e - s >= 2 * q))
        x, q = x[ask], q[ask]
        if len(x) and grammar is None:  # of the texts that may hold runs from here on
            inner = np.flatnonzero(_worth(symbols, text, forward, back, low, longest, x))
            place = np.cumsum(np.isin(np.arange(len(symbols)), inner, assume_unique=True)) - 1
            grammar = Grammar(symbols[inner])
        for begin in range(0, len(x), _AT_ONCE):
            a, period = x[begin:begin + _AT_ONCE], q[begin:begin + _AT_ONCE]
            here, there = place[a], place[a + period]
            right, left = grammar.extend_right(here, there), grammar.extend_left(here, there)
            length = left + right + period
            good = (right > 0) & (length >= np.maximum(min_length, 2 * period))
            rows = np.unique(np.stack([(a - left)[good], length[good], period[good]], 1), axis=0)
            found.append(rows)
            for start, size_, period_ in rows[np.argsort(rows[:, 1], kind="stable")].tolist():
                over = slice(start, start + size_)
                longer = (known[1][over] - known[0][over] < size_)
                for row, value in zip(known, (start, start + size_, period_)):
                    row[over][longer] = value
        low = high
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if len(rows):  # equal stretches: the least period
        rows = rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(1))]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _worth(symbols, text, forward, back, low, longest, x):
    """Which symbols belong to texts with a candidate at *low* or above."""
    some = np.zeros(int(text[-1]) + 1, bool)
    some[text[x]] = True
    step = 2 * low
    while step <= longest // 2:
        high = min(2 * step, longest // 2 + 1)
        some[text[_candidates(symbols, forward, back, text, step, high)[0]]] = True
        step = high
    # A text's first wall counts as its own; the next one ends it.
    return some[text] | ((symbols < 0) & some[np.maximum(text - 1, 0)])


def _found(min_length: int, rewrite: Callable | None):
    def run(batches):
        for batch, texts in text_blocks(batches, TEXT_BYTES):
            words = [t.split() for t in texts]
            if rewrite is not None:
                words = [rewrite(w, row.as_py()) for w, row in zip(words, column(batch, "row"))]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            flat = pa.array([w for some in words for w in some], pa.large_binary())
            symbols = np.full(int(sizes.sum()) + len(words) + 1, -1, np.int64)
            first = np.cumsum(sizes + 1) - sizes
            wall = np.ones(len(symbols), bool)
            wall[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(words)), sizes) + 1] = False
            symbols[~wall] = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(flat) else 0
            symbols[wall] = -1 - np.arange(len(words) + 1)
            rows = runs_of(symbols, min_length)
            owner = np.searchsorted(first, rows[:, 0], "right") - 1
            cut = np.searchsorted(owner, np.arange(len(words) + 1))
            lists, kept = [], []
            for i, some in enumerate(words):
                mine = rows[cut[i]:cut[i + 1]] - np.array([first[i], 0, 0])
                lists.append([dict(zip(("start", "length", "period"), r)) for r in mine.tolist()])
                if len(mine):
                    gone = np.zeros(len(some) + 1, np.int64)
                    np.add.at(gone, mine[:, 0] + mine[:, 2], 1)
                    np.add.at(gone, mine[:, 0] + mine[:, 1], -1)
                    some = [w for w, x in zip(some, (np.cumsum(gone)[:-1] > 0).tolist()) if not x]
                kept.append(b" ".join(some))
            yield pa.RecordBatch.from_arrays([
                column(batch, "row"), pa.array(sizes), pa.array(lists, pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))),
                pa.array(kept, pa.binary()).cast(pa.string())], ["row", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, rewrite: Callable | None = None) -> DataFrame:
    """The rows of *docs* (text, and any other columns, carried in the struct
    ``row``) with ``n_words``, ``runs`` (array<struct<start, length, period>>, in
    words from 0, by start, then period) and ``collapsed`` (the words, joined by
    one space, without those that some run holds after its first period).

    *rewrite* (words, row) -> words is applied to the words of each text first.
    A null text is empty: no words, no runs, collapsed to the empty text. Rows
    are judged each by itself: repeated rows and null or equal ids come back
    alike, and columns of any name are carried. An empty table gives no rows.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    row = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(row.alias("row"), F.col("text").cast("binary").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(_found(min_length, rewrite), schema)
