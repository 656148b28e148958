"""Packing documents into token windows by Karmarkar-Karp differencing.

*Tokens.* A text is split at ASCII white space, which the tokenizer never
crosses (it drops white space and splits there before merging), and each
distinct word is encoded once per worker; the ids of the text are those of its
words, then the end id. The tokenizer file is read on the driver and broadcast
(a vocabulary of fixed size).

*Pieces.* A document is cut into pieces of at most *piece* tokens: small items
let windows come out nearly equal.

*Differencing.* The pieces are numbered as they are written and dealt by a hash
of the number, so equal rows part, into groups of about ``GROUP_WINDOWS`` windows
of tokens and ``GROUP_PIECES`` pieces at most (by expectation). In a group every
piece starts as a partial partition into k windows, all but one empty (empty
ones take no room). The two partial partitions with
the largest imbalance (largest minus smallest window) are merged with opposing
order, the fullest window of one onto the emptiest of the other, until one is
left. k starts at the least number of windows that can hold the group and
rises whenever a window exceeds its capacity. A group is bounded in tokens and
pieces, so is a task, whatever the table, its copies, its tiny texts or its hot
sources.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import column, text_blocks
from .tables import keep

WINDOW = 2048
PIECE = 512
END_ID = 1
GROUP_WINDOWS = 256
GROUP_PIECES = 1 << 16
CACHE_WORDS = 1_000_000
_TAIL = re.compile(rb"([A-Za-z0-9])([,.;:!?])(?=[ \n]|$)")


class WordEncoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.is_end[number] = token.endswith("</w>")
        self.known: dict[bytes, bytes] = {}

    def _learn(self, words: set[bytes]) -> None:
        if len(self.known) + len(words) > CACHE_WORDS:
            self.known.clear()
        # A word of letters only ends with its one end-of-word token, so many
        # are encoded as one text; others, one by one.
        letters, others = [], []
        for word in words:
            (letters if word.decode("utf-8", "replace").isalpha() else others).append(word)
        if letters:
            ids = np.array(self.tokenizer.encode(b" ".join(letters).decode(), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.is_end[np.minimum(ids, len(self.is_end) - 1)]) + 1
            if len(ends) == len(letters) and ends[-1] == len(ids):
                data, cut = ids.tobytes(), [0, *(4 * ends).tolist()]
                self.known.update(zip(letters, (data[a:b] for a, b in zip(cut, cut[1:]))))
            else:  # a letter that turns into several
                others += letters
        for word, found in zip(others, self.tokenizer.encode_batch([w.decode("utf-8", "replace") for w in others], add_special_tokens=False)):
            self.known[word] = np.array(found.ids, "<u4").tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        # ASCII case is folded before the lookup, as the tokenizer does, and a
        # mark that ends a word is split off, as a token of its own; a text
        # that may name a special token keeps its spelling.
        words = [(t if b"<|" in t else _TAIL.sub(rb"\1 \2", t.lower())).split() for t in texts]
        missing = set().union(*words).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > CACHE_WORDS:
                missing = set().union(*words)  # _learn starts anew
            self._learn(missing)
        known = self.known
        return [b"".join([known[w] for w in ws]) for ws in words]


_encoders: dict[int, WordEncoder] = {}


def _encoder(spec: str) -> WordEncoder:
    key = hash(spec)
    if key not in _encoders:
        _encoders[key] = WordEncoder(spec)
    return _encoders[key]


def _pieces(spec, piece: int, end_id: int, with_ids: bool):
    def run(batches):
        encoder, end = _encoder(spec.value), np.array([end_id], "<u4").tobytes()
        place = TaskContext.get().partitionId() << 40
        for batch, texts in text_blocks(batches):
            rows: list[list] = [[], [], [], [], [], []]
            for i, ids in enumerate(encoder.encode(texts)):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, piece):
                    part = ids[4 * start:4 * (start + piece)]
                    for values, x in zip(rows, (i, start, len(part) // 4, zlib.crc32(part), total, part if with_ids else None)):
                        values.append(x)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id").take(pa.array(rows[0], pa.int64())), *(pa.array(x, pa.int64()) for x in rows[1:5]),
                 pa.array(rows[5], pa.binary()), pa.array(np.arange(place, place + len(rows[0])))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "place"])
            place += len(rows[0])
    return run


def difference(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window (0 .. k-1) of each item after k-way largest differencing. A
    partial partition holds its non-empty windows only, fullest first."""
    n = len(sizes)
    left, right = np.full(2 * n, -1), np.full(2 * n, -1)  # a merged window joins two
    made = n
    heap = [(-(size if k > 1 else 0), i, [size], [i]) for i, size in enumerate(sizes.tolist())]
    heapq.heapify(heap)
    order = n
    while len(heap) > 1:
        _, _, a_sums, a = heapq.heappop(heap)
        _, _, b_sums, b = heapq.heappop(heap)
        if len(a) + len(b) <= min(8, k):  # most merges: few windows, none of them meet
            pairs = sorted(zip([*a_sums, *b_sums], [*a, *b]), key=lambda x: -x[0])
            sums, nodes = [x for x, _ in pairs], [x for _, x in pairs]
            heapq.heappush(heap, ((sums[-1] if len(sums) == k else 0) - sums[0], order, sums, nodes))
            order += 1
            continue
        a_sums, a, b_sums, b = map(np.asarray, (a_sums, a, b_sums, b))
        # a's window i meets b's window k - 1 - i: only the last of both overlap.
        both = max(0, len(a) + len(b) - k)
        sums = np.concatenate([a_sums, b_sums[:len(b) - both]])
        nodes = np.concatenate([a, b[:len(b) - both]])
        if both:
            at = np.arange(len(a) - both, len(a))
            new = np.arange(made, made + both)
            left[new], right[new] = a[at], b[k - 1 - at]
            sums[at], nodes[at] = a_sums[at] + b_sums[k - 1 - at], new
            made += both
        by = np.argsort(-sums, kind="stable")
        sums, nodes = sums[by], nodes[by]
        heapq.heappush(heap, (int((sums[-1] if len(sums) == k else 0) - sums[0]), order, sums, nodes))
        order += 1
    window = np.full(2 * n, -1)
    if heap:
        nodes = np.asarray(heap[0][3])
        window[nodes] = np.arange(len(nodes))
        for node in range(made - 1, n - 1, -1):
            window[left[node]] = window[right[node]] = window[node]
    return window[:n]


def windows_of(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows of items of at most *capacity* by differencing: their number
    rises until none exceeds it."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = difference(sizes, k)
        if not len(sizes) or np.bincount(window, sizes).max() <= capacity:
            return window
        k += max(1, k // 256)


def _group(capacity: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable", na_position="last")
        rows["window"] = windows_of(rows["length"].to_numpy(), capacity)
        rows = rows.sort_values(["window", "doc_id", "start"], kind="stable")
        rows["offset"] = rows.groupby("window")["length"].cumsum() - rows["length"]
        rows["sequence_id"] = (int(key[0]) << 24) + rows["window"]
        return rows.drop(columns=["window", "pack_group"])
    return run


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, piece: int = PIECE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and ids, packed unsigned 32-bit, if *with_ids*).

    *tokenizer* is the path of a tokenizers file on the driver. A null text is
    empty and has the end id alone; doc_id may be null or repeated (rows are
    never joined). Equal rows are packed each. An empty table gives no rows.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    pieces, _ = keep(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
        .mapInArrow(_pieces(spec, min(piece, window), end_id, with_ids),
                    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, place long"), "pieces")
    if not with_ids:
        pieces = pieces.drop("ids")
    total, count = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    groups = max(1, -(-total // (GROUP_WINDOWS * window)), -(-count // GROUP_PIECES))
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64("place"), F.lit(groups))).drop("place")
    ids = ", ids binary" if with_ids else ""
    return dealt.groupBy("pack_group").applyInPandas(
        _group(window), f"doc_id long, start long, length long, ids_crc32 long, doc_tokens long{ids}, sequence_id long, offset long")
