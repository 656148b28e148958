"""Language-model scoring by subword lattice likelihood.

A text is a sequence of words, each written as a word mark and its lower-cased
bytes, and an end. The model is a unigram distribution over pieces: an existing
subword vocabulary (with the 256 single bytes, so that every word can be
spelled), the whole words of the training texts, and the end. A whole word is
a piece that ends with its word: an arc over all of that word's lattice beside
the arcs of its subwords. The probability of a text is summed over *all* its segmentations into pieces; as no piece goes
beyond a word, it is the product of the words' marginals, each found by a
forward recursion in log space over the lattice of pieces.

Scores of the subwords start from the vocabulary's own (pieces in order of
rank, as ``1 / (rank + 1)``) and are re-estimated by expectation maximisation
over the lattices of the distinct training words: a forward and a backward pass
give the expected count of each piece. A whole word seen c times scores
``(c - d) / N``; the mass that the discount d frees goes to the spellings by
subwords, so rare and unseen words live on those. d is ``n1 / (n1 + 2 n2)`` of
the words seen once and twice.

Scale: texts are cut into blocks, and a block's distinct words with their
counts are what goes on; all passes work on the table of distinct words, which
Spark deals out. Only the score of each vocabulary piece (a fixed number)
and the scores of the FREQUENT most frequent words reach the driver. Those are
broadcast to the blocks; the scores of all other words go back by a join on the
word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import column, text_blocks
from .tables import discard, keep

ROUNDS = 3
FLOOR = 0.1  # pseudo-count of each piece
MARK = b" "
TEXT_BYTES = 3 << 20
WORDS_AT_ONCE = 1 << 15
FREQUENT = 1 << 17  # most words whose scores are broadcast
_SPREAD = 0x9E3779B1
_LN10 = np.log(10.0)


class Lattice:
    """Pieces as a byte trie, and the lattices of many words at a time. The
    trie's edges lie in a hash table of (node, byte), a few MB in all."""

    def __init__(self, pieces: list[bytes]):
        edges: dict[int, int] = {}  # node << 8 | byte, from 1 on -> node
        ends = [-1]
        for number, piece in enumerate(pieces):
            node = 0
            for byte in piece:
                edge = (node << 8 | byte) + 1
                if edge not in edges:
                    edges[edge] = len(ends)
                    ends.append(-1)
                node = edges[edge]
            ends[node] = number
        bits = max(4, (4 * len(edges)).bit_length())
        self.shift, self.mask = np.uint32(32 - bits), (1 << bits) - 1
        self.keys, self.to = np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, np.int32)
        for edge, to in edges.items():
            at = (edge * _SPREAD & 0xFFFFFFFF) >> (32 - bits)
            while self.keys[at]:
                at = (at + 1) & self.mask
            self.keys[at], self.to[at] = edge, to
        self.end = np.array(ends, np.int32)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The nodes that *byte* leads to; 0: no piece goes on so."""
        key = (node.astype(np.uint32) << np.uint32(8) | byte) + np.uint32(1)
        at = ((key * np.uint32(_SPREAD)) >> self.shift).astype(np.int64)
        found = self.keys[at]
        out = np.where(found == key, self.to[at], 0)
        more = np.flatnonzero((found != key) & (found != 0))
        while len(more):
            at[more] = (at[more] + 1) & self.mask
            found = self.keys[at[more]]
            hit = found == key[more]
            out[more[hit]] = self.to[at[more[hit]]]
            more = more[~hit & (found != 0)]
        return out

    def forward(self, words: np.ndarray, log_p: np.ndarray, spelled: float = 0.0, whole: np.ndarray | None = None):
        """*words*: (count, length) bytes. Log marginals, the log forward
        weights and the arcs (from, to, rows, pieces) in order of ``from``.
        *whole* has the log score of each word as one piece, an arc over all of
        its lattice; *spelled* is the log weight of the arcs of subwords."""
        count, length = words.shape
        alpha = np.full((length + 1, count), -np.inf)
        alpha[0] = spelled
        if whole is not None:
            alpha[length] = whole
        arcs = []
        for i in range(length):
            rows, node = np.arange(count), np.zeros(count, np.int32)
            for j in range(i, length):
                node = self.step(node, words[rows, j])
                alive = node > 0
                if not alive.all():
                    rows, node = rows[alive], node[alive]
                if not len(rows):
                    break
                piece = self.end[node]
                is_piece = piece >= 0
                on, piece = (rows, piece) if is_piece.all() else (rows[is_piece], piece[is_piece])
                alpha[j + 1, on] = np.logaddexp(alpha[j + 1, on], alpha[i, on] + log_p[piece])
                arcs.append((i, j + 1, on, piece))
        return alpha[length], alpha, arcs

    def expected(self, words: np.ndarray, weights: np.ndarray, log_p: np.ndarray) -> np.ndarray:
        """Expected count of each piece over all segmentations of the words."""
        total, alpha, arcs = self.forward(words, log_p)
        beta = np.full_like(alpha, -np.inf)
        beta[-1] = 0.0
        found = np.zeros(len(log_p))
        for i, j, on, piece in reversed(arcs):
            through = log_p[piece] + beta[j, on]
            beta[i, on] = np.logaddexp(beta[i, on], through)
            found += np.bincount(piece, np.exp(alpha[i, on] + through - total[on]) * weights[on], len(log_p))
        return found


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces and start log probabilities from a sentencepiece vocabulary: its
    pieces by rank, without those that lower-cased words cannot hold."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranked: dict[bytes, int] = {}
    for i in sorted(range(model.get_piece_size()), key=lambda i: (-model.get_score(i), i)):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        data = (MARK + piece[1:].encode()) if piece[0] == "▁" else piece.encode()
        if data != data.lower() or "▁".encode() in data:
            continue
        ranked.setdefault(data, len(ranked))
    for byte in range(256):
        ranked.setdefault(bytes([byte]), len(ranked))
    weight = 1.0 / (np.arange(len(ranked)) + 1)
    return list(ranked), np.log(weight / weight.sum())


def _by_length(batches, size: int):
    """Groups of (rows, batch table, byte matrix) of words of one length."""
    held: list[pa.RecordBatch] = []

    def groups():
        table = pa.Table.from_batches(held)
        words = [MARK + w for w in table["word"].to_pylist()]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        cut = np.append(np.flatnonzero(np.append(True, np.diff(sizes[order]) != 0)), len(order))
        yield table, [(rows := order[a:b], np.frombuffer(b"".join([words[i] for i in rows]), np.uint8).reshape(len(rows), -1))
                      for a, b in zip(cut[:-1], cut[1:])]

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= size:
            yield from groups()
            held.clear()
    if held:
        yield from groups()


def _expectations(shared, log_p):
    def run(batches):
        lattice, total = shared.value, np.zeros(len(log_p))
        for table, groups in _by_length(batches, WORDS_AT_ONCE):
            for rows, words in groups:
                total += lattice.expected(words, np.ones(len(rows)), log_p)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["piece", "expected"])
    return run


def _word_scores(shared, log_p, n: int, discount: float, log_spelled: float):
    def run(batches):
        lattice = shared.value
        for table, groups in _by_length(batches, WORDS_AT_ONCE):
            out = np.zeros(len(table))
            with np.errstate(divide="ignore"):
                whole = np.log(np.maximum(table["c"].to_numpy() - discount, 0) / max(n, 1))
            for rows, words in groups:
                out[rows] = lattice.forward(words, log_p, log_spelled, whole[rows])[0]
            yield pa.RecordBatch.from_arrays([table["word"].combine_chunks(), table["c"].combine_chunks(), pa.array(out)], ["word", "c", "log_p"])
    return run


_BLOCKS = "block long, doc_id long, held_out boolean, n_tokens long, words binary, counts binary"


def _counted(batches):
    """Per block a row (words, training counts) and a row per text (indices
    into the block's words, counts)."""
    number = TaskContext.get().partitionId() << 32
    for batch, texts in text_blocks(batches, TEXT_BYTES):
        of_text = [t.lower().split() for t in texts]
        sizes = np.fromiter(map(len, of_text), np.int64, len(of_text))
        found = pa.array([w for some in of_text for w in some], pa.large_binary()).dictionary_encode()
        words, index = found.dictionary.to_pylist(), found.indices.to_numpy()
        del of_text, found
        held_out = column(batch, "held_out").to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(texts)), sizes)
        train = np.bincount(index, ~held_out[doc], len(words)).astype(np.int64)
        pair, count = np.unique(doc * max(1, len(words)) + index, return_counts=True)
        del doc, index
        bound = np.searchsorted(pair, np.arange(len(texts) + 1) * max(1, len(words)))
        pair = (pair % max(1, len(words))).astype(np.int32)
        count = count.astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            pa.array([number]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.bool_()), pa.nulls(1, pa.int64()),
            pa.array([b"\n".join(words)], pa.binary()), pa.array([train.tobytes()], pa.binary())], _names(_BLOCKS))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(texts), number)), column(batch, "doc_id"), column(batch, "held_out"), pa.array(sizes + 1),
            pa.array([pair[a:b].tobytes() for a, b in zip(bound[:-1], bound[1:])], pa.binary()),
            pa.array([count[a:b].tobytes() for a, b in zip(bound[:-1], bound[1:])], pa.binary())], _names(_BLOCKS))
        number += 1


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _block_words(batches):
    for batch in batches:
        for number, words, counts in zip(*(column(batch, c).to_pylist() for c in ("block", "words", "counts"))):
            words, counts = words.split(b"\n") if counts else [], np.frombuffer(counts, np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(words), number)), pa.array(np.arange(len(words), dtype=np.int32)), pa.array(words, pa.binary()), pa.array(counts)],
                ["block", "place", "word", "c"])


def _frequent_words(frequent):
    """A row per block: for each of its words the number of the frequent word
    that it is, or -1."""
    def run(batches):
        number = {word: i for i, word in enumerate(frequent.value[0])}
        for batch in batches:
            found = [np.fromiter((number.get(w, -1) for w in (words.split(b"\n") if counts else ())), np.int32).tobytes()
                     for words, counts in zip(column(batch, "words").to_pylist(), column(batch, "counts").to_pylist())]
            yield pa.RecordBatch.from_arrays([column(batch, "block"), pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.int64()),
                                              pa.nulls(batch.num_rows, pa.float64()), pa.array(found, pa.binary())], ["block", "place", "c", "log_p", "frequent"])
    return run


def _rare_words(frequent):
    """The rows of :func:`_block_words` of words that are not frequent."""
    def run(batches):
        known = set(frequent.value[0])
        for batch in _block_words(batches):
            yield batch.filter(pa.array([w not in known for w in column(batch, "word").to_pylist()], pa.bool_())).select(["block", "place", "word"])
    return run


def _frequent(scored: DataFrame):
    """Words, counts and scores of the most frequent training words, FREQUENT
    at most: those whose count reaches the least step that no more words reach."""
    step = F.floor(F.log2("c") * 16).cast("int")
    steps = scored.where("c > 0").groupBy(step.alias("step")).count().collect()  # some hundreds
    least, total = None, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        total += row["count"]
        if total > FREQUENT:
            break
        least = row["step"]
    if least is None:
        return [], np.zeros(0, np.int64), np.zeros(0)
    rows = scored.where("c > 0").where(step >= least).collect()
    return [bytes(r["word"]) for r in rows], np.array([r["c"] for r in rows], np.int64), np.array([r["log_p"] for r in rows])


def _scored(n: int, v: int, end_count: int, log_end: float, frequent):
    def run(texts: pa.Table, scores: pa.Table) -> pa.Table:
        _, c, log = frequent.value
        mine = next((np.frombuffer(x, np.int32) for x in scores["frequent"].to_pylist() if x is not None), np.zeros(0, np.int32))
        known, log_p = np.zeros(len(mine), np.int64), np.zeros(len(mine))
        known[mine >= 0], log_p[mine >= 0] = c[mine[mine >= 0]], log[mine[mine >= 0]]
        scores = scores.filter(pc.is_valid(scores["place"]))
        known[scores["place"].to_numpy()], log_p[scores["place"].to_numpy()] = scores["c"].to_numpy(), scores["log_p"].to_numpy()
        below = np.log10(n + 0.5 * (v + 1))
        base = np.log10(known + 0.5) - below
        out = []
        for words, counts in zip(texts["words"].to_pylist(), texts["counts"].to_pylist()):
            w, c = np.frombuffer(words, np.int32), np.frombuffer(counts, np.int32)
            out.append((int(c[known[w] > 0].sum()) + (end_count > 0), float(base[w] @ c + np.log10(end_count + 0.5) - below),
                        float((log_p[w] @ c + log_end) / _LN10)))
        n_known, base_score, score = zip(*out)
        return pa.table([texts["doc_id"], texts["held_out"], texts["n_tokens"], pa.array(n_known, pa.int64()), pa.array(np.full(len(out), n)),
                         pa.array(base_score, pa.float64()), pa.array(score, pa.float64())],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score(docs: DataFrame, pieces_path: str, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    for each row of *docs* (doc_id, text); texts whose ``crc32(doc_id) mod 5``
    is 1 are held out, the others train.

    *pieces_path* is a sentencepiece vocabulary file on the driver. A null text
    is empty: its score is that of the end alone; a null doc_id counts as the
    empty id. Equal rows count and score each. Without training texts the
    vocabulary's own scores hold. An empty table gives no rows.
    """
    spark = docs.sparkSession
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1
    blocks, _ = keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), held.alias("held_out"))
                     .mapInArrow(_counted, _BLOCKS), "lm_blocks")
    texts = blocks.where("n_tokens is not null")
    placed = blocks.where("n_tokens is null").select("block", "words", "counts").mapInArrow(_block_words, "block long, place int, word binary, c long")
    words, words_path = keep(placed.groupBy("word").agg(F.sum("c").alias("c")), "lm_words")
    discard(spark)
    seen = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v"),
                     F.count(F.when(F.col("c") == 1, 1)).alias("n1"), F.count(F.when(F.col("c") == 2, 1)).alias("n2")).first()
    end_count = texts.where("not held_out").count()
    n, v = seen["n"] + end_count, seen["v"] + (end_count > 0)

    pieces, log_p = vocabulary(pieces_path)
    shared = spark.sparkContext.broadcast(Lattice(pieces))
    for _ in range(rounds if seen["n"] else 0):
        found = words.where("c > 0").mapInArrow(_expectations(shared, log_p), "piece int, expected double").groupBy("piece").agg(F.sum("expected").alias("e")).collect()
        expected = np.full(len(pieces), FLOOR)
        for row in found:  # a row per vocabulary piece at most
            expected[row["piece"]] += row["e"]
        log_p = np.log(expected / expected.sum())
    discount = min(0.9, max(0.1, seen["n1"] / max(1, seen["n1"] + 2 * seen["n2"])))
    # Shares of the next token: an end, a spelled word (the rest: whole words).
    log_end, log_spelled = np.log(0.5), np.log(0.5)
    if seen["n"]:
        log_end, log_spelled = float(np.log(end_count / n)), float(np.log(discount * seen["v"] / n))
    scored, _ = keep(words.mapInArrow(_word_scores(shared, log_p, n, discount, log_spelled), "word binary, c long, log_p double"), "lm_scores")
    discard(spark, words_path)
    frequent = spark.sparkContext.broadcast(_frequent(scored))
    lists = blocks.where("n_tokens is null").select("block", "words", "counts")
    rare = lists.mapInArrow(_rare_words(frequent), "block long, place int, word binary")
    back = rare.join(scored, "word").select("block", "place", "c", "log_p", F.lit(None).cast("binary").alias("frequent")).unionByName(
        lists.mapInArrow(_frequent_words(frequent), "block long, place int, c long, log_p double, frequent binary"))
    return texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        _scored(n, v, end_count, log_end, frequent),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
