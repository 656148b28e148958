"""Suffix-sorting removal of repeated byte strings.

Of every *length*-byte string that occurs twice or more in the table, all
occurrences but the first are removed: a byte goes if some *length*-byte string
over it also starts earlier (in a smaller doc_id, or earlier in the same
document). Strings are judged on the input, and never cross documents.

Method
------
1. *Anchors.* Sorting one suffix per byte would move a hundred times the
   input. A suffix is kept only where :mod:`anchors` puts an anchor; equal
   windows have equal anchors, so nothing is missed. An anchor stands for the
   run of windows around it, their *span*.
2. *Settle equal spans.* Fingerprints (anchor, span, doc_id, offset) are dealt
   by anchor hash in packed blobs. Anchors that occur once vanish; of equal
   spans all but the first are removed whole. A task settles its own repeats
   before the shuffle, so a passage held by a third of all documents reaches
   the next task at most once per task. Only spans that share an anchor but
   differ (the edges of repeated passages) go on.
3. *Sort suffixes.* The suffixes at those anchors are range-partitioned by
   their leading bytes (``repartitionByRange`` samples the splitters; ties are
   split by what follows), and each bucket sorts the suffixes at its windows by
   multikey sort, eight bytes a level, going on only within runs that are still
   equal. A window equal to one that starts earlier is removed.
4. *Compare across boundaries.* An anchor at either end of a bucket may go on in
   its neighbours; the first of each distinct window there are compared over
   all buckets by their fingerprints.

Settling is a shortcut by fingerprints: equal spans never reach the sort. An
anchor's and a span's hash have 64 bits each and must both agree; edges and all
windows that differ from their neighbours are compared byte by byte.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import anchors
from .blocks import Block, column, signed, text_blocks
from .tables import discard, keep, partitions_for

FLUSH = 1 << 18  # anchors that a task holds before it hands them on; sorting them takes some ten times their 42 bytes
BLOCK = 1 << 20
_LAST = (1 << 63) - 1
_ROW = np.dtype([("anchor", "<u8"), ("span", "<u8"), ("key", "<i8"), ("version", "<i8"), ("first", "<i4"), ("count", "u1"), ("ahead", "u1")])
_FIELDS = list(_ROW.names)


def _fingerprints(length: int, gram: int, parts: int):
    """Rows (part, one blob per field): part < parts holds anchors by hash, the
    parts from there on hold spans that the task has settled, by document."""
    def run(batches):
        held, n = [], 0
        for batch, texts in text_blocks(batches, BLOCK):
            block = Block(texts)
            at, value, first, count = anchors(block, length, gram)
            row = np.searchsorted(block.doc_start, first, "right") - 1
            out = np.empty(len(at), _ROW)
            out["anchor"], out["span"] = value, block.slice_hashes(first, first + count + (length - 1))
            out["key"] = column(batch, "key").to_numpy()[row]
            out["version"] = column(batch, "version").to_numpy()[row]
            out["first"], out["count"], out["ahead"] = first - block.doc_start[row], count, at - first
            held.append(out)
            n += len(out)
            if n > FLUSH:
                yield _dealt(np.concatenate(held), parts)
                held, n = [], 0
        if n:
            yield _dealt(np.concatenate(held), parts)
    return run


def _settle(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Split *rows* into those that may be first and those whose whole span
    also starts earlier. The former come back sorted by anchor and span."""
    rows = rows[np.lexsort((rows["first"], rows["key"], rows["span"], rows["anchor"]))]
    fresh = np.append(True, (rows["anchor"][1:] != rows["anchor"][:-1]) | (rows["span"][1:] != rows["span"][:-1]))
    lead = rows[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] if len(rows) else rows
    later = (rows["key"] != lead["key"]) | (rows["first"] != lead["first"])
    return rows[~later], rows[later]


def _dealt(rows: np.ndarray, parts: int) -> pa.RecordBatch:
    rows, gone = _settle(rows)
    part = np.append((rows["anchor"] >> np.uint64(24)) % np.uint64(parts),
                     parts + (gone["key"].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(parts)).astype(np.int32)
    rows = np.concatenate([rows, gone])
    del gone
    order = np.lexsort((rows["first"], rows["key"], part))
    rows, part = rows[order], part[order]
    cut = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)).tolist()
    return pa.RecordBatch.from_arrays(
        [pa.array(part[cut[:-1]])] + [pa.array([rows[f][a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()) for f in _FIELDS],
        ["part", *_FIELDS])


_INTERVAL = [("kind", pa.int32()), ("key", pa.int64()), ("version", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("ahead", pa.int32())]
_INTERVALS = "kind int, key long, version long, first int, last int, ahead int"


def _intervals(kind: int, key, version, first, last, ahead=None) -> pa.Table:
    """A row per interval of a document. Rows are as many as the intervals,
    whatever the number of parts that found them."""
    n = len(key)
    values = [np.full(n, kind, np.int32), key, version, first, last, np.zeros(n) if ahead is None else ahead]
    return pa.table([pa.array(np.asarray(x).astype(t.to_pandas_dtype())) for x, (_, t) in zip(values, _INTERVAL)], [f for f, _ in _INTERVAL])


def _resolve(length: int, parts: int):
    """Of one part: kind 0, removed (first, last = end); kind 1, edges (first,
    last = number of windows, ahead)."""
    def run(table: pa.Table) -> pa.Table:
        rows = np.concatenate([np.zeros(0, _ROW), *(_unpacked(r) for r in table.to_pylist())])
        if table["part"][0].as_py() >= parts:
            gone, edges = rows, rows[:0]
        else:
            rows, gone = _settle(rows)
            group = np.append(True, rows["anchor"][1:] != rows["anchor"][:-1])
            spans = group | np.append(True, rows["span"][1:] != rows["span"][:-1])
            number = np.cumsum(group) - 1
            edges = rows[np.bincount(number, spans)[number] > 1]
        return pa.concat_tables([
            _intervals(0, gone["key"], gone["version"], gone["first"], gone["first"] + gone["count"] + np.int32(length - 1)),
            _intervals(1, edges["key"], edges["version"], edges["first"], edges["count"], edges["ahead"])])
    return run


def _unpacked(row: dict) -> np.ndarray:
    out = np.empty(len(row["anchor"]) // 8, _ROW)
    for f in _FIELDS:
        out[f] = np.frombuffer(row[f], _ROW[f])
    return out


def _lists(batch: pa.RecordBatch, name: str):
    """The intervals of each row of *batch* as rows of numbers."""
    values = column(batch, name)
    sizes = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(values), 0).to_numpy()))
    flat = values.flatten()
    rows = np.stack([x.to_numpy(zero_copy_only=False) for x in flat.flatten()], 1) if len(flat) else np.zeros((0, 3), np.int32)
    return (rows[a:b] for a, b in zip(sizes[:-1].tolist(), sizes[1:].tolist()))


def _contexts(length: int):
    """A row per edge: the suffix at its anchor and the bytes before it."""
    def run(batches):
        for batch, texts in text_blocks(batches):
            out: list[list] = [[], [], [], [], [], []]
            for text, key, version, edges in zip(texts, column(batch, "key").to_pylist(), column(batch, "version").to_pylist(), _lists(batch, "edges")):
                for first, count, ahead in edges.tolist():
                    for values, x in zip(out, (text[first + ahead:first + count + length - 1], text[first:first + ahead], key, version, first, count)):
                        values.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int64()),
                                              pa.array(out[3], pa.int64()), pa.array(out[4], pa.int32()), pa.array(out[5], pa.int32())],
                                             ["suffix", "before", "key", "version", "first", "count"])
    return run


def equal_runs(data: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey sort of the *length*-byte strings of *data* at *places*: the
    indices of those that equal another, and the number of their run. A level
    sorts each run that is equal so far by its next eight bytes."""
    padded = np.append(data, np.zeros(16, np.uint8)).astype(np.uint64)
    word = np.zeros(len(data) + 8, np.uint64)
    for j in range(8):
        word = (word << np.uint64(8)) | padded[j:j + len(word)]
    index, run = np.arange(len(places)), np.zeros(len(places), np.int64)
    for depth in range(0, length, 8):
        key = word[places[index] + depth]
        if length - depth < 8:
            key = key >> np.uint64(8 * (8 - (length - depth)))
        order = np.lexsort((key, run))
        index, run, key = index[order], run[order], key[order]
        fresh = np.append(True, (run[1:] != run[:-1]) | (key[1:] != key[:-1])) if len(index) else np.zeros(0, bool)
        run = np.cumsum(fresh) - 1
        several = np.bincount(run, minlength=1)[run] > 1
        index, run = index[several], run[several]
    return index, run


_BUCKET = f"{_INTERVALS}, part int, {', '.join(f'{f}_ binary' for f in _FIELDS)}"
_BUCKET_NAMES = [x.split()[0] for x in _BUCKET.split(", ")]


def _sorted_bucket(length: int, gram: int, parts: int):
    """Kind 0: removed (start, end) per document; kind 2: the first of each
    distinct window of the anchors at the bucket's ends, packed like the
    fingerprints and dealt by window, to be compared across boundaries."""
    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        suffix, before = table["suffix"].to_pylist(), table["before"].to_pylist()
        spans = [b + s for b, s in zip(before, suffix)]
        grams = [s[:gram] for s in suffix]
        ends = {min(grams), max(grams)}
        at_end = np.fromiter((g in ends for g in grams), bool, len(grams))
        block = Block(spans)
        rows = {c: table[c].to_numpy() for c in ("key", "version", "first", "count")}
        count = rows["count"].astype(np.int64)
        owner = np.repeat(np.arange(len(spans)), count)
        shift = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        place = block.doc_start[owner] + shift
        key, first = rows["key"][owner], rows["first"][owner] + shift
        index, group = equal_runs(block.data, place, length)
        order = np.lexsort((first[index], key[index], group))
        index, group = index[order], group[order]
        later = np.zeros(len(place), bool)
        if len(index):
            lead = index[np.flatnonzero(np.append(True, group[1:] != group[:-1]))[np.cumsum(np.append(0, group[1:] != group[:-1]))]]
            later[index] = (key[index] != key[lead]) | (first[index] != first[lead])
        gone = np.flatnonzero(later)
        # Windows of one span that follow each other merge into one interval.
        fresh = np.append(True, (np.diff(gone) != 1) | (owner[gone[1:]] != owner[gone[:-1]])) if len(gone) else np.zeros(0, bool)
        begin, last = gone[fresh], gone[np.append(fresh[1:], True)] if len(gone) else gone
        found = _intervals(0, key[begin], rows["version"][owner[begin]], first[begin], first[last] + length)
        edge = np.flatnonzero(at_end[owner] & ~later)
        ends = np.zeros(len(edge), _ROW)
        ends["anchor"] = block.slice_hashes(place[edge], place[edge] + length)
        ends["span"] = block.slice_hashes(place[edge], place[edge] + length // 2)
        ends["key"], ends["version"], ends["first"] = key[edge], rows["version"][owner[edge]], first[edge]
        yield from _bucket_rows(found)
        if len(ends):
            dealt = pa.Table.from_batches([_dealt(ends, parts)])
            dealt = dealt.rename_columns(["part", *(f"{f}_" for f in _FIELDS)])
            yield from _bucket_rows(dealt.append_column("kind", pa.array(np.full(len(dealt), 2, np.int32))))
    return run


_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _bucket_rows(table: pa.Table):
    """*table* in all columns of a bucket's result, null where it has none."""
    kinds = dict(x.split() for x in _BUCKET.split(", "))
    return pa.table([table[c] if c in table.column_names else pa.nulls(len(table), _TYPES[kinds[c]]) for c in _BUCKET_NAMES], _BUCKET_NAMES).to_batches()


def _across(length: int):
    """Kind 0 of the windows that started earlier in another bucket."""
    def run(table: pa.Table) -> pa.Table:
        _, later = _settle(np.concatenate([np.zeros(0, _ROW), *(_unpacked(r) for r in table.to_pylist())]))
        return _intervals(0, later["key"], later["version"], later["first"], later["first"] + np.int32(length))
    return run


def merged(intervals: np.ndarray) -> np.ndarray:
    """The union of (start, end) rows as disjoint, non-adjacent rows."""
    if not len(intervals):
        return intervals.reshape(0, 2)
    intervals = intervals[np.argsort(intervals[:, 0], kind="stable")]
    reach = np.maximum.accumulate(intervals[:, 1])
    fresh = np.append(True, intervals[1:, 0] > reach[:-1])
    return np.stack([intervals[fresh, 0], reach[np.append(fresh[1:], True)]], 1)


def _cut(batches, as_text: bool):
    for batch, texts in text_blocks(batches):
        kept, spans = [], []
        for text, removed in zip(texts, _lists(batch, "removed")):
            gaps = merged(removed[:, :2]).tolist()
            at, pieces = 0, []
            for start, end in gaps:
                pieces.append(text[at:start])
                at = end
            pieces.append(text[at:])
            # A cut may fall inside a character; its other bytes are no text.
            kept.append("".join(x.decode("utf-8", "ignore") for x in pieces) if as_text else b"".join(pieces))
            spans.append([{"start": a, "end": b} for a, b in gaps])
        others = [n for n in batch.schema.names if n not in ("removed", "text")]
        yield pa.RecordBatch.from_arrays(
            [column(batch, n) for n in others] + [
                pa.array(list(map(len, texts)), pa.int64()), pa.array(kept, pa.string() if as_text else pa.binary()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
            [*others, "n_bytes", "kept", "removed"])


def remove_repeats(docs: DataFrame, length: int = 100, gram: int = 50, as_text: bool = False) -> DataFrame:
    """The rows of *docs* (doc_id, text, and any other columns, carried in the
    struct ``row``) with ``n_bytes``, ``kept`` (the bytes left; with *as_text* a
    string of the whole characters left) and ``removed`` (array<struct<start,
    end>>: maximal removed byte runs).

    A null text is empty. A null doc_id counts as larger than all others. Rows
    with equal doc_id are one document: a string at the same start in two of
    them is not earlier in either. Texts under *length* bytes lose nothing. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("key"),
                       F.col("text").cast("binary").alias("text"))
    repeated = rows.groupBy("key").count().where("count > 1").select("key", F.lit(True).alias("again"))
    if repeated.isEmpty():
        rows = rows.withColumn("version", F.lit(0).cast("long"))
    else:  # intervals must find the very text of several with one doc_id
        rows = (rows.join(repeated, "key", "left")
                .withColumn("version", F.when(F.col("again"), F.xxhash64("text")).otherwise(0)).drop("again"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = partitions_for(spark, size * 2 / (length - gram) * _ROW.itemsize)
    blobs = ", ".join(f"{f} binary" for f in _FIELDS)
    settled, settled_path = keep(
        rows.select("key", "version", "text").mapInArrow(_fingerprints(length, gram, parts), f"part int, {blobs}")
        .groupBy("part").applyInArrow(_resolve(length, parts), _INTERVALS), "settled")
    interval = F.struct("first", "last", "ahead")
    edges = settled.where("kind = 1").groupBy("key", "version").agg(F.collect_list(interval).alias("edges"))
    contexts, contexts_path = keep(
        rows.select("key", "version", "text").join(edges, ["key", "version"])
        .mapInArrow(_contexts(length), "suffix binary, before binary, key long, version long, first int, count int"), "contexts")
    n_buckets = partitions_for(spark, contexts.count() * 256)
    end_parts = n_buckets // 4 + 1
    buckets, buckets_path = keep(
        contexts.repartitionByRange(n_buckets, "suffix", "before", "key").mapInArrow(_sorted_bucket(length, gram, end_parts), _BUCKET), "buckets")
    across = (buckets.where("kind = 2").select("part", *(F.col(f"{f}_").alias(f) for f in _FIELDS))
              .groupBy("part").applyInArrow(_across(length), _INTERVALS))
    columns = ["key", "version", "first", "last", "ahead"]
    removed = (settled.where("kind = 0").select(*columns).unionByName(buckets.where("kind = 0").select(*columns)).unionByName(across.select(*columns))
               .groupBy("key", "version").agg(F.collect_list(interval).alias("removed")))
    removed, _ = keep(removed, "removed")
    discard(spark, settled_path, contexts_path, buckets_path)
    schema = (f"row {rows.schema['row'].dataType.simpleString()}, key long, version long, n_bytes long, kept {'string' if as_text else 'binary'}, "
              "removed array<struct<start:int,end:int>>")
    return rows.join(removed, ["key", "version"], "left").select("row", "key", "version", "text", "removed").mapInArrow(partial(_cut, as_text=as_text), schema).drop("key", "version")
