"""N-gram Jaccard join by parity sketches (near-duplicate classes).

A document's set is its distinct *n*-word shingles. Two documents link when
``100 * |A & B| >= percent * |A | B|``; the result names the component of each.

Method
------
*Parity sketch.* The shingles of a set are dealt to ``m`` cells by their hash
and XORed there, so a cell holds the parity of every token bit that falls into
it. One shingle changes one cell: the number of cells in which two sketches
differ (their Hamming distance over cells) is at most the symmetric difference.

*Size bands.* ``m`` is fixed per band of sizes ``[4**k, 4**(k+1))``; a set whose
partner may lie in the next band takes part there as well, so any two sets that
can link meet in the larger one's band.

*Pigeonhole.* Linked sets differ in at most ``d = n * (100 - percent) / percent``
shingles (n: the size of either), hence in at most d cells, and agree in
``m - d``. Under any common order of (cell, value) pairs it is enough that each
set offers its first ``d + 1`` pairs: two sets that agree in ``m - d`` of m
cells share one of them. The order is by rarity, from a count sketch of fixed
size over all documents, so empty cells and cells that hold only a frequent
passage come last and are hardly ever offered. The order decides the amount of
work only, never the result.

*Verify.* Sets that share an offer are first joined to the least one of the
bucket (a star, not all pairs, in a part of the buckets); of its centres a set
verifies the least and the nearest by a 2048-bit parity sketch. After the
components of the verified stars are known, all buckets that span several
components are looked at again, with pairs across components screened by that
sketch: first the nearest of each set, then, with the components that gives,
all of them. A link inside one component changes nothing, so
none is lost. Verification
compares the shingle sets of the two whole texts.

Exact copies (equal sets) are one class throughout and offered once per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import Block, column, mix, shingle_sets, signed, text_blocks
from .components import connected_components
from .tables import discard, keep, partitions_for

SKETCH_BITS = 2048
COUNT_CELLS = 1 << 20  # of the rarity sketch: 4 MB whatever the input
COUNT_SLICES = 16
BITMAP_BYTES = 1 << 21
FLUSH = 1 << 20  # offers that a task holds before it hands them on
STAR_OF = 8
SPREAD = 2048  # rows of a group's buckets, about, that go to one task
GRID = 2048  # members of a bucket that one task compares
PAIRS_AT_ONCE = 1 << 17


def _sketch(shingles: np.ndarray) -> bytes:
    bits = np.bincount((shingles & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _profile(n: int, percent: int):
    """Per document: set size, two set hashes and the bit sketch; at the end of
    a task its cell counts, in slices."""
    def run(batches):
        total, held, keys, seen = np.zeros(COUNT_CELLS, np.int64), 0, [], set()

        def count():
            return np.bincount((np.concatenate(keys) % np.uint64(COUNT_CELLS)).astype(np.int64), minlength=COUNT_CELLS)
        for batch, texts in text_blocks(batches):
            sets = shingle_sets(Block(texts), n)
            one, two = [_set_hash(s) for s in sets], [int(np.add.reduce(mix(s))) if len(s) else 0 for s in sets]
            yield _profiled(column(batch, "doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                            pa.array(signed(np.array(one, np.uint64))), pa.array(signed(np.array(two, np.uint64))),
                            pa.array([_sketch(s) if len(s) else None for s in sets], pa.binary()))
            for _, _, cells, _ in _sketches(sets, one, seen, percent):
                keys.append(cells)
                held += len(cells)
            if held > FLUSH:
                total += count()
                held, keys = 0, []
        if keys:
            total += count()
        if total.any():
            none = pa.nulls(COUNT_SLICES, pa.int64())
            yield _profiled(none, none, none, none, pa.array([x.astype(np.int32).tobytes() for x in np.split(total, COUNT_SLICES)], pa.binary()),
                            pa.array(range(COUNT_SLICES), pa.int32()))
    return run


_PROFILE = "doc_id long, n_shingles long, f1 long, f2 long, sketch binary, slice int"


def _profiled(*columns) -> pa.RecordBatch:
    if len(columns) < 6:
        columns += (pa.nulls(len(columns[0]), pa.int32()),)
    return pa.RecordBatch.from_arrays(list(columns), [x.split()[0] for x in _PROFILE.split(", ")])


def _set_hash(shingles: np.ndarray) -> int:
    return int(mix(np.bitwise_xor.reduce(shingles)[None])[0]) if len(shingles) else 0


def _cells(shingles: np.ndarray, band: int) -> np.ndarray:
    """Keys of the non-empty cells of the parity sketch in *band*."""
    m = max(16, 2 * 4 ** band)
    cell = mix(shingles + np.uint64(band + 1)) % np.uint64(m)
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    value = np.bitwise_xor.reduceat(shingles[order], first)
    return mix(value + mix(cell[first] + np.uint64((band + 1) << 48)))


def _sketches(sets, hashes, seen: set, percent: int):
    """(set hash, offers wanted, cells, band) of each distinct set, in each of
    its bands; copies that the task has *seen* are passed over."""
    for s, f1 in zip(sets, hashes):
        size = len(s)
        if not size or (f1, size) in seen:
            continue
        seen.add((f1, size))
        wanted = size * (100 - percent) // percent + 1
        band = (size.bit_length() - 1) // 2
        for b in (band, band + 1):
            if b == band or 100 * size >= percent * 4 ** b:
                yield f1, wanted, _cells(s, b), b


def _sum_slices(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(COUNT_CELLS // COUNT_SLICES, np.int64)
    for batch in batches:
        for x in column(batch, "sketch").to_pylist():
            total += np.frombuffer(x, np.int32)
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()], pa.int32()), pa.array([np.minimum(total, (1 << 31) - 1).astype(np.int32).tobytes()])],
        ["slice", "counts"])


def _offers(n: int, percent: int, counts, parts: int):
    """Rows (part, keys, sets): the first ``wanted`` cells of each sketch."""
    def run(batches):
        rarity = counts.value
        keys, owners, held = [], [], 0

        def flush():
            key, owner = np.concatenate(keys), np.concatenate(owners)
            part = (key >> np.uint64(32)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            key, owner, part = key[order], owner[order], part[order]
            cut = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
            return pa.RecordBatch.from_arrays([
                pa.array(part[cut[:-1]].astype(np.int32)),
                pa.array([key[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                pa.array([owner[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], ["part", "keys", "sets"])

        seen: set = set()
        for _, texts in text_blocks(batches):
            sets = shingle_sets(Block(texts), n)
            for f1, wanted, cells, band in _sketches(sets, map(_set_hash, sets), seen, percent):
                if len(cells) > wanted:
                    count = rarity[(cells % np.uint64(COUNT_CELLS)).astype(np.int64)]
                    cells = cells[np.lexsort((cells, count))[:wanted]]
                elif len(cells) < wanted:  # then empty cells belong to the first ones
                    cells = np.append(cells, mix(np.array([band + 1], np.uint64)))
                keys.append(cells)
                owners.append(np.full(len(cells), f1, np.uint64))
                held += len(cells)
            if held > FLUSH:
                yield flush()
                keys, owners, held = [], [], 0
        if keys:
            yield flush()
    return run


def _buckets(table: pa.Table) -> pa.Table:
    """Of one part: stars (key null) and the members of shared buckets."""
    key = np.concatenate([np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()])
    owner = np.concatenate([np.frombuffer(x, np.uint64) for x in table["sets"].to_pylist()])
    order = np.lexsort((owner, key))
    key, owner = key[order], owner[order]
    fresh = np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]))
    key, owner = key[fresh], owner[fresh]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(first, len(key)))
    centre = np.repeat(owner[first], size)
    shared = np.repeat(size > 1, size)
    key, owner, centre = key[shared], owner[shared], centre[shared]
    # Sets that link share many buckets; an eighth of them give enough stars.
    star = (centre != owner) & (mix(key) % np.uint64(STAR_OF) == 0)
    pairs = np.unique(np.stack([centre, owner], 1)[star], axis=0) if len(key) else np.zeros((0, 2), np.uint64)
    none = pa.nulls(len(pairs), pa.int64())
    return pa.concat_tables([
        pa.table([none, pa.array(signed(pairs[:, 0].copy())), pa.array(signed(pairs[:, 1].copy()))], ["key", "a", "b"]),
        pa.table([pa.array(signed(key)), pa.array(signed(owner)), pa.nulls(len(key), pa.int64())], ["key", "a", "b"])])


def _near(percent: int):
    """Keep pairs whose sizes and bit sketches allow a link."""
    def run(batches):
        for batch in batches:
            na, nb = (column(batch, c).to_numpy() for c in ("n_a", "n_b"))
            apart = _apart(*(_sketches_of(column(batch, c).to_pylist()) for c in ("s_a", "s_b")))
            ok = _possible(na, nb, apart, percent)
            yield pa.RecordBatch.from_arrays([column(batch, "a"), column(batch, "b"), column(batch, "f_a"), pa.array(apart)], ["a", "b", "f_a", "apart"]).filter(pa.array(ok))
    return run


def _sketches_of(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint64).reshape(-1, SKETCH_BITS // 64)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hamming distances of rows of sketches."""
    return np.bitwise_count(x ^ y).sum(1, dtype=np.int64)


def _possible(na, nb, apart, percent):
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    # J >= p/100 and |A| + |B| = s: at most s * (100 - p) / (100 + p) differ.
    return (100 * small >= percent * large) & (apart * (100 + percent) <= (na + nb) * (100 - percent))


def _verify(n: int, percent: int):
    def run(batches):
        for batch, texts in text_blocks(batches, column="text_a"):
            other = [x or b"" for x in column(batch, "text_b").to_pylist()]
            ok = []
            for x, y in zip(shingle_sets(Block(texts), n), shingle_sets(Block(other), n)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([column(batch, "a"), column(batch, "b")], ["a", "b"]).filter(pa.array(ok))
    return run


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> tuple[DataFrame, str]:
    pairs, path = keep(pairs, "pairs")
    wanted = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "doc_id")
    screened = texts.where("doc_id is not null").mapInArrow(in_bitmap(bitmap_of(wanted)), "doc_id long, text binary")
    texts, texts_path = keep(screened.hint("merge").join(wanted, "doc_id", "left_semi"), "pair_texts")
    links, links_path = keep(
        pairs.hint("merge").join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .hint("merge").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_verify(n, percent), "a long, b long"), "links")
    discard(pairs.sparkSession, path, texts_path)
    return links, links_path


def _bit(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.view(np.uint64)) % np.uint64(8 * BITMAP_BYTES)).astype(np.int64)


def _marks(batches):
    bits = np.zeros(8 * BITMAP_BYTES, bool)
    for batch in batches:
        bits[_bit(batch.column(0).to_numpy())] = True
    if bits.any():
        data = np.packbits(bits)
        yield pa.RecordBatch.from_arrays([pa.array(range(COUNT_SLICES), pa.int32()),
                                          pa.array([x.tobytes() for x in np.split(data, COUNT_SLICES)], pa.binary())], ["slice", "sketch"])


def _or_slices(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BITMAP_BYTES // COUNT_SLICES, np.uint8)
    for batch in batches:
        for x in column(batch, "sketch").to_pylist():
            total |= np.frombuffer(x, np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()])], ["slice", "counts"])


def bitmap_of(ids: DataFrame):
    """Broadcast bitmap of the hashed ids: of fixed size, so that rows whose id
    is surely not among them need not be shuffled."""
    rows = (ids.coalesce(max(1, ids.sparkSession.sparkContext.defaultParallelism)).mapInArrow(_marks, "slice int, sketch binary")
            .groupBy("slice").applyInArrow(_or_slices, "slice int, counts binary").collect())
    total = np.zeros((COUNT_SLICES, BITMAP_BYTES // COUNT_SLICES), np.uint8)
    for row in rows:
        total[row["slice"]] = np.frombuffer(row["counts"], np.uint8)
    return ids.sparkSession.sparkContext.broadcast(total.reshape(-1))


def in_bitmap(bitmap):
    """Rows whose doc_id may be among the ids of a bitmap."""
    def run(batches):
        bits = bitmap.value
        for batch in batches:
            at = _bit(column(batch, "doc_id").to_numpy())
            yield batch.filter(pa.array((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)))
    return run


def _across(percent: int, nearest: bool):
    """Of the buckets in a task: pairs in different components, screened. All
    of them once per task, or (*nearest*) each member's nearest with the
    distance.

    Rows come sorted by (key, i, j). A cell (i, j) of a bucket's grid holds the
    members of its chunks i and j, at most two chunks of about GRID members.
    """
    def pairs(table: pa.Table) -> np.ndarray:
        cell = np.stack([table[c].to_numpy() for c in ("key", "i", "j")], 1)
        chunk, node, comp, size = (table[c].to_numpy() for c in ("chunk", "rep", "component", "n_shingles"))
        sketch = _sketches_of(table["sketch"].to_pylist())
        last = np.append(np.flatnonzero((cell[1:] != cell[:-1]).any(1)), len(cell) - 1)
        later = last[np.searchsorted(last, np.arange(len(cell)))] - np.arange(len(cell))
        through = np.append(0, np.cumsum(later))
        out, begin = [np.zeros((0, 3), np.int64)], 0
        while begin < len(cell):
            end = max(begin + 1, int(np.searchsorted(through, through[begin] + PAIRS_AT_ONCE)))
            n = later[begin:end]
            x = np.repeat(np.arange(begin, begin + len(n)), n)
            y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
            ok = (comp[x] != comp[y]) & ((cell[x, 1] == cell[x, 2]) | (chunk[x] != chunk[y]))
            x, y = x[ok], y[ok]
            ok = 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
            x, y = x[ok], y[ok]
            apart = _apart(sketch[x], sketch[y])
            ok = _possible(size[x], size[y], apart, percent)
            out.append(_least(np.stack([node[x[ok]], node[y[ok]], apart[ok]], 1), nearest))
            begin = end
        return _least(np.concatenate(out), nearest)

    def run(batches):
        held: list[pa.RecordBatch] = []
        found = np.zeros((0, 3), np.int64)
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 1 << 16:
                continue
            table = pa.Table.from_batches(held)
            keys = table["key"].to_numpy()
            whole = len(keys) - int(np.argmax(keys[::-1] != keys[-1])) if keys[0] != keys[-1] else 0
            if whole:  # the last bucket may go on in the next batch
                found = _least(np.concatenate([found, pairs(table.slice(0, whole))]), nearest)
                held = table.slice(whole).to_batches()
            if len(found) > FLUSH:
                yield _pair_batch(found)
                found = found[:0]
        if held and (table := pa.Table.from_batches(held)).num_rows:
            found = _least(np.concatenate([found, pairs(table)]), nearest)
        if len(found):
            yield _pair_batch(found)
    return run


def _least(pairs: np.ndarray, nearest: bool) -> np.ndarray:
    """Distinct (least, greatest, distance) rows; with *nearest* those that are
    the nearest of one of their members."""
    pairs = np.concatenate([np.sort(pairs[:, :2], axis=1), pairs[:, 2:]], 1)
    if nearest and len(pairs):
        both = np.concatenate([pairs, pairs[:, [1, 0, 2]]])
        both = both[np.lexsort((both[:, 1], both[:, 2], both[:, 0]))]
        both = both[np.append(True, both[1:, 0] != both[:-1, 0])]
        pairs = np.concatenate([np.sort(both[:, :2], axis=1), both[:, 2:]], 1)
    return np.unique(pairs, axis=0)


def _pair_batch(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i])) for i in range(3)], ["a", "b", "apart"])


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of *docs* (doc_id, text).

    A null or wordless text has an empty set and links with nothing; fewer than
    *n* words are one shingle. ASCII letters are lower-cased. Rows with an equal
    doc_id count as versions of one document. A row with a null doc_id gets the
    component of its copies, or null. Other columns are ignored; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    profiled, _ = keep(texts.mapInArrow(_profile(n, percent), _PROFILE), "profile")
    profile = profiled.where("slice is null")
    classes, classes_path = keep(
        profile.where("n_shingles > 0").groupBy("n_shingles", "f1", "f2")
        .agg(F.min("doc_id").alias("rep"), F.min("sketch").alias("sketch")).where("rep is not null"), "classes")
    shingles = classes.agg(F.sum("n_shingles")).first()[0] or 0

    slices = (profiled.where("slice is not null").select("slice", "sketch")
              .groupBy("slice").applyInArrow(_sum_slices, "slice int, counts binary").collect())
    rarity = np.zeros((COUNT_SLICES, COUNT_CELLS // COUNT_SLICES), np.int32)
    for row in slices:  # 4 MB at any size of the input
        rarity[row["slice"]] = np.frombuffer(row["counts"], np.int32)
    counts = spark.sparkContext.broadcast(rarity.reshape(-1))
    parts = partitions_for(spark, 16 * 1.2 * shingles * (100 - percent) / percent)
    buckets, buckets_path = keep(
        texts.select("text").mapInArrow(_offers(n, percent, counts, parts), "part int, keys binary, sets binary")
        .groupBy("part").applyInArrow(_buckets, "key long, a long, b long"), "buckets")

    def side(name):
        return classes.select(F.col("f1").alias(f"f_{name}"), F.col("rep").alias(name),
                              F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))
    stars = (buckets.where("key is null").select(F.col("a").alias("f_a"), F.col("b").alias("f_b")).distinct()
             .join(side("a"), "f_a").join(side("b"), "f_b").where("a <> b")
             .select("a", "b", "f_a", "n_a", "n_b", "s_a", "s_b").mapInArrow(_near(percent), "a long, b long, f_a long, apart long")
             .groupBy("b").agg(F.min_by("a", "f_a").alias("least"), F.min_by("a", F.struct("apart", "a")).alias("nearest"))
             .select("b", F.explode(F.array_distinct(F.array("least", "nearest"))).alias("a")))
    links, links_path = _verified(stars, texts, n, percent)
    found, found_path = keep(connected_components(links), "found")

    for nearest in (True, False):  # nearest neighbours first: few pairs, and most components
        members = (classes.join(found.withColumnRenamed("node", "rep"), "rep", "left")
                   .select("f1", "rep", F.coalesce("component", "rep").alias("component")))
        shared, shared_path = keep(buckets.where("key is not null").select("key", F.col("a").alias("f1"))
                                   .join(members, "f1").select("key", "rep", "component"), "shared")
        # Buckets of one group of documents go to one task, where their pairs are
        # found once; the more rows all its buckets have, the more tasks it is
        # dealt to. A home is a member of its buckets, so it has few of them.
        mixed = (shared.groupBy("key").agg(F.countDistinct("component").alias("c"), F.count("*").alias("n"), F.min("rep").alias("home"))
                 .where("c > 1").withColumn("rows", F.sum("n").over(Window.partitionBy("home")))
                 .select("key", "home", (F.col("n") / GRID).cast("int").alias("last"),
                         F.pmod(F.xxhash64("key"), (F.col("rows") / SPREAD).cast("int") + 1).cast("int").alias("deal")))
        grid = (shared.join(mixed, "key")
                .withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("last") + 1).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
                .select("key", "rep", "component", "chunk", "home", "deal",
                        F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
                .join(classes.select("rep", "n_shingles", "sketch"), "rep"))
        across = (grid.repartition("home", "deal", "i", "j").sortWithinPartitions("key", "i", "j")
                  .mapInArrow(_across(percent, nearest), "a long, b long, apart long"))
        if nearest:
            both = across.unionByName(across.select(F.col("b").alias("a"), F.col("a").alias("b"), "apart"))
            best = both.groupBy("a").agg(F.min_by("b", F.struct("apart", "b")).alias("b"))
            across = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        more, more_path = _verified(across.select("a", "b").distinct(), texts, n, percent)
        if not more.isEmpty():
            found, new_path = keep(connected_components(found.select(F.col("node").alias("a"), F.col("component").alias("b"))
                                                        .unionByName(more)), "found")
            discard(spark, found_path)
            found_path = new_path
        discard(spark, shared_path, more_path)
    discard(spark, buckets_path, links_path)
    reps = (classes.join(found.withColumnRenamed("node", "rep"), "rep", "left")
            .select("n_shingles", "f1", "f2", F.coalesce("component", "rep").alias("component_id")))
    return (profile.join(reps, ["n_shingles", "f1", "f2"], "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def representatives(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of *docs* that stay when one document of each component does
    (the one with the least doc_id), in all their columns. Of several rows with
    one doc_id one stays, that with the least hash of its columns, so reruns
    agree; rows with a null doc_id all do."""
    found = near_duplicates(docs.select("doc_id", "text"), n, percent)
    stay = found.where("doc_id = component_id").select("doc_id").distinct()
    row = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns))
    return (docs.join(stay, "doc_id", "left_semi").groupBy("doc_id").agg(row.alias("row")).select("row.*")
            .unionByName(docs.where("doc_id is null")))
