"""Embedding near-duplicates by cross-polytope hashing.

Vectors link when their labels are equal and their cosine, in double precision,
is at least *cosine*.

Method
------
* Equal vectors of a label are one class (counted, not paired), so a very common
  vector is one row.
* A *fast rotation* multiplies by random signs and applies the fast Hadamard
  transform, three times over, on the vector padded to a power of two. The
  *cross-polytope hash* of a rotated vector is its nearest signed axis.
* A table's bucket joins ``k`` such hashes; k grows with the classes of the
  largest label so that a bucket of unrelated vectors stays small, and the number
  of tables with k so that the recall of a pair at the threshold stays. *Multiprobe*: besides its
  own bucket a vector probes those next nearest (the axes that lose least).
* Classes that meet in the own bucket of one of them, in any of the *tables*, are
  candidate pairs; a pair is verified once, on the vectors themselves, so no false link remains.
  Every class is hashed in every table, and no bucket is capped: the pairs of a
  large bucket are spread over tasks by a grid of its members.

Signs come from a fixed seed, so reruns agree. Recall (measured by brute force
in the tests) is a matter of *tables* and *probes*.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import column, mix, signed
from .components import connected_components
from .tables import keep, partitions_for

COSINE = 0.93
TABLES = 10
RECALL = 0.995
PROBES = 6
BUCKET_ROWS = 4
GRID = 4096
_SEED = 77


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (length a power of two)."""
    n, d = x.shape
    step = 1
    while step < d:
        x = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    """Pseudo-random rotation *number* of each row."""
    rng = np.random.Generator(np.random.PCG64([_SEED, number, x.shape[1]]))
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], x.shape[1]))
    return x


def probes(x: np.ndarray, table: int, k: int, count: int) -> np.ndarray:
    """(rows, count) bucket numbers of unit rows in *table*, nearest first:
    one axis of the k polytopes at a time gives way to its next nearest."""
    n, d = x.shape
    best, losses = [], []
    depth = min(d, max(2, -(-(count - 1) // k) + 1))
    for j in range(k):
        y = rotated(x, table * k + j)
        size = np.abs(y)
        order = np.argsort(-size, axis=1, kind="stable")[:, :depth]
        near = np.take_along_axis(size, order, 1)
        axis = order * 2 + (np.take_along_axis(y, order, 1) < 0)
        best.append(axis.astype(np.uint64))
        losses.append(near[:, :1] - near[:, 1:])
    own = np.zeros(n, np.uint64)
    for j in range(k):
        own = own * np.uint64(2 * d) + best[j][:, 0]
    loss = np.concatenate(losses, 1)
    pick = np.argsort(loss, axis=1, kind="stable")[:, :count - 1]
    out = [own]
    for column_ in pick.T:
        j, step = column_ // (depth - 1), column_ % (depth - 1) + 1
        weight = np.array([(2 * d) ** (k - 1 - i) for i in range(k)], np.uint64)[j]
        first = np.stack([b[:, 0] for b in best], 1)[np.arange(n), j]
        other = np.stack(best, 1)[np.arange(n), j, step]
        out.append(own + (other - first) * weight)
    return np.stack(out, 1)


def tables_for(k: int, width: int, cosine: float, count: int, least: int = TABLES) -> int:
    """Tables, *least* or more, in which a pair of vectors of *width* components
    and exactly that cosine meets with probability RECALL: the chance of one
    table is measured on seeded random pairs."""
    d, tries = 1 << max(0, (width - 1).bit_length()), 4
    rng = np.random.Generator(np.random.PCG64([_SEED, k, d]))
    x, z = (rng.standard_normal((min(2048, max(256, (1 << 17) // d)), d)) for _ in range(2))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.maximum(np.sqrt((z * z).sum(1, keepdims=True)), 1e-12)
    y = cosine * x + np.sqrt(max(0.0, 1 - cosine * cosine)) * z
    met = 0.0
    for table in range(tries):
        a, b = probes(x, table, k, count), probes(y, table, k, count)
        met += ((a[:, :1] == b).any(1) | (a == b[:, :1]).any(1)).mean() / tries
    return max(least, int(np.ceil(np.log(1 - RECALL) / np.log1p(-min(max(met, 1e-3), 0.999)))))


def _matrix(values: pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision, padded."""
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)
    flat = flat / np.abs(flat).max(1, keepdims=True)
    return flat / np.sqrt((flat * flat).sum(1, keepdims=True))


def _by_dimension(batch: pa.RecordBatch, name: str):
    values = column(batch, name)
    sizes = np.fromiter((len(v) for v in values), np.int64, len(values))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, _matrix(values.take(pa.array(rows)))


def _buckets(k: int, tables: int, count: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rep = column(batch, "rep").to_numpy()
            label = column(batch, "label").to_numpy().astype(np.int64).view(np.uint64)
            for rows, x in _by_dimension(batch, "embedding"):
                size = x.shape[1]
                padded = np.zeros((len(x), 1 << max(0, (size - 1).bit_length())))
                padded[:, :size] = x
                for table in range(tables):
                    key = probes(padded, table, k, count)
                    place = mix(mix(label[rows] + np.uint64(table << 40)) + np.uint64(size))
                    key = mix(key + place[:, None])
                    own = np.zeros(key.shape, bool)
                    own[:, 0] = True
                    yield pa.RecordBatch.from_arrays([pa.array(signed(key.reshape(-1))), pa.array(np.repeat(rep[rows], key.shape[1])),
                                                      pa.array(own.reshape(-1))], ["bucket", "rep", "own"])
    return run


def _pairs(batches):
    """Pairs of the buckets in a task with one member at least in its own
    bucket. Rows come sorted by (bucket, i, j); in a grid cell with i < j, pairs
    across the two chunks."""
    held: list[pa.RecordBatch] = []

    def pairs(table: pa.Table):
        cell = np.stack([table[c].to_numpy() for c in ("bucket", "i", "j")], 1)
        chunk, rep = table["chunk"].to_numpy(), table["rep"].to_numpy()
        own = table["own"].to_numpy()
        last = np.append(np.flatnonzero((cell[1:] != cell[:-1]).any(1)), len(cell) - 1)
        later = last[np.searchsorted(last, np.arange(len(cell)))] - np.arange(len(cell))
        begin = 0
        while begin < len(cell):
            end = max(begin + 1, begin + int(np.searchsorted(np.cumsum(later[begin:]), 1 << 19)))
            n = later[begin:end]
            x = np.repeat(np.arange(begin, end), n)
            y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
            ok = (own[x] | own[y]) & (rep[x] != rep[y]) & ((cell[x, 1] == cell[x, 2]) | (chunk[x] != chunk[y]))
            a, b = rep[x[ok]], rep[y[ok]]
            found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], ["a", "b"])
            begin = end

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < 1 << 16:
            continue
        table = pa.Table.from_batches(held)
        keys = table["bucket"].to_numpy()
        whole = len(keys) - int(np.argmax(keys[::-1] != keys[-1])) if keys[0] != keys[-1] else 0
        if whole:  # the last bucket may go on in the next batch
            yield from pairs(table.slice(0, whole))
            held = table.slice(whole).to_batches()
    if held and (table := pa.Table.from_batches(held)).num_rows:
        yield from pairs(table)


def _verify(cosine: float):
    def run(batches):
        for batch in batches:
            sizes = [np.fromiter((len(v) for v in column(batch, c)), np.int64, batch.num_rows) for c in ("v_a", "v_b")]
            ok = np.zeros(batch.num_rows, bool)
            for size in np.unique(sizes[0]):
                rows = np.flatnonzero((sizes[0] == size) & (sizes[1] == size))
                x, y = (_matrix(column(batch, c).take(pa.array(rows))) for c in ("v_a", "v_b"))
                ok[rows] = (x * y).sum(1) >= cosine
            yield pa.RecordBatch.from_arrays([column(batch, "a"), column(batch, "b")], ["a", "b"]).filter(pa.array(ok))
    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes_: int = PROBES,
                 k: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of *vectors* (vec_id,
    embedding, label).

    A null label, and an embedding that is null, empty, zero or holds null or
    non-finite components, links with nothing. Equal vectors of a label link
    with each other. Rows with a null vec_id are counted as links but have a
    null component unless others are in it, and are not kept. Rows with equal
    vec_id are copies of one vector id, counted each. Vectors of different
    length never link. An empty table gives no rows. *tables* is the least
    number of tables; *k* is chosen from the table unless it is given.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
                          F.col("label").cast("long").alias("label"))
    good = (F.col("label").isNotNull() & (F.size("embedding") > 0)
            & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("embedding", lambda x: x != 0))
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    # One row per distinct vector of a label; a class is named by a row number
    # that its least id and content fix.
    classes, _ = keep(rows.where("good").groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
                      .withColumn("rep", F.xxhash64("label", "embedding")), "vector_classes")
    n, most, width = classes.groupBy("label").agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("width")).agg(
        F.sum("n"), F.max("n"), F.max("width")).first()
    n, most, width = n or 0, most or 0, width or 1
    if k is None:
        k = 1
        while (2 * width) ** k * BUCKET_ROWS < most:
            k += 1
    tables = tables_for(k, width, cosine, probes_, tables)
    buckets, _ = keep(classes.select("rep", "label", "embedding").mapInArrow(_buckets(k, tables, probes_), "bucket long, rep long, own boolean"), "vector_buckets")
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket", (F.col("n") / GRID).cast("int").alias("last"))
    grid = (buckets.join(shared, "bucket").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("last") + 1).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
            .select("bucket", "rep", "own", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j")))
    pairs = (grid.repartition(partitions_for(spark, n * tables * probes_ * 32), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
             .mapInArrow(_pairs, "a long, b long").distinct())
    side = classes.select("rep", "embedding")
    links, _ = keep(pairs.join(side.select(F.col("rep").alias("a"), F.col("embedding").alias("v_a")), "a")
                    .join(side.select(F.col("rep").alias("b"), F.col("embedding").alias("v_b")), "b")
                    .select("a", "b", "v_a", "v_b").mapInArrow(_verify(cosine), "a long, b long"), "vector_links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = (both.join(classes.select(F.col("rep").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
              .withColumnRenamed("a", "rep"))
    found = connected_components(links).withColumnRenamed("node", "rep")
    known = (classes.join(linked, "rep", "left").join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    known, _ = keep(known, "vector_known")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    answer = known.join(least, "component").select(
        F.col("label").alias("k_label"), F.col("embedding").alias("k_embedding"),
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    return (rows.join(answer, F.col("good") & (F.col("label") == F.col("k_label")) & (F.col("embedding") == F.col("k_embedding")), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
