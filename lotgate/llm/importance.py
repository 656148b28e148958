"""Quality selection by importance resampling.

Two generative models over hashed words and word pairs are counted: one of the
*target* (documents labelled good), one of the *raw* corpus (all documents). A
document's log importance is the sum over its n-grams of
``log p_target - log p_raw``. Drawing k documents without replacement with
probabilities proportional to their importance is the Gumbel top-k: add seeded
Gumbel noise to each log importance and take the k largest.

Scale: both models have a fixed number of buckets, summed in tasks before the
shuffle. The k-th largest key is found by counting keys per leading 16 bits,
then within the one prefix that holds it, four times, so nothing is sorted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import column, mix, text_blocks
from .features import hashed_grams, sliced, summed
from .parity_join import bitmap_of, in_bitmap
from .tables import keep

BUCKETS = 1 << 16
ORDERS = (1, 2)
SEED = 11


def _count(buckets: int, name: str):
    def run(batches):
        total = np.zeros(buckets)
        for _, texts in text_blocks(batches):
            total += np.bincount(hashed_grams(texts, buckets, ORDERS, plain=False)[1], minlength=buckets)
        yield sliced(total, name)
    return run


def gumbel(ids: np.ndarray, seed: int) -> np.ndarray:
    """Seeded standard Gumbel noise by id."""
    uniform = (mix(mix(ids.view(np.uint64)) + np.uint64(seed)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return -np.log(-np.log(np.clip(uniform, 1e-300, 1 - 1e-16)))


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Longs in the order of the doubles."""
    bits = (x + 0.0).view(np.int64)
    return np.where(bits < 0, np.int64(-(1 << 63)) - bits - 1, bits)


def _weigh(log_ratio, buckets: int, seed: int):
    def run(batches):
        ratio = log_ratio.value
        for batch, texts in text_blocks(batches):
            doc, bucket = hashed_grams(texts, buckets, ORDERS, plain=False)
            weight = np.bincount(doc, ratio[bucket], len(texts))
            ids = column(batch, "doc_id")
            number = pc.fill_null(ids, -1).to_numpy()
            key = ordered_bits(weight + gumbel(number, seed))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.bincount(doc, minlength=len(texts)).astype(np.int64)), pa.array(weight), pa.array(key)],
                                             ["doc_id", "n_grams", "log_importance", "key"])
    return run


def kth_largest(keys: DataFrame, k: int, name: str = "key") -> int:
    """The k-th largest value (from 1) of a long column, by four counting
    passes over 16 bits each; at most 65,536 counts reach the driver."""
    prefix, part = None, keys
    for shift in (48, 32, 16, 0):
        part = keys if prefix is None else keys.where(F.shiftright(name, shift + 16) == F.lit(prefix))
        counts = sorted(((r["p"], r["n"]) for r in part.groupBy(F.shiftright(name, shift).alias("p")).agg(F.count("*").alias("n")).collect()), reverse=True)
        for value, n in counts:
            if k <= n:
                prefix = value
                break
            k -= n
    return prefix


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_grams, log_importance, kept) for each row of *docs* (doc_id,
    text); *labels* (doc_id, quality 0/1) name the target, its good documents.

    ``k = round(share * rows)`` documents are kept; *share* defaults to the
    share of good among the labels (all documents without labels). Rows that
    tie with the k-th key, such as equal rows, are kept too. A null text has
    no n-grams and importance 0; a null doc_id draws the noise of one id; null
    labels count for nothing, and a document is good if any of its labels is.
    Reruns agree. An empty table gives no rows.
    """
    spark = docs.sparkSession
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna()
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    if share is None:
        share = marks.agg(F.avg("quality")).first()[0]
        share = 1.0 if share is None else share
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    # Only good documents are shuffled to their labels: a bitmap of fixed size
    # passes over the others in the scan.
    good = marks.where("quality = 1").select("doc_id")
    chosen = (texts.where("doc_id is not null").mapInArrow(in_bitmap(bitmap_of(good)), "doc_id long, text binary")
              .hint("merge").join(good, "doc_id", "left_semi"))
    vectors = "name string, slice int, data binary"
    counts = summed(texts.select("text").mapInArrow(_count(buckets, "raw"), vectors)
                    .unionByName(chosen.select("text").mapInArrow(_count(buckets, "target"), vectors)))
    target, raw = (counts.get(x, np.zeros(buckets)) + 1.0 for x in ("target", "raw"))
    ratio = spark.sparkContext.broadcast(np.log(target / target.sum()) - np.log(raw / raw.sum()))
    weighed, _ = keep(texts.mapInArrow(_weigh(ratio, buckets, seed), "doc_id long, n_grams long, log_importance double, key long"), "importance")
    k = round(share * weighed.count())
    kept = (F.col("key") >= F.lit(kth_largest(weighed, k))) if k else F.lit(False)
    return weighed.select("doc_id", "n_grams", "log_importance", kept.alias("kept"))
