"""The registered queries of this subpackage: one per operator, over its whole
table. ``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLE``
has the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import importance, lattice_lm, licenses, mixing, ordinal_toxicity, packing, risk_rules
from .cross_polytope import near_vectors
from .parity_join import near_duplicates
from .periodic import periodic_runs
from .personal import BASE, personal_spans
from .suffix_dedup import remove_repeats
from .whitening import whiten


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _tokenizer(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected toxicity severity of every document."""
    return ordinal_toxicity.severity(_documents(spark, sf_dir), _labels(spark, sf_dir).select("doc_id", "toxic"))


def op2_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document, and a word baseline."""
    return lattice_lm.score(_documents(spark, sf_dir), _tokenizer("piece_bpe_32k.model"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and risk-controlled verdict of every document."""
    return risk_rules.judge(_documents(spark, sf_dir), _labels(spark, sf_dir)).drop("text_hash")


def op4_differencing_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in windows of 2048 tokens."""
    return packing.pack(_documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"), window=2048, end_id=1)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document (five words, 0.8)."""
    return near_duplicates(_documents(spark, sf_dir), n=5, percent=80)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the capped mix takes."""
    return mixing.mix(_documents(spark, sf_dir)).drop("source")


def op7_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences that documents, or lines of them, are."""
    return licenses.scan(_documents(spark, sf_dir))


def op8_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log importance of every document and whether the sample keeps it."""
    return importance.resample(_documents(spark, sf_dir), _labels(spark, sf_dir))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector (cosine 0.93, equal labels)."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.93)


def _digests(docs: DataFrame) -> DataFrame:
    cut = remove_repeats(docs.select("doc_id", "text"), length=100)
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return cut.select("row.doc_id", "n_bytes", lost.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every document without its repeated 100-byte strings."""
    return _digests(_documents(spark, sf_dir))


def _planted(words: list[bytes], row: dict) -> list[bytes]:
    """The contract's texts: a tenth of them repeat their words from some word on."""
    h = zlib.crc32(str(row["doc_id"]).encode()) if row["doc_id"] is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and digests of them and of the
    text without their repeats (a null doc_id leaves the words as they are)."""
    found = periodic_runs(_documents(spark, sf_dir).select("doc_id", "text"), min_length=12, rewrite=_planted)
    longest = F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], F.signum(b["length"] - a["length"]).cast("int"))
                           .when(a["start"] != b["start"], F.signum(a["start"] - b["start"]).cast("int"))
                           .otherwise(F.signum(a["period"] - b["period"]).cast("int")))
    found = found.withColumn("longest", F.get(longest, F.lit(0)))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]).alias("x")), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every vector on the first 16 components (a
    deviation beyond 63 bits, which contracts to a long, is null)."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=16).withColumn(
        "deviation", F.expr("try_cast(deviation as long)"))


def op13_personal_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base kinds,
    and all spans."""
    found = personal_spans(_documents(spark, sf_dir).select("doc_id", "text"))

    def of_kind(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "row.doc_id", *map(of_kind, BASE),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


QUERIES = {
    "op1_ordinal_toxicity": op1_ordinal_toxicity,
    "op2_subword_lattice": op2_subword_lattice,
    "op3_quality_rules": op3_quality_rules,
    "op4_differencing_pack": op4_differencing_pack,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_source_mixing": op6_source_mixing,
    "op7_licence_digests": op7_licence_digests,
    "op8_importance_resampling": op8_importance_resampling,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_personal_spans": op13_personal_spans,
}

ORACLE: dict[str, str] = {
    "op3_quality_rules": risk_rules.oracle_sql(),
    "op6_source_mixing": mixing.oracle_sql(),
    "op7_licence_digests": licenses.oracle_sql(),
}
