"""The corpus pipeline: quality rules, near-duplicates, repeated passages,
mixing and packing over ``documents``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and reread as the next one's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotgate.llm import mixing, packing, risk_rules
from lotgate.llm.parity_join import representatives
from lotgate.llm.suffix_dedup import remove_repeats
from lotgate.llm.tables import keep


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the risk-controlled rules reject."""
    return risk_rules.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate component."""
    return representatives(docs, n=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated 100-byte strings out of the texts; every document stays (a
    null text becomes empty)."""
    cut = remove_repeats(docs, length=100, as_text=True)
    columns = {"text": F.col("kept"), "n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType)}
    return cut.select(*(columns[c].alias(c) if c in columns else F.col(f"row.{c}") for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and cut documents so that the sources have their target shares."""
    return mixing.repeat(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in windows of 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix_sources", mix_sources),
    ("pack_windows", pack_windows),
]

#: Suffix sorting and packing have no SQL form; the tests hold each stage
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents in *sf_dir*."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
