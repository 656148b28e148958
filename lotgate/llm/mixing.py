"""Mixing sources to target weights by capped water-filling.

*Targets.* Every source has a weight and wants that share of all words, but is
never repeated more than *max_epochs* times: sources whose share exceeds
``max_epochs * size`` are clamped there and the excess is redistributed to the
others in proportion to their weights until none is above. The end state is
``target = min(cap, level * weight)`` with one water level, and sources clamp in
order of ``cap / weight``; so a running sum over the sources in that order finds
the level without iterating.

*Sampling.* A target of 2.4 sizes takes every document twice and a seeded 0.4:
documents are ordered by ``md5(seed, doc_id)`` and taken until the remainder is
used up, the last one in part. To find the cut without ordering a whole source
in one task, words are first summed per source and leading hash digits; only the
cell that holds the cut is ordered document by document. The number of digits
grows with the table, so a cell stays small even if one source holds most rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import keep, word_count

MAX_EPOCHS = 3
WEIGHTS = [1, 2, 3]
SEED = "mix-1"
CELL_ROWS = 1000


def targets(sizes: DataFrame, weights: list[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) for a row per source (source,
    source_size). Weights repeat over the sources in code point order, null
    last. The windows run over one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
    weighed = sizes.withColumn("weight", weight).withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    everything = Window.partitionBy()
    # In order of cap / weight: caps of the sources before, weights from here on.
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    levels = (weighed.withColumn("total", F.sum("source_size").over(everything).cast("double"))
              .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("open", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("level", F.col("left") / F.col("open"))
              # The first source that its level does not fill fixes the level.
              .withColumn("water", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(
                  (F.col("cap") / F.col("weight")).alias("at"), F.col("level").alias("level")))).over(everything)["level"]))
    return levels.select("source", "source_size", F.coalesce(F.least("cap", F.col("water") * F.col("weight")), F.col("cap")).alias("target"))


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def mix(docs: DataFrame, weights: list[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for each row of
    *docs* (doc_id, text, source): *taken* words of the document's ``size`` are
    in the mix, whole repetitions and one in part counted.

    A null text has size 0 and gives nothing; a null source is a source, the
    last; null doc_ids are ordered as the empty id. Equal rows are interchangeable: the same
    number of words is taken of them together. A source without words has
    target 0. An empty table gives no rows. Reruns agree: order depends on the
    seed and the rows only.
    """
    sized, _ = keep(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                                F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("draw")), "sized")
    n = sized.count()
    digits = 2
    while 16 ** digits * CELL_ROWS < n:
        digits += 1
    cell = F.substring("draw", 1, digits)
    cells, _ = keep(sized.groupBy("source", cell.alias("cell")).agg(F.sum("size").alias("cell_size")), "cells")
    aims = targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(max_epochs), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("long")
    aims = aims.withColumn("whole", whole).withColumn("rest", F.round(F.col("target")).cast("long") - F.col("whole") * F.col("source_size"))
    # Words of the source in cells before this one; the sums are long, so exact.
    upto = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    plan = (cells.withColumn("ahead", F.coalesce(F.sum("cell_size").over(upto), F.lit(0).cast("long")))
            .join(aims.withColumnRenamed("source", "aim_source"), _same("source", "aim_source")).drop("aim_source"))
    plan = plan.select(F.col("source").alias("plan_source"), F.col("cell").alias("plan_cell"), "ahead", "cell_size", "source_size", "target", "whole", "rest")
    plan, _ = keep(plan, "mix_plan")
    rows = sized.withColumn("cell", cell).join(plan, _same("source", "plan_source") & (F.col("cell") == F.col("plan_cell")))
    cut = (F.col("ahead") < F.col("rest")) & (F.col("ahead") + F.col("cell_size") > F.col("rest"))
    within = Window.partitionBy("source", "cell").orderBy("draw", "doc_id", "size")
    split = rows.where(cut).withColumn("before", F.col("ahead") + F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    straight = rows.where(~cut).withColumn("before", F.col("ahead"))
    part = F.greatest(F.lit(0), F.least("size", F.when(cut, F.col("rest") - F.col("before")).otherwise(
        F.when(F.col("ahead") < F.col("rest"), F.col("size")).otherwise(0)))).cast("long")
    return straight.unionByName(split).select(
        "doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"),
        (F.col("whole") * F.col("size") + part).alias("taken"))


def repeat(docs: DataFrame, weights: list[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself, in the columns of *docs*: a row for each whole repetition
    and one with the leading words for a part; ``n_chars`` follows the text. A
    document without words weighs nothing in the mix and passes once."""
    plan = (mix(docs, weights, max_epochs, seed).where("taken > 0 or size = 0")
            .groupBy(F.col("doc_id").alias("mix_id"), F.col("size").alias("mix_size")).agg(F.max("taken").alias("mix_taken")))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("mix_row"), word_count(F.col("text")).alias("mix_words"))
    joined = rows.join(plan, F.col("mix_row.doc_id").eqNullSafe(F.col("mix_id")) & (F.col("mix_words") == F.col("mix_size")))
    size = F.greatest("mix_size", F.lit(1))
    whole = F.when(F.col("mix_size") == 0, 1).otherwise(F.floor(F.col("mix_taken") / size)).cast("int")
    part = F.col("mix_taken") % size
    copies = F.concat(F.array_repeat(F.lit(0).cast("long"), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    text = F.col("mix_row.text")
    out = joined.withColumn("mix_copy", F.explode(copies)).withColumn(
        "mix_text", F.when(F.col("mix_copy") == 0, text).otherwise(_leading_words(text, F.col("mix_copy"))))
    changed = {"text": F.col("mix_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("mix_text").cast(docs.schema["n_chars"].dataType)
    return out.select(*(changed.get(c, F.col(f"mix_row.`{c}`")).alias(c) for c in docs.columns))


def _leading_words(text: Column, n: Column) -> Column:
    """The text up to its n-th word."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def oracle_sql(weights: list[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> str:
    """DuckDB SQL for :func:`mix` over documents (without its source column)."""
    weight = "[" + ", ".join(f"{float(w)}::double" for w in weights) + "]"
    return rf"""
with recursive d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
        md5('{seed}:' || coalesce(doc_id::varchar, '')) as draw from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, {weight}[((row_number() over (order by source nulls last) - 1) % {len(weights)} + 1)::integer] as weight, {max_epochs} * source_size::double as cap,
        sum(source_size) over ()::double as total from s),
-- Clamp what is above its cap, share the rest out again, until nothing is.
f as (select 0 as round, source, source_size, weight, cap, total, false as shut from w
      union all
      select round + 1, source, source_size, weight, cap, total, shut or share * weight > cap from (
        select *, (total - sum(case when shut then cap else 0 end) over ()) / nullif(sum(case when shut then 0 else weight end) over (), 0) as share from f)
      where round <= (select count(*) from s)),
t as (select source, source_size, case when shut then cap else (total - sum(case when shut then cap else 0 end) over ())
        / sum(case when shut then 0 else weight end) over () * weight end as target from f where round = (select max(round) from f)),
a as (select *, case when source_size > 0 then least({max_epochs}, floor(target / source_size)) else 0 end::bigint as whole from t),
r as (select d.*, a.source_size, a.target, a.whole, round(a.target)::bigint - a.whole * a.source_size as rest,
        sum(size) over (partition by d.source order by draw, doc_id, size rows unbounded preceding) - size as before
      from d join a on d.source is not distinct from a.source)
select doc_id, size, source_size, target, (whole * size + greatest(0, least(size, rest - before)))::bigint as taken from r"""
