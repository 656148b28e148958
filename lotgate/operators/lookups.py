"""Reference lookups: size-checked broadcast, the flattened hierarchy (H-1) and
key resolution from names to ids (J-1, J-2, J-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frames above this many rows are joined by shuffle instead of broadcast.
# Every broadcast frame here is narrow (ids, names, a date, a flag), so the
# bound keeps a broadcast well under a few hundred MB.  A session may lower
# or raise it with the ``lotgate.broadcast.maxRows`` setting.
BROADCAST_ROW_LIMIT = 1_000_000


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("lotgate.broadcast.maxRows", str(BROADCAST_ROW_LIMIT)))


def bounded_broadcast(dim: DataFrame, limit: int | None = None) -> DataFrame:
    """Broadcast *dim* only when it provably has at most *limit* rows.

    The check reads at most ``limit + 1`` rows; beyond the bound the frame is
    returned unchanged and the planner (with AQE) picks a shuffle join.
    """
    limit = limit or broadcast_limit(dim)
    if dim.limit(limit + 1).count() <= limit:
        return F.broadcast(dim)
    return dim


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    limit = limit or broadcast_limit(df)
    return df.limit(limit + 1).count() <= limit


# A Bloom filter of fixed size: two bitmaps of BLOOM_ROWS rows of 4 KB each.
BLOOM_ROWS = 2048
_ROW_BITS = 32_768  # bits that bitmap_construct_agg keeps in a row


def bloom_restrict(table: DataFrame, col: str, keys: DataFrame, key_col: str) -> DataFrame:
    """Rows of *table* whose *col* may occur in *keys*, found map-side.

    Each of two hashes of a key sets a bit in a bitmap of BLOOM_ROWS * 32,768
    bits; the bitmaps (8 MB each, whatever the number of keys) are broadcast and
    a row passes if its bits are set.  Keys always pass; others seldom, while
    the keys are fewer than the bits.  An exact join must follow.
    """
    for seed in (1, 2):
        def bit(c: str):
            return F.pmod(F.xxhash64(F.lit(seed), F.col(c)), F.lit(BLOOM_ROWS * _ROW_BITS))
        bitmap = keys.where(F.col(key_col).isNotNull()).select(bit(key_col).alias("_bit")).groupBy(
            F.floor(F.col("_bit") / _ROW_BITS).alias("_row")).agg(F.bitmap_construct_agg(F.col("_bit") % _ROW_BITS).alias("_bits"))
        probed = table.withColumn("_bit", bit(col)).withColumn("_probe", F.floor(F.col("_bit") / _ROW_BITS))
        met = probed.join(F.broadcast(bitmap), F.col("_probe") == F.col("_row"))
        place = (F.col("_bit") % _ROW_BITS).cast("int")
        byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit % 32768 div 8 as int) + 1, 1)")), 16, 10).cast("int")
        table = met.where(F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1).drop("_bit", "_probe", "_row", "_bits")
    return table


def restrict_to_keys(table: DataFrame, col: str, keys: DataFrame, key_col: str,
                     limit: int | None = None, small: bool | None = None) -> DataFrame:
    """Rows of a (large) *table* whose *col* occurs in *keys*.

    *keys* is small per run (the names one upload touches); within the bound
    it is broadcast and the table is filtered map-side without a shuffle.
    Beyond it a Bloom filter of fixed size does the same but for a few rows, and
    the exact join shuffles only what passes.  *small* passes a size check the
    caller already made.
    """
    k = keys.select(F.col(key_col).alias("_r_key")).distinct()
    if small is None:
        small = fits_broadcast(k, limit)
    if small:
        k = F.broadcast(k)
    else:
        table = bloom_restrict(table, col, k, "_r_key")
    return table.join(k, table[col] == k["_r_key"], "left_semi")


def restrict_for_anti_join(table: DataFrame, col: str, keys: DataFrame, key_col: str) -> DataFrame:
    """What an anti join of *keys* needs of *table*: a table within the broadcast
    bound as it is, for which the keys need not be found first (they are the
    outcome of a whole run, the table often new and empty); of a larger one
    the rows of :func:`restrict_to_keys`."""
    return F.broadcast(table) if fits_broadcast(table) else restrict_to_keys(table, col, keys, key_col)


HEAVY_NAMES = 100
HEAVY_SHARE = 200  # a name is heavy from this part of the rows on


def heavy_names(rows: DataFrame, col: str) -> list[str]:
    """The names that hold more than a 200th of *rows*: HEAVY_NAMES at most, from
    an approximate top-k sketch that tasks merge (no shuffle of the rows)."""
    found = rows.where(F.col(col).isNotNull()).agg(
        F.expr(f"approx_top_k(`{col}`, {HEAVY_NAMES}, 10000)").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(r["item"] for r in found["top"] or [] if r["count"] * HEAVY_SHARE > found["n"])


def spread_join(rows: DataFrame, col: str, table: DataFrame, key: str, inner: bool = False) -> DataFrame:
    """*rows* with the columns of *table* (unique on *key*) where ``col = key``: a
    left join by shuffle, or an inner one, in which no name gathers rows.

    Heavy names meet their table rows by broadcast (HEAVY_NAMES rows at most).
    In the shuffle join, rows of heavy names and rows without a name have a hash
    of the row as key, which no name is, so they spread over all tasks.
    """
    heavy = heavy_names(rows, col)
    values = [c for c in table.columns if c != key]
    is_heavy = F.coalesce(F.col(col).isin(heavy), F.lit(False)) if heavy else F.lit(False)
    named = F.when(~is_heavy & (F.trim(F.col(col)) != ""), F.col(col))
    known = table.select(F.concat(F.lit("n"), F.col(key)).alias("_j_key"), *[F.col(c).alias(f"_j_{c}") for c in values], F.lit(True).alias("_j_met"))
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).cast("string")
    out = rows.withColumn("_k_key", F.when(named.isNull(), F.concat(F.lit("row "), whole)).otherwise(F.concat(F.lit("n"), named)))
    out = out.join(known, F.col("_k_key") == F.col("_j_key"), "left")
    found = {c: F.col(f"_j_{c}") for c in values}
    met = F.col("_j_met")
    if heavy:
        few = table.where(F.col(key).isin(heavy)).select(F.col(key).alias("_f_key"), *[F.col(c).alias(f"_f_{c}") for c in values], F.lit(True).alias("_f_met"))
        out = out.join(F.broadcast(few), F.col(col) == F.col("_f_key"), "left")
        found = {c: F.coalesce(F.col(f"_j_{c}"), F.col(f"_f_{c}")) for c in values}
        met = F.coalesce(met, F.col("_f_met"))
    if inner:
        out = out.where(met)
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], *[v.alias(c) for c, v in found.items()])


def bounded_broadcast_all(dims: list[DataFrame], limit: int | None = None) -> list[DataFrame]:
    """:func:`bounded_broadcast` for several frames, sized in one job."""
    if not dims:
        return []
    limit = limit or broadcast_limit(dims[0])
    parts = [d.limit(limit + 1).agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "n")
             for i, d in enumerate(dims)]
    sized = parts[0]
    for p in parts[1:]:
        sized = sized.unionByName(p)
    counts = {r["i"]: r["n"] for r in sized.collect()}
    return [F.broadcast(d) if counts[i] <= limit else d for i, d in enumerate(dims)]


def hierarchy_dim(process: DataFrame, unit_operation: DataFrame, parameter: DataFrame) -> DataFrame:
    """One row per parameter with its unit operation and process, ids and names (H-1)."""
    return (
        process.select("process_id", "process_name")
        .join(unit_operation.select("unit_operation_id", "process_id", "unit_operation_name"),
              "process_id")
        .join(parameter.select("parameter_id", "unit_operation_id", "parameter_name"),
              "unit_operation_id")
        .select("process_id", "process_name", "unit_operation_id", "unit_operation_name",
                "parameter_id", "parameter_name")
    )


def unit_operation_dim(process: DataFrame, unit_operation: DataFrame) -> DataFrame:
    """Process and unit-operation names with the unit operation id (J-2 level)."""
    return process.select("process_id", "process_name").join(
        unit_operation.select("unit_operation_id", "process_id", "unit_operation_name"),
        "process_id",
    )


def lookup_manufacturer(rows: DataFrame, manufacturer: DataFrame,
                        name_col: str = "Manufacturer") -> DataFrame:
    """Inner lookup of the manufacturer id by exact name (J-1)."""
    m = bounded_broadcast(manufacturer.select(
        F.col("name").alias("_m_name"), "manufacturer_id"))
    return rows.join(m, rows[name_col] == m["_m_name"], "inner").drop("_m_name")


def lookup_unit_operation(rows: DataFrame, process: DataFrame, unit_operation: DataFrame) -> DataFrame:
    """Inner lookup of process id then unit-operation id by names (J-2)."""
    p = bounded_broadcast(process.select(F.col("process_name").alias("_p_name"), "process_id"))
    step = rows.join(p, rows["Process"] == p["_p_name"], "inner").drop("_p_name")
    u = bounded_broadcast(unit_operation.select(
        F.col("process_id").alias("_u_pid"), F.col("unit_operation_name").alias("_u_name"),
        "unit_operation_id"))
    return step.join(
        u, (step["process_id"] == u["_u_pid"]) & (step["Unit Operation"] == u["_u_name"]), "inner"
    ).drop("_u_pid", "_u_name")


def resolve_parameter(rows: DataFrame, hier: DataFrame) -> DataFrame:
    """Inner lookup of parameter_id by the three hierarchy names (J-3, hierarchy part)."""
    h = bounded_broadcast(hier.select(
        F.col("process_name").alias("_h_p"), F.col("unit_operation_name").alias("_h_u"),
        F.col("parameter_name").alias("_h_n"), "parameter_id"))
    cond = ((rows["Process"] == h["_h_p"]) & (rows["Unit Operation"] == h["_h_u"])
            & (rows["Parameter"] == h["_h_n"]))
    return rows.join(h, cond, "inner").drop("_h_p", "_h_u", "_h_n")


def resolve_keys(rows: DataFrame, batch: DataFrame, hier: DataFrame) -> DataFrame:
    """Names to (batch_id, parameter_id) (J-3).

    The hierarchy is reference data and is broadcast behind a size check.  The
    batch table grows with the data: when the rows name few enough batches it
    is filtered map-side by a broadcast of those names and the result is
    broadcast; otherwise it is a shuffle join on the batch name in which a hot
    batch does not gather its rows (:func:`spread_join`).
    """
    with_param = resolve_parameter(rows, hier)
    # The names of all rows, so that sizing them does not run the join before.
    named = rows.select("Batch Name").distinct()
    if not fits_broadcast(named):
        return spread_join(with_param, "Batch Name", batch.select("batch_name", "batch_id"), "batch_name", inner=True)
    # Few batch names per run: filter the batch table map-side and
    # broadcast the matching rows, so nothing large shuffles.
    batch = F.broadcast(restrict_to_keys(batch, "batch_name", named, "Batch Name", small=True))
    b = batch.select(F.col("batch_name").alias("_b_name"), "batch_id")
    return with_param.join(b, with_param["Batch Name"] == b["_b_name"], "inner").drop("_b_name")
