"""Every registered check against its DuckDB twin on the smallest driver tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_mod
from lotgate import registry

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(df: pd.DataFrame):
    df = df.reindex(sorted(df.columns), axis=1)

    def cell(v):
        if v is None or (not isinstance(v, (list, tuple)) and pd.isna(v)):
            return None
        if isinstance(v, float) and v.is_integer() and not math.isinf(v):
            return str(int(v))
        return str(v)

    rows = [tuple(cell(v) for v in r) for r in df.itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, x or "") for x in r))


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(entry_mod.queries())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns[:3] == ["batch_name", "dom", "manufacturer"]
    assert df.count() > 0


def test_queries_match_oracle(spark, oracle):
    bad = []
    sqls = registry.oracle_sql()
    for name, fn in registry.queries().items():
        got = fn(spark, SF_DIR).toPandas()
        exp = oracle.execute(sqls[name]).df()
        if sorted(got.columns) != sorted(exp.columns) or canon(got) != canon(exp):
            bad.append(name)
    assert bad == []
