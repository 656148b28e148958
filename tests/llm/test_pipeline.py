"""The pipeline's stages on the small tables, and the registered SQL."""

import os

import pytest
from cases import words_of

import __spark_entry__ as entry
import corpus_pipeline
from lotgate.llm import queries
from lotgate.llm.tables import keep

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def shingles(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [{r["doc_id"]: r for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, _ = keep(stage(spark, docs, SF), name)
        assert docs.columns == spark.read.parquet(f"{SF}/documents.parquet").columns
        rows = docs.collect()
        seen.append({r["doc_id"]: r for r in rows})
    start, good, single, cut, mixed = seen
    assert set(mixed) <= set(cut) == set(single) <= set(good) <= set(start)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    passed = [i for i, r in start.items() if labels.get(i) == 1 and len(words_of(r["text"])) >= 200]
    assert sum(i in good for i in passed) >= 0.9 * len(passed)
    # No two that stay are near copies, and whoever left has one that stayed or left with it.
    sets = {i: shingles(r["text"]) for i, r in good.items()}
    left = list(single)
    for x, i in enumerate(left):
        for j in left[:x]:
            both = len(sets[i] & sets[j])
            assert not both or 100 * both < 80 * (len(sets[i]) + len(sets[j]) - both)
    for i in set(good) - set(single):
        assert any(j != i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j in good)
    # What a text lost occurs earlier.
    for i, r in cut.items():
        assert len(r["text"]) <= len(single[i]["text"]) and r["n_chars"] == len(r["text"])
    assert cut[min(cut)]["text"] == single[min(cut)]["text"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == set(mixed)


def test_registered_names():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert names["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    found = queries.QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    expected = con.execute(f"select {', '.join(columns)} from ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in found.select(columns).collect()))) == sorted(map(str, expected))
