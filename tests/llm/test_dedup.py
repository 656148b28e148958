"""Joins and deduplication against brute force."""

import hashlib
import os
import subprocess
import sys

import numpy as np
import pytest
from cases import corpus, docs, none, random_words, words_of  # noqa: F401
from pyspark.sql import functions as F

from lotgate.llm import parity_join, suffix_dedup
from lotgate.llm.components import connected_components
from lotgate.llm.cross_polytope import hadamard, near_vectors, rotated
from lotgate.llm.parity_join import near_duplicates, representatives
from lotgate.llm.suffix_dedup import equal_runs, merged, remove_repeats


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute_components(rows):
    """Distinct (doc_id, text) rows; rows of one doc_id are one document."""
    sets = [(i, shingles(t)) for i, t in rows]
    union = Union()
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and a and 100 * len(a & b) >= 80 * len(a | b):
                union.join(i, j)
    return sets, union


def check_near(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted(map(tuple, near_duplicates(frame).collect()), key=str)
    sets, union = brute_components(rows)
    expected = sorted(((i, len(s), i if i is None else union.find(i) if s else i) for i, s in sets), key=str)
    assert found == expected


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (7, 7), (200, 90), (90, 101), (100, 101)]
    found = dict(connected_components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect())
    assert found == {**{i: 0 for i in range(51)}, 100: 90, 101: 90, 200: 90, 90: 90}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_match_brute_force(spark):
    rows = [(r[0], r[1]) for r in corpus() if r[0] is not None]
    check_near(spark, rows)


def test_near_duplicates_at_the_threshold(spark):
    """Pairs with k of n shingles in common around 0.8, at many sizes."""
    rng = np.random.default_rng(3)
    rows, number = [], 0
    for size in (5, 6, 9, 14, 20, 50, 63, 64, 65, 130, 255, 256, 400, 1100):
        base = random_words(rng, size, 10 ** 6).split()
        for cut in sorted({0, 1, size // 12, size // 10, size // 9, size // 8, size // 6, size // 5, size // 4}):
            rows.append((number, " ".join(base[cut:])))  # drops cut shingles
            rows.append((number + 1, " ".join(base[:max(1, size - cut)] + random_words(rng, cut, 10 ** 6).split())))
            number += 2
    check_near(spark, rows)


@pytest.mark.parametrize("spread", [16, 2048])
def test_near_duplicates_in_large_mixed_groups(spark, monkeypatch, spread):
    """Chains of drifting copies that share a passage with unlike documents;
    the grid of large buckets is used."""
    monkeypatch.setattr(parity_join, "GRID", 8)
    monkeypatch.setattr(parity_join, "SPREAD", spread)
    rng = np.random.default_rng(9)
    passage = random_words(rng, 40, 10 ** 6)
    rows = [(i, f"{random_words(rng, 25, 10 ** 6)} {passage} {random_words(rng, 20, 10 ** 6)}") for i in range(40)]
    w = (passage + " " + random_words(rng, 60, 10 ** 6)).split()
    for i in range(40, 90):
        w[int(rng.integers(0, len(w)))] = f"drift{i}"
        rows.append((i, " ".join(w)))
    check_near(spark, rows)


def test_near_duplicates_edge_rows(spark, docs, none):
    assert near_duplicates(none).count() == 0
    found = {r["doc_id"]: r for r in near_duplicates(docs).where("doc_id is not null").collect()}
    by_text = {r[1]: r[0] for r in corpus() if r[0] is not None}
    assert found[by_text[""]]["n_shingles"] == 0 and found[by_text[None]]["component_id"] == by_text[None]
    assert found[by_text["one"]]["n_shingles"] == 1
    stay = representatives(docs)
    assert stay.columns == docs.columns
    ids = [r["doc_id"] for r in stay.collect()]
    assert ids.count(3) == 1 and ids.count(None) == 2
    assert representatives(none).count() == 0


def test_representatives_of_rows_that_share_an_id(spark):
    """Two texts with one id: the same row stays however the rows lie."""
    rng = np.random.default_rng(6)
    rows = [(i % 10, random_words(rng, 40, 10 ** 6), f"src{i}") for i in range(40)]
    stayed = set()
    for parts, turned in ((1, rows), (3, rows[::-1]), (5, rows[7:] + rows[:7])):
        frame = spark.createDataFrame(turned, "doc_id long, text string, row string").repartition(parts)
        stayed.add(tuple(sorted(map(tuple, representatives(frame).collect()))))
    assert len(stayed) == 1 and [r[0] for r in next(iter(stayed))] == list(range(10))


def brute_repeats(rows, length):
    """rows: (doc_id, bytes) with distinct ids, in any order."""
    seen, out = {}, {}
    for i, x in rows:
        for k in range(len(x) - length + 1):
            s = x[k:k + length]
            seen[s] = min(seen.get(s, (i, k)), (i, k))
    for i, x in rows:
        gone = bytearray(len(x))
        for k in range(len(x) - length + 1):
            if seen[x[k:k + length]] < (i, k):
                gone[k:k + length] = b"\1" * length
        out.setdefault(i, []).append((len(x), bytes(c for c, g in zip(x, gone) if not g), sum(1 for k in range(len(x)) if gone[k] and (k == 0 or not gone[k - 1]))))
    return {i: sorted(v) for i, v in out.items()}


def found_repeats(frame, **kw):
    out = {}
    for r in remove_repeats(frame, **kw).collect():
        key = r["row"]["doc_id"]
        out.setdefault((1 << 63) - 1 if key is None else key, []).append((r["n_bytes"], bytes(r["kept"]), len(r["removed"])))
    return {i: sorted(v) for i, v in out.items()}


def test_repeats_match_brute_force(spark, docs, none):
    rows = [((1 << 63) - 1 if r[0] is None else r[0], (r[1] or "").encode()) for r in corpus()]
    assert found_repeats(docs) == brute_repeats(rows, 100)
    assert remove_repeats(none).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_with_small_windows(spark, seed):
    """Many overlapping repeats over a small alphabet, over many buckets."""
    rng = np.random.default_rng(seed)
    pieces = ["".join(rng.choice(list("abc"), 40)) for _ in range(6)]
    texts = ["".join(pieces[j] if rng.random() < 0.7 else "".join(rng.choice(list("abcd"), 15)) for j in rng.integers(0, 6, 12)) for _ in range(40)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    assert found_repeats(frame, length=20, gram=8) == brute_repeats([(i, t.encode()) for i, t in enumerate(texts)], 20)


def test_repeats_across_bucket_boundaries(spark, monkeypatch):
    """One passage in most documents with differing surroundings: its anchors
    go over several buckets of the range partitioning."""
    monkeypatch.setattr(suffix_dedup, "partitions_for", lambda *_a, **_k: 24)
    rng = np.random.default_rng(4)
    passage = random_words(rng, 50, 10 ** 6)
    texts = [f"{random_words(rng, int(rng.integers(0, 30)), 10 ** 6)} {passage[int(rng.integers(0, 60)):]} {random_words(rng, 10, 10 ** 6)}" for _ in range(80)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert found_repeats(frame) == brute_repeats([(i, t.encode()) for i, t in enumerate(texts)], 100)


def test_cut_text_keeps_whole_characters(spark):
    shared = "".join(chr(0x4E00 + 37 * i) for i in range(120))
    frame = spark.createDataFrame([(1, "a" + shared), (2, "ß" + shared + "ü")], "doc_id long, text string")
    found = {r["row"]["doc_id"]: r["kept"] for r in remove_repeats(frame, as_text=True).collect()}
    assert found[1] == "a" + shared and found[2].startswith("ß") and found[2].endswith("ü") and len(found[2]) <= 4


def test_multikey_sort_finds_equal_runs():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 400, dtype=np.uint8)
    places = np.arange(400 - 13)
    index, run = equal_runs(data, places, 13)
    strings = [data[p:p + 13].tobytes() for p in places]
    expected = {s for s in strings if strings.count(s) > 1}
    assert {strings[i] for i in index} == expected and len(index) == sum(s in expected for s in strings)
    assert len({(r, strings[i]) for i, r in zip(index, run)}) == len(expected)


def test_merged_intervals():
    x = np.array([[5, 9], [0, 3], [3, 4], [7, 12], [20, 21]])
    assert merged(x).tolist() == [[0, 4], [5, 12], [20, 21]]
    assert merged(np.zeros((0, 2), int)).tolist() == []


def brute_vectors(rows):
    union, links = Union(), [0] * len(rows)
    good = [i for i, (_, e, label) in enumerate(rows) if label is not None and e and None not in e and np.isfinite(e).all() and any(e)]
    for x, i in enumerate(good):
        union.find(i)
        for j in good[:x]:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93:
                links[i] += 1
                links[j] += 1
                union.join(i, j)
    comps = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            root = union.find(i)
            comps[root] = min(comps.get(root, v), v)
    return [(v, links[i], comps.get(union.find(i)), v is not None and v == comps.get(union.find(i))) for i, (v, _, _) in enumerate(rows)]


def vectors():
    rng = np.random.default_rng(8)
    base = rng.normal(size=(60, 24))
    rows = [(i, x.tolist(), i % 3) for i, x in enumerate(base)]
    for i in range(200):  # neighbours at all distances around the threshold
        x = base[i % 60] + rng.normal(size=24) * rng.uniform(0, 0.6)
        rows.append((100 + i, x.tolist(), int(i % 60 % 3)))
    rows += [(400 + i, base[0].tolist(), 0) for i in range(30)] + [(500, base[0].tolist(), 1), (501, (base[0] * 7).tolist(), 0)]
    rows += [(510, None, 1), (511, [0.0] * 24, 1), (512, [float("nan")] * 24, 1), (513, [float("inf")] + [1.0] * 23, 1), (514, [None] + [1.0] * 23, 1),
             (515, base[0].tolist(), None), (516, [], 0), (517, [1.0, 2.0], 0), (518, [1.0, 2.0], 0)]
    return rows


def test_vectors_match_brute_force(spark):
    rows = vectors()
    schema = "vec_id long, embedding array<double>, label int"
    got = sorted(map(tuple, near_vectors(spark.createDataFrame(rows, schema).repartition(4)).collect()))
    expected = sorted(brute_vectors(rows))
    found, true = sum(r[1] for r in got), sum(r[1] for r in expected)
    assert true > 1000 and found >= 0.97 * true
    assert all(g[1] <= e[1] for g, e in zip(got, expected)), "a link below the threshold"
    assert sum(g != e for g, e in zip(got, expected)) <= 0.05 * len(rows)


@pytest.mark.parametrize("k", [4, 5])
def test_vectors_at_the_threshold_with_many_hashes(spark, k):
    """Pairs at the threshold itself, hashed as in a very large table."""
    rng = np.random.default_rng(k)
    x, z = rng.standard_normal((2, 800, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.9301 * x + np.sqrt(1 - 0.9301 ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([x, y]))]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), k=k)
    assert got.where("n_links > 0").count() >= 0.985 * len(rows)


def test_vectors_edge_rows(spark):
    schema = "vec_id long, embedding array<float>, label int, rep string, component string"
    assert near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 0.0], 1, "a", "b"), (3, [1.0, 0.0], 1, "a", "b"), (3, [1.0, 0.0], 1, "a", "b"), (4, [0.0, 1.0], 1, "a", "b")]
    got = sorted(map(tuple, near_vectors(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(3, 2, 3, True), (3, 2, 3, True), (4, 0, 4, True), (None, 2, 3, False)], key=str)


def test_fast_rotation_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 32))
    assert np.allclose(np.linalg.norm(rotated(x, 3), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(hadamard(hadamard(x)), x)


def test_digest_query_columns(spark, docs):
    from lotgate.llm import queries

    cut = queries._digests(docs.where("doc_id is not null"))
    assert cut.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    by_id = {r["doc_id"]: r for r in cut.where(F.col("doc_id") != 3).collect()}
    text = {r[0]: (r[1] or "").encode() for r in corpus()}
    assert all(r["kept_sha256"] == hashlib.sha256(text[i]).hexdigest() for i, r in by_id.items() if not r["n_removed"])
    assert any(r["n_removed"] for r in by_id.values())


def test_settled_rows_do_not_depend_on_the_parts(spark, docs, monkeypatch):  # noqa: F811
    from lotgate.llm import suffix_dedup

    found, keep = {}, suffix_dedup.keep

    def counted(df, name):
        kept = keep(df, name)
        if name == "settled":
            found["settled"] = kept[0].groupBy("kind").count().orderBy("kind").collect()
        return kept
    monkeypatch.setattr(suffix_dedup, "keep", counted)
    seen = []
    for parts in (3, 60):
        monkeypatch.setattr(suffix_dedup, "partitions_for", lambda *_, parts=parts: parts)
        rows = suffix_dedup.remove_repeats(docs).select("row.doc_id", "kept", "removed").collect()
        seen.append((found["settled"], sorted(map(str, rows))))
    assert seen[0] == seen[1] and sum(r["count"] for r in seen[0][0]) > 0


def test_tasks_import_what_they_call():
    """A fresh worker has only the modules that the functions' own module imports."""
    code = ("import pyarrow as pa, pyarrow.compute; from lotgate.llm import suffix_dedup as s;"
            "vars(pa).pop('compute', None);"  # as where no other module has loaded it
            "kind = pa.list_(pa.struct([(c, pa.int32()) for c in 'abc']));"
            "batch = pa.RecordBatch.from_arrays([pa.array([[{'a': 1, 'b': 2, 'c': 3}], None], kind)], ['edges']);"
            "assert [x.tolist() for x in s._lists(batch, 'edges')] == [[[1, 2, 3]], []]")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_text_blocks_hold_the_texts_of_one_run():
    """Of a batch of 20 MB, only the texts of one run become Python objects at a time."""
    import tracemalloc

    import pyarrow as pa

    from lotgate.llm.blocks import text_blocks

    texts = [None, b"", *(bytes([65 + i % 26]) * 100_000 for i in range(200))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"])
    tracemalloc.start()
    sizes = [(rows.num_rows, sum(map(len, found))) for rows, found in text_blocks([batch], 1_000_000)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [sum(x) for x in zip(*sizes)] == [202, 20_000_000] and max(n for _, n in sizes) <= 1_000_000
    assert peak < 5_000_000
