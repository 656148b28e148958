"""Periodic runs, whitening and personal data against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from cases import corpus, docs, none, random_words  # noqa: F401
from pyspark.sql import functions as F

from lotgate.llm import periodic, personal, queries, whitening
from lotgate.llm.bidiagonal import bidiagonalise, leading_directions, squared_singular_values
from lotgate.llm.blocks import Block
from lotgate.llm.recompression import Grammar

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


# -- op11 --------------------------------------------------------------------

def brute_runs(words, least=12):
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, size, q) for (s, size), q in found.items()), key=lambda r: (r[0], r[2]))


def texts_of_symbols(rng):
    for _ in range(int(rng.integers(1, 6))):
        n, p = int(rng.integers(0, 150)), int(rng.integers(1, 20))
        kind = rng.integers(0, 5)
        if kind == 0:
            yield rng.integers(0, 2, n).tolist()
        elif kind == 1:
            yield rng.integers(0, 50, n).tolist()
        elif kind == 2:
            yield [0] * n
        elif kind == 3:
            t = np.tile(rng.integers(0, 3, p), n // p + 1)[:n]
            if n:
                t[int(rng.integers(0, n))] = 7
            yield t.tolist()
        else:  # a Fibonacci word: as many runs as words can have, nearly
            a, b = [0], [0, 1]
            while len(b) < n:
                a, b = b, b + a
            yield b[:n]


def walled(texts):
    out = [-1]
    for k, t in enumerate(texts):
        out += [*t, -2 - k]
    return np.array(out)


@pytest.mark.parametrize("least", [2, 5, 12, 30])
def test_runs_match_brute_force(least):
    rng = np.random.default_rng(least)
    for _ in range(60):
        texts = list(texts_of_symbols(rng))
        expected, at = [], 1
        for t in texts:
            expected += [(s + at, size, q) for s, size, q in brute_runs(t, least)]
            at += len(t) + 1
        got = periodic.runs_of(walled(texts), least)
        assert [tuple(r) for r in got.tolist()] == sorted(expected, key=lambda r: (r[0], r[2]))


def test_grammar_extensions_match_plain_comparison():
    rng = np.random.default_rng(8)
    for _ in range(30):
        symbols = walled(list(texts_of_symbols(rng)) + [rng.integers(0, 2, 40).tolist()])
        inside = np.flatnonzero(symbols >= 0)
        x, y = np.sort(rng.choice(inside, (200, 2)), 1).T
        x, y = x[x < y], y[x < y]
        grammar = Grammar(symbols)
        right, left = grammar.extend_right(x, y), grammar.extend_left(x, y)
        for a, b, r, m in zip(x.tolist(), y.tolist(), right.tolist(), left.tolist()):
            assert symbols[a:a + r].tolist() == symbols[b:b + r].tolist() and symbols[a + r] != symbols[b + r]
            assert symbols[a - m:a].tolist() == symbols[b - m:b].tolist() and symbols[a - m - 1] != symbols[b - m - 1]


def test_long_text_and_large_periods():
    rng = np.random.default_rng(9)
    period = rng.integers(0, 9000, 30_000).tolist()
    symbols = walled([period * 3, [1, 2] * 40_000, rng.integers(0, 9000, 50_000).tolist()])
    assert periodic.runs_of(symbols).tolist() == [[1, 90_000, 30_000], [90_002, 80_000, 2]]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def sha(text):
    return hashlib.sha256(text).hexdigest()


def test_periodic_query_matches_brute_force(spark, docs, none, monkeypatch):  # noqa: F811
    expected = collections.Counter()
    rows = [r if r[1] is None or len(r[1]) < 20_000 else (*r[:1], r[1][:6000], *r[2:]) for r in corpus()]
    frame = spark.createDataFrame(rows, docs.schema).repartition(3)
    for r in rows:
        words = planted(r[0], WORD.findall((r[1] or "").encode()))
        runs = brute_runs(words)
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        expected[(r[0], len(runs), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4),
                  sha("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()),
                  sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))] += 1
    assert any(k[1] for k in expected)
    monkeypatch.setattr(queries, "_documents", lambda *_: frame)
    got = queries.op11_periodic_runs(spark, "")
    assert collections.Counter(map(tuple, got.collect())) == expected
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 6 + ["string"] * 2
    monkeypatch.setattr(queries, "_documents", lambda *_: none)
    assert queries.op11_periodic_runs(spark, "").count() == 0
    carried = periodic.periodic_runs(docs).select("row.*", "n_words", F.col("runs")).collect()
    assert len(carried) == len(corpus()) and {r["kept"] for r in carried} == {"k", None}


# -- op12 --------------------------------------------------------------------

def matrices():
    rng = np.random.default_rng(1)
    q, p = (np.linalg.qr(rng.standard_normal((40, 40)))[0] for _ in range(2))
    yield rng.standard_normal((40, 40))
    yield rng.standard_normal((40, 40)) * np.logspace(0, -9, 40)
    yield q @ np.diag([5.0] * 20 + [1.0] * 20) @ p  # tied values
    yield q @ np.diag([5.0] * 20 + [0.0] * 20) @ p  # rank 20
    yield q @ np.diag(np.linspace(1, 1 + 1e-7, 40)) @ p  # close values
    yield np.eye(7) * 3
    yield np.diag([5.0] * 8) + np.diag([1e-9] * 7, 1)
    yield np.diag(np.abs(np.arange(-10, 11)) + 11.0) + np.diag(np.ones(20), 1)
    yield np.array([[2.0]])
    yield np.zeros((5, 5))


@pytest.mark.parametrize("matrix", list(matrices()))
def test_solver_matches_svd(matrix):
    expected = np.linalg.svd(matrix, compute_uv=False) ** 2
    a, b, w = bidiagonalise(matrix)
    bidiagonal = np.diag(a) + np.diag(b, 1)
    assert np.allclose(w.T @ matrix.T @ matrix @ w, bidiagonal.T @ bidiagonal, atol=1e-12 * max(1, expected[0]))
    assert np.allclose(squared_singular_values(a, b), expected, rtol=0, atol=1e-13 * max(expected[0], 1e-30))
    squares, v = leading_directions(matrix, 16)
    k = len(squares)
    assert k == min(16, int((expected > 1e-20 * max(expected[0], 1e-30)).sum()))
    assert np.allclose(v.T @ v, np.eye(k), atol=1e-13)
    assert np.abs(matrix.T @ (matrix @ v) - v * squares).max(initial=0) <= 1e-13 * max(expected[0], 1e-30)


def test_small_singular_values_are_accurate():
    """dqds keeps relative accuracy where a covariance matrix loses it."""
    n = 12
    a, b = 10.0 ** -np.arange(n), 10.0 ** -np.arange(n)[:-1] * 0.5
    from fractions import Fraction

    product = math.prod(Fraction(float(x)) ** 2 for x in a)  # of all squares
    got = math.prod(Fraction(float(x)) for x in squared_singular_values(a, b))
    assert abs(got / product - 1) < 1e-12


VECTORS = "vec_id long, embedding array<float>, label int, x string, n long"


def whitened(vectors, count=16):
    """Brute force on plain arrays: {vec_id: rows}, eigenvalues."""
    good = [(i, np.floor(np.array(v, np.float32).astype(float) * 64).astype(np.int64) + 1_000_000) for i, v in vectors
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    fit = np.array(sorted({tuple(x) for _, x in good}))
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    return good, n, s, values[::-1][:count], vectors_[:, ::-1][:, :count], values.sum()


def test_whitening_matches_plain_eigenvectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((400, 20)) * np.linspace(0.2, 3, 20)
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    vectors += [(500 + i, vectors[0][1]) for i in range(600)]  # copies fit once
    vectors += [(3, vectors[3][1]), (None, vectors[4][1]), (900, None), (901, [float("nan")] * 20), (902, [1.0] * 19 + [float("inf")]),
                (903, [None] + [1.0] * 19)]
    frame = spark.createDataFrame([(i, v, 1, "x", 5) for i, v in vectors], VECTORS).repartition(5)
    got = whitening.whiten(frame).collect()
    good, n, s, values, directions, trace = whitened(vectors)
    assert len(got) == 16 * len(good) and {r["n"] for r in got} == {n}
    assert collections.Counter(r["vec_id"] for r in got) == collections.Counter(i for i, _ in good for _ in range(16))
    by_id = {(r["vec_id"], r["component"]): r for r in got}
    signs = {}
    for i, x in good[:200]:
        expected = (x - s / n) @ directions / np.sqrt(values)
        for c in range(16):
            r = by_id[i, c + 1]
            sign = signs.setdefault(c, 1 if r["whitened"] * expected[c] > 0 else -1)
            assert abs(r["whitened"] - sign * expected[c]) < 1e-8
            assert int(r["deviation"]) == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s))
            assert abs(r["explained"] - values[c] / trace) < 1e-10 and r["identity_error"] < 1e-12


def test_whitening_edge_cases(spark, monkeypatch):
    def rows(vectors):
        return whitening.whiten(spark.createDataFrame([(i, v, 1, "x", 5) for i, v in enumerate(vectors)], VECTORS)).collect()
    assert rows([]) == [] and rows([[1.0, 2.0]]) == [] and rows([[1.0, 2.0]] * 5) == [] and rows([[], []]) == [] and rows([None]) == []
    two = rows([[1.0, 2.0], [3.0, 2.0]])  # one direction with variance
    assert [(r["vec_id"], r["component"]) for r in sorted(two)] == [(0, 1), (1, 1)] and all(abs(abs(r["whitened"]) - 1) < 1e-12 for r in two)
    short = rows([[1.0], [3.0, 2.0], [0.0, 5.0]])  # the first is (1, 0)
    assert len(short) == 6
    huge = rows([[1e30, 0.0], [-1e30, 1.0], [5.0, 7.0]])
    assert max(int(r["deviation"]) for r in huge) > 1 << 63 and all(math.isfinite(r["whitened"]) for r in huge)


def test_triangles_of_many_tasks_are_folded_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    x = np.random.default_rng(4).integers(-1000, 1000, (300, 6))
    sums = x.sum(0).tolist()
    frame = spark.createDataFrame([(r.astype("<i4").tobytes(),) for r in x], "x binary").repartition(7)
    triangle = whitening._triangle_of(frame, 300, sums)
    centred = x - np.array(sums) / 300
    assert np.allclose(triangle, np.triu(triangle)) and np.allclose(triangle.T @ triangle, centred.T @ centred)


def test_whitening_query_columns(spark):
    got = queries.op12_embedding_whitening(spark, "/root/testdata/sf0.001")
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema] == [
        "vec_id bigint", "component int", "n bigint", "deviation bigint", "whitened double", "explained double", "identity_error double"]


# -- op13 --------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    found = [(m.start(), list(PATTERNS).index(k), k, m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def spans(text):
    data = text.encode()
    return [(k, len(data[:a].decode()), len(data[:b].decode())) for a, b, k in personal.spans_of(Block([data]))]


def personal_texts():
    rng = np.random.default_rng(13)
    pieces = ["a@b.co", "@", ".", "..", "-", " ", "+", "1", "23", "456", "4077922580886963", "4000 0000 0000 0002", "10.20.30.40", "1.2.3.4.5.6.7.8", "256.1.1.1", "é", "数",
              "x_%y", "\n", "(", ")", "+1 (337) 555-0693", "+44 20 7946 0958", "user@host", "b.c@d.e@f.g.h", "000.0255.001.9", "٣", "-5", "+-"]
    for _ in range(1500):
        yield "".join(rng.choice(pieces, int(rng.integers(0, 14))))
    yield from [r[1] or "" for r in corpus()]
    yield "a" * 50_000 + "@" + "b." * 30_000 + "c"
    yield "1" * 40_000 + "." + "2" * 40_000
    yield "1 " * 40_000
    yield "+1" + "-2" * 40_000
    yield "@" * 3000


def test_base_kinds_match_the_patterns():
    for text in personal_texts():
        if len(text) > 10_000 and "aaaa" in text or text.startswith("1" * 99):  # the patterns take time in squares of these
            continue
        assert [s for s in spans(text) if s[0] in personal.BASE] == base_spans(text), text[:200]
    assert spans("a" * 50_000 + "@" + "b." * 30_000 + "c") == [("email", 0, 110_002)]
    assert spans("1" * 40_000 + "." + "2" * 40_000) == []


def test_added_kinds():
    def one(text, kind):
        return [text[a:b] for k, a, b in spans(text) if k == kind]
    assert one("write to jane.doe [at] mail dot com", "spelled_email") == []
    assert one("write to jane.doe [at] mail (dot) example [dot] com now", "spelled_email") == ["jane.doe [at] mail (dot) example [dot] com"]
    assert one("write to jane(at)mail.example", "spelled_email") == ["jane(at)mail.example"]
    assert one("see https://bob:s3cret@host.example/x and http://host:80/", "login") == ["bob:s3cret"]
    assert one("IBAN: GB82 WEST 1234 5698 7654 32 please", "iban") == ["GB82 WEST 1234 5698 7654 32"]
    assert one("IBAN GB83 WEST 1234 5698 7654 32", "iban") == []
    assert one("Account number: 0012345678, passport no. X1234567", "account") == ["0012345678", "X1234567"]
    assert one("account number one of many; subaccount number 123456", "account") == []
    assert one("SSN 123-45-6789, ssn: 666-45-6789, SSN 900-45-6789", "account") == ["123-45-6789"]
    assert one("P.O. Box 1234, po box office", "po_box") == ["P.O. Box 1234"]


def test_spans_of_a_table(spark, docs, none, monkeypatch):  # noqa: F811
    texts = ["é mail a@b.co\n+1 (337) 555-0693 10.0.0.1", "4077922580886963 数 4077922580886963", "nothing"]
    rows = corpus() + [(1000 + i, t, "en", "s", 1, "r", 1, "k", "row") for i, t in enumerate(texts)] + [(1000, texts[0], "en", "s", 1, "r", 1, "k", "row")]
    monkeypatch.setattr(queries, "_documents", lambda *_: spark.createDataFrame(rows, docs.schema).repartition(4))
    got = queries.op13_personal_spans(spark, "").collect()
    expected = collections.Counter()
    for r in rows:
        base = base_spans(r[1])
        assert base == spans(r[1] or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        expected[(r[0], *(sum(s[0] == k for s in base) for k in personal.BASE), sha(text.encode()), text)] += 1
    assert collections.Counter(map(tuple, got)) == expected and sum(len(r["spans"]) > 0 for r in got) == 3
    monkeypatch.setattr(queries, "_documents", lambda *_: none)
    assert queries.op13_personal_spans(spark, "").count() == 0
