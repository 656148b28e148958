"""Scores, rules, mixing, packing and samples against plain Python."""

import collections
import itertools
import math
import re
import textwrap
import zlib

import numpy as np
import pytest
from cases import SCHEMA, WORD, corpus, docs, labels, none, random_words, words_of  # noqa: F401
from pyspark.sql import functions as F

from lotgate.llm import importance, lattice_lm, licenses, mixing, ordinal_toxicity, packing, risk_rules

public_tokenizers = pytest.importorskip("public_tokenizers")


# -- op1 ---------------------------------------------------------------------

def test_severity_on_held_out_documents(spark):
    """Grades planted by counts of marked words; fitted on a part."""
    rng = np.random.default_rng(2)
    rows, grades = [], []
    for i in range(900):
        grade = int(rng.choice([0, 0, 0, 1, 2]))
        marks = " ".join(rng.choice(["vile", "foul", "nasty"], {0: 0, 1: 2, 2: 9}[grade]))
        rows.append((i, f"{random_words(rng, 40, 300)} {marks}"))
        grades.append((i, grade))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(grades[:500], "doc_id long, grade int")
    got = {r["doc_id"]: r for r in ordinal_toxicity.severity(docs, labels).where("doc_id >= 500").collect()}
    assert np.mean([got[i]["grade"] == g for i, g in grades[500:]]) > 0.95
    means = [np.mean([got[i]["severity"] for i, g in grades[500:] if g == k]) for k in range(3)]
    assert means[0] < 0.2 < 0.7 < means[1] < 1.3 < 1.7 < means[2] <= 2


def test_ordinal_gradient_and_order():
    rng = np.random.default_rng(0)
    doc, bucket = np.repeat(np.arange(200), 3), rng.integers(0, 30, 600)
    grade = np.clip(np.bincount(doc, bucket < 8), 0, 3).astype(int)
    model = ordinal_toxicity.fit(doc, bucket, np.ones(600), grade, 64)
    assert (np.diff(model.thresholds) > 0).all()
    above = model.exceed(np.bincount(doc, model.weights[bucket]))
    assert (np.diff(above, axis=1) <= 0).all()
    assert np.corrcoef(above.sum(1), grade)[0, 1] > 0.9


def test_fit_ends_where_the_numeric_gradient_is_zero(monkeypatch):
    """The penalised log likelihood, written out row by row, has no slope left
    in any weight or threshold."""
    for name, value in {"STEPS": 3000, "RATE": 0.02, "PENALTY": 0.01}.items():
        monkeypatch.setattr(ordinal_toxicity, name, value)
    rng = np.random.default_rng(4)
    doc, bucket = np.repeat(np.arange(150), 4), rng.integers(0, 12, 600)
    value = rng.uniform(0.5, 2, 600)
    grade = np.clip(np.bincount(doc, bucket < 3) + rng.integers(-1, 2, 150), 0, 2).astype(int)
    model = ordinal_toxicity.fit(doc, bucket, value, grade, 16)

    def objective(x):
        w, t = x[:12], x[12:]
        total = 0.0
        for i in range(150):
            score = sum(w[b] * v for d, b, v in zip(doc, bucket, value) if d == i)
            above = [1.0, *(1 / (1 + math.exp(cut - score)) for cut in t), 0.0]
            total += math.log(above[grade[i]] - above[grade[i] + 1])
        return total / 150 - 0.01 / 2 * sum(y * y for y in w)
    at = np.concatenate([model.weights[:12], model.thresholds])
    slopes = [(objective(at + step) - objective(at - step)) / 2e-5 for step in np.eye(14) * 1e-5]
    assert np.abs(slopes).max() < 1e-3 and np.abs(model.weights[:12]).max() > 0.3


def test_severity_edge_rows(spark, docs, none, labels):
    toxic = labels.select("doc_id", "toxic")
    assert ordinal_toxicity.severity(none, toxic).count() == 0
    got = ordinal_toxicity.severity(docs, toxic).collect()
    assert len(got) == len(corpus()) and all(0 <= r["severity"] <= 2 for r in got)
    assert ordinal_toxicity.severity(docs, toxic.limit(0)).agg(F.countDistinct("severity")).first()[0] == 1


def test_sample_holds_one_row_of_a_repeated_id(spark, monkeypatch):
    """A labelled id on many rows trains as one document."""
    rows = [(i, f"plain words number {i % 7} {'vile' if i % 3 == 0 else 'kind'}") for i in range(60)] + [(0, f"copy {i} of vile text") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    fitted, fit = [], ordinal_toxicity.fit
    monkeypatch.setattr(ordinal_toxicity, "fit", lambda doc, bucket, value, grade, buckets: fitted.append(len(grade)) or fit(doc, bucket, value, grade, buckets))
    assert ordinal_toxicity.severity(docs, labels, sample=50).count() == len(rows) and fitted == [50]


# -- op2 ---------------------------------------------------------------------

def test_lattice_sums_all_segmentations():
    pieces = [b" a", b" ab", b"b", b"c", b"bc", b"abc", b" ", b"a"]
    log_p = np.log(np.array([.2, .1, .15, .1, .05, .05, .25, .1]))
    p = dict(zip(pieces, np.exp(log_p)))

    def brute(word):
        total, weighted = 0.0, collections.Counter()
        for cut in itertools.product([0, 1], repeat=len(word) - 1):
            bounds = [0, *(i + 1 for i, c in enumerate(cut) if c), len(word)]
            parts = [word[a:b] for a, b in zip(bounds, bounds[1:])]
            if all(x in p for x in parts):
                q = math.prod(p[x] for x in parts)
                total += q
                for x in parts:
                    weighted[x] += q
        return total, weighted
    lattice = lattice_lm.Lattice(pieces)
    for word in (b" abc", b" aab", b" ccb"):
        data = np.frombuffer(word, np.uint8)[None]
        total, weighted = brute(word)
        assert math.isclose(math.exp(lattice.forward(data, log_p)[0][0]), total)
        expected = lattice.expected(data, np.array([2.0]), log_p)
        assert np.allclose(expected, [2 * weighted[x] / total for x in pieces])


HELD_OUT = -3.35  # the word baseline: -3.46


def test_whole_words_are_arcs_of_the_lattice():
    lattice, log_p = lattice_lm.Lattice([b" a", b"b", b" "]), np.log([.5, .3, .2])
    words = np.frombuffer(b" ab ab", np.uint8).reshape(2, 3)
    got = lattice.forward(words, log_p, math.log(.25), np.array([math.log(.125), -np.inf]))[0]
    assert np.allclose(np.exp(got), [.25 * .5 * .3 + .125, .25 * .5 * .3])


def test_scores_match_plain_counts(spark, docs, none, monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = corpus()

    def held_out(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    count = collections.Counter()
    for r in rows:
        if not held_out(r[0]):
            count.update([*words_of(r[1]), None])
    n, v = sum(count.values()), len(count)
    expected = collections.Counter()
    for r in rows:
        tokens = [*words_of(r[1]), None]
        base = sum(math.log10((count[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        expected[r[0], held_out(r[0]), len(tokens), sum(count[t] > 0 for t in tokens), n, round(base, 6)] += 1
    got = lattice_lm.score(docs, path).collect()
    assert collections.Counter((*r[:5], round(r["base_score"], 6)) for r in got) == expected
    # A proper model: probabilities of whole words and spellings stay below one.
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    # Log10 per token on texts that were held out; it must not fall.
    held = [r for r in got if r["held_out"] and r["n_tokens"] > 50]
    assert sum(r["score"] for r in held) / sum(r["n_tokens"] for r in held) > HELD_OUT
    monkeypatch.setattr(lattice_lm, "FREQUENT", 30)  # most words go back by the join
    joined = lattice_lm.score(docs, path).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"])
    assert all(math.isclose(a["score"], b["score"]) and a["n_known"] == b["n_known"] for a, b in zip(sorted(got, key=key), sorted(joined, key=key)))
    assert lattice_lm.score(none, path).count() == 0
    only = lattice_lm.score(docs.where("crc32(cast(doc_id as string)) % 5 = 1"), path).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in only)


# -- op3 ---------------------------------------------------------------------

def brute_counts(text):
    words = [w.decode() for w in WORD.findall((text or "").encode())]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    found = collections.Counter(grams)
    again = {i + j for i, g in enumerate(grams) if found[g] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x.encode())]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again))


def test_repeats_of_windows_that_share_hash_bits(spark, docs, monkeypatch):
    """With four bits of the hash beside the position, different windows lie between equal ones."""
    monkeypatch.setattr(risk_rules, "_PLACE_BITS", 60)
    got = risk_rules.base_counts(docs.select("doc_id", "text", F.lit("").alias("stratum"))).select("doc_id", "n_repeat_words").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter((r[0], brute_counts(r[1])[4]) for r in corpus())


def test_base_counts_match_plain_python(spark, docs, none, labels):
    got = risk_rules.judge(docs, labels).collect()
    expected = collections.Counter()
    for r in corpus():
        c = brute_counts(r[1])
        expected[r[0], *c, c[0] < 50 or 100 * c[4] > 50 * c[0]] += 1
    assert collections.Counter((r["doc_id"], *(r[c] for c in risk_rules.COUNTS), r["base_failed"]) for r in got) == expected
    assert risk_rules.judge(none, labels).count() == 0
    assert risk_rules.judge(docs, labels.limit(0)).where("kept = base_failed").count() == 0
    kept = risk_rules.good_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)


def test_long_texts_use_pairs(spark, monkeypatch):
    monkeypatch.setattr(risk_rules, "_PLACE_BITS", 3)  # texts over 8 windows
    texts = ["a b c d a b c e f g h i j k a b c", "x y z", "q q q q q q q q q q q q q"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("stratum", F.lit(""))
    got = {r["doc_id"]: r["n_repeat_words"] for r in risk_rules.base_counts(frame).collect()}
    assert got == {i: brute_counts(t)[4] for i, t in enumerate(texts)}


def tail(n, k, a):
    return sum(math.comb(n, j) * a ** j * (1 - a) ** (n - j) for j in range(k + 1))


def test_cutoffs_are_safe_by_the_exact_binomial_bound(spark):
    rng = np.random.default_rng(6)
    rows = []
    for stratum, n in (("en", 3000), ("de", 900), ("few", 40)):
        for _ in range(n):
            good = rng.random() < 0.8
            symbols = int(rng.poisson(3) if good else rng.poisson(90))
            rows.append((stratum, bool(good), 200, 1000, symbols, 0, 0))
    frame = spark.createDataFrame(rows, "stratum string, good boolean, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
    got = {r["stratum"]: r.asDict() for r in risk_rules.safe_cutoffs(frame).collect()}
    share, error = risk_rules.RISK / len(risk_rules.RULES), risk_rules.ERROR / (3 * len(risk_rules.RULES))
    assert got["few"]["cut_symbols"] is None and got["en"]["cut_dup_lines"] is None
    for stratum in ("en", "de"):
        cutoffs = risk_rules.RULES["symbols"][2]
        good = [r for r in rows if r[0] == stratum and r[1]]
        bad = [r for r in rows if r[0] == stratum and not r[1]]
        safe = list(itertools.takewhile(lambda c: tail(len(good), sum(r[4] / r[2] > c for r in good), share) <= error, cutoffs))
        best = max(safe, key=lambda c: (sum(r[4] / r[2] > c for r in bad) - sum(r[4] / r[2] > c for r in good), -cutoffs.index(c)))
        assert got[stratum]["cut_symbols"] == best


def test_log_tail(spark):
    cases = [(10, 0, .02), (50, 3, .02), (400, 2, .02), (3000, 40, .02), (100000, 1500, .02)]
    frame = spark.createDataFrame(cases, "n long, k long, a double")
    got = [r[0] for r in frame.select(risk_rules._log_tail(F.col("n"), F.col("k"), 0.02)).collect()]
    for (n, k, a), x in zip(cases, got):
        terms = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(a) + (n - j) * math.log1p(-a) for j in range(k + 1)]
        assert math.isclose(x, max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms)), rel_tol=1e-9)


def test_copies_of_one_document_are_one_trial(spark):
    """3,000 copies of one good text open no cutoff, under one id or many."""
    rng = np.random.default_rng(2)
    def text(good):
        words = [f"word{int(i)}" for i in rng.integers(0, 5000, 120)]
        return " ".join(w if good or i % 2 else "##" + w for i, w in enumerate(words))
    rows = [(i, text(i % 2 == 0), "en") for i in range(40)]
    many = rows + [(0, rows[0][1], "en")] * 3000 + [(1000 + i, rows[2][1], "en") for i in range(3000)]
    labels = [(r[0], int(r[0] % 2 == 0)) for r in rows] + [(1000 + i, 1) for i in range(3000)] + [(4, 0)]

    def kept(rows, labels):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        return {r["doc_id"]: r["kept"] for r in risk_rules.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    assert all(kept(many, labels).values())
    # As many distinct good texts do open one.
    apart = rows + [(1000 + i, text(True), "en") for i in range(1500)]
    found = kept(apart, labels)
    assert not found[1] and found[0] and found[4]


# -- op4 ---------------------------------------------------------------------

def test_differencing_partitions():
    assert sorted(np.bincount(packing.difference(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])) == [14, 16]
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 512, 1200)
    window = packing.windows_of(sizes, 2048)
    loads = np.bincount(window, sizes)
    assert loads.max() <= 2048 and len(loads) <= 1.02 * sizes.sum() / 2048 + 1
    assert loads.max() - loads.min() < 60
    assert (packing.windows_of(np.array([2048] * 3 + [1]), 2048) >= 0).all()
    assert len(packing.windows_of(np.zeros(0, int), 2048)) == 0


def test_packing_round_trip(spark, docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [*corpus(), (900, "A B, c. D!? e.g. <|endoftext|> <|ENDOFTEXT|> it's É́ x,y ,z", "en", "s", 1, "r", 1, "k", "r")]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(3), path, with_ids=True).collect()
    by_doc = collections.defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        by_doc[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"]))
    for i, group in itertools.groupby(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)), key=lambda r: r[0]):
        whole = sorted([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in group)
        pieces = by_doc[i]
        assert sum(len(p) for _, p, _ in pieces) == sum(map(len, whole))
        if len(whole) == 1:
            assert [x for _, p, _ in sorted(pieces) for x in p] == whole[0] and {t for *_, t in pieces} == {len(whole[0])}
    for _, sequence in itertools.groupby(sorted(got, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in sequence:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert packing.pack(none, path).count() == 0


@pytest.mark.parametrize("k", [1, 2, 7, 40])
def test_differencing_gives_near_equal_windows(k):
    rng = np.random.default_rng(k)
    for sizes in (rng.integers(1, 513, 300), np.ones(1000, int), np.full(50, 512), np.append(np.full(300, 512), np.ones(300, int))):
        window = packing.difference(np.sort(sizes)[::-1], k)
        sums = np.bincount(window, np.sort(sizes)[::-1], k)
        assert ((window >= 0) & (window < k)).all() and sums.max() - sums.min() <= sizes.max()


def test_equal_rows_and_tiny_texts_are_dealt_over_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_WINDOWS", 4)
    monkeypatch.setattr(packing, "GROUP_PIECES", 500)
    path = public_tokenizers.path("word_bpe_49k.json")
    copies = spark.createDataFrame([(1, "some words of one text " * 100)] * 300, "doc_id long, text string").repartition(3)
    tiny = spark.createDataFrame([(i, "") for i in range(20_000)], "doc_id long, text string").repartition(3)
    for docs, rows_each in ((copies, None), (tiny, 700)):
        got = packing.pack(docs, path).collect()
        groups = collections.Counter(r["sequence_id"] >> 24 for r in got)
        tokens = collections.Counter()
        for r in got:
            tokens[r["sequence_id"] >> 24] += r["length"]
        total = sum(tokens.values())
        assert len(groups) >= min(total // (4 * 2048), 40) and max(tokens.values()) <= 2.5 * 4 * 2048
        if rows_each:
            assert max(groups.values()) <= rows_each


# -- op6 ---------------------------------------------------------------------

def fill(sizes, weights, most):
    """Water-filling by rounds: clamp, share the rest out again."""
    full, total = {}, sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in full]
        level = (total - sum(full.values())) / (sum(weights[s] for s in free) or 1)
        above = [s for s in free if level * weights[s] > most * sizes[s]]
        if not above:
            return {**full, **{s: level * weights[s] for s in free}}
        full.update({s: most * sizes[s] for s in above})


def test_mix_reaches_its_targets(spark, docs, none):
    rows = corpus()
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    expected = fill(sizes, {s: [1, 2, 3][i % 3] for i, s in enumerate(order)}, 3)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], expected[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - expected[s]) <= 1 for s in sizes)
    repeated = mixing.repeat(docs)
    assert repeated.columns == docs.columns
    words = collections.Counter()
    for r in repeated.collect():
        words[r["source"]] += len(words_of(r["text"]))
    assert all(abs(words[s] - taken[s]) <= 200 for s in sizes)  # the repeated row
    assert mixing.mix(none).count() == 0 and mixing.repeat(none).count() == 0


def test_targets_of_odd_tables(spark):
    for sizes in ({"a": 0}, {"a": 5}, {"a": 1, "b": 1000, "c": 10, "d": 0, None: 3}, {"a": 7, "b": 7}):
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        expected = fill(sizes, {s: [1, 2, 3][i % 3] for i, s in enumerate(order)}, 3)
        assert got == pytest.approx(expected)


def test_cut_document_with_nul_characters(spark):
    text = "a\0b c\0 \0 d\0\0e  f g"
    got = spark.createDataFrame([(text, n) for n in range(1, 7)], "text string, n long").select(
        "n", mixing._leading_words(F.col("text"), F.col("n")).alias("part")).collect()
    assert {r["n"]: r["part"] for r in got} == {1: "a\0b", 2: "a\0b c\0", 3: "a\0b c\0 \0", 4: "a\0b c\0 \0 d\0\0e", 5: "a\0b c\0 \0 d\0\0e  f", 6: text}


def test_mix_keeps_documents_without_words(spark):
    rows = [(1, "a b c d", "x"), (2, "", "x"), (3, None, "x"), (4, " \n", "y"), (5, "e f", "y"), (None, None, None), (6, "", "z")]
    got = mixing.repeat(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    wordless = sorted((r for r in rows if not words_of(r[1])), key=str)
    assert sorted((tuple(r) for r in got if not words_of(r["text"])), key=str) == wordless


# -- op7 ---------------------------------------------------------------------

def test_licence_digests(spark, docs, none):
    mit = licenses.TEXTS["MIT"]
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,")), (2, mit + " and more"), (3, "Some text.\nreleased under the MIT licence!\nx"),
            (4, None), (5, ""), (6, "LICENSED UNDER CC BY-NC 4.0"), (7, licenses.TEXTS["ISC"]), (7, "Licensed under the MIT License.")]
    got = {(r["doc_id"], r["digest"]): r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    by = {i: [(r["licence"], r["n_licence_lines"], r["line_licences"]) for (j, _), r in got.items() if i == j] for i in range(1, 8)}
    assert by[1] == [("MIT", 0, "")] and by[2] == [(None, 0, "")] and by[3] == [(None, 1, "MIT")]
    assert by[4] == by[5] == [(None, 0, "")] and by[6] == [("CC-BY-NC-4.0", 1, "CC-BY-NC-4.0")]
    assert sorted(by[7]) == [("ISC", 1, "MIT"), ("MIT", 1, "MIT")]
    assert licenses.scan(docs).count() == len(corpus()) and licenses.scan(none).count() == 0


def _wrapped(text, width, prefix=""):
    """Each paragraph on lines of *width* columns (0: on one line)."""
    paragraphs = [" ".join(x.split()) for x in re.split(r"\n[ \t]*\n", text) if x.strip()]
    filled = [x if not width else textwrap.fill(x, width) for x in paragraphs]
    return "\n".join(f"{prefix}{line}" for line in "\n\n".join(filled).split("\n"))


def test_whole_licences_in_any_wrapping(spark):
    """Each known text at several widths, with and without title and copyright lines."""
    rows = []
    for spdx, text in licenses.TEXTS.items():
        for width in (0, 40, 60, 70, 72, 76, 78, 79, 80, 100, 120):
            body = _wrapped(text, width)
            heads = ["", "Copyright (c) 2020 Someone\n\n", "Copyright 1999-2004 A, B\n(C) 2020 C\n\u00a9 D\nAll rights reserved.\n\n"]
            rows += [(spdx, title + head + body) for head in heads for title in ("", f"{spdx} License\n\n", f"The {spdx} License ({spdx})\n\n")]
    rows += [(None, "Copyright law\n" + licenses.TEXTS["MIT"]), (None, licenses.TEXTS["MIT"].replace("COPYRIGHT HOLDERS", ""))]
    got = licenses.scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["licence"] for r in got} == {i: spdx for i, (spdx, _) in enumerate(rows)}


def test_whole_texts_of_common_licences(spark):
    """Every stored text, wrapped, titled, in comments and in typographic marks."""
    texts = licenses.whole_texts()
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0", "Unlicense",
            "CC0-1.0", "MIT", "ISC"} <= {spdx for spdx, _ in texts}
    typographic = str.maketrans({"'": "\u2019", '"': "\u201d", "-": "\u2013", " ": "\u00a0"})
    rows = []
    for spdx, text in texts:
        title = licenses.TITLES[spdx][0] + "\n\n"
        rows += [(spdx, x) for x in (text, title + text, title.upper() + _wrapped(text, 0), text.replace("\n", "\r\n"), text.translate(typographic),
                                     "# Copyright 2020 X\n#\n" + _wrapped(title + text, 77, "# "), "/*\n * Copyright (c) X\n *\n" + _wrapped(text, 70, " * ") + "\n */")]
        rows += [(spdx, _wrapped(text, width)) for width in (60, 65, 72, 76, 79, 80, 100)]
        rows.append((None, title + text + "\nand more"))
    apache = dict(texts)["Apache-2.0"]
    rows += [("Apache-2.0", apache[:apache.index("APPENDIX")]), (None, apache.replace("(c) You must retain", "You must retain"))]
    got = licenses.scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")).collect()
    wrong = [(spdx, rows[r["doc_id"]][1][:60]) for r in got if r["licence"] != (spdx := rows[r["doc_id"]][0])]
    assert len(got) == len(rows) and not wrong


def test_notice_in_typographic_marks(spark):
    rows = [(1, "// \u201cLicensed under the MIT License.\u201d"), (2, "Licensed under CC BY\u2011NC\u00a04.0")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["line_licences"]) for r in got) == [(1, "MIT"), (2, "CC-BY-NC-4.0")]


def test_canonical_text_in_python_and_spark(spark):
    texts = [t for r in corpus() if (t := r[1])] + [*licenses.TEXTS.values(), "x\r\n (C) 2001 me\r\ncopyright owner", "copyright\nCopyright [yyyy] x\nau\n\u00a9", "# \u00a9 x\n * Copyright \u2013 2020\n\u00abq\u00bb \u2026",
                                                                     *(t for _, t in licenses.whole_texts())]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(licenses.canonical(F.col("text"))).collect()
    assert [r[0] for r in got] == [licenses.canonical_text(t) for t in texts]


def test_sql_and_operator_agree_on_whole_texts(spark):
    """The DuckDB form on licences as published, in typographic marks, in
    comments, with statements dropped, and on the corpus of odd texts."""
    import duckdb
    import pandas as pd

    typographic = str.maketrans({"'": "\u2019", '"': "\u201d", "-": "\u2013", " ": "\u00a0"})
    texts = [x for _, t in licenses.whole_texts() for x in (t, t.translate(typographic), _wrapped(t, 70, " * "), t.replace("\n", "\r\n"))]
    texts += ["// \u201cLicensed under the MIT License.\u201d\nLicensed under CC BY\u2011NC\u00a04.0\nx", "\u00a9 2020 me\nlicence", "# Copyright [yyyy] x\rau\n(c) 1999",
              "\uff0a copyright yearly\ncopyright year\ncopyright \u2014 (C) a", *(r[1] for r in corpus())]
    rows = list(enumerate(texts))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    want = con.sql(licenses.oracle_sql())
    assert sorted(tuple(r[c] for c in want.columns) for r in got) == sorted(want.fetchall())
    assert sum(r["licence"] is not None for r in got) >= 4 * len(licenses.whole_texts())


# -- op8 ---------------------------------------------------------------------

def test_resampling_prefers_the_target(spark, docs, none, labels):
    rng = np.random.default_rng(3)
    rows, marks = [], []
    for i in range(600):
        good = i % 4 > 0
        rows.append((i, random_words(rng, 60, 200) if good else " ".join(f"||{w}||" for w in random_words(rng, 60, 200).split())))
        if i % 3 == 0:
            marks.append((i, int(good)))
    got = importance.resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int")).collect()
    share = sum(q for _, q in marks) / len(marks)
    assert sum(r["kept"] for r in got) == round(share * 600)
    assert np.mean([r["kept"] for r in got if r["doc_id"] % 4]) > 0.97
    assert importance.resample(none, labels.select("doc_id", "quality")).count() == 0
    everything = importance.resample(docs, labels.select("doc_id", "quality").limit(0))
    assert everything.where("kept").count() == len(corpus())


def test_importances_and_draw_match_plain_counts(spark):
    """Log importances from counts of words and pairs, the noise from whole
    numbers, and the k largest sums, all in plain Python."""
    rng = np.random.default_rng(8)
    rows = [(i * 7 - 20, random_words(rng, int(rng.integers(0, 30)), 12)) for i in range(60)]
    marks = [(i, int(i % 3 > 0)) for i, _ in rows[::2]]
    buckets = 1 << 20
    got = importance.resample(spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
                              spark.createDataFrame(marks, "doc_id long, quality int"), buckets=buckets, seed=5).collect()

    def grams(text):
        words = text.split()
        return words + list(zip(words, words[1:]))

    def spread(x):
        for _ in range(2):
            x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 % 2 ** 64
        return x ^ x >> 32
    good = {i for i, quality in marks if quality}
    raw = collections.Counter(g for _, t in rows for g in grams(t))
    target = collections.Counter(g for i, t in rows if i in good for g in grams(t))
    gap = math.log(raw.total() + buckets) - math.log(target.total() + buckets)
    keys = {}
    for r in got:
        text = dict(rows)[r["doc_id"]]
        want = sum(math.log(target[g] + 1) - math.log(raw[g] + 1) + gap for g in grams(text))
        assert r["n_grams"] == len(grams(text)) and math.isclose(r["log_importance"], want, abs_tol=1e-9)
        uniform = (spread((spread(r["doc_id"] % 2 ** 64) + 5) % 2 ** 64) >> 11) / 2 ** 53
        keys[r["doc_id"]] = want - math.log(-math.log(uniform))
    k = round(len(good) / len(marks) * len(rows))
    assert {r["doc_id"] for r in got if r["kept"]} == set(sorted(keys, key=keys.get)[-k:])


def test_kth_largest(spark):
    values = [5, -7, 0, 1 << 62, -(1 << 63), 5, 3, -1, (1 << 63) - 1, 12345678901]
    frame = spark.createDataFrame([(x,) for x in values], "key long")
    for k in range(1, len(values) + 1):
        assert importance.kth_largest(frame, k) == sorted(values, reverse=True)[k - 1]
    x = np.array([-np.inf, -2.5, -0.0, 0.0, 1e-300, 3.5, np.inf])
    assert (np.diff(importance.ordered_bits(x)) >= 0).all()
