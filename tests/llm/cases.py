import re

import numpy as np
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rep string, size long, kept string, row string"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall((text or "").encode().lower())


def random_words(rng, n, vocabulary=400):
    return " ".join(f"w{int(i)}" for i in rng.integers(0, vocabulary, n))


def corpus():
    """Small texts with nulls, empties, copies, near copies, shared passages,
    a very long text, a repeated row, null ids and extra clashing columns."""
    rng = np.random.default_rng(5)
    texts = [random_words(rng, int(rng.integers(3, 160))) for _ in range(60)]
    passage = random_words(rng, 60, 10_000)
    for i in range(6):  # near copies: a few words differ
        w = texts[0].split() or ["x"]
        w[int(rng.integers(0, len(w)))] = f"changed{i}"
        texts.append(" ".join(w))
    texts += [texts[1]] * 5 + [f"start{i} {passage} end{i}" for i in range(6)]
    texts += ["", None, " \t\n ", "one", "one two three four", "Ünï ß 数据 é " * 30, "line one\nline one\nline two\r\nline one", "a b c a b c a b c " * 20,
              random_words(rng, 20_000, 30_000), "# $ % & | < > *", "x" * 5000, "ab" * 400]
    langs, sources = ["en", "de", None], ["src0", "src0", "src1", "src2", None]
    rows = [(i, t, langs[i % 3], sources[i % 5], None if t is None else len(t), "r", i, "k", "row") for i, t in enumerate(texts)]
    rows.append(rows[3])  # a repeated row
    rows += [(None, "a null id and a text of some words", "en", "src1", 3, "r", 1, "k", "row"), (None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(r[0], i % 2, i % 3 % 2, "x") for i, r in enumerate(corpus()[:70])] + [(None, 1, 1, "x"), (5, None, None, "x"), (5, 1, 0, "x")],
        "doc_id long, quality int, toxic int, text string")
