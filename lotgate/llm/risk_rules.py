"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Every text gets the base counts. Five rules compare a rate made of them with a
cutoff; the cutoffs are not set by hand but chosen per stratum (language) from
labelled holdout documents:

* For each stratum, rule and cutoff of a fixed list (lax to strict), let n be
  the holdout's good documents that pass the base test, and k those that the
  cutoff would reject. The cutoff is *safe* if ``P(Binomial(n, a) <= k) <= e``:
  then the exact (Clopper-Pearson) upper bound of its false rejection rate at
  level ``1 - e`` is at most a.
* The allowed rate is shared among the rules (``a = risk / rules``), the error
  among strata and rules (Bonferroni, ``e = error / (strata * rules)``); within
  a list, cutoffs are tested lax to strict and testing stops at the first
  failure (fixed sequence, which costs no further correction). So with
  probability ``1 - error`` no stratum loses more than *risk* of its good
  documents to the rules together.
* Among the safe cutoffs the one with the most bad minus good holdout
  documents rejected is taken, the laxest of equals; a rule that rejects no bad
  ones, or has no safe cutoff, stays off in that stratum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import SPACE, keep

RISK, ERROR = 0.10, 0.05
MOST_STRATA = 100_000  # cutoffs of more strata are joined by shuffle

#: rule -> (rate, sign, cutoffs lax to strict); rejects if sign * rate > sign * cutoff.
RULES: dict[str, tuple[str, int, list[float]]] = {
    "symbols": ("n_symbols / nullif(n_words, 0)", 1, [3.0, 2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05]),
    "long_words": ("word_chars / nullif(n_words, 0)", 1, [14.0, 12.0, 10.0, 9.0, 8.0, 7.5, 7.0, 6.5]),
    "short_words": ("word_chars / nullif(n_words, 0)", -1, [1.5, 2.0, 2.5, 3.0, 3.25, 3.5, 3.75, 4.0]),
    "dup_lines": ("n_dup_lines / nullif(n_words, 0)", 1, [0.2, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01, 0.005]),
    "repeats": ("n_repeat_words / nullif(n_words, 0)", 1, [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1]),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: A window's position shares 64 bits with its hash; longer texts sort pairs.
_PLACE_BITS = 24


def _let(value: Column, body) -> Column:
    """*body* of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text."""
    n = F.size(words)

    def window(i):
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def covered(at):
        return F.aggregate(
            F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3)))),
            F.lit(0).cast("long"), lambda total, x: total + x)

    def packed(hashes):  # the high bits of the hash, then the position
        entry = F.transform(hashes, lambda h, i: F.shiftleft(F.shiftright(h, _PLACE_BITS), _PLACE_BITS).bitwiseOR(i.cast("long")))

        def bits(x):
            return F.shiftright(x, _PLACE_BITS)

        def at(x):
            return x.bitwiseAND((1 << _PLACE_BITS) - 1).cast("int")

        def settled(found):  # whole runs of equal high bits; a run may hold different windows
            mixed = F.filter(found, lambda x, j: F.coalesce((bits(x) == bits(F.get(found, j + 1))) & (
                F.get(hashes, at(x)) != F.get(hashes, at(F.get(found, j + 1)))), F.lit(False)))
            pairs = F.transform(found, lambda x: F.struct(F.get(hashes, at(x)).alias("h"), at(x).alias("i")))
            return F.when(F.size(mixed) > 0, paired(pairs)).otherwise(F.sort_array(F.transform(found, at)))

        def runs(order):
            return F.filter(order, lambda x, j: F.coalesce(bits(x) == bits(F.get(order, j + 1)), F.lit(False))
                            | F.coalesce(bits(x) == bits(F.get(order, j - 1)), F.lit(False)))
        return _let(_let(F.sort_array(entry), runs), settled)

    def paired(pairs):  # (hash, position)
        def places(order):
            again = F.filter(order, lambda x, j: F.coalesce(x["h"] == F.get(order, j + 1)["h"], F.lit(False))
                             | F.coalesce(x["h"] == F.get(order, j - 1)["h"], F.lit(False)))
            return F.sort_array(F.transform(again, lambda x: x["i"]))
        return _let(F.sort_array(pairs), places)

    def whole(hashes):
        return paired(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    hashes = F.transform(F.sequence(F.lit(0), n - 3), window)
    count = _let(hashes, lambda h: _let(
        F.when(F.size(h) < (1 << _PLACE_BITS), packed(h)).otherwise(whole(h)), covered))
    return F.when(n >= 4, count).otherwise(F.lit(0).cast("long"))


def base_counts(docs: DataFrame) -> DataFrame:
    """*docs* (doc_id, text, stratum) with the base counts and a hash in place
    of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    of_words = _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated_words(w).alias("repeated")))
    return (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "stratum", of_words.alias("w"),
                        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
                        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
            .select("doc_id", "text_hash", "stratum", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                    F.col("w.repeated").alias("n_repeat_words"))
            .withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")))


def _rejects(rule: str, cutoff: Column) -> Column:
    rate, sign, _ = RULES[rule]
    return (F.expr(f"{rate} * {sign}D") > cutoff * sign) if sign < 0 else (F.expr(rate) > cutoff)


def _log_tail(n: Column, k: Column, a: float) -> Column:
    """log P(Binomial(n, a) <= k), summed term by term in log space."""
    first = n * F.log1p(F.lit(-a))
    odds = F.log(F.lit(a)) - F.log1p(F.lit(-a))

    def add(state, j):
        term = state["term"] + F.log((n - j + 1) / j) + odds
        high, low = F.greatest(state["total"], term), F.least(state["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))
    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, F.struct(first.alias("term"), first.alias("total")), add, lambda s: s["total"])


def safe_cutoffs(labelled: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per stratum: the chosen cutoff of each rule (null: off).

    *labelled* has stratum, the base counts and good (boolean), and only rows
    that pass the base test. One pass aggregates it; the rest works on a row
    per stratum, rule and cutoff.
    """
    def rejected(rule, cutoff, good):
        return F.count(F.when(F.col("good") == good, F.when(_rejects(rule, F.lit(cutoff)), 1)))
    tests = [F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"),
                      rejected(rule, c, True).alias("k"), rejected(rule, c, False).alias("bad"))
             for rule, (_, _, cutoffs) in RULES.items() for i, c in enumerate(cutoffs)]
    strata = labelled.groupBy("stratum").agg(F.count(F.when(F.col("good"), 1)).alias("n"), F.array(*tests).alias("tests"))
    share = risk / len(RULES)
    rows = (strata.crossJoin(strata.agg(F.count("*").alias("strata")))  # one row
            .select("stratum", "n", "strata", F.explode("tests").alias("t")).select("stratum", "n", "strata", "t.*"))
    # A tail beyond the mean is above any sensible error; it is not summed.
    log_p = F.when((F.col("n") > 0) & (F.col("k") < F.col("n") * share), _log_tail(F.col("n"), F.col("k"), share)).otherwise(F.lit(0.0))
    tested = rows.withColumn("fails", log_p > F.log(F.lit(error) / (F.col("strata") * len(RULES))))
    lists = tested.groupBy("stratum", "rule").agg(
        F.min(F.when(F.col("fails"), F.col("step"))).alias("stop"),
        F.collect_list(F.struct((F.col("bad") - F.col("k")).alias("gain"), (-F.col("step")).alias("lax"), "cutoff", "bad")).alias("steps"))
    best = F.array_max(F.filter("steps", lambda x: (F.coalesce(-x["lax"] < F.col("stop"), F.lit(True))) & (x["bad"] > 0) & (x["gain"] > 0)))
    return (lists.withColumn("best", best).groupBy("stratum")
            .agg(*(F.max(F.when(F.col("rule") == r, F.col("best.cutoff"))).alias(f"cut_{r}") for r in RULES)))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(doc_id, text_hash, base counts, base_failed, kept) for each row of
    *docs* (doc_id, text and the stratum column), with *labels* (doc_id,
    quality: 1 good, 0 bad).

    A null text is empty and fails; a null stratum is a stratum of its own; a
    null doc_id or quality is unlabelled. A trial of the binomial tests is a
    labelled text: copies of a text in a stratum, under one doc_id or several,
    are one trial, several texts under one doc_id are one (that of the least
    stratum and counts), and a text labelled both ways is a good one. Equal rows
    get equal verdicts. With no (or too
    few) labels the rules stay off. An empty table gives no rows.
    """
    counts, _ = keep(base_counts(docs.select("doc_id", "text", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"))),
                     "rule_counts")
    marks = labels.where("quality is not null").select("doc_id", (F.col("quality") == 1).alias("good")).distinct()
    found = F.struct("stratum", *COUNTS, "text_hash")
    of_document = counts.where("not base_failed").join(marks, "doc_id").groupBy("doc_id").agg(F.min(found).alias("x"), F.max("good").alias("good"))
    trials = of_document.select("x.*", "good").groupBy("stratum", "text_hash").agg(*(F.min(c).alias(c) for c in COUNTS), F.max("good").alias("good"))
    # A row per stratum: written, then broadcast behind a check of its size, so
    # that no stratum gathers its documents.
    cuts, _ = keep(safe_cutoffs(trials, risk, error), "rule_cutoffs")
    if cuts.limit(MOST_STRATA + 1).count() <= MOST_STRATA:
        cuts = F.broadcast(cuts)
    hit = F.lit(False)
    for rule in RULES:
        hit = hit | F.coalesce(_rejects(rule, F.col(f"cut_{rule}")), F.lit(False))
    return counts.join(cuts, "stratum", "left").select(
        "doc_id", "text_hash", *COUNTS, "base_failed", (~F.col("base_failed") & ~hit).alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The rows of *docs* that :func:`judge` keeps, in all their columns."""
    kept = judge(docs, labels, stratum, risk, error).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]) & (F.xxhash64(docs["text"]) == kept["kept_hash"]), "left_semi")


def oracle_sql(risk: float = RISK, error: float = ERROR) -> str:
    """DuckDB SQL for :func:`judge` over documents and labels."""
    share = risk / len(RULES)
    grid = ", ".join(f"('{r}', {i}, {c}::double)" for r, (_, _, cs) in RULES.items() for i, c in enumerate(cs))

    def rejects(rule, cutoff):
        rate, sign, _ = RULES[rule]
        return f"({rate}) {'>' if sign > 0 else '<'} {cutoff}"
    case = "case rule " + " ".join(f"when '{r}' then {rejects(r, 'cutoff')}" for r in RULES) + " end"
    chosen = " or ".join(f"(rule = '{r}' and {rejects(r, 'cutoff')})" for r in RULES)
    return rf"""
with t as (select row_number() over () as row, doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from t),
g as (select row, unnest(range(1, len(words) - 1)) as i, words from w where len(words) >= 3),
h as (select row, i, count(*) over (partition by row, words[i], words[i + 1], words[i + 2]) as found from g),
r as (select row, count(distinct p) as n from (select row, unnest([i, i + 1, i + 2]) as p from h where found > 1) group by row),
c as (select w.row, doc_id, stratum, text, len(words)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words
      from w left join r on w.row = r.row),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c),
d as (select b.doc_id, max(good) as good, min(struct_pack(stratum := stratum, n_words := n_words, word_chars := word_chars, n_symbols := n_symbols,
          n_dup_lines := n_dup_lines, n_repeat_words := n_repeat_words, text := text)) as x
      from b join (select distinct doc_id, quality = 1 as good from labels where quality is not null) m
        on b.doc_id = m.doc_id where not base_failed group by b.doc_id),
l as (select x.stratum as stratum, x.text as text, min(x.n_words) as n_words, min(x.word_chars) as word_chars, min(x.n_symbols) as n_symbols,
        min(x.n_dup_lines) as n_dup_lines, min(x.n_repeat_words) as n_repeat_words, max(good) as good from d group by x.stratum, x.text),
s as (select stratum, rule, step, cutoff, count(*) filter (good) as n, count(*) filter (good and {case}) as k,
        count(*) filter (not good and {case}) as bad
      from l, (values {grid}) v(rule, step, cutoff) group by all),
p as (select *, case when n > 0 and k < n * {share} then list_sum(list_transform(range(0, k + 1), lambda j:
        exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({share}) + (n - j) * ln(1 - {share})))) else 1 end as tail,
        (select count(distinct stratum) from l) as strata from s),
f as (select *, min(case when tail > {error} / (strata * {len(RULES)}) then step end) over (partition by stratum, rule) as stop from p),
z as (select stratum, rule, arg_max(cutoff, (bad - k) * 100 - step) as cutoff from f
      where (stop is null or step < stop) and bad > 0 and bad - k > 0 group by all)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not exists (select 1 from z where z.stratum = b.stratum and ({chosen})) as kept
from b"""
