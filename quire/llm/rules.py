"""Quality rules whose cutoffs are risk-controlled: exact binomial tests on labelled documents, per stratum."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quire.session import small, stored

#: Base rules: fewer words than this, or a larger percentage of words in repeated windows, fail outright.
MIN_WORDS, MAX_REPEATED = 50, 50
#: Cutoff of each rule at the lenient and at the strict end of the path; a document breaks a rule beyond its cutoff.
PATH = {
    "symbols": (0.60, 0.02),  # symbols for each character of a word
    "dup_lines": (0.90, 0.10),  # duplicate lines for each line
    "repeats": (0.50, 0.10),  # words in repeated windows for each word
    "long_words": (20.0, 10.0),  # mean characters of a word
}
#: Points of the path that are tested, from lenient to strict.
STEPS = 20
#: Share of good documents that may be rejected in any stratum, and the chance that this fails in any of them.
ALPHA, DELTA = 0.05, 0.05


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _repeated(words: Column) -> Column:
    """Words inside windows of three that occur twice or more; hashes of windows are sorted next to each other."""

    def covered(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(p: Column) -> Column:
            alike = lambda x, j: (x["h"] == F.coalesce(F.get(p, j - 1)["h"], F.bitwise_not(x["h"]))) | (x["h"] == F.coalesce(F.get(p, j + 1)["h"], F.bitwise_not(x["h"])))
            return F.sort_array(F.transform(F.filter(p, alike), lambda x: x["i"]))

        add = lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(a["end"], i)).alias("n"), (i + 3).alias("end"))
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        total = F.aggregate(_let(pairs, positions), zero, add, lambda a: a["n"])
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), total).otherwise(0)

    hashed = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) > 3, _let(hashed, covered)).otherwise(0)


def measured(docs: DataFrame) -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of the whole text, instead of it.

    Words are runs of anything but space and \\t to \\r; null has none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = lambda w: F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), _repeated(w).alias("n_repeat_words"))
    of_lines = lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c != "text"],
        F.explode(F.array(F.struct(_let(words, of_words).alias("w"), _let(lines, of_lines).alias("l"), F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("s")))).alias("m__"),
    )
    names = {"n_words": "w.n_words", "word_chars": "w.word_chars", "n_symbols": "s", "n_dup_lines": "l.n_dup_lines", "n_repeat_words": "w.n_repeat_words", "n_lines": "l.n_lines"}
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns if c != "text"], *[F.col(f"m__.{v}").cast("long").alias(k) for k, v in names.items()])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def margin() -> Column:
    """How far along the path a document passes all rules: it is rejected at t if the margin is below t."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    value = {"symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"), "long_words": share("word_chars", "n_words")}
    return F.least(*[(low - value[k]) / (low - high) for k, (low, high) in PATH.items()])


def _log_factorial(x: Column) -> Column:
    """Logarithm of x!, by Stirling's series from ten further on, where it is right to twelve places."""
    y = x + 10.0
    series = y * F.log(y) - y + 0.5 * F.log(2 * math.pi * y) + 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    between = x + 1.0
    for k in range(2, 11):
        between = between * (x + float(k))
    return series - F.log(between)


def _tail(k: Column, n: Column, alpha: float) -> Column:
    """P(at most k of n) at rejection rate alpha, exactly; 1 where k is above its mean.

    Below the mean the terms fall faster and faster, so they are added from the k-th down, as far as twelve standard deviations:
    what is left has no place in a double. The number of terms grows with the square root of n only.
    """
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(alpha) + (n - k) * math.log(1 - alpha))
    terms = F.least(k, F.ceil(40 + 12 * F.sqrt(n * alpha * (1 - alpha))))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))
    ratio = lambda i: i * ((1 - alpha) / alpha) / (n - i + 1.0)
    step = lambda a, j: F.struct((a["term"] * ratio(k - j)).alias("term"), (a["sum"] + a["term"]).alias("sum"))
    return F.when(k > alpha * n, 1.0).otherwise(top * F.aggregate(F.sequence(F.lit(0).cast("long"), terms), start, step, lambda a: a["sum"]))


def cutoffs(good: DataFrame, alpha: float = ALPHA, delta: float = DELTA, steps: int = STEPS) -> DataFrame:
    """(stratum, margin) of good documents -> stratum, n_good, cutoff: the strictest safe point of the path, or null.

    At each point the hypothesis "more than alpha of the stratum's good documents are rejected" is tested by
    the exact binomial tail. Points are tested from lenient to strict, and testing ends at the first that is not
    rejected (fixed-sequence testing), each at delta divided by the number of strata (Bonferroni): with
    chance 1 - delta every stratum's rejection rate is at most alpha. One row of sums for each stratum.
    """
    at = [k / steps for k in range(steps + 1)]
    sums = good.groupBy("stratum").agg(F.count("*").alias("n_good"), F.array(*[F.count(F.when(F.col("margin") < t, 1)) for t in at]).alias("rejected"))
    sums = stored(sums, "sums")
    level = delta / max(1, sums.count())
    safe = F.transform("rejected", lambda k: _tail(k, F.col("n_good"), alpha) <= level)
    passed = F.coalesce(F.array_position(safe, F.lit(False)) - 1, F.lit(0))
    passed = F.when(passed < 0, steps + 1).otherwise(passed)
    return sums.select("stratum", "n_good", F.when(passed > 0, (passed - 1) / F.lit(float(steps))).alias("cutoff"))


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """Figures of every document, base_failed, and kept by the risk-controlled rules of its stratum.

    Calibrates on all documents with a label of quality 1 that pass the base rules. A stratum without enough of them has no
    cutoff and keeps what passes the base rules; a null stratum is one of its own. A label that repeats counts once
    for each document row; null doc_ids have no label. Texts are read once; the narrow table of figures is stored.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("-"))
    rows = stored(measured(docs.select("doc_id", key.alias("stratum"), "text")).withColumn("base_failed", base_failed()).withColumn("margin", margin()), "figures")
    good = rows.filter(~F.col("base_failed")).join(labels.filter("quality = 1").select("doc_id").distinct(), "doc_id", "left_semi")
    found = stored(cutoffs(good.select("stratum", "margin")), "cutoffs")
    rows = rows.join(small(found), "stratum", "left")
    kept = ~F.col("base_failed") & F.coalesce(F.col("margin") >= F.col("cutoff"), F.lit(True))
    return rows.withColumn("kept", kept).withColumn("stratum", F.when(F.col("stratum") != "-", F.substr("stratum", F.lit(2))))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures, base_failed, kept, stratum and cutoff of every document."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return judged(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "stratum", "cutoff")


OP5_SQL = r"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, p, words[p + 1] AS a, words[p + 2] AS b, words[p + 3] AS c
  FROM (SELECT doc_id, words, unnest(range(0, len(words) - 2)) AS p FROM w)),
r AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
f AS (SELECT w.doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, len(lines) AS n_lines
  FROM w LEFT JOIN rep USING (doc_id)),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    least((0.6::DOUBLE - n_symbols::DOUBLE / greatest(word_chars, 1)) / (0.6::DOUBLE - 0.02::DOUBLE),
          (0.9::DOUBLE - n_dup_lines::DOUBLE / greatest(n_lines, 1)) / (0.9::DOUBLE - 0.1::DOUBLE),
          (0.5::DOUBLE - n_repeat_words::DOUBLE / greatest(n_words, 1)) / (0.5::DOUBLE - 0.1::DOUBLE),
          (20.0::DOUBLE - word_chars::DOUBLE / greatest(n_words, 1)) / (20.0::DOUBLE - 10.0::DOUBLE)) AS margin FROM f),
good AS (SELECT lang, margin FROM m WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
s AS (SELECT lang, t, count(*) AS n, count(*) FILTER (margin < t) AS k
  FROM good, (SELECT unnest(range(0, 21)) / 20.0::DOUBLE AS t) GROUP BY lang, t),
test AS (SELECT lang, t, CASE WHEN k > 0.05 * n THEN 1.0 ELSE
    list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.05::DOUBLE) + (n - i) * ln(0.95::DOUBLE)))) END
    <= 0.05::DOUBLE / (SELECT count(DISTINCT coalesce('=' || lang, '-')) FROM good) AS safe FROM s),
cut AS (SELECT lang, max(t) FILTER (safe AND t < coalesce(first_bad, 2)) AS cutoff
  FROM (SELECT *, min(t) FILTER (NOT safe) OVER (PARTITION BY lang) AS first_bad FROM test) GROUP BY lang)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND coalesce(margin >= cutoff, true) AS kept, m.lang AS stratum, cutoff
FROM m LEFT JOIN cut ON m.lang IS NOT DISTINCT FROM cut.lang
"""
