"""X: audits of a corpus and metrics of its results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quire.functions.geometry import share
from quire.functions.text import PRIVATE


def corpus_mix(docs: DataFrame, by: list[str]) -> DataFrame:
    """Documents by each of the columns and in all: grouping sets ((a), (b), ..., ())."""
    sets = [[F.col(c)] for c in by] + [[]]
    level = F.concat_ws("+", *[F.when(F.grouping(c) == 0, F.lit(c)) for c in by])
    return docs.groupingSets(sets, *by).agg(F.count("*").alias("n_docs"), level.alias("level"))


def font_audit(kinds: DataFrame) -> DataFrame:
    """Characters to verify by producer and font: all, different ones, private-use ones and those without a Unicode map.

    `kinds` has a row for each producer, fontname, ch and has_unicode_map, with its number of characters n: characters
    are aggregated before they are classified.
    """
    return kinds.groupBy("producer", "fontname").agg(
        F.sum("n").alias("n_chars"), F.count_distinct("ch").alias("n_kinds"), F.sum(F.when(F.col("ch").rlike(PRIVATE), F.col("n")).otherwise(0)).alias("n_pua"), F.sum(F.when(~F.col("has_unicode_map"), F.col("n")).otherwise(0)).alias("n_unmapped")
    )


def calibration(rows: DataFrame, confidence: Column, correct: Column, bins: int = 10) -> DataFrame:
    """Rows and share of correct ones in equal bins of confidence."""
    made = rows.select(F.least(F.floor(confidence * bins), F.lit(bins - 1)).cast("int").alias("bin"), correct.cast("double").alias("correct"))
    return made.groupBy("bin").agg(F.count("*").alias("n"), F.avg("correct").alias("accuracy"))


def isotonic(rows: DataFrame, confidence: Column, correct: Column, bins: int = 1_000) -> DataFrame:
    """A calibrated confidence: low, high, n, calibrated, the steps of the monotone curve that fits the share of correct ones best.

    Rows are first summed in `bins` equal bins of confidence from 0 to 1, so that whatever their number a table of `bins` rows goes to one
    place; there adjacent bins whose shares fall are pooled until none does (pool adjacent violators), as a fold with a stack. `low` and `high` are
    the least and the largest confidence of a step's rows. Rows with a null in either are left out; no rows give no steps.
    """
    at = F.least(F.greatest(F.floor(confidence * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    sums = rows.select(at.alias("bin"), confidence.cast("double").alias("x"), correct.cast("double").alias("y")).filter("x is not null and y is not null")
    sums = sums.groupBy("bin").agg(F.count("*").cast("double").alias("n"), F.sum("y").alias("s"), F.min("x").alias("low"), F.max("x").alias("high"))
    step = "struct<low:double,high:double,n:double,s:double>"
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("bin", "low", "high", "n", "s"))), lambda b: F.struct(b["low"], b["high"], b["n"], b["s"]))
    both = lambda p, q: F.struct(p["low"].alias("low"), q["high"].alias("high"), (p["n"] + q["n"]).alias("n"), (p["s"] + q["s"]).alias("s"))

    def pushed(a: Column, b: Column) -> Column:
        """The steps of a, then b, which takes in as many of the last steps as lie above it."""
        down = F.aggregate(F.reverse(a), F.struct(F.lit(0).alias("taken"), b.alias("top"), F.lit(True).alias("open")), lambda s, p: F.when(s["open"] & (p["s"] * s["top"]["n"] >= s["top"]["s"] * p["n"]), F.struct((s["taken"] + 1).alias("taken"), both(p, s["top"]).alias("top"), F.lit(True).alias("open"))).otherwise(F.struct(s["taken"].alias("taken"), s["top"].alias("top"), F.lit(False).alias("open"))))
        return F.transform(F.array(down), lambda d: F.concat(F.slice(a, F.lit(1), F.size(a) - d["taken"]), F.array(d["top"])))[0]

    curve = F.aggregate("bins", F.array().cast(f"array<{step}>"), pushed)
    found = sums.agg(ordered.alias("bins")).select(F.explode(curve).alias("x"))
    return found.select("x.low", "x.high", F.col("x.n").cast("long").alias("n"), (F.col("x.s") / F.col("x.n")).alias("calibrated"))


def calibrated(curve: DataFrame, rows: DataFrame, confidence: Column, name: str = "calibrated") -> DataFrame:
    """Rows with the confidence that a curve of isotonic() gives them: that of the last step that begins at or below theirs, or of the first.

    The curve has a step for each bin at most, so it goes along as one broadcast row. A null confidence, or a curve without steps, gives null.
    """
    own = curve.agg(F.array_sort(F.collect_list(F.struct("low", F.col("calibrated").alias("value")))).alias("steps__"))
    below = F.filter("steps__", lambda s: s["low"] <= F.col("conf__"))
    value = F.when(F.col("conf__").isNotNull(), F.coalesce(F.try_element_at(below, F.lit(-1)), F.get("steps__", F.lit(0)))["value"])
    return rows.drop(name).withColumn("conf__", confidence.cast("double")).join(F.broadcast(own)).withColumn(name, value).drop("conf__", "steps__")


def silent_errors(questions: DataFrame, wrong: Column, uncertain: Column) -> DataFrame:
    """Share of questions that are wrong and not marked; questions are the denominator, not pages."""
    return questions.agg(F.count("*").alias("n_questions"), F.count_if(wrong & ~uncertain).alias("n_silent")).withColumn("silent_rate", share(F.col("n_silent"), F.col("n_questions")))


def fill_rates(rows: DataFrame, checks: dict[str, Column], least: float = 0.9) -> DataFrame:
    """For each check: rows, those that pass it, the rate, and whether it reaches `least`. One pass over the rows."""
    sums = rows.agg(F.count("*").alias("n"), *[F.count_if(c).alias(k) for k, c in checks.items()])
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("n_filled")) for k in checks]))
    out = sums.select("n", each.alias("x")).select("x.metric", "n", "x.n_filled").withColumn("rate", share(F.col("n_filled"), F.col("n")))
    return out.withColumn("reached", F.coalesce(F.col("rate") >= least, F.lit(False)))
