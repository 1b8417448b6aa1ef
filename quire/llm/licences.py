"""Licence scan: a sparse word n-gram classifier of paragraphs, a calibrated unknown class, and a comparison with templates."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quire.llm.notices import IDENTIFIERS, MARKS, NAMES, OTHER, SHORT, TEMPLATES, WORDINGS
from quire.session import removed, small, stored

UNKNOWN = "unknown"
#: Unlabelled paragraphs to learn the unknown class from; those that hold so much of a notice are left out, as nobody has labelled them.
SAMPLE, LIKE = 1_500, 0.35
#: One notice in so many is kept, with all its variants, for the calibration; so are unlabelled paragraphs.
KEPT = 4
#: n-grams of notices in a larger share of the unlabelled paragraphs tell little, and are left out.
COMMON = 0.01
#: A family is confirmed where a paragraph holds so much of one of its notices, and a HALF of its word pairs. Without that, the calibrated probability has to reach
#: SURE, and at least a HALF of a notice and of its word pairs has to be there; else the paragraph is unknown.
SHARED, SURE, HALF, BRIEF = 0.6, 0.9, 0.5, 8
#: What a whole name counts where no notice is held better: enough for a paragraph that is SURE to be a licence, not to confirm it.
NAME = 0.5
#: Calibrated probability from which a paragraph is compared at all.
GATE = 0.2


#: Words of a piece of a paragraph, in which n-grams are looked up; a piece has one word more, for its last pair.
PIECE = 256


@dataclass(frozen=True)
class Model:
    """Weights of the n-grams that have any, by family; intercepts; the logistic calibration of the margin; templates."""

    families: list[str]
    grams: dict[str, list[float]]
    intercept: list[float]
    slope: float
    offset: float


def words(text: Column) -> Column:
    """Words in lower case, runs of letters or of digits; a licence is a license, and the v of a version is a word."""
    text = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "licen[cs]e", "license"), "((?:gp|mp)l)v(?=[0-9])", "$1 v")
    return F.regexp_extract_all(text, F.lit(r"(cc0|\p{L}+|\p{N}+)"), F.lit(1))


def _grams(tokens: Column) -> Column:
    """Words and pairs of neighbours, each once."""
    pairs = F.zip_with(F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))), F.slice(tokens, F.lit(2), F.size(tokens)), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(tokens, F.when(F.size(tokens) > 1, pairs).otherwise(F.array().cast("array<string>"))))


#: A line feed inside a sentence: after it the line goes on, behind marks of a comment if there are any.
WRAP = r"(?<=[^.!?:;。\s])[ \t\r]*+\n(?=[ \t#*/;%!>-]*+[\p{L}\p{N}\"'(\[])"


def _paragraphs(docs: DataFrame) -> DataFrame:
    """A row (…, paragraph, passage) for each paragraph of each text, numbered from 0 on, those without a letter or digit left out.

    A line feed ends a paragraph unless it stands inside a sentence: wrapped notices are whole again.
    """
    rows = docs.select(*[c for c in docs.columns if c != "text"], F.posexplode(F.split(F.regexp_replace("text", WRAP, " "), "\n")).alias("paragraph", "passage"))
    return rows.filter(F.col("passage").rlike(r"[\p{L}\p{N}]"))


def _table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A few literal rows, made by the JVM."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("x")).select("x.*")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _held(passage: Column, forms: Column) -> Column:
    """The best struct (share, pairs, family) over forms (family, grams, marks): how much a passage holds of a form's n-grams and word pairs.

    A part of a form of under BRIEF n-grams counts half, and none of a form counts where a word that tells licences apart is missing. Where
    a form has such words, a shorter passage may be held by it as well: what counts then is the part of the passage, and of its pairs.
    """
    pairs = lambda a: F.size(F.filter(a, lambda g: g.contains(" ")))

    def of(f: Column, k: Column) -> Column:
        held = F.array_intersect(f["grams"], k["grams"])
        share = F.size(held) / F.size(f["grams"])
        whole = F.when((F.size(f["grams"]) < BRIEF) & (share < 1), share / 2).otherwise(share)
        part = F.when(F.size(f["marks"]) > 0, F.least(F.size(held) / F.greatest(k["n"], F.lit(1)), F.coalesce(F.try_divide(pairs(held), k["pairs"]), F.lit(1.0)))).otherwise(0.0)
        own = F.coalesce(F.try_divide(pairs(held), pairs(f["grams"])), F.lit(1.0))
        name = F.when(F.size(held) == F.size(f["grams"]), NAME + F.size(held) / 1_000).otherwise(0.0)
        part = F.when(f["bare"], name).otherwise(part)
        whole = F.when(f["bare"], name).otherwise(whole)
        return F.struct(F.greatest(whole, part).alias("share"), F.greatest(own, part).alias("pairs"), f["family"].alias("family"))

    def best(k: Column) -> Column:
        told = F.filter(forms, lambda f: F.size(F.array_except(f["marks"], k["grams"])) == 0)
        return F.coalesce(F.array_max(F.transform(told, lambda f: of(f, k))), F.struct(F.lit(0.0).alias("share"), F.lit(0.0).alias("pairs"), F.lit("").alias("family")))

    every = F.array_distinct(F.flatten(F.transform(forms, lambda f: f["grams"])))
    known = lambda own: F.struct(F.array_intersect(own, every).alias("grams"), F.size(own).alias("n"), pairs(own).alias("pairs"))
    return _let(_let(_grams(words(passage)), known), best)


def _known(spark: SparkSession) -> DataFrame:
    """family, n, form, short: notices, and short ones by rule; every KEPTth notice or wording of a family can be kept out."""
    rows = [{"family": f, "n": k, "form": t, "short": False} for f, ts in TEMPLATES.items() for k, t in enumerate(ts)]
    rows += [{"family": f, "n": k // (len(ts) // len(WORDINGS)), "form": t, "short": True} for f, ts in SHORT.items() for k, t in enumerate(ts)]
    return _table(spark, rows, "family string, n int, form string, short boolean").withColumn("bare", F.lit(False))


def _forms(spark: SparkSession, all_: bool = True) -> DataFrame:
    """forms, one row: family, n-grams and telling words of each notice; without all_, only of those that are not kept for the calibration."""
    rows = _known(spark).filter(F.lit(all_) | (F.col("n") % KEPT != KEPT - 1))
    names = _table(spark, [{"family": f, "form": n} for f, ns in NAMES.items() for n in ns], "family string, form string")
    rows = rows.select("family", "form", "bare").unionByName(names.withColumn("bare", F.lit(True))).withColumn("tokens", words(F.col("form")))
    marks = F.array_intersect("tokens", F.array(*map(F.lit, MARKS)))
    return rows.agg(F.collect_list(F.struct("family", _grams(F.col("tokens")).alias("grams"), marks.alias("marks"), "bare")).alias("forms"))


def examples(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(family, passage, kept): notices and hard negatives in variants, and unlabelled paragraphs as the unknown class.

    A notice comes whole, without its beginning or end, and with every fifth word left out, a short one whole; a notice's words in alphabetical order
    are a hard negative, as are sentences that use them for other things. Whole notices are `kept` for the calibration, never
    single variants. Paragraphs come from documents drawn by a hash of the text, repeated ones once, `sample` of them at most by the
    order of their hashes; paragraphs that hold LIKE of a notice or more are left out. An empty table leaves notices and sentences.
    """
    spark = docs.sparkSession
    other = _table(spark, [{"family": UNKNOWN, "n": k, "form": t, "short": False} for k, t in enumerate(OTHER)], "family string, n int, form string, short boolean")
    rows = _known(spark).drop("bare").unionByName(other).withColumn("parts", F.split("form", " "))
    n = F.size("parts")
    variants = [F.col("parts"), F.slice("parts", F.lit(1), F.ceil(n * 0.7).cast("int")), F.slice("parts", F.floor(n * 0.3).cast("int") + 1, n)]
    without = lambda r: F.filter("parts", lambda _, i: i % 5 != r)
    variants += [F.when(n > 4, without(r)).otherwise(F.col("parts")) for r in range(5)]
    own = rows.select("family", "n", F.explode(F.when(F.col("short"), F.array("parts")).otherwise(F.array(*variants))).alias("parts"))
    mixed = rows.filter((F.col("family") != UNKNOWN) & ~F.col("short")).select(F.lit(UNKNOWN).alias("family"), "n", F.array_sort(F.transform("parts", lambda w: F.lower(w))).alias("parts"))
    known = own.unionByName(mixed).select("family", F.array_join("parts", " ").alias("passage"), (F.col("n") % KEPT == KEPT - 1).alias("kept")).distinct()

    total = docs.count()
    drawn = docs.filter(F.pmod(F.xxhash64("text", F.lit(1)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 2 * sample / max(1, total)))).select("text")
    other = _paragraphs(drawn).select("passage", F.xxhash64("passage", F.lit(2)).alias("h"))
    last = other.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    other = other.filter(F.col("h") <= F.lit(last)).dropDuplicates(["h"])
    other = other.join(F.broadcast(_forms(spark))).filter(_held(F.col("passage"), F.col("forms"))["share"] < LIKE)
    return known.unionByName(other.select(F.lit(UNKNOWN).alias("family"), "passage", (F.pmod("h", F.lit(KEPT)) == 0).alias("kept")))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Multinomial logistic regression with an L1 penalty on presence of the notices' n-grams, then a calibration of its margin.

    Whole notices and a part of the paragraphs are kept from the regression; on those, a logistic curve of the margin between the best
    family and the unknown class gives the probability that a paragraph is a licence at all. Learns from `docs` (text) only
    the unknown class; without documents, from sentences alone. Nothing depends on the order or repetition of rows.
    """
    families = [UNKNOWN, *sorted(TEMPLATES)]
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double") - 1
    rows = stored(examples(docs, sample).select(label.alias("label"), _grams(words(F.col("passage"))).alias("grams"), "kept").coalesce(4), "examples")
    vocabulary = rows.filter("label > 0 and not kept").select(F.explode("grams").alias("gram")).groupBy("gram").count()
    telling = F.arrays_overlap(F.split("gram", " "), F.array(*map(F.lit, MARKS)))
    vocabulary = vocabulary.filter((F.col("count") > 1) | telling).select("gram")
    unknown = rows.filter("label = 0")
    often = unknown.select(F.explode("grams").alias("gram")).groupBy("gram").count().filter(F.col("count") > max(3.0, COMMON * unknown.count()))
    names = sorted(r.gram for r in vocabulary.join(often, "gram", "left_anti").collect())  # n-grams of the notices, a fixed text
    fitted = CountVectorizerModel.from_vocabulary(names, inputCol="grams", outputCol="features").setBinary(True)
    # one weight for each class, so that small families count as much as large ones, and the unknown class as all of them
    sizes = rows.groupBy("label").agg((F.when(F.col("label") == 0, float(len(TEMPLATES))).otherwise(1.0) / F.count("*")).alias("weight"))
    made = stored(fitted.transform(rows).join(F.broadcast(sizes), "label").select("label", "features", "kept", "weight").coalesce(1), "features")
    model = LogisticRegression(family="multinomial", weightCol="weight", elasticNetParam=1.0, regParam=0.0002, maxIter=60, standardization=False).fit(made.filter("not kept"))
    table, intercept = model.coefficientMatrix.toArray(), [float(x) for x in model.interceptVector.toArray()]
    raw = model.transform(made.filter("kept")).select("label", F.expr("cast(rawPrediction as string)").alias("shown"))
    margin = F.transform(F.split(F.regexp_replace("shown", r"[\[\]]", ""), ","), lambda x: x.cast("double"))
    raw = raw.withColumn("margin", F.array_max(F.slice(margin, F.lit(2), F.lit(model.numClasses - 1))) - F.get(margin, 0))
    curve = stored(raw.select((F.col("label") > 0).cast("double").alias("y"), "margin").coalesce(1), "margins")
    slope, offset = _logistic(curve)
    grams = {g: [float(v) for v in table[:, k]] for k, g in enumerate(names) if abs(table[:, k]).max() > 1e-6}
    removed(docs.sparkSession, rows, made, curve)
    return Model(families[: len(intercept)], grams, intercept, slope, offset)


def _logistic(curve: DataFrame, turns: int = 25) -> tuple[float, float]:
    """Slope and offset of P(y = 1 | margin), by Newton's method on sums over the rows, with a small ridge."""
    a, b = 0.1, 0.0
    for _ in range(turns):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), a * F.col("margin") + b))))
        w, d, m = p * (1 - p), F.col("y") - p, F.col("margin")
        ga, gb, haa, hab, hbb = (x or 0.0 for x in curve.agg(F.sum(d * m), F.sum(d), F.sum(w * m * m), F.sum(w * m), F.sum(w)).first())
        ga, gb, haa, hbb = ga - 0.01 * a, gb - 0.01 * b, haa + 0.01, hbb + 0.01
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a + max(-2.0, min(2.0, da)), b + max(-5.0, min(5.0, db))
        if abs(da) + abs(db) < 1e-6:
            break
    return max(a, 1e-6), b


def scan(docs: DataFrame, model: Model, all_: bool = True) -> DataFrame:
    """doc_id, text -> doc_id, paragraph, family, probability, similarity, confirmed: paragraphs that hold a licence.

    Every paragraph of every text is scored: its n-grams are looked up in the broadcast table of weights, which has a row for each
    n-gram with a weight, and only hits are shuffled. Where the calibrated probability is GATE or more, the paragraph is
    compared with the notices of all families, whichever the regression takes for the best: `similarity` is the largest share that it holds
    of the words and word pairs of one of them, whose family is returned, and `confirmed` says that it is SHARED or more, with a HALF of the pairs. What is not confirmed
    stays only if the probability is SURE and half of the notice and of its pairs are there; else the paragraph is of the unknown class and
    not returned. A paragraph with a known SPDX-License-Identifier has that family, its first one's, with a similarity and a probability of 1.
    Without all_, notices that were kept from learning are kept from the comparison too. Rows alike in doc_id and paragraph are
    reported once; null texts have no paragraphs; null doc_ids are kept; other columns are left behind.
    """
    spark = docs.sparkSession
    weights = [{"gram": g, "weight": w} for g, w in model.grams.items()] or [{"gram": "", "weight": []}]
    weights = _table(spark, weights, "gram string, weight array<double>").select(F.xxhash64("gram").alias("code"), "weight")
    rows = _paragraphs(docs.select("doc_id", "text"))
    tokens = words(F.col("passage"))
    # a lambda sees the words as an array element of its own, or they would be taken anew for every piece
    pieces = _let(tokens, lambda t: F.transform(F.when(F.size(t) > 0, F.sequence(F.lit(0), F.floor((F.size(t) - 1) / PIECE).cast("int"))), lambda k: F.slice(t, k * PIECE + 1, PIECE + 1)))
    at = rows.select("doc_id", "paragraph", F.xxhash64("passage").alias("same"), F.explode_outer(pieces).alias("tokens"))
    at = at.select("*", F.posexplode_outer("tokens").alias("pos", "token"))
    following = F.get(F.col("tokens"), F.col("pos") + 1)
    codes = F.explode(F.array(F.xxhash64("token"), F.when(following.isNotNull(), F.xxhash64(F.concat_ws(" ", "token", following)))))
    at = at.select("doc_id", "paragraph", "same", codes.alias("code")).filter("code is not null")
    once = at.join(F.broadcast(weights), "code").groupBy("doc_id", "paragraph", "same", "code").agg(F.first("weight").alias("weight"))
    sums = [F.sum(F.get("weight", F.lit(k))).alias(f"z{k}") for k in range(len(model.families))]
    z = [F.col(f"z{k}") + F.lit(model.intercept[k]) for k in range(len(model.families))]
    best = F.greatest(*z[1:]) if len(z) > 2 else z[-1]
    probability = 1 / (1 + F.exp(-(model.slope * (best - z[0]) + model.offset)))
    found = once.groupBy("doc_id", "paragraph", "same").agg(*sums).select("doc_id", "paragraph", "same", probability.alias("probability")).filter(F.col("probability") >= GATE)
    named = _identified(docs)
    found = stored(found.join(named.select("doc_id", "paragraph", "same"), _same(found, named), "left_anti"), "licences")
    return _compared(docs, found, all_).unionByName(named.drop("same"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["paragraph"] == b["paragraph"]) & (a["same"] == b["same"])


def _identified(docs: DataFrame) -> DataFrame:
    """Paragraphs that name their licence by an identifier of the list."""
    families = F.create_map(*[F.lit(x) for f, ids in IDENTIFIERS.items() for i in ids for x in (i.lower(), f)])
    rows = _paragraphs(docs.select("doc_id", "text").filter(F.col("text").contains("SPDX-License-Identifier")))
    identifier = F.lower(F.regexp_extract("passage", r"SPDX-License-Identifier:\s*\(?([A-Za-z0-9.-]*[A-Za-z0-9])", 1))
    rows = rows.select("doc_id", F.col("paragraph").cast("long").alias("paragraph"), F.xxhash64("passage").alias("same"), F.try_element_at(families, identifier).alias("family"))
    return rows.filter("family is not null").distinct().select("*", F.lit(1.0).alias("probability"), F.lit(1.0).alias("similarity"), F.lit(True).alias("confirmed"))


def _compared(docs: DataFrame, found: DataFrame, all_: bool) -> DataFrame:
    """Reads the found paragraphs again and compares them with the notices of all families."""
    keys = found.select(F.col("doc_id").alias("id__")).distinct()
    rows = _paragraphs(docs.select("doc_id", "text").join(small(stored(keys, "licensed")), F.col("doc_id").eqNullSafe(F.col("id__")), "left_semi"))
    own = found.select(F.col("doc_id").alias("id__"), F.col("paragraph").alias("at__"), "same", "probability")
    on = rows["doc_id"].eqNullSafe(own["id__"]) & (rows["paragraph"] == own["at__"]) & (F.xxhash64("passage") == own["same"])
    rows = rows.join(small(own), on).dropDuplicates(["doc_id", "paragraph", "same"]).join(F.broadcast(_forms(docs.sparkSession, all_)))
    rows = rows.withColumn("best", F.explode(F.array(_held(F.col("passage"), F.col("forms")))))
    rows = rows.select("doc_id", F.col("paragraph").cast("long").alias("paragraph"), "best.family", F.round("probability", 6).alias("probability"), F.round("best.share", 6).alias("similarity"), "best.pairs")
    rows = rows.withColumn("confirmed", (F.col("similarity") >= SHARED) & (F.col("pairs") >= HALF))
    return rows.filter(F.col("confirmed") | ((F.col("probability") >= SURE) & (F.col("similarity") >= HALF) & (F.col("pairs") >= HALF))).drop("pairs")


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs of all documents, by a model whose unknown class is learnt from them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs, train(docs))
