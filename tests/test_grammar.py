"""S6.1, S6.2, S6.4: markers are read by the numbering that they make together."""

import itertools
import random

from pyspark.sql import functions as F

from quire.functions.text import token_kind, token_number
from quire.operators import ledger, structure

BLOCK = "doc_id long, block_no long, text string"


def kinds(spark, texts):
    rows = spark.createDataFrame([(1, k, t) for k, t in enumerate(texts)], BLOCK)
    return [r.kind for r in structure.decoded(rows).orderBy("block_no").collect()]


def test_markers_and_their_numbers(spark):
    want = {"十二、x": ("section", 12), "三、x": ("section", 3), "二十、": ("section", 20), "12. x": ("question", 12), "3．": ("question", 3), "3.5 m": ("text", None), "(4) a": ("subquestion", 4), "C. x": ("option", 3), "x": ("text", None), None: ("text", None)}
    rows = spark.createDataFrame([(t,) for t in want], "t string").select("t", token_kind(F.col("t")).alias("k"), token_number(F.col("t")).alias("n"))
    assert {r.t: (r.k, r.n) for r in rows.collect()} == want


def test_stray_numbers_are_text(spark):
    assert kinds(spark, ["1. A", "3.5 metres", "2. of the two", "2. B", "(1) s", "(2) s", "3. C"]) == ["question", "text", "text", "question", "subquestion", "subquestion", "question"]
    assert kinds(spark, ["一、A", "1. a", "2. b", "二、B", "1. a", "2. b"]) == ["section", "question", "question", "section", "question", "question"]
    assert kinds(spark, ["7. an excerpt", "8. goes on", "9. and on"])[1:] == ["question", "question"]
    assert kinds(spark, ["1. a", "A. w", "C. Smith", "B. x", "2. b"]) == ["question", "option", "text", "option", "question"]


def value(taken):
    """Score of a reading that takes exactly these markers."""
    s = q = sub = opt = fresh = 0
    total = 0.0
    for _, kind, n, worth in taken:
        if kind == "question":
            total += (structure.EXPECTED if n == q + 1 or (n == 1 and fresh) else structure.BROKEN if n > q else structure.BACKWARDS) + worth
            q, sub, opt, fresh = n, 0, 0, 0
            continue
        last = {"section": s, "subquestion": sub, "option": opt}[kind]
        total += structure.EXPECTED if n == last + 1 and (q > 0 or kind == "section") else structure.BROKEN
        if kind == "section":
            s, sub, opt, fresh = n, 0, 0, 1
        elif kind == "subquestion":
            sub, opt = n, 0
        else:
            opt = n
    return total


def plain(rows):
    """The best score of all readings."""
    marks = [r for r in rows if r[1] != "text"]
    return max(value([m for m, t in zip(marks, take, strict=True) if t]) + structure.AS_TEXT * take.count(0) for take in itertools.product((0, 1), repeat=len(marks)))


def test_the_reading_is_the_best_of_all(spark):
    rnd = random.Random(6)
    marks = ["一、x", "二、x", "1. a", "2. b", "3. c", "2. B", "4. D (5 分)", "(1) s", "(2) s", "A. w", "B. x", "plain"]
    for _ in range(4):
        docs = [[rnd.choice(marks) for _ in range(rnd.randint(1, 9))] for _ in range(30)]
        frame = spark.createDataFrame([(d, k, t) for d, texts in enumerate(docs) for k, t in enumerate(texts)], BLOCK)
        got = structure.decoded(frame).select("doc_id", "block_no", "text", "kind", token_kind(F.col("text")).alias("own"), token_number(F.col("text")).alias("n")).orderBy("doc_id", "block_no").collect()
        for d, texts in enumerate(docs):
            rows = [r for r in got if r.doc_id == d]
            worth = lambda r: (structure.MIDWAY if r.text[3:4].islower() and r.own == "question" else 0.0) + (structure.POINTS if "分" in r.text else 0.0)
            all_ = [(r.block_no, r.own, r.n, worth(r)) for r in rows]
            taken = [x for x, r in zip(all_, rows, strict=True) if r.kind != "text"]
            forced = value(taken) + structure.AS_TEXT * sum(r.own != "text" and r.kind == "text" for r in rows)
            assert abs(forced - plain(all_)) < 1e-9, texts


def test_nulls_repeats_and_empty(spark):
    rows = spark.createDataFrame([(None, 1, "1. a"), (1, 1, None), (1, None, "1. a"), (2, 1, "1. a"), (2, 1, "1. a"), (2, 2, "2. b")], BLOCK)
    assert sorted((r.doc_id or 0, r.kind) for r in structure.decoded(rows).collect()) == [(0, "question"), (1, "question"), (1, "text"), (2, "question"), (2, "question"), (2, "question")]
    assert structure.decoded(rows.withColumn("kind", F.lit("old"))).columns == ["doc_id", "block_no", "text", "kind"]
    assert structure.numbered(rows.limit(0)).count() == 0


def test_labels_in_place(spark):
    rows = [(1, "a", "stem", 0.1), (1, "b", "stem", 0.1), (None, "c", "stem", 0.1), (2**60 + 1, "d", "stem", 0.9), (3, None, None, None)]
    spans = spark.createDataFrame(rows, "span_id long, text string, kind string, confidence double")
    asked = structure.labelled(spans, lambda texts: [f"new {t}" for t in texts])
    assert [tuple(r)[:3] for r in asked.collect()] == [(1, "a", "new a"), (1, "b", "new b"), (None, "c", "new c"), (2**60 + 1, "d", "stem"), (3, None, "new None")]
    assert structure.labelled(spans.limit(0), lambda texts: texts).count() == 0


def test_null_keys_are_consumed(spark):
    prims = spark.createDataFrame([(1, None), (None, 2), (3, 3)], "doc_id long, prim_id long")
    got = ledger.conservation(prims, prims.filter("prim_id is null or doc_id is null"), ["doc_id", "prim_id"]).collect()
    assert {(r.doc_id, r.prim_id): r.state for r in got} == {(1, None): "once", (None, 2): "once", (3, 3): "orphan"}
