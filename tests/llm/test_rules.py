import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.llm.rules import ALPHA, OP5_SQL, _tail, cutoffs, judged, measured, op5_quality_rules
from tests.llm.oracle import same

SF = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {i + k for i in range(len(words) - 2) if windows[(words[i], words[i + 1], words[i + 2])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), len(lines)


def test_figures(spark):
    rnd = random.Random(8)
    texts = [None, "", " \n\t", "a", "a b c", "a b c a b c", "a a a a", "a a a", "x\n x\nx\n\nx", "#1 <b>|</b>\x1c é\U0001f600 $", "w " * 50_000, "a b a b a b c d e c d e"]
    texts += [" ".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 40))) for _ in range(60)]
    got = measured(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == [plain(t) for t in texts]


@pytest.mark.parametrize("k,n", [(0, 0), (0, 10), (3, 100), (5, 100), (6, 100), (40, 1000), (900, 20000)])
def test_binomial_tail(spark, k, n):
    exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(ALPHA) + (n - i) * math.log(1 - ALPHA)) for i in range(k + 1)) if k <= ALPHA * n else 1.0
    row = spark.createDataFrame([(k, n)], "k long, n long").select(_tail(F.col("k"), F.col("n"), ALPHA).alias("p")).first()
    assert row.p == pytest.approx(exact, rel=1e-9)


def test_cutoffs_hold_the_risk(spark):
    rnd = random.Random(3)
    rows = [("en", rnd.random()) for _ in range(3000)] + [("de", 0.9)] * 500 + [("few", 1.0)] * 10
    got = {r.stratum: r.cutoff for r in cutoffs(spark.createDataFrame(rows, "stratum string, margin double")).collect()}
    assert got["de"] == 0.9 and got["few"] is None and 0 <= got["en"] <= 0.05
    assert cutoffs(spark.createDataFrame([], "stratum string, margin double")).count() == 0


def test_odd_rows(spark):
    good = " ".join(f"word{i}" for i in range(60))
    docs = [(1, good, None, "x"), (1, good, None, "x"), (None, good, "en", None), (2, None, "en", "y"), (3, "a " * 80, "en", "y")]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, kept string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = sorted((str(r.doc_id), str(r.stratum), r.base_failed, r.kept) for r in judged(docs, labels).collect())
    assert got == [("1", "None", False, True), ("1", "None", False, True), ("2", "en", True, False), ("3", "en", True, False), ("None", "en", False, True)]
    assert judged(docs.limit(0), labels).count() == 0 and judged(docs, labels.limit(0)).count() == 5


def test_query_against_sql(spark):
    assert same(op5_quality_rules(spark, SF), OP5_SQL, SF) == 1000
