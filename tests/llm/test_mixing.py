import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm.mixing import _ends, _fly, _land, copies, mixed, mixture, n_words, op7_mixing, repeated, targets

SF = "/root/testdata/sf0.01"


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    out, free, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while free and left > 1e-9:
        total = sum(weight[s] for s in free)
        for s in free:
            out[s] += left * weight[s] / total
        left = 0.0
        for s in list(free):
            if out[s] >= most * sizes[s]:
                left += out[s] - most * sizes[s]
                out[s] = most * sizes[s]
                free.remove(s)
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, "c": 5, "é": 7, "Z": 90, None: 40}, {None: 3}, {"a": 0, "b": 4}, {}])
def test_targets(spark, sizes):
    got = {r.source: r.target for r in targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_flight_keeps_sums_and_expectations():
    rng = np.random.default_rng(1)
    size = rng.integers(0, 500, 60)
    p = np.full(60, 0.37)
    runs = []
    for k in range(400):
        out = _fly(p, size, np.random.default_rng(k))
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert out.sum() == pytest.approx(p.sum()) and out @ size == pytest.approx(p @ size)
        runs.append(out)
    assert np.abs(np.mean(runs, 0) - 0.37).max() < 0.11
    equal = _fly(np.full(30, 0.5), np.full(30, 7), np.random.default_rng(0))
    assert ((equal > 0) & (equal < 1)).sum() <= 2


@pytest.mark.parametrize("n", [5, 20, 50])
def test_small_sources_keep_their_inclusion_probabilities(n):
    """Over many seeds; the words are near the target all the same, as near as the units' sizes allow."""
    rng = np.random.default_rng(n)
    p, size = rng.random(n), np.exp(rng.normal(4.0, 1.0, n)).round()
    runs = np.array([_land(p, size, np.random.default_rng(k)) for k in range(1_500)])
    assert np.isin(runs, (0.0, 1.0)).all() and np.abs(runs.mean(0) - p).max() < 0.05
    missed = np.abs((runs - p) @ size) / (p @ size)
    assert missed.mean() < {5: 0.25, 20: 0.06, 50: 0.002}[n]


def test_ends_are_the_best_there_are():
    p, size = np.array([0.5, 0.5, 0.5, 0.5]), np.array([3.0, 1.0, 2.0, 2.0])
    ends, chances = _ends(p, size)
    assert chances @ ends == pytest.approx(p) and chances @ np.abs((ends - p) @ size) == pytest.approx(0)
    ends, chances = _ends(np.array([0.3]), np.array([7.0]))
    assert chances @ ends == pytest.approx([0.3])
    for k in range(40):  # never worse than units that end apart or together
        rng = np.random.default_rng(k)
        n = int(rng.integers(2, 9))
        p, size = rng.random(n).round(2).clip(0.01, 0.99), rng.integers(0, 50, n).astype(float)
        ends, chances = _ends(p, size)
        assert chances @ ends == pytest.approx(p) and (chances >= 0).all()
        every = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
        apart = np.where(every, p, 1 - p).prod(1) @ np.abs((every - p) @ size)
        assert chances @ np.abs((ends - p) @ size) <= apart + 1e-6


def test_landing_keeps_expectations_and_misses_little():
    for p, size in (([1.0, 0.3, 0.6], [3.0, 10.0, 4.0]), ([0.2, 0.9], [0.0, 5.0]), ([0.2, 0.9], [0.0, 0.0]), ([0.4], [7.0]), ([1.0, 0.0], [1.0, 1.0])):
        p, size = np.array(p), np.array(size)
        runs = np.array([_land(p, size, np.random.default_rng(k)) for k in range(3_000)])
        assert np.isin(runs, (0.0, 1.0)).all() and np.abs(runs.mean(0) - p).max() < 0.04
        assert np.abs((runs - p) @ size).max() <= size.max()
    size = np.array([20_000.0, 9_000.0] + [float(s) for k in range(14) for s in (1 << k, 3 << k >> 1) for _ in range(8)])
    p = np.random.default_rng(2).random(len(size)) * 0.8 + 0.1
    runs = np.array([_land(p, size, np.random.default_rng(k)) for k in range(2_000)])
    assert np.abs(runs.mean(0) - p).max() < 0.05 and np.quantile(np.abs((runs - p) @ size), 0.95) < 100


def test_inclusion_probabilities_of_the_whole_method(spark):
    rows = [(k, "a", 5 * k, 1) for k in range(1, 25)]
    units = spark.createDataFrame(rows, "doc_id long, source__ string, size__ long, many__ long")
    rates = units.select("source__").distinct().withColumn("rate__", F.lit(0.4))
    times = Counter(r.doc_id for seed in range(25) for r in copies(units, rates, ["doc_id"], seed=seed).collect() if r.copies__)
    share = np.array([times[k] for k in range(1, 25)]) / 25
    assert abs(share.mean() - 0.4) < 0.05 and np.abs(share - 0.4).max() < 0.45  # over four standard deviations of 25 draws


@pytest.mark.parametrize("bucket_rows", [20_000, 16])
def test_totals_and_partitioning(spark, bucket_rows):
    rng = np.random.default_rng(4)
    rows = [(int(k), "hot" if k % 3 else f"s{k % 7}", int(rng.integers(0, 300)), 1 if k else 50) for k in range(900)]
    units = spark.createDataFrame(rows, "doc_id long, source__ string, size__ long, many__ long")
    rates = units.select("source__").distinct().withColumn("rate__", F.lit(1.37))
    got = copies(units, rates, ["doc_id"], bucket_rows=bucket_rows).collect()
    again = copies(units.repartition(7), rates, ["doc_id"], bucket_rows=bucket_rows).collect()
    assert sorted(got) == sorted(again) and len(got) == 900
    near, words = defaultdict(float), defaultdict(float)
    for r in got:
        near[r.source__] += r.copies__ * r.size__ - 1.37 * r.many__ * r.size__
        assert 1.37 * r.many__ - 1 < r.copies__ < 1.37 * r.many__ + 1
    assert all(abs(v) < 300 for v in near.values())


def test_odd_rows(spark):
    docs = [(1, "a b", "x", 1)] * 9 + [(2, None, "x", None), (3, "", None, 1), (None, "q", None, 2), (4, "w " * 100_000, "y", 3)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, source string, size long")
    assert sorted(r.n for r in docs.select(n_words(F.col("text")).alias("n")).collect()) == [0, 0, 1] + [2] * 9 + [100_000]
    out = mixture(docs)
    assert out.columns == [*docs.columns, "copy"]
    seen = Counter((r.doc_id, r.text, r.source) for r in out.collect())
    assert all(n <= 2 * (9 if k[0] == 1 else 1) for k, n in seen.items())
    assert mixture(docs.limit(0)).count() == 0
    assert mixture(docs.withColumn("copy", F.lit("x"))).columns == out.columns
    clash = docs.withColumns({"nth": F.lit(1), "many__x": F.lit(2), "source_size": F.lit("z")})
    assert mixture(clash).columns == [*clash.columns, "copy"] and mixture(clash).count() > 0
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(mixture(docs.repartition(5))) == key(out)


def test_repeats_of_one_row_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr("quire.llm.mixing.BLOCK", 10)
    rows = spark.createDataFrame([("a", 3), ("b", 0), ("c", 57), ("d", None)], "k string, n long")
    got = Counter((r.k, r.nth) for r in repeated(rows, F.col("n"), "nth").collect())
    assert got == Counter([("a", k) for k in range(1, 4)] + [("c", k) for k in range(1, 58)])


def test_query(spark):
    texts = {r.doc_id: (r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text))) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sizes = Counter()
    for source, n in texts.values():
        sizes[source] += n
    want, taken = plain_targets(sizes), Counter()
    rows = op7_mixing(spark, SF).collect()
    assert len(rows) == len(texts) and sorted(rows) == sorted(op7_mixing(spark, SF).collect())
    for r in rows:
        source, n = texts[r.doc_id]
        assert r.size == n and r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert r.taken in (0, n, 2 * n)
        taken[source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.01 * sizes[s] + 50 for s in want)
