"""S7.1-S7.3, X.7, X.4, S3.10: ledgers by digests, and confidences that mean what they say."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import audit, escalation, ledger

PRIM = "doc_id long, page_no int, prim_id long"


def papers(spark):
    rnd = random.Random(2)
    prims = [(d, p, 100 * p + i) for d in range(30) for p in range(3) for i in range(8)]
    used = [x for x in prims]
    for d in (3, 7, None):
        prims += [(d, None, 1), (d, 5, None)]
        used += [(d, None, 1)]
    used.remove((4, 1, 103))
    used += [(9, 2, 205), (11, 0, 999), (40, 0, 1)]
    used.remove((12, 0, 3))
    used.append((12, 0, 4))  # as many as there should be, but not the same
    rnd.shuffle(used)
    return spark.createDataFrame(prims, PRIM), spark.createDataFrame(used, PRIM)


def test_digests_find_what_the_join_finds(spark):
    prims, used = papers(spark)
    keys = ["doc_id", "page_no", "prim_id"]
    want = {tuple(r)[:5] for r in ledger.conservation(prims, used, keys).filter("state <> 'once'").collect()}
    got = {tuple(r)[:5] for r in ledger.unbalanced(prims, used, ["doc_id", "page_no"], keys).collect()}
    assert got == want | {(11, 0, 999, 1, "unknown"), (40, 0, 1, 1, "unknown")}
    pages = {tuple(r) for r in ledger.unequal(prims, used, ["doc_id", "page_no"], keys).collect()}
    assert pages == {(4, 1), (9, 2), (11, 0), (40, 0), (12, 0), (3, 5), (7, 5), (None, 5)}
    assert ledger.unbalanced(prims, prims, ["doc_id", "page_no"], keys).count() == 0 == ledger.unbalanced(prims.limit(0), used.limit(0), ["doc_id", "page_no"], keys).count()


def test_digests_of_parts_add_up(spark):
    prims, _ = papers(spark)
    whole, twice = ledger.digests(prims, ["doc_id"], ["prim_id"]), ledger.digests(prims.unionByName(prims), ["doc_id"], ["prim_id"])
    assert {r.doc_id: (r.n * 2, r.a.a_low * 2) for r in whole.collect()} == {r.doc_id: (r.n, r.a.a_low) for r in twice.collect()}


def plain_isotonic(points):
    """Pool adjacent violators over points in order."""
    steps = []
    for x, y in sorted(points):
        steps.append([x, x, 1, y])
        while len(steps) > 1 and steps[-2][3] * steps[-1][2] >= steps[-1][3] * steps[-2][2]:
            b, a = steps.pop(), steps.pop()
            steps.append([a[0], b[1], a[2] + b[2], a[3] + b[3]])
    return [(a, b, n, s / n) for a, b, n, s in steps]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_isotonic_against_a_plain_twin(spark, seed):
    rnd = random.Random(seed)
    points = [(k / 200 + 0.001, float(rnd.random() < (k / 200) ** 2)) for k in range(200)]  # one in each bin
    rows = spark.createDataFrame(points, "c double, y double")
    got = sorted(map(tuple, audit.isotonic(rows, F.col("c"), F.col("y"), 200).collect()))
    assert got == [(a, b, n, pytest.approx(v)) for a, b, n, v in plain_isotonic(points)]
    values = [v for *_, v in got]
    assert values == sorted(values) and sum(n for _, _, n, _ in got) == 200
    curve = audit.isotonic(rows, F.col("c"), F.col("y"), 200)
    shown = {r.c: r.calibrated for r in audit.calibrated(curve, rows, F.col("c")).collect()}
    assert all(shown[x] == pytest.approx(next(v for a, b, _, v in got if a <= x <= b)) for x, _ in points)


def test_the_threshold_uses_the_curve(spark):
    judged = spark.createDataFrame([(0.9, k < 5) for k in range(10)] + [(0.95, True)] * 10 + [(0.5, False)] * 3 + [(None, True), (0.2, None)], "confidence double, correct boolean")
    nodes = spark.createDataFrame([(1, 0.9), (2, 0.95), (3, 0.4), (4, None), (5, 1.0), (6, 7.0)], "node_id long, confidence double")
    got = {r.node_id: r.calibrated for r in escalation.calibrated_queue(nodes, judged).collect()}
    assert got == {1: 0.5, 3: 0.0, 4: None}
    assert escalation.calibrated_queue(nodes, judged.limit(0)).count() == 6 and escalation.calibrated_queue(nodes.limit(0), judged).count() == 0
