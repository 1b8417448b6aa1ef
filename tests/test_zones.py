"""S2.1-S2.3: zones in two dimensions."""

import random

import pytest

from quire.operators import lines
from tests.test_operators import BOX

SEED = "doc_id long, page_no int, prim_id long, reason string"


def found(spark, boxes, **settings):
    prims = spark.createDataFrame([(1, 0, k, *map(float, b)) for k, b in enumerate(boxes)], BOX)
    seeds = spark.createDataFrame([(1, 0, k, "font" if k % 2 else "operator") for k in range(len(boxes))], SEED)
    return [(r.zone_id, r.x0, r.top, r.x1, r.bottom, r.seeds) for r in lines.zones(seeds, prims, **settings).orderBy("zone_id").collect()]


def test_formulas_apart_on_a_line_are_two_zones(spark):
    got = found(spark, [(0, 0, 10, 10), (15, 0, 25, 10), (525, 0, 535, 10), (537, 2, 540, 8)])
    assert got == [(1, 0.0, 0.0, 25.0, 10.0, ["font", "operator"]), (2, 525.0, 0.0, 540.0, 10.0, ["font", "operator"])]


def plain(boxes, reach):
    label = [*range(len(boxes))]
    near = lambda a, b: a[0] - reach <= b[2] and b[0] - reach <= a[2] and a[1] - reach <= b[3] and b[1] - reach <= a[3]
    for _ in boxes:
        for i, a in enumerate(boxes):
            for j, b in enumerate(boxes):
                if near(a, b):
                    label[i] = label[j] = min(label[i], label[j])
    groups = {}
    for k, b in zip(label, boxes, strict=True):
        groups.setdefault(k, []).append(b)
    return sorted((min(b[1] for b in g), min(b[0] for b in g), max(b[2] for b in g), max(b[3] for b in g)) for g in groups.values())


@pytest.mark.parametrize("cell", [7.0, 60.0])
def test_against_all_pairs(spark, cell):
    rnd = random.Random(int(cell))
    boxes = [(x, y, x + rnd.choice([4, 6, 90]), y + rnd.choice([2, 8])) for x, y in ((rnd.randint(0, 500), rnd.randint(0, 400)) for _ in range(90))]
    chain = [(600 + 14 * k, 14 * k, 604 + 14 * k, 14 * k + 4) for k in range(40)]  # one zone of forty, each next to the one before
    got = found(spark, boxes + chain, cell=cell)
    assert sorted((t, x0, x1, b) for _, x0, t, x1, b, _ in got) == [tuple(map(float, z)) for z in plain(boxes + chain, 12)]
    assert [z[0] for z in got] == [*range(1, len(got) + 1)]


def test_seeds_without_box_repeats_and_empty(spark):
    prims = spark.createDataFrame([(1, 0, 1, 0.0, 0.0, 5.0, 5.0), (1, 0, 1, 0.0, 0.0, 5.0, 5.0), (1, 0, 2, None, 0.0, 5.0, 5.0)], BOX)
    seeds = spark.createDataFrame([(1, 0, 1, "font"), (1, 0, 1, "font"), (1, 0, 2, "font"), (1, 0, 3, "font"), (None, 0, 1, "font")], SEED)
    assert [(r.zone_id, r.x0, r.seeds) for r in lines.zones(seeds, prims).collect()] == [(1, 0.0, ["font"])]
    assert lines.zones(seeds.limit(0), prims).count() == 0
