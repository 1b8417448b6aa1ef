"""S2.4, S4.2, S4.6: columns beside each other are read one after the other."""

import random

from pyspark.sql import functions as F

from quire.operators import blocks, lines
from tests.test_operators import CHAR, char

LINE = "doc_id long, page_no int, line_no long, x0 double, top double, x1 double, bottom double, text string"


def column(names, x0, top, width=100.0):
    return [(x0, top + 12.0 * k, x0 + width, top + 12.0 * k + 10, n) for k, n in enumerate(names)]


def read(spark, boxes, **settings):
    draw = random.Random(1)
    rows = [(1, 0, k, float(a), float(b), float(c), float(d), t) for k, (a, b, c, d, t) in enumerate(boxes)]
    draw.shuffle(rows)
    got = lines.reading_order(spark.createDataFrame(rows, LINE), **settings).orderBy("order_no").collect()
    return [r.text for r in got], [r.region_no for r in got]


def test_one_to_three_columns_under_a_heading(spark):
    head = [(50.0, 0.0, 450.0, 10.0, "head")]
    for n in (1, 2, 3):
        width = 400 / n - 20
        names = [[f"{c}{k}" for k in range(6 - c)] for c in range(n)]
        boxes = head + [b for c in range(n) for b in column(names[c], 50 + c * 400 / n, 14.0, width)] + [(50.0, 100.0, 450.0, 110.0, "foot")]
        texts, _ = read(spark, boxes)
        assert texts == ["head", *[t for own in names for t in own], "foot"]


def test_columns_whose_lines_are_not_level(spark):
    boxes = column(["a", "b", "c"], 0, 0) + [(120.0, 3.0 + 14 * k, 220.0, 15.0 + 14 * k, t) for k, t in enumerate("xyz")]
    assert read(spark, boxes)[0] == list("abcxyz")


def test_nested_columns_and_short_lines(spark):
    left = column(["l1", "l2"], 0, 0, 90) + [(0.0, 24.0, 40.0, 34.0, "l3")]
    right = [(120.0, 0.0, 320.0, 10.0, "r0"), *column(["p1", "p2"], 120, 14, 80), *column(["q1", "q2"], 240, 14, 80)]
    texts, regions = read(spark, left + right)
    assert texts == ["l1", "l2", "l3", "r0", "p1", "p2", "q1", "q2"] and regions == [1, 1, 1, 2, 3, 3, 4, 4]
    assert read(spark, left + right, depth=1)[0][:3] == ["l1", "l2", "l3"]


def test_one_column_keeps_its_order_whatever_its_widths(spark):
    rnd = random.Random(4)
    boxes = [(rnd.choice([0.0, 20.0]), 12.0 * k, rnd.choice([60.0, 200.0, 300.0]), 12.0 * k + 10, str(k)) for k in range(20)]
    assert read(spark, boxes)[0] == [str(k) for k in range(20)]


def test_pages_of_a_batch_are_cut_apart(spark):
    """Pages of any number of strips, columns and turns, each as if it were alone; sides may be NaN or infinite, x1 may lie left of x0."""
    rnd = random.Random(5)
    odd = (float("nan"), float("inf"), -float("inf"), -40.0)
    rows = []
    for d in range(120):
        for i in range(rnd.choice([1, 3, 12, 30])):
            x0, top = float(rnd.randrange(0, 300, rnd.choice([1, 40]))), float(rnd.randrange(0, 200, 9))
            box = [x0, top, x0 + rnd.choice([5, 20, 60, 200]), top + rnd.choice([1, 9, 30])]
            if d % 4 == 0 and rnd.random() < 0.1:
                box[rnd.randrange(4)] = rnd.choice(odd)
            rows.append((d, 0, i, *box, str(i)))
    shuffled = rnd.sample(rows, len(rows))
    got = {}
    for r in lines.reading_order(spark.createDataFrame(shuffled, LINE).coalesce(1)).orderBy("doc_id", "order_no").collect():
        got.setdefault(r.doc_id, []).append((r.line_no, r.region_no))
    for d in range(120):
        own = sorted((r for r in rows if r[0] == d), key=lambda r: (order_of(r[4]), order_of(r[3]), r[2]))
        assert got[d] == [(r[2], k + 1) for k, part in enumerate(recursive(own)) for r in part]


def order_of(v):
    return (v != v, 0 if v != v else v)


def recursive(boxes, gutter=12.0, slack=1.0, depth=4):
    """The same cut of one page's boxes, written plainly. NaN is the largest number."""
    less = lambda a, b: order_of(a) < order_of(b)
    high, low = lambda v: max(v, key=order_of), lambda v: min(v, key=order_of)
    parts = [boxes]
    for _ in range(depth):
        parts = [c for p in parts if p for c in cut_once(p, gutter, slack, less, high, low)]
    return parts


def cut_once(boxes, gutter, slack, less, high, low):
    left, right = low([r[3] for r in boxes]), high([r[5] for r in boxes])
    strips = []
    for r in boxes:
        if strips and less(r[4], high([q[6] for q in strips[-1]]) - slack):
            strips[-1].append(r)
        else:
            strips.append([r])
    parts = []
    for own in strips:
        end, gaps = left, []
        for r in sorted(own, key=lambda r: (order_of(r[3]), order_of(r[5]))):
            if not less(r[3] - end, gutter):
                gaps.append((end, r[3]))
            end = high([end, r[5]])
        if not less(right - end, gutter):
            gaps.append((end, right))
        both = [(high([a, c]), low([b, d])) for a, b in parts[-1][0] for c, d in gaps] if parts else []
        both = [(a, b) for a, b in both if not less(b - a, gutter)]
        if parts and (both or not (parts[-1][0] or gaps)):
            parts[-1] = (both, parts[-1][1] + own)
        else:
            parts.append((gaps, own))
    merged = []
    for gaps, own in parts:
        inner = [(a, b) for a, b in gaps if any(not less(a, r[5]) for r in own) and any(not less(r[3], b) for r in own)]
        if merged and not inner and not merged[-1][0]:
            merged[-1] = ([], merged[-1][1] + own)
        else:
            merged.append((inner, own))
    place = lambda r, gaps: sum(not less(r[3], b) for _, b in gaps)
    return [[r for r in own if place(r, gaps) == k] for gaps, own in merged for k in range(len(gaps) + 1)]


def test_nulls_repeats_and_empty(spark):
    rows = [(1, 0, 1, 0.0, 0.0, 9.0, 9.0, "a"), (1, 0, 1, 0.0, 0.0, 9.0, 9.0, "a"), (1, 0, None, 0.0, 20.0, 9.0, 29.0, "b"), (1, 0, 4, None, 0.0, 9.0, 9.0, "c"), (None, 0, 1, 0.0, 0.0, 9.0, 9.0, "d"), (2, 1, 1, None, None, None, None, "e")]
    frame = spark.createDataFrame(rows, LINE)
    got = lines.reading_order(frame)
    assert got.columns == [*frame.columns, "region_no", "order_no"]
    assert sorted((r.doc_id or 0, r.order_no, r.text) for r in got.collect()) == [(0, 1, "d"), (1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (1, 4, "c"), (2, 1, "e")]
    assert lines.reading_order(frame.limit(0)).count() == 0


def test_characters_of_two_columns_are_not_one_line(spark):
    rows = [char(i, c, 6 * (i % 3) + (100 if i >= 3 else 0), 0) for i, c in enumerate("onetwo")] + [char(10 + i, c, 6 * i, 14) for i, c in enumerate("abc")]
    chars = spark.createDataFrame(rows, CHAR)
    assert [r.text for r in lines.line_clusters(chars).orderBy("line_no").collect()] == ["onetwo", "abc"]
    pieces = lines.line_clusters(chars, gutter=2.0)
    assert [(r.line_no, r.text, r.n_chars, r.x0) for r in pieces.orderBy("line_no").collect()] == [(1, "one", 3, 0.0), (2, "two", 3, 100.0), (3, "abc", 3, 0.0)]
    ordered = lines.reading_order(pieces).withColumnRenamed("region_no", "band_no")
    text = blocks.blocks(blocks.paragraphs(ordered.withColumn("band_no", F.col("band_no").cast("int")))).orderBy("block_no").collect()
    assert [r.text for r in text] == ["one\nabc", "two"]
