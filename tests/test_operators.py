import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from quire.operators import audit, blocks, escalation, formula, health, ledger, lines, primitives, render, structure, tables
from quire.sources.files import raw_documents, write_html, write_questions
from quire.streaming.ingest import SCHEMA, profile_stream

CHAR = "doc_id long, page_no int, prim_id long, ch string, fontname string, size double, x0 double, top double, x1 double, bottom double, has_unicode_map boolean"
BOX = "doc_id long, page_no int, prim_id long, x0 double, top double, x1 double, bottom double"
PAGE = "doc_id long, page_no int, width double, height double"


def char(i, ch, x, top, size=10.0, font="Times", page=0, known=True):
    return (1, page, i, ch, font, float(size), float(x), float(top), float(x) + 6, float(top) + size, known)


def test_page_health(spark):
    rows = [char(1, "�", 0, 0), char(2, "", 10, 0), char(3, "(cid:7)", 20, 0), char(4, "a", 30, 0, font="F1", known=False), char(5, "b", 40, 0), char(6, "b", 40.1, 0), char(7, "c", 700, 0), char(8, "x", 5, 5, page=1)]
    pages = spark.createDataFrame([(1, 0, 600.0, 800.0), (1, 1, 600.0, 800.0), (1, 2, 600.0, 800.0), (1, 3, 600.0, 800.0)], PAGE)
    images = spark.createDataFrame([(1, 3, 1, 0.0, 0.0, 600.0, 780.0)], BOX)
    got = {r.page_no: r for r in health.page_health(spark.createDataFrame(rows, CHAR), pages, images).collect()}
    r = got[0]
    assert (r.n_chars, r.n_cid, r.n_fffd, r.n_pua, r.n_unmapped_fonts, r.n_dup, r.n_oob, r.route) == (7, 1, 1, 1, 1, 1, 1, "B")
    assert [got[k].route for k in (1, 2, 3)] == ["A", "C", "C"] and got[3].max_img_cov == pytest.approx(0.975)


def test_text_health_and_producers(spark):
    docs = spark.createDataFrame([(1, "a�b  (cid:12)"), (2, None), (3, "plain"), (4, "éé")], "doc_id long, text string")
    got = {r.doc_id: (r.n_cid, r.n_fffd, r.n_pua, r.route) for r in health.text_health(docs).collect()}
    assert got == {1: (1, 1, 1, "B"), 2: (0, 0, 0, "C"), 3: (0, 0, 0, "A"), 4: (0, 0, 0, "B")}
    metas = ["pdfTeX-1.40", "XeTeX output", "Microsoft® Word 2019", "WPS Office", "scanner", None]
    rows = spark.createDataFrame([(m,) for m in metas], "m string").select(health.producer(F.col("m")).alias("p")).collect()
    assert [r.p for r in rows] == ["LaTeX", "XeTeX", "Word", "WPS", "other", "other"]


def test_deduplicated(spark):
    chars = spark.createDataFrame([char(1, "a", 0, 0), char(1, "a", 0, 0), char(2, "b", 6, 0)], CHAR)
    once = primitives.deduplicated(chars, ["doc_id", "page_no", "ch", "x0", "top"], ["prim_id"])
    assert once.columns == chars.columns and once.count() == 2 and primitives.duplicates(chars, ["prim_id"]).collect()[0].n == 2
    box = spark.createDataFrame([(1, 0, 9, 0.0, 0.0, 1.0, 1.0)], BOX)
    assert sorted(r.kind for r in primitives.primitives(once, box, box).collect()) == ["char", "char", "image", "rule"]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("abc xyz", min_size=1, max_size=8).filter(str.strip), min_size=1, max_size=5), st.randoms())
def test_lines_do_not_depend_on_order(spark, texts, rnd):
    rows = [char(100 * k + i, c, 6 * i, 20 * k + rnd.random()) for k, t in enumerate(texts) for i, c in enumerate(t)]
    rnd.shuffle(rows)
    got = lines.line_clusters(spark.createDataFrame(rows, CHAR)).orderBy("line_no").collect()
    assert [r.text for r in got] == texts


def test_columns(spark):
    rows = [char(i, "x", x, 12 * (i // 2)) for i, x in enumerate([0, 300, 6, 306, 0, 312])]
    chars = spark.createDataFrame(rows, CHAR)
    bands = lines.bands(chars)
    assert [(r.x0, r.x1) for r in bands.orderBy("band_no").collect()] == [(0.0, 12.0), (300.0, 318.0)]
    placed = lines.column_of(chars.withColumn("line_no", F.col("prim_id")), bands).collect()
    assert {r.prim_id: r.band_no for r in placed} == {0: 1, 1: 2, 2: 1, 3: 2, 4: 1, 5: 2}


def test_math_seeds_and_zones(spark):
    chars = spark.createDataFrame([char(1, "x", 0, 0, font="CMMI10"), char(2, "∑", 40, 0), char(3, "a", 100, 0), char(4, "b", 100, 14), char(5, "c", 200, 100)], CHAR)
    rules = spark.createDataFrame([(1, 0, 9, "horizontal", 98.0, 11.5, 110.0, 12.0), (1, 0, 8, "horizontal", 198.0, 111.0, 210.0, 112.0)], "doc_id long, page_no int, prim_id long, orientation string, x0 double, top double, x1 double, bottom double")
    seeds = lines.math_seeds(chars, rules)
    assert sorted((r.prim_id, r.reason) for r in seeds.collect()) == [(1, "font"), (2, "operator"), (9, "fraction")]
    found = lines.zones(seeds, chars.select(*BOX_COLUMNS).unionByName(rules.select(*BOX_COLUMNS))).collect()
    assert [r.seeds for r in found] == [["font"], ["operator"], ["fraction"]]  # 34 points and more apart on their line
    found = lines.zones(seeds, chars.select(*BOX_COLUMNS).unionByName(rules.select(*BOX_COLUMNS)), reach=60.0).collect()
    assert len(found) == 1 and found[0].seeds == ["font", "fraction", "operator"]


BOX_COLUMNS = ["doc_id", "page_no", "prim_id", "x0", "top", "x1", "bottom"]
ZONE = "zone_id long, prim_id long, kind string, ch string, size double, x0 double, top double, x1 double, bottom double"


def sign(i, ch, x, top, size=10.0, w=6.0, h=None, kind="char"):
    return (i, kind, ch, float(size), float(x), float(top), float(x) + float(w), float(top) + float(size if h is None else h))


ZONES = {
    "x^{2}": [sign(1, "x", 0, 10), sign(2, "2", 6, 7, 6)],
    "a_{i}+1": [sign(1, "a", 0, 10), sign(2, "i", 6, 16, 6), sign(3, "+", 14, 10), sign(4, "1", 22, 10)],
    r"\frac{a}{b}": [sign(1, "a", 2, 0), sign(2, "b", 2, 14), sign(3, None, 0, 11, w=12, h=1, kind="rule")],
    r"\sqrt{x}": [sign(1, "√", 0, 1), sign(2, None, 6, 0, w=10, h=1, kind="rule"), sign(3, "x", 8, 2)],
    r"\left(x\right)": [sign(1, "(", 0, 0), sign(2, "x", 6, 0), sign(3, ")", 12, 0)],
    r"\sum_{i}^{n} x": [sign(1, "∑", 0, 10, 12), sign(2, "n", 1, 2, 6), sign(3, "i", 1, 24, 6), sign(4, "x", 12, 11)],
    r"\bar{x}": [sign(1, "x", 0, 5), sign(2, None, 0, 2, w=6, h=1, kind="rule")],
    r"\hat{y}": [sign(1, "y", 0, 10), sign(2, "^", 0, 6, 5)],
    r"\begin{cases}x=1 \\ y=2\end{cases}": [sign(1, "{", 0, 0, 30), *[sign(10 + i, c, 10 + 7 * i, 0) for i, c in enumerate("x=1")], *[sign(20 + i, c, 10 + 7 * i, 18) for i, c in enumerate("y=2")]],
    r"\left(x\right)^{2}": [sign(1, "(", 0, 4), sign(2, "x", 6, 4), sign(3, ")", 12, 4), sign(4, "2", 18, 0, 6)],
    r"x^{a_{b}}": [sign(1, "x", 0, 10), sign(2, "a", 6, 6, 6), sign(3, "b", 10, 11, 4)],
    r"\frac{\frac{a}{b}}{c}": [sign(1, "a", 4, 0), sign(2, None, 2, 11, w=10, h=1, kind="rule"), sign(3, "b", 4, 13), sign(4, None, 0, 25, w=14, h=1, kind="rule"), sign(5, "c", 4, 28)],
    r"\frac{x^{2}}{\sqrt{b}}": [sign(1, "x", 2, 0), sign(2, "2", 8, -3, 6), sign(3, None, 0, 11, w=20, h=1, kind="rule"), sign(4, "√", 2, 14), sign(5, None, 8, 13, w=8, h=1, kind="rule"), sign(6, "b", 9, 15)],
}


def test_formulas(spark):
    rows = [(k, *p) for k, parts in enumerate(ZONES.values()) for p in parts]
    random.Random(1).shuffle(rows)
    prims = spark.createDataFrame(rows, ZONE)
    got = {r.zone_id: r for r in formula.formulas(prims).collect()}
    assert [got[k].latex for k in sorted(got)] == list(ZONES)
    assert all(r.confidence == 1.0 and not r.needs_escalation for r in got.values())
    nodes = formula.formula_nodes(prims).collect()
    assert {r.slot for r in nodes} >= {"root", "num", "den", "radicand", "sup", "sub", "lower", "upper", "line", "base"}
    assert all((r.parent_id is None) == (r.slot == "root") for r in nodes)
    odd = spark.createDataFrame([(1, *sign(1, "(", 0, 0)), (1, *sign(2, None, 50, 50, w=9, h=1, kind="rule"))], ZONE)
    row = formula.formulas(odd).first()
    assert row.confidence == 0.0 and row.needs_escalation
    twice = formula.formulas(prims.unionByName(prims.filter("zone_id = 0 and prim_id = 1"))).filter("zone_id = 0").first()
    assert "x" in twice.latex  # repeated rows stay
    assert formula.formulas(prims.limit(0)).count() == 0 and formula.formula_nodes(prims.limit(0)).count() == 0


def test_scripts(spark):
    chars = spark.createDataFrame([(1, 1, "x", 10.0, 0.0, 10.0, 6.0, 20.0), (1, 2, "2", 6.0, 6.0, 7.0, 10.0, 13.0), (1, 3, "i", 6.0, 6.0, 17.0, 10.0, 23.0), (1, 4, "y", 10.0, 12.0, 10.0, 18.0, 20.0)], "zone_id long, prim_id long, ch string, size double, x0 double, top double, x1 double, bottom double")
    assert sorted(tuple(r) for r in formula.script_edges(chars).collect()) == [(1, 1, 2, "sup"), (1, 1, 3, "sub")]


def test_paper_from_lines_to_html(spark, tmp_path):
    texts = ["一、选择题", "1. 1 < 2 的值 (5 分)", "续行", "(1) 小问", "A. 一 B. 二", "C. 三 D. 四", "【答案】A", "1. 不算", "2. 第二题", "【解析】略", "说明"]
    rows = [(1, k // 6, 1, k % 6, 0.0, 20.0 * (k % 6), 50.0, 20.0 * (k % 6) + 10, t) for k, t in enumerate(texts) if t != "1. 不算"]
    page = spark.createDataFrame(rows, "doc_id long, page_no int, band_no int, line_no int, x0 double, top double, x1 double, bottom double, text string")
    each = blocks.without_answers(blocks.blocks(blocks.paragraphs(page)))
    marked = structure.numbered(each)
    shown = [(r.text, r.kind, r.section_no, r.q_no, r.sub_no, r.ignore_reason) for r in marked.orderBy("block_no").collect()]
    assert shown[1][1:] == ("question", 1, 1, 0, None) and shown[3][1:] == ("subquestion", 1, 1, 1, None)
    assert [s[5] for s in shown] == [None] * 6 + ["answer", None, "answer", "answer"] and shown[7][3] == 2
    options = blocks.option_grid(marked.select("doc_id", "q_no", F.col("block_no").alias("line_no"), "text"))
    assert sorted((r.label, r.text) for r in options.collect()) == [("A", "一"), ("B", "二"), ("C", "三"), ("D", "四")]
    found = structure.questions(marked, options)
    one = found.filter("q_no = 1").first()
    assert (float(one.score), one.uncertain, len(one.options)) == (5.0, False, 4) and "续行" in one.stem
    assert '"uncertain_reason":null' in structure.question_json(found).filter("q_no = 1").first().json
    html = render.document_html(render.question_html(found)).first().html
    assert "1 &lt; 2" in html and '<li data-label="D">四</li>' in html and html == render.document_html(render.question_html(found.repartition(3))).first().html
    write_questions(structure.question_json(found), str(tmp_path / "q"))
    write_html(render.document_html(render.question_html(found)), str(tmp_path / "h"))
    assert spark.read.json(str(tmp_path / "q")).count() == 2 and html == next((tmp_path / "h").glob("*/1.html")).read_text()


def test_uncertain_is_in_json_and_html(spark):
    options = spark.createDataFrame([(1, 1, 1, "A", "x")], "doc_id long, q_no long, line_no long, label string, text string")
    each = spark.createDataFrame([(1, 1, "1. s", None)], "doc_id long, block_no long, text string, ignore_reason string")
    found = structure.questions(structure.numbered(each), options)
    assert '"uncertain":true' in structure.question_json(found).first().json and '<mark class="uncertain">' in render.question_html(found).first().html


def test_inline(spark):
    keys = "doc_id long, page_no int, line_no long, x0 double, id long"
    text = spark.createDataFrame([(1, 0, 1, 0.0, 1, "if "), (1, 0, 1, 30.0, 2, " then")], f"{keys}, text string")
    maths = spark.createDataFrame([(1, 0, 1, 20.0, 9, "x^{2}")], f"{keys}, latex string")
    assert blocks.inline(text, maths).first().text == "if $x^{2}$ then"


def test_labels_do_not_rewrite(spark):
    spans = spark.createDataFrame([(1, "sure", "stem", 0.9), (2, "low", "stem", 0.3)], "span_id long, text string, kind string, confidence double")
    out = {r.span_id: r for r in structure.labelled(spans, lambda texts: ["option" for _ in texts]).collect()}
    assert (out[1].kind, out[2].kind) == ("stem", "option") and [out[k].text for k in (1, 2)] == ["sure", "low"]


def test_tables(spark):
    key = (1, 0, 5)
    v = [(*key, "vertical", x, t, x, t + 10.0) for x in (0.0, 10.0, 20.0, 30.0) for t in (0.0, 10.0, 20.0) if (x, t) != (10.0, 0.0)]
    h = [(*key, "horizontal", 0.0, t, 30.0, t) for t in (0.0, 10.0, 20.0, 30.0)]
    rules = spark.createDataFrame(v + h, "doc_id long, page_no int, table_id long, orientation string, x0 double, top double, x1 double, bottom double")
    cells = tables.grid(rules)
    assert cells.count() == 9
    gaps = tables.gaps(cells, rules)
    assert [tuple(r)[3:] for r in gaps.collect()] == [(0, 0, "right")]
    spans = tables.merged(cells, gaps).collect()
    assert len(spans) == 8 and [(r.rowspan, r.colspan) for r in spans if (r.r, r.c) == (0, 0)] == [(1, 2)]
    chars = spark.createDataFrame([char(1, "a", 2, 12, 4), char(2, "b", 22, 22, 4), char(3, "c", 90, 2, 4)], CHAR)
    assert sorted((r.ch, r.r, r.c) for r in tables.members(chars, cells).collect()) == [("a", 1, 0), ("b", 2, 2)]
    images = spark.createDataFrame([(1, 0, 7, 0.0, 0.0, 5.0, 5.0, 640, 480, bytearray(b"raw"))], f"{BOX}, px_w int, px_h int, stream binary")
    ref = tables.figure_refs(images).withColumn("url", render.embedded(F.col("stream"))).first()
    assert ref.figure_ref.figure_id == 7 and (ref.px_w, ref.px_h) == (640, 480) and ref.url == "data:image/png;base64,cmF3"


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 9), max_size=20))
def test_ledger(spark, uses):
    prims = spark.createDataFrame([(k, k % 2) for k in range(10)], "prim_id long, node long")
    rows = ledger.conservation(prims, spark.createDataFrame([(u,) for u in uses], "prim_id long"), ["prim_id"])
    got = {r.prim_id: (r.uses, r.state) for r in rows.collect()}
    assert got == {k: (uses.count(k), {0: "orphan", 1: "once"}.get(uses.count(k), "duplicate")) for k in range(10)}


def test_coverage(spark):
    boxes = spark.createDataFrame([(1, 0, 1, 0.0, 0.0, 10.0, 10.0), (1, 0, 2, 5.0, 5.0, 15.0, 15.0)], BOX)
    pages = spark.createDataFrame([(1, 0, 100.0, 10.0), (1, 1, 1.0, 1.0)], PAGE)
    assert {r.page_no: r.coverage for r in ledger.coverage(boxes, pages).collect()} == {0: pytest.approx(0.175), 1: 0.0}


def test_coverage_against_counting(spark):
    draw = random.Random(3)
    rows, want = [], {}
    for page in range(40):
        filled = set()
        for k in range(draw.randint(1, 12)):
            x0, top, w, h = (draw.randint(0, n) for n in (15, 15, 5, 5))  # some have no area
            rows.append((1, page, k, float(x0), float(top), float(x0 + w), float(top + h)))
            filled |= {(x, y) for x in range(x0, x0 + w) for y in range(top, top + h)}
        want[page] = len(filled) / 400
    boxes = spark.createDataFrame(rows, BOX).unionByName(spark.createDataFrame([(1, 0, 99, None, None, None, None)], BOX))
    got = ledger.coverage(boxes, spark.createDataFrame([(1, p, 20.0, 20.0) for p in want], PAGE))
    assert {r.page_no: pytest.approx(r.coverage) for r in got.collect()} == want
    assert ledger.coverage(boxes.limit(0), spark.createDataFrame([], PAGE)).count() == 0


def test_ladder(spark):
    asked = spark.sparkContext.accumulator(0)

    def low(sources):
        return [(s + "0", s != "hard" and s != "never", 0.5) for s in sources]

    def high(sources):
        asked.add(len(sources))
        return [(s + "1", s != "never", 0.9) for s in sources]

    nodes = spark.createDataFrame([(1, "easy"), (2, "hard"), (3, "never")], "node_id long, source string")
    attempts = escalation.climb(nodes, [("200 dpi", low), ("300 dpi padded", high), ("model", high)])
    assert asked.value == 3  # two nodes on rung 1, one on rung 2: no engine is asked twice
    best = escalation.best_of(attempts, ["node_id"], [F.col("score").desc(), "rung", "payload"])
    out = {r.node_id: (r.payload, r.uncertain) for r in escalation.settled(nodes, best).collect()}
    assert out == {1: ("easy0", False), 2: ("hard1", False), 3: (None, True)} and attempts.agg(F.max("rung")).first()[0] <= 2
    with pytest.raises(ValueError):
        escalation.climb(nodes, [("x", low)] * 4)


def test_best_of_breaks_ties_and_drops_broken(spark):
    rows = [(1, 0, "a", True, 0.5), (1, 1, "b", True, 0.5), (1, 2, "c", False, 0.9), (2, 0, "d", False, 0.9)]
    attempts = spark.createDataFrame(rows, "node_id long, rung int, payload string, invariants_ok boolean, score double")
    assert [r.payload for r in escalation.best_of(attempts, ["node_id"], [F.col("score").desc(), "rung"]).collect()] == ["a"]
    assert [r.id for r in escalation.queue(spark.createDataFrame([(1, 0.9), (2, 0.1), (3, None)], "id long, confidence double")).orderBy("id").collect()] == [2, 3]


def test_fonts(spark):
    rows = [("LaTeX", "F1", "a", True, 3), ("LaTeX", "F1", "\ue000", False, 2), ("Word", "F1", "a", True, 1)]
    got = audit.font_audit(spark.createDataFrame(rows, "producer string, fontname string, ch string, has_unicode_map boolean, n long")).collect()
    assert sorted(map(tuple, got)) == [("LaTeX", "F1", 5, 2, 2, 2), ("Word", "F1", 1, 1, 0, 0)]


def test_silent_errors_count_questions(spark):
    rows = spark.createDataFrame([(1, True, False), (1, False, False), (1, True, True), (2, False, False)], "page long, wrong boolean, uncertain boolean")
    got = audit.silent_errors(rows, F.col("wrong"), F.col("uncertain")).first()
    assert (got.n_questions, got.n_silent, got.silent_rate) == (4, 1, 0.25)
    assert audit.silent_errors(rows.limit(0), F.col("wrong"), F.col("uncertain")).first().silent_rate is None
    assert not audit.fill_rates(rows.limit(0), {"x": F.col("wrong")}).first().reached


def test_overlay(spark):
    boxes = spark.createDataFrame([(1, 0, 2, 0.0, 0.0, 5.0, 5.0, True), (1, 0, 1, 1.0, 1.0, 2.0, 2.0, False)], "doc_id long, page_no int, node_id long, x0 double, top double, x1 double, bottom double, uncertain boolean")
    svg = render.overlay(boxes, spark.createDataFrame([(1, 0, 10.0, 10.0)], PAGE)).first().svg
    assert svg.index('class="sure"') < svg.index('class="uncertain"') and svg.startswith('<svg viewBox="0 0 10.0 10.0">')


def test_raw_files_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.pdf").write_bytes(b"%PDF")
    assert raw_documents(spark, str(tmp_path / "in")).first().length == 4
    source, sink, mark = (str(tmp_path / x) for x in ("source", "sink", "mark"))
    for rows in ([(1, "plain", "en", "s", 5)], [(2, "", "en", "s", 0), (3, "ééé", "fr", "s", 3)]):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(source)
        profile_stream(spark, source, sink, mark).awaitTermination(120)
    assert sorted((r.doc_id, r.route) for r in spark.read.parquet(sink).collect()) == [(1, "A"), (2, "C"), (3, "B")]
    health.write_health(spark.read.parquet(sink), str(tmp_path / "report"))
    assert spark.read.parquet(str(tmp_path / "report")).filter("route = 'B'").count() == 1
