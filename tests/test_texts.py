"""Pages that come as texts and are laid out in numpy: the same results as from rows, no glyph an object, and nothing shuffled."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.functions import glyphs as flat
from quire.operators import health, lines, primitives
from quire.plans import registry
from tests.oracle import same

SF = "/root/testdata/sf0.001"
TEXTS = [(1, "ab  cd\n\nef"), (2, "\n".join(f"line {i} x" * (i % 3) for i in range(165))), (3, "\n\n"), (4, None), (5, "aé文 b\U0001d4b3�\n\U0001d4b3"), (6, ""), (None, " \r\n\tz"), (7, "x" * 130 + "\n")]
AGAIN = [(1, "ab x\n\n\ng"), (2, None), (None, "\n" * 90 + "q"), (5, "aé文")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _rows(docs):
    rows = primitives.glyphs(docs)
    prim = F.col("line_no").cast("long") * 1_000_000 + F.col("col")
    return rows.select("doc_id", "page_no", prim.alias("prim_id"), "ch", F.lit(12.0).alias("size"), F.lit("grid").alias("fontname"), F.lit(True).alias("has_unicode_map"), "x0", "top", "x1", "bottom")


@pytest.mark.parametrize("texts", [TEXTS, TEXTS + AGAIN])
@pytest.mark.parametrize(("gap", "gutter"), [(0.5, None), (0.5, -0.6), (1.0, None), (2.0, 0.0)])
def test_lines_of_texts(spark, texts, gap, gutter):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = lines.line_clusters(primitives.texts_of(docs), gap, gutter)
    want = lines.line_clusters(_rows(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(-1))), gap, gutter).withColumn("doc_id", F.nullif("doc_id", F.lit(-1)))
    assert _sorted(found) == _sorted(want.select(*found.columns)) and found.count() > 8


@pytest.mark.parametrize("texts", [TEXTS, TEXTS + AGAIN])
def test_health_of_texts(spark, texts):
    docs = spark.createDataFrame([t for t in texts if t[0] is not None], "doc_id long, text string")
    images = spark.createDataFrame([(1, 0, 0.0, 0.0, 40.0, 470.0), (2, 1, 0.0, 0.0, 10.0, 10.0), (2, 9, 0.0, 0.0, 10.0, 10.0), (None, 0, 0.0, 0.0, 1.0, 1.0)], "doc_id long, page_no int, x0 double, top double, x1 double, bottom double")
    rows, size = _rows(docs), {"width": F.lit(40.0), "height": F.lit(470.0)}
    found = health.page_health(None, primitives.texts_of(docs).withColumns(size), images)
    want = health.page_health(rows, rows.select("doc_id", "page_no").distinct().withColumns(size), images)
    assert _sorted(found) == _sorted(want.select(*found.columns))
    assert found.agg(F.sum("n_oob")).first()[0] > 90 and found.agg(F.sum("n_dup")).first()[0] == (6 if len(texts) > len(TEXTS) else 0)


@pytest.mark.parametrize(("gap", "gutter"), [(0.5, None), (0.1, 0.4), (0.0, 0.0)])
def test_lines_of_any_geometry(spark, gap, gutter):
    """Levels that overlap, ties and repeats: the numpy way against the rows'."""
    rnd = np.random.default_rng(4)
    n = 600
    page, ch, prim = np.sort(rnd.integers(0, 9, n)), rnd.integers(97, 100, n).astype(np.uint32), rnd.integers(0, 40, n)
    size, x0, top = rnd.integers(1, 4, n) * 2.0, rnd.integers(0, 12, n) * 1.5, rnd.integers(0, 30, n) * 0.75
    x1, bottom = x0 + rnd.integers(1, 4, n), top + size
    own = flat.Glyphs(page, ch, prim, size, x0, top, x1, bottom, np.arange(9), np.zeros(9, int))
    *found, text, = flat.line_runs(own, gap, gutter)
    found = sorted(zip(*[x.tolist() for x in found], flat.strings(text, found[2]).to_pylist(), strict=True))
    columns = [page.tolist(), [0] * n, prim.tolist(), [chr(c) for c in ch], *[x.tolist() for x in (size, x0, top, x1, bottom)]]
    rows = spark.createDataFrame(list(zip(*columns, strict=True)), "doc_id long, page_no int, prim_id long, ch string, size double, x0 double, top double, x1 double, bottom double")
    want = lines.line_clusters(rows, gap, gutter).select("doc_id", "line_no", "n_chars", "x0", "top", "x1", "bottom", "text")
    assert found == sorted(map(tuple, want.collect()))


def test_repeats_are_counted_to_epsilon():
    page, x0 = np.array([0, 0, 0, 1, 1]), np.array([-0.25, -0.5, 0.1, 3.0, 3.3])
    own = flat.Glyphs(page, np.array([65, 65, 65, 65, 65], np.uint32), *[np.zeros(5)] * 2, x0, *[np.zeros(5)] * 3, np.arange(2), np.zeros(2, int))
    assert flat.repeats(own, 0.5).tolist() == [1, 0] and flat.repeats(own, 1.0).tolist() == [1, 1]


def test_slices_of_a_batch():
    texts = pa.array([["skip"], None, ["a\nb", None, "c"], [], ["d" * 50]]).slice(1)
    found = [(g.row.tolist(), "".join(map(chr, g.ch)), g.page_no.tolist()) for g in flat.laid_out(texts, 6.0, 12.0, 1, 4)]
    assert found == [([1, 1], "acb", [0, 1]), ([3], "d" * 50, [0])]
    texts = pa.array([[t for _, t in TEXTS + AGAIN], *[[t] for _, t in TEXTS]])
    cut = lambda most: [(int(g.row[p]), int(g.page_no[p]), chr(c), x) for g in flat.laid_out(texts, 6.0, 12.0, 40, most) for p, c, x in zip(g.page, g.ch, g.x0.tolist(), strict=True)]
    assert cut(1) == cut(300) == cut(1 << 20) and len(cut(1)) > 2_000


@pytest.mark.parametrize("name", ["line_cluster", "page_profile"])
def test_no_glyph_is_an_object(spark, name):
    found = registry.QUERIES[name](spark, SF)
    assert "lambda" not in _plan(found) and "MapInArrow" in _plan(found) and same(found, registry.ORACLES[name], SF) > 0


def test_lines_of_texts_are_not_shuffled(spark):
    assert "Exchange" not in _plan(registry.QUERIES["line_cluster"](spark, SF))
