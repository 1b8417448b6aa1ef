"""Characters that come page by page: the same results as from rows, and nothing shuffled."""

from pyspark.sql import Window, functions as F

from quire.operators import health, lines, primitives

TEXTS = [(1, "ab  cd\n\nef"), (2, "\n".join(f"line {i} x" for i in range(85))), (3, "\n\n"), (4, None), (5, "aé文 b")]


def _both(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    prim = lambda g: [(g["line_no"].cast("long") * 1000 + g["col"]).alias("prim_id"), g["ch"].alias("ch"), F.lit(12.0).alias("size"), F.lit("f").alias("fontname"), F.lit(True).alias("has_unicode_map"), *[g[c].alias(c) for c in ("x0", "top", "x1", "bottom")]]
    rows = primitives.glyphs(docs)
    return rows.select("doc_id", "page_no", *prim({c: F.col(c) for c in rows.columns})), primitives.glyph_pages(docs, prim)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_lines_of_pages(spark):
    rows, pages = _both(spark)
    found = lines.line_clusters(pages)
    assert "Exchange" not in _plan(found)
    assert _sorted(found) == _sorted(lines.line_clusters(rows)) and found.count() == 88


def test_bands_of_pages(spark):
    rows, pages = _both(spark)
    wide = lambda df, name: df.withColumn(name, F.transform("glyphs", lambda c: F.struct(F.when(c["ch"] != " ", c["x0"]).alias("x0"), (c["x1"] + 8).alias("x1"))))
    found = lines.bands(wide(pages, "glyphs"))
    assert "Exchange" not in _plan(found)
    assert _sorted(found) == _sorted(lines.bands(rows.filter("ch <> ' '").withColumn("x1", F.col("x1") + 8)))


def test_health_of_pages(spark):
    rows, pages = _both(spark)
    none = spark.createDataFrame([], "doc_id long, page_no int, x0 double, top double, x1 double, bottom double")
    twice = pages.withColumns({"glyphs": F.concat("glyphs", F.slice("glyphs", 1, 1)), "width": F.lit(40.0), "height": F.lit(480.0)})
    first = rows.filter("x0 = 0").withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "page_no").orderBy("top"))).filter("n = 1").drop("n")
    sizes = rows.select("doc_id", "page_no").distinct().withColumns({"width": F.lit(40.0), "height": F.lit(480.0)})
    found = health.page_health(None, twice, none)
    want = health.page_health(rows.unionByName(first), sizes, none)
    assert _sorted(found) == _sorted(want.select(*found.columns))
    assert {r.n_dup for r in found.collect()} == {1}
