"""Stand-ins for exam papers, made from the driver's tables: they hold no PDF, glyph or exam numbering of their own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quire.operators.primitives import LEADING, PAGE_LINES, STEP, by_page, glyph_pages, glyphs, texts_of
from quire.session import table

WIDTH, HEIGHT = 612.0, PAGE_LINES * LEADING


def chars(spark: SparkSession, sf: str) -> DataFrame:
    """Glyphs of all documents in a fixed grid; prim_id is the column, unique within a line."""
    rows = glyphs(table(spark, sf, "documents"))
    return rows.withColumn("prim_id", F.col("line_no").cast("long") * 1_000_000 + F.col("col")).withColumn("size", F.lit(LEADING))


def pages(spark: SparkSession, sf: str, keep: Callable[[dict[str, Column]], list[Column]]) -> DataFrame:
    """The same glyphs page by page, with the fields that `keep` makes, and the page's size. Documents that share a doc_id share its pages, so they meet by page first."""
    docs = table(spark, sf, "documents")
    if docs.groupBy("doc_id").count().filter("count > 1").isEmpty():
        found = glyph_pages(docs, keep)
    else:
        rows = glyphs(docs)
        found = by_page(rows.select("doc_id", "page_no", *keep({c: F.col(c) for c in rows.columns})))
    return found.withColumns({"width": F.lit(WIDTH), "height": F.lit(HEIGHT)})


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """The same glyphs as texts that are laid out where they are read, and the page's size."""
    return texts_of(table(spark, sf, "documents")).withColumns({"width": F.lit(WIDTH), "height": F.lit(HEIGHT)})


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of all documents that are not empty, as boxes on pages; leading spaces indent them."""
    rows = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "text")).filter("text <> ''")
    top = (F.col("at") % PAGE_LINES) * LEADING
    return rows.select(
        "doc_id", F.floor(F.col("at") / PAGE_LINES).alias("page_no"), F.lit(1).alias("band_no"), F.col("at").cast("long").alias("line_no"),
        ((F.length("text") - F.length(F.ltrim("text"))) * STEP).alias("x0"), top.alias("top"), (F.length("text") * STEP).alias("x1"), (top + LEADING).alias("bottom"), "text",
    )


def page_sizes(lines: DataFrame) -> DataFrame:
    return lines.select("doc_id", "page_no").distinct().withColumns({"width": F.lit(WIDTH), "height": F.lit(HEIGHT)})


def rules(spark: SparkSession, sf: str) -> DataFrame:
    """An order is a table with a row for each line number and three columns; returned or filled items lack an inner rule. Rules come by table."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus").repartition("l_orderkey")
    items = items.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("flag"), F.max("l_linestatus").alias("status"))
    own = items.groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").cast("double").alias("n"), "flag", "status")).alias("items"))
    made = lambda kind, x0, top, x1, bottom: F.struct(F.lit(kind).alias("orientation"), x0.alias("x0"), top.alias("top"), x1.alias("x1"), bottom.alias("bottom"))
    v = lambda i, x, show: F.when(show, made("vertical", F.lit(x), i["n"] * 10, F.lit(x), i["n"] * 10 + 10))
    h = lambda at: made("horizontal", F.lit(0.0), at, F.lit(30.0), at)
    true = F.lit(True)
    each = lambda i: F.array(v(i, 0.0, true), v(i, 10.0, i["flag"] != "R"), v(i, 20.0, i["status"] != "F"), v(i, 30.0, true), h(i["n"] * 10), h(i["n"] * 10 + 10))
    made_of = F.filter(F.flatten(F.transform("items", each)), lambda r: r.isNotNull())
    return own.select(F.col("l_orderkey").alias("doc_id"), F.lit(0).alias("page_no"), F.lit(0).alias("table_id"), made_of.alias("rules"))


def questions(spark: SparkSession, sf: str) -> DataFrame:
    """A user turn is a question of its conversation; the turns up to the next one answer it."""
    rows = carried(spark, sf).filter("q_no > 0")
    stem = F.max(F.when(F.col("role") == "user", F.col("text")))
    return rows.groupBy(F.col("conv_id").alias("doc_id"), "q_no").agg(stem.alias("stem"), F.count_if(F.col("role") == "assistant").alias("n_answers"))


def carried(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns with the number of the question they belong to."""
    from pyspark.sql import Window

    order = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf, "conversations").withColumn("q_no", F.sum((F.col("role") == "user").cast("int")).over(order))
