"""S9: deterministic HTML of questions, and the overlay of boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quire.functions.geometry import escaped


def question_html(questions: DataFrame) -> DataFrame:
    """doc_id, q_no, html: stem, options and a visible mark where a question is uncertain. Formulas between $ become spans."""
    stem = F.regexp_replace(escaped(F.col("stem")), r"\$([^$]+)\$", '<span class="math" data-latex="$1"></span>')
    options = F.array_join(F.transform(F.coalesce("options", F.array().cast("array<struct<label:string,text:string>>")), lambda o: F.concat(F.lit('<li data-label="'), escaped(o["label"]), F.lit('">'), escaped(o["text"]), F.lit("</li>"))), "")
    mark = F.when(F.col("uncertain"), F.concat(F.lit('<mark class="uncertain">'), escaped(F.coalesce("uncertain_reason", F.lit(""))), F.lit("</mark>"))).otherwise("")
    html = F.concat(F.lit('<section id="q'), F.col("q_no").cast("string"), F.lit('"><p>'), stem, F.lit("</p>"), F.when(options != "", F.concat(F.lit("<ol>"), options, F.lit("</ol>"))).otherwise(""), mark, F.lit("</section>"))
    return questions.select("doc_id", "q_no", html.alias("html"))


def document_html(sections: DataFrame) -> DataFrame:
    """One HTML string for each document, sections by number."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("q_no", "html"))), lambda s: s["html"]), "\n")
    return sections.groupBy("doc_id").agg(F.concat(F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"></head><body>\n'), body, F.lit("\n</body></html>")).alias("html"))


def embedded(stream: Column, kind: str = "image/png") -> Column:
    """Data URL of an image's native stream; its pixels are not touched."""
    return F.concat(F.lit(f"data:{kind};base64,"), F.base64(stream))


def overlay(boxes: DataFrame, pages: DataFrame) -> DataFrame:
    """An SVG of each page with the boxes (doc_id, page_no, node_id, box, uncertain) over it, by node."""
    page = ["doc_id", "page_no"]
    rect = F.format_string('<rect x="%.1f" y="%.1f" width="%.1f" height="%.1f" class="%s"/>', "x0", "top", F.col("x1") - F.col("x0"), F.col("bottom") - F.col("top"), F.when(F.col("uncertain"), "uncertain").otherwise("sure"))
    rows = boxes.withColumn("rect", rect).groupBy(*page).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node_id", "rect"))), lambda r: r["rect"]), "").alias("rects"))
    return rows.join(pages, page).select(*page, F.concat(F.format_string('<svg viewBox="0 0 %.1f %.1f">', "width", "height"), "rects", F.lit("</svg>")).alias("svg"))
