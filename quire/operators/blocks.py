"""S4: paragraphs, inline formulas, option grids, dropped answers, ordered blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quire.functions.text import ANSWER_MARK, OPTION, token_kind


def paragraphs(lines: DataFrame, gap: float = 0.6, indent: float = 12.0) -> DataFrame:
    """Lines -> lines with block_no: a paragraph starts after a wide gap, at an indent, or in another band.

    `lines` has band_no; the order is page, band, top, line number.
    """
    order = Window.partitionBy("doc_id").orderBy("page_no", "band_no", "top", "line_no")
    height = F.col("bottom") - F.col("top")
    before = lambda c: F.lag(c).over(order)
    moved = (F.col("page_no") != before("page_no")) | (F.col("band_no") != before("band_no"))
    starts = moved | (F.col("top") - before("bottom") > gap * height) | (F.col("x0") - before("x0") > indent)
    rows = lines.withColumn("starts", F.coalesce(starts.cast("int"), F.lit(1)))
    return rows.withColumn("block_no", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("starts")


def blocks(lines: DataFrame) -> DataFrame:
    """Lines with block_no -> blocks: doc_id, block_no, first page, text in reading order and number of lines."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "band_no", "top", "line_no", "text"))), lambda x: x["text"]), "\n")
    return lines.groupBy("doc_id", "block_no").agg(F.min("page_no").alias("page_no"), text.alias("text"), F.count("*").alias("n_lines"))


def without_answers(blocks: DataFrame) -> DataFrame:
    """Blocks with ignore_reason: `answer` from a marker of an answer or analysis up to the next question or section.

    Rows stay, so that the ledger still balances. The state is carried forward by last_value ignoring nulls.
    """
    order = Window.partitionBy("doc_id").orderBy("block_no").rowsBetween(Window.unboundedPreceding, 0)
    kind = token_kind(F.col("text"))
    turn = F.when(F.ltrim("text").rlike(ANSWER_MARK), "answer").when(kind.isin("question", "section"), "")
    return blocks.withColumn("ignore_reason", F.nullif(F.last(turn, ignorenulls=True).over(order), F.lit("")))


def inline(lines: DataFrame, formulas: DataFrame) -> DataFrame:
    """Text of each line with its formulas set in at their place, from left to right.

    `lines` are pieces (doc_id, page_no, line_no, x0, id, text), `formulas` (doc_id, page_no, line_no, x0, id, latex).
    """
    keys = ["doc_id", "page_no", "line_no", "x0", "id"]
    pieces = lines.select(*keys, F.lit(0).alias("kind"), "text").unionByName(formulas.select(*keys, F.lit(1).alias("kind"), F.concat(F.lit("$"), "latex", F.lit("$")).alias("text")))
    ordered = F.array_sort(F.collect_list(F.struct("x0", "kind", "id", "text")))
    return pieces.groupBy("doc_id", "page_no", "line_no").agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "").alias("text"))


def option_grid(lines: DataFrame) -> DataFrame:
    """Options A to D of each question: every marker inside a line opens a cell (doc_id, q_no, label, text).

    `lines` has doc_id, q_no, line_no, text; a line may hold one option or all of a row of the grid.
    """
    marks = F.regexp_extract_all("text", F.lit(r"(?:^|\s)([A-D])[.．、]"), F.lit(1))
    texts = F.slice(F.split("text", r"(?:^|\s)[A-D][.．、]"), F.lit(2), F.greatest(F.size(marks), F.lit(0)))
    rows = lines.filter(F.ltrim("text").rlike(OPTION)).withColumn("cell", F.explode(F.arrays_zip(marks.alias("label"), F.transform(texts, lambda t: F.trim(t)).alias("text"))))
    return rows.select("doc_id", "q_no", "line_no", F.col("cell.label").alias("label"), F.col("cell.text").alias("text"))
