"""Character classes that a page's health and a paper's grammar rest on."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Markers of exam papers.
ANSWER_MARK = "【答案】|【解析】|^答案|^解析"
SECTION = r"^[一二三四五六七八九十]+、"
QUESTION = r"^([0-9]{1,3})[.．、](?:[^0-9]|$)"
SUBQUESTION = r"^[(（]([0-9]{1,2})[)）]"
OPTION = r"^([A-D])[.．、]"
SCORE = r"[(（]([0-9]+(?:\.[0-9]+)?) ?分[)）]"

FFFD, PRIVATE, CID = r"\x{FFFD}", r"[\x{E000}-\x{F8FF}]", r"\(cid:[0-9]+\)"


def count_of(text: Column, pattern: str) -> Column:
    """Matches of a pattern in a text as a bigint; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def token_kind(line: Column) -> Column:
    """section, question, subquestion, option or text, by the marker at the start of a line."""
    line = F.ltrim(line)
    return F.when(line.rlike(SECTION), "section").when(line.rlike(QUESTION), "question").when(line.rlike(SUBQUESTION), "subquestion").when(line.rlike(OPTION), "option").otherwise("text")


def token_label(line: Column) -> Column:
    """Number or letter of a line's marker; empty for text."""
    line = F.ltrim(line)
    return F.concat(F.regexp_extract(line, QUESTION, 1), F.regexp_extract(line, SUBQUESTION, 1), F.regexp_extract(line, OPTION, 1))


def token_number(line: Column) -> Column:
    """Number of a line's marker: Arabic, Chinese up to ninety-nine, or the place of an option's letter; null for text."""
    line = F.ltrim(line)
    numeral = F.regexp_extract(line, r"^([一二三四五六七八九十]+)、", 1)
    one = lambda c: F.instr(F.lit("一二三四五六七八九"), c)
    ones = F.regexp_extract(numeral, "([一二三四五六七八九])$", 1)
    chinese = F.when(numeral.contains("十"), F.when(numeral.startswith("十"), 1).otherwise(one(F.substr(numeral, F.lit(1), F.lit(1)))) * 10).otherwise(0) + F.when(ones != "", one(ones)).otherwise(0)
    letter = F.regexp_extract(line, OPTION, 1)
    number = F.concat(F.regexp_extract(line, QUESTION, 1), F.regexp_extract(line, SUBQUESTION, 1))
    return F.when(numeral != "", chinese).when(number != "", number.cast("int")).when(letter != "", F.ascii(letter) - 64).cast("int")


def score_of(line: Column) -> Column:
    """Points of a question written behind it, or null."""
    return F.nullif(F.regexp_extract(line, SCORE, 1), F.lit("")).cast("decimal(6,2)")
