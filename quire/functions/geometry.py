"""Scalar expressions over boxes (x0, top, x1, bottom; origin top left, y down, points)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def area(x0: Column, top: Column, x1: Column, bottom: Column) -> Column:
    return F.greatest(x1 - x0, F.lit(0.0)) * F.greatest(bottom - top, F.lit(0.0))


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Length that two intervals share."""
    return F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0.0))


def share(part: Column, whole: Column) -> Column:
    """part / whole, null where whole is 0 (ANSI mode raises on division by zero)."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def escaped(text: Column) -> Column:
    """HTML text: & < > \" become entities."""
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(mark), F.lit(entity))
    return text
