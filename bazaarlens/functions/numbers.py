"""Ratio, rounding and threshold expressions that hold under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; null for a null side or a zero ``whole``."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def fixed_text(value: Column, digits: int) -> Column:
    """Text with ``digits`` decimals, half-even, with thousands commas."""
    return F.format_number(value, digits)


def threshold_text(total: Column, share: float) -> Column:
    """``share`` of a total, rounded half-even to a whole number, as text."""
    return fixed_text(total * F.lit(float(share)), 0)


def last_admitted_rank(
    total: Column, share: float, text_threshold: bool = False
) -> Column:
    """The last rank that is within :func:`threshold_text`, taken as the number it shows.

    ``text_threshold`` compares with the text itself, as it parses: one with a thousands
    comma does not, so a threshold from 1,000 up then admits no rank at all. No text is
    made here: ``rint`` rounds half-even as the text does.
    """
    whole = F.rint(total * F.lit(float(share)))
    admitted = F.when(F.abs(whole) < 1000, whole) if text_threshold else whole
    return admitted.try_cast("bigint")
