"""Text normalisation and null-tolerant text predicates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip_zeros(text: Column) -> Column:
    """Drop leading zeros; an all-zero code becomes the empty string."""
    return F.ltrim(text, F.lit("0"))


def strip_zeros_regex(text: Column) -> Column:
    return F.regexp_replace(text, "^0+", "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def not_blank(text: Column) -> Column:
    """True for text with a visible character, false for null."""
    return F.coalesce(F.trim(text) != "", F.lit(False))


def not_empty(text: Column) -> Column:
    return F.coalesce(text != "", F.lit(False))


def differs(text: Column, value: str) -> Column:
    """Inequality that counts null as the empty text."""
    return F.coalesce(text, F.lit("")) != value


def not_of_length(text: Column, n: int) -> Column:
    """Three-valued: null text gives null, so a filter drops it."""
    return ~(F.length(text) == n)
