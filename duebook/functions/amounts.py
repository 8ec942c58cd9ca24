"""Numbers and money.

The bodies of the rounding and conversion functions are not public, so their assumed
meaning is kept in this one file: scale 3, credit code ``H`` negative, and
``amount * rate * to_ratio / from_ratio``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CREDIT = "H"
WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"


def to_int(text: Column) -> Column:
    """Integer, or null where the text is none (ANSI casts would fail the job).

    The pattern goes first, as ``try_cast`` alone catches an exception for each bad value.
    """
    return F.when(text.rlike(WHOLE_NUMBER), text.try_cast("int"))


def zero_to_null(number: Column) -> Column:
    return F.nullif(number, F.lit(0))


def signed_amount(amount: Column, debit_credit: Column, scale: int = 3) -> Column:
    rounded = F.round(amount, scale)
    return F.when(debit_credit == CREDIT, -rounded).otherwise(rounded)


def currency_scale(decimals: Column) -> Column:
    """Factor that moves an amount stored with two decimals to the currency's own decimals."""
    return F.pow(F.lit(10), 2 - F.coalesce(decimals, F.lit(2)))


def convert_amount(amount: Column, rate: Column, from_ratio: Column, to_ratio: Column) -> Column:
    """Null when any part is missing, or the source ratio is zero."""
    as_double = [c.cast("double") for c in (amount, rate, to_ratio)]
    return as_double[0] * as_double[1] * as_double[2] / zero_to_null(from_ratio.cast("double"))
