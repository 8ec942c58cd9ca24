"""Aging buckets of receivables.

A disputed item (two-character reason code, not cleared) leaves the dunning run, so it
counts as neither current nor past due.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from duebook.functions import not_of_length

from duebook.schemas import ITEM_BUCKETS, MATERIAL_BUCKETS

STATUS = "accounting_document_item_clearing_status_name"
CLEARED_ON = "accounting_document_item_clearing_date"
REASON = "accounting_document_item_payment_reason_code"
DUE = "accounting_document_item_due_date"


def _amount_if(condition: Column, amount: Column) -> Column:
    return F.when(condition, amount).otherwise(0)


def aging_live(df: DataFrame, as_of: Column, amount: str, names: list[str] = ITEM_BUCKETS, *,
               status: str = STATUS, due: str = DUE, cleared_on: str = CLEARED_ON,
               reason: str = REASON) -> DataFrame:
    """Five buckets as the live report shows them.

    An open item without a due date or without a reason code is in no due bucket here;
    ``aging_as_of`` is the form whose parts always add up.
    """
    money = F.col(amount)
    is_open = F.col(status) == "OPEN"
    undisputed = not_of_length(F.col(reason), 2)
    values = [
        _amount_if(is_open, money),
        _amount_if(F.col(cleared_on).isNull() & (F.length(reason) == 2), money),
        _amount_if(is_open & (F.col(due) >= as_of) & undisputed, money),
        _amount_if(is_open & (F.col(due) < as_of) & undisputed, money),
        _amount_if(F.col(status) == "CLEARED", money),
    ]
    return df.withColumns(dict(zip(names, values)))


def aging_as_of(df: DataFrame, as_of: Column, amount: str, names: list[str] = MATERIAL_BUCKETS, *,
                status: str = STATUS, due: str = DUE, cleared_on: str = CLEARED_ON,
                reason: str = REASON, dispute: str = "disjoint") -> DataFrame:
    """Five buckets as of a date; open = current + past due + disputed by construction.

    With ``dispute="overlap"`` disputed is only a mark: disputed items stay in their due
    bucket and open = current + past due.
    """
    if dispute not in ("disjoint", "overlap"):
        raise ValueError(dispute)
    money = F.col(amount)
    is_open = F.col(status) == "OPEN"
    disputed = F.coalesce(F.col(cleared_on).isNull() & (F.length(reason) == 2), F.lit(False))
    current = F.coalesce(F.col(due) >= as_of, F.lit(False))
    if dispute == "disjoint":
        current = current & ~disputed
        past = ~disputed & ~current
    else:
        past = ~current
    values = [
        _amount_if(is_open, money),
        _amount_if(is_open & disputed, money),
        _amount_if(is_open & current, money),
        # written as a rest, a missing amount would be missing in one bucket only
        F.when(is_open & past, money).when(is_open, money - money).otherwise(0),
        _amount_if(F.col(status) == "CLEARED", money),
    ]
    return df.withColumns({n: v.cast("decimal(36,3)") for n, v in zip(names, values)})
