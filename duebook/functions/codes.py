"""Company codes and security keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The sold-off company and the one that carries its customers.
MERGED_COMPANY = "0048"
PARENT_COMPANY = "1082"


def map_company(code: Column) -> Column:
    return F.when(code == MERGED_COMPANY, PARENT_COMPANY).otherwise(code)


def flow_company(code: Column) -> Column:
    """Company under which the order of an item was booked."""
    return F.when(code == PARENT_COMPANY, MERGED_COMPANY).otherwise(code)


def security_key(*ids: Column) -> Column:
    """One text key per set of owning units: distinct, sorted, missing ones as 0."""
    units = F.array(*[F.coalesce(i.cast("long"), F.lit(0).cast("long")) for i in ids])
    return F.concat_ws("-", F.sort_array(F.array_distinct(units)).cast("array<string>"))
