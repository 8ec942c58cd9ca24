"""Reading the two ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from duebook.schemas import LEDGER_COLUMNS


def scan(df: DataFrame, columns: list[str], where: Column | None = None) -> DataFrame:
    """Narrow scan; column list and filter reach the parquet reader."""
    return (df if where is None else df.where(where)).select(*columns)


def ledger_items(open_items: DataFrame, cleared_items: DataFrame) -> DataFrame:
    """Open and cleared items in one relation, told apart by ``item_status``."""
    tagged = [scan(df, LEDGER_COLUMNS).withColumn("item_status", F.lit(status))
              for df, status in ((open_items, "OPEN"), (cleared_items, "CLEARED"))]
    return tagged[0].unionByName(tagged[1])
