"""Registry of the queries and of the SQL that gives the same rows in DuckDB."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from duebook.session import shared_folder

from .frames import RAW, Frames, duckdb_with

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types that read the same in both engines: text for dates, double for money."""
    def convert(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return column.cast("long").alias(field.name)
        return column
    return df.select(*[convert(f) for f in df.schema.fields])


def query(key: str, *frames: str, sql: str | None = None):
    """Register a function of ``Frames``; ``sql`` reads the tables named in ``frames``."""
    def register(fn: Callable[[Frames], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, folder: plain(fn(Frames(spark, folder)))
        if sql is not None:
            derived = [n for n in frames if n not in RAW]
            text = sql.strip()
            if derived:
                head = duckdb_with(*derived)
                # the query may go on with tables of its own
                text = (f"{head},\n{text[5:]}" if text.lower().startswith("with ")
                        else f"{head}\n{text}")
            ORACLES[key] = text
        return fn
    return register


def database(spark: SparkSession) -> str:
    """A new catalog database in the shared folder."""
    name = f"duebook_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}'")
    return name
