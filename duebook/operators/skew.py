"""Finding keys that hold so many rows that their join must be split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

HOT_KEYS = 256           # most keys reported per column set
HOT_SHARE = 1 / 512      # a key is hot from this share of the rows on ...
HOT_ROWS = 100_000       # ... and from this many rows


# Types whose values Spark compares with each other, and the one they are hashed as.
_FAMILIES = (
    ((T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType), "number", "decimal(38,18)"),
    ((T.FloatType, T.DoubleType), "real", "double"),
    ((T.StringType,), "text", "string"),
    ((T.DateType, T.TimestampType), "time", "timestamp"),
    ((T.BooleanType,), "flag", "boolean"),
    ((T.BinaryType,), "bytes", "binary"))


def _family(df: DataFrame, column: str) -> tuple[str, str]:
    kind = df.schema[column].dataType
    for types, name, common in _FAMILIES:
        if isinstance(kind, types):
            return name, common
    raise TypeError(f"no hot keys over {column}: {kind.simpleString()}")


def key_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """Hash of a key that is the same for equal values of any comparable types.

    A number is hashed as a double as well, by which those too large for the common type are told.
    """
    parts = []
    for c in columns:
        name, common = _family(df, c)
        parts.append(F.col(f"`{c}`").try_cast(common))
        if name == "number":
            parts.append(F.col(f"`{c}`").cast("double"))
    return F.xxhash64(*parts)


def require_comparable(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> None:
    """Fail where equal keys of the two sides might not have equal hashes."""
    for c in columns:
        if _family(left, c)[0] != _family(right, c)[0]:
            raise TypeError(f"{c} is {left.schema[c].dataType.simpleString()} on one side and "
                            f"{right.schema[c].dataType.simpleString()} on the other: cast it before")


@dataclass(frozen=True)
class Hot:
    """Hot keys of one column set: hash of the key -> rows, and the rows of the table."""

    rows: int
    counts: dict[int, int]

    def __bool__(self) -> bool:
        return bool(self.counts)


def hot_keys(df: DataFrame, columns: dict[str, Sequence[str]],
             hot_rows: int = HOT_ROWS) -> dict[str, Hot]:
    """Hot keys of several column sets of a table, in one pass over those columns.

    Starts a job, but brings back at most ``HOT_KEYS`` numbers per set: each task keeps a
    frequent-items sketch and the sketches are merged, no key is shuffled.  The answer only
    steers how a join runs; joins give the same rows for any set of hot keys.
    """
    parts = []
    for name, cols in columns.items():
        some_null = F.exists(F.array(*[F.col(c).isNull() for c in cols]), lambda x: x)
        key = F.when(~some_null, key_hash(df, cols))
        parts += [key.alias(name)]
    hashed = df.select(*parts)
    row = hashed.agg(F.count(F.lit(1)).alias("rows"), *[
        F.expr(f"approx_top_k({name}, {HOT_KEYS}, {64 * HOT_KEYS})").alias(name)
        for name in columns]).first()
    least = max(row["rows"] * HOT_SHARE, hot_rows)
    return {name: Hot(row["rows"], {i["item"]: i["count"] for i in row[name] or []
                                    if i["item"] is not None and i["count"] >= least})
            for name in columns}
