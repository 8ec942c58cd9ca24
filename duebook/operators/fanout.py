"""Inner join of two large sides that may both repeat a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .lookups import SPREAD
from .skew import HOT_ROWS, Hot, key_hash, require_comparable

CELLS = 4096   # parts a whole table would be cut into

_GRID = T.StructType([T.StructField("__hot", T.LongType()), T.StructField("__lp", T.IntegerType()),
                      T.StructField("__rp", T.IntegerType())])


def _parts(hot: Hot, key: int, least: int) -> int:
    per_part = max(hot.rows / CELLS, least)
    return max(1, -(-hot.counts.get(key, 0) // int(per_part)))


def hot_grid(df: DataFrame, left: Hot, right: Hot, least: int = HOT_ROWS) -> DataFrame | None:
    """Parts of the left and right rows of each key that is hot on either side.

    A fixed list of at most twice ``HOT_KEYS`` rows, so both sides of the join see the same.
    """
    rows = [(k, _parts(left, k, least), _parts(right, k, least))
            for k in sorted({*left.counts, *right.counts})]
    return df.sparkSession.createDataFrame(rows, _GRID) if rows else None


def _with_parts(df: DataFrame, keys: Sequence[str], grid: DataFrame) -> DataFrame:
    joined = df.join(F.broadcast(grid), key_hash(df, keys) == F.col("__hot"), "left").drop("__hot")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(1)) for c in ("__lp", "__rp")})


def _spread(df: DataFrame, parts, ids: Sequence[str] | None = None) -> Column:
    """A part of a row, that follows from the row alone."""
    spot = F.xxhash64(*(ids or [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]))
    return F.pmod(spot, parts).cast("int")


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def _place(df: DataFrame, keys: Sequence[str], grid: DataFrame, own: str, other: str,
           ids: Sequence[str] | None = None) -> DataFrame:
    """Put each row in one part of its own side and copy it to every part of the other.

    Rows without a key meet nothing, so they may lie in any part.
    """
    every = F.sequence(F.lit(0), F.col(f"__{other}p") - 1)
    part = F.when(_has_key(keys), _spread(df, F.col(f"__{own}p"), ids)).otherwise(
        _spread(df, F.lit(SPREAD), ids))
    return (_with_parts(df, keys, grid).withColumn(f"__{own}", part)
            .withColumn(f"__{other}", F.explode(every)).drop("__lp", "__rp"))


def _everywhere(df: DataFrame, keys: Sequence[str], grid: DataFrame) -> DataFrame:
    df = _with_parts(df, keys, grid)
    for side in "lr":
        every = F.sequence(F.lit(0), F.col(f"__{side}p") - 1)
        df = df.withColumn(f"__{side}", F.explode(every))
    return df.drop("__lp", "__rp")


def _unmatched_once(joined: DataFrame, right: DataFrame, keys: Sequence[str], grid: DataFrame) -> DataFrame:
    """Of a left row's copies without a partner keep the first, if the key has no right row at all.

    Only keys of the grid have several copies, so the right side is asked for those alone: a
    list no longer than the grid.
    """
    there = (right.where(_has_key(keys)).select(*keys, key_hash(right, keys).alias("__hot"))
             .join(F.broadcast(grid.select("__hot")), "__hot", "left_semi").drop("__hot").distinct())
    there = there.withColumnsRenamed({k: f"__t_{k}" for k in keys}).withColumn("__there", F.lit(True))
    match = reduce(Column.__and__, [F.col(k) == F.col(f"__t_{k}") for k in keys])
    joined = joined.join(F.broadcast(there), match, "left").drop(*[f"__t_{k}" for k in keys])
    first = (F.col("__r") == 0) & F.col("__there").isNull()
    return joined.where(F.col("__met").isNotNull() | first).drop("__there")


def fan_out(left: DataFrame, right: DataFrame, keys: Sequence[str], grid: DataFrame | None = None,
            per_key: Sequence[DataFrame] = (), keep_unmatched: bool = False,
            ids: Sequence[str] | None = None) -> DataFrame:
    """All pairs with equal keys; unmatched left rows too with ``keep_unmatched``.

    ``grid`` (from ``hot_grid``) cuts a heavy key into left parts by right parts, so neither
    side's rows of it meet in one task.  ``per_key`` tables hold at most one row per key and
    are joined on the same shuffle.  The left side is read once in every mode; its rows
    without a key are spread over all tasks.  ``ids`` are left columns that tell rows apart, by
    default all: rows are dealt by them, so that columns nobody reads need not be shuffled.
    """
    keys = list(keys)
    if not keep_unmatched:
        left = left.where(_has_key(keys))
    if grid is not None:
        for side in (right, *per_key):
            require_comparable(left, side, keys)
        cells = [*keys, "__l", "__r"]
        tables = [_place(left, keys, grid, "l", "r", ids), _place(right, keys, grid, "r", "l"),
                  *[_everywhere(t, keys, grid) for t in per_key]]
    elif keep_unmatched:
        # the right side is all part 0, in a form that is not folded into a condition on the left
        cells, zero = [*keys, "__l"], F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
        tables = [left.withColumn("__l", F.when(_has_key(keys), 0).otherwise(_spread(left, F.lit(SPREAD), ids) + 1)),
                  *[t.withColumn("__l", zero) for t in (right, *per_key)]]
    else:
        cells, tables = keys, [left, right, *per_key]
    if keep_unmatched and grid is not None:
        tables[1] = tables[1].withColumn("__met", F.lit(True))
    result = tables[0].join(tables[1], cells, "left" if keep_unmatched else "inner")
    for table in tables[2:]:
        result = result.join(table, cells, "left")
    if keep_unmatched and grid is not None:
        result = _unmatched_once(result, right, keys, grid)
    return result.drop("__l", "__r", "__met")
