"""Lookups that leave the row count of the left side alone.

A ledger column is rarely spread evenly: most items may lack a reference, and a third of
the rest may share one.  ``lookup_join`` therefore never sends the rows of a missing key,
nor those of a hot key, to one task.  No size hint is given anywhere: Spark broadcasts a
lookup table when its size is below ``spark.sql.autoBroadcastJoinThreshold`` and joins by
shuffle otherwise.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .skew import Hot, key_hash, require_comparable

SPREAD = 1 << 20   # buckets for rows that match nothing


def top1(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key.

    Spark turns the filter on ``row_number`` into a limit per group on both sides of the
    shuffle, so that a hot key sends one row per task and not all of its rows.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).where("__place = 1").drop("__place")


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str], *,
                within: str | None = None, hot: Hot | None = None,
                spread: bool = True, ids: Sequence[str] | None = None) -> DataFrame:
    """Left join with a table that holds at most one match per left row.

    The caller sees to that (``top1``, ``group_totals``): a repeated right key repeats left
    rows, as in any join, whether it is hot or not.

    ``on`` are columns of both sides.  ``within`` is a further condition, such as a range,
    as SQL text; it may name left columns and the right ones that are not in ``on``.

    Rows whose key is in ``hot`` look their match up in a broadcast copy of just those keys'
    rows (at most one per hot key, or one per hot key and date under ``within``) and take no
    part in the shuffle; keys that the right side repeats stay in it.  ``spread=False`` says that no left key is null.  ``ids`` are left
    columns that tell rows apart, by default all; rows without a partner are dealt by them.
    """
    on, payload = list(on), [c for c in right.columns if c not in on]
    usable = " and ".join(f"`{c}` is not null" for c in on)
    if hot:
        left = _with_hot_matches(left, right, on, payload, within, hot)
        usable = f"{usable} and not __hot"
    if hot or spread:
        # A row without a partner goes to a bucket taken from its own hash: equal null keys
        # would all meet in one task.  The bucket follows from the row alone, so filters still
        # reach the scan and a repeated task deals its rows alike.  The right side is all
        # bucket 0, in a form that constant folding does not turn into a condition on the
        # left side alone.
        some = ids or [f.name for f in left.schema if f.name not in on and f.name != "__few"
                       and f.dataType.typeName() not in ("map", "variant")]
        own = f"pmod(xxhash64({_names(some or on)}), {SPREAD}) + 1"
        left = left.withColumn("__bucket", F.expr(f"case when {usable} then 0 else {own} end"))
        right = right.withColumn("__bucket", F.expr(f"pmod(xxhash64({_names(on)}), 1)"))
        on = [*on, "__bucket"]
    if hot:
        right = right.withColumnsRenamed({c: f"__cold_{c}" for c in payload})
        within = within and _renamed(within, {c: f"__cold_{c}" for c in payload})
    if within is None:
        joined = left.join(right, on, "left")
    else:
        right = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
        match = " and ".join(f"`{c}` = `__r_{c}`" for c in on)
        joined = left.join(right, F.expr(f"{match} and ({within})"), "left").drop(
            *[f"__r_{c}" for c in on])
    if hot:
        joined = joined.withColumns({
            c: F.expr(f"case when __hot then __few.`{c}` else `__cold_{c}` end")
            for c in payload}).drop("__hot", "__few", *[f"__cold_{c}" for c in payload])
    return joined.drop("__bucket")


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _renamed(condition: str, names: dict[str, str]) -> str:
    return re.sub(r"\w+", lambda word: names.get(word.group(), word.group()), condition)


def _with_hot_matches(left: DataFrame, right: DataFrame, on: list[str], payload: list[str],
                      within: str | None, hot: Hot) -> DataFrame:
    """Mark the rows of hot keys and join them to those keys' rows, as one struct.

    Without ``within`` the broadcast holds one row per hot key, and a key with several right
    rows is not taken as hot; with it, one per hot key and date.
    """
    require_comparable(left, right, on)
    listed = [F.lit(n) for n in hot.counts]
    few = right.where(key_hash(right, on).isin(*listed))
    if within is None:
        few = few.groupBy(*on).agg(F.count("*").alias("__times"),
                                   *[F.any_value(c).alias(c) for c in payload])
    few = few.withColumnsRenamed({c: f"__f_{c}" for c in few.columns})
    match = " and ".join(f"`{c}` = `__f_{c}`" for c in on)
    if within is not None:
        match += f" and ({_renamed(within, {c: f'__f_{c}' for c in payload})})"
    struct = "named_struct(" + ", ".join(f"'{c}', `__f_{c}`" for c in payload) + ")"
    present = F.expr(" and ".join(f"`{c}` is not null" for c in on))
    is_hot = present & key_hash(left, on).isin(*listed)
    joined = left.withColumn("__hot", is_hot).join(F.broadcast(few), F.expr(match), "left")
    if within is None:
        joined = joined.withColumn("__hot", F.col("__hot") & (F.coalesce("__f___times", F.lit(1)) == 1))
    return joined.withColumn("__few", F.expr(struct)).drop(*few.columns)


def intervals(df: DataFrame, keys: Sequence[str], start: str, until: str) -> DataFrame:
    """Give each row of a change list the start of its successor: ``[start, until)``.

    Rows are made unique by key and start first, so a group is no longer than the number
    of different dates.
    """
    others = [F.col(c) for c in df.columns if c not in keys and c != start]
    unique = top1(df.where(F.col(start).isNotNull()), [*keys, start], others or [F.lit(1)])
    return unique.withColumn(
        until, F.lead(start).over(Window.partitionBy(*keys).orderBy(start)))


def as_of_join(left: DataFrame, changes: DataFrame, on: Sequence[str], at: str, start: str,
               hot: Hot | None = None) -> DataFrame:
    """Latest change of the key at or before ``at``; one output row per left row."""
    spans = intervals(changes, on, start, "__until")
    within = f"{start} <= {at} and (__until is null or {at} < __until)"
    return lookup_join(left, spans, on, within=within, hot=hot).drop("__until")


def validity_join(left: DataFrame, right: DataFrame, on: Sequence[str], at: str, start: str, end: str,
                  first: dt.date, last: dt.date, width: int = 64, hot: Hot | None = None,
                  ids: Sequence[str] | None = None) -> DataFrame:
    """Left join with the row whose interval ``[start, end]`` holds the left row's own date ``at``.

    Dates are cut into bins of ``width`` days.  An interval is listed in each bin it touches between
    ``first`` and ``last``, the dates that the left side can have, so the lists are no longer
    than that time has bins; the left side is looked up by key and bin, once, and the exact test
    runs over the few intervals of the bin.  Of overlapping ones the latest start wins, of
    these the smallest other columns.  Null dates and those outside match nothing; an interval
    without an end is open, one without a start matches nothing.
    """
    payload = [c for c in right.columns if c not in (*on, start, end)]
    bins = [F.floor(F.unix_date(c) / width).cast("int") for c in (
        F.greatest(F.col(start), F.lit(first)), F.least(F.coalesce(end, F.lit(last)), F.lit(last)))]
    rows = right.where(F.col(start).isNotNull() & (F.col(start) <= F.lit(last))
                       & (F.coalesce(end, F.lit(last)) >= F.greatest(F.col(start), F.lit(first))))
    # latest start first, so that the first interval that holds the date is the one
    entry = F.struct((-F.unix_date(start)).alias("order"), *[F.col(c) for c in payload],
                     F.col(start).alias("start"), F.col(end).alias("end"))
    listed = (rows.withColumn("__bin", F.explode(F.sequence(*bins))).groupBy(*on, "__bin")
              .agg(F.sort_array(F.collect_list(entry)).alias("__listed")))
    date = F.col(at)
    inside = date.between(F.lit(first), F.lit(last))
    left = left.withColumn("__bin", F.when(inside, F.floor(F.unix_date(date) / width).cast("int")))
    joined = lookup_join(left, listed, [*on, "__bin"], hot=hot, ids=ids)
    found = F.get(F.filter("__listed", lambda e: (e["start"] <= date) & (
        e["end"].isNull() | (date <= e["end"]))), F.lit(0))
    joined = joined.withColumn("__found", found)
    return joined.withColumns({c: F.col(f"__found.{c}") for c in payload}).drop("__bin", "__listed", "__found")


def valid_on(df: DataFrame, day: Column, valid_from: str, valid_to: str) -> DataFrame:
    """Rows of a dimension that are in force on one day, both ends included."""
    return df.where(day.between(F.col(valid_from), F.col(valid_to)))


def tiered_lookup(left: DataFrame, tiers: Sequence[tuple[str, DataFrame, Sequence[str]]],
                  value: str, label: str, unresolved: str,
                  hot: Sequence[Hot | None] | None = None) -> DataFrame:
    """First value found over several lookup tables, with the name of the tier that had it.

    A tier is ``(name, table, keys)``; the table holds the keys, one row each, and ``value``.
    A guard is put into the key: null it where the tier must not be asked.
    """
    hot = hot or [None] * len(tiers)
    found = []
    for n, (_, table, keys) in enumerate(tiers):
        found.append(f"__tier_{n}")
        table = table.select(*keys, F.col(value).alias(found[n]))
        left = lookup_join(left, table, keys, hot=hot[n])
    which = F.coalesce(*[F.when(F.col(c).isNotNull(), name)
                         for c, (name, _, _) in zip(found, tiers)], F.lit(unresolved))
    return (left.withColumn(value, F.coalesce(*found)).withColumn(label, which)
            .drop(*found))
