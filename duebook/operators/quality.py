"""Nine checks of a snapshot load.  A check gives a row only when it fails.

Seven of them compare counts and sums.  Their numbers come from one aggregate over the
union of the tables, so each table is read once and one row is shuffled per task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from duebook.schemas import CHECK_SCHEMA, SNAPSHOT_KEY

from .aging import CLEARED_ON, STATUS
from .fingerprints import PRINT, fingerprint, repeated

TOLERANCE = 0.01
RETENTION_DAYS = 60
DOCUMENT_ID = "accounting_document_id"

# Check ids and names.
NAMES = {
    "DQ-01": "l1_row_count_mismatch",
    "DQ-02": "l1_open_sum_mismatch",
    "DQ-03": "bucket_partition_violation",
    "DQ-04": "closed_once_violation",
    "DQ-05": "grain_uniqueness_violation",
    "DQ-06": "l2_l1_open_mismatch",
    "DQ-07": "retention_violation",
    "DQ-08": "archive_no_inflow_today",
    "DQ-09": "todays_load_missing",
}
SEVERITY = "BLOCKING"


class DataQualityError(RuntimeError):
    """A load failed its checks; the message lists them."""


def bucket_gap(dispute: str = "disjoint") -> Column:
    """How far the open amount of a row is from the sum of its buckets."""
    names = ["current_due", "past_due"] + (["disputed"] if dispute == "disjoint" else [])
    parts = [F.col(f"material_{name}_functional_amount") for name in names]
    return F.abs(F.col("material_open_functional_amount") - sum(parts[1:], parts[0]))


def facts(as_of: dt.date, snapshot: DataFrame, sku: DataFrame | None = None,
          open_only: DataFrame | None = None, archive: DataFrame | None = None,
          days: int = RETENTION_DAYS, dispute: str = "disjoint",
          late: DataFrame | None = None) -> DataFrame:
    """The numbers of the checks, as one row; ``late`` are late clearings that today's slice has.

    Of the snapshot's past only date and state are read; amounts and ids of today's
    partition alone.
    """
    amount = "material_open_functional_amount"
    nothing = F.lit(None)

    def rows(df: DataFrame, table: str, day, state=nothing, money=nothing, gap=nothing,
             document=nothing, material=nothing) -> DataFrame:
        return df.select(
            F.lit(table).alias("table"), day.cast("date").alias("day"),
            state.cast("string").alias("state"), money.cast("decimal(36,3)").alias("money"),
            gap.alias("gap"), document.cast("string").alias("document"),
            material.cast("string").alias("material"))

    gap = bucket_gap(dispute)
    no_gap = F.lit(None).cast(snapshot.select(gap.alias("gap")).schema["gap"].dataType)
    day, state = F.col("snapshot_date"), F.col("snapshot_state")
    parts = [rows(snapshot, "snapshot", day, state, gap=no_gap),
             rows(snapshot.where(day == F.lit(as_of)), "today", day, state, F.col(amount), gap,
                  F.col(DOCUMENT_ID), F.col("material_number"))]
    if sku is not None:
        parts.append(rows(sku, "sku", F.col(CLEARED_ON), F.col(STATUS), F.col(amount), no_gap))
    if late is not None:
        parts.append(rows(late, "late", F.col(CLEARED_ON), F.col(STATUS), gap=no_gap))
    if open_only is not None:
        parts.append(rows(open_only, "open", nothing, gap=no_gap))
    if archive is not None:
        parts.append(rows(archive, "archive", F.col("archived_on_date"), gap=no_gap))

    def count(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("money"))), F.lit(0))

    hot, fresh, mart = [F.col("table") == name for name in ("snapshot", "today", "sku")]
    is_open, today = F.col("state") == "OPEN", F.col("day") == F.lit(as_of)
    stale = hot & (F.col("day") < F.lit(as_of - dt.timedelta(days)))
    uneven = fresh & is_open & (F.col("gap") > TOLERANCE)
    return reduce(DataFrame.unionByName, parts).agg(
        count(fresh).alias("today_rows"),
        total(fresh & is_open).alias("today_open"),
        count(hot & is_open).alias("open_rows"),
        F.min(F.when(hot, F.col("day"))).alias("oldest"),
        count(stale).alias("stale_rows"),
        count(uneven).alias("uneven_rows"),
        F.min(F.when(uneven, F.col("document"))).alias("uneven_document"),
        F.min(F.when(uneven, F.col("material"))).alias("uneven_material"),
        F.max(F.when(uneven, F.col("gap"))).alias("uneven_gap"),
        (count(mart & is_open) + count(mart & (F.col("state") == "CLEARED") & today)
         + count(F.col("table") == "late")).alias("expected_rows"),
        total(mart & is_open).alias("sku_open"),
        count(F.col("table") == "open").alias("open_only_rows"),
        count((F.col("table") == "archive") & today).alias("archived_today"),
        count(F.col("table") == "archive").alias("archived_rows"))


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _result(check: str, as_of: dt.date, violations: Column, detail: Column) -> list[Column]:
    values = [F.lit(check), F.lit(NAMES[check]), F.lit(SEVERITY), F.lit(as_of), violations, detail]
    return [v.cast(f.dataType).alias(f.name) for v, f in zip(values, CHECK_SCHEMA)]


def fact_checks(numbers: DataFrame, checks: Sequence[str], as_of: dt.date,
                days: int = RETENTION_DAYS, archive_started: bool = False) -> DataFrame:
    """Failed checks among ``checks``, from the row of ``facts``.

    DQ-08 also fires on the first day a slice reaches the bound, when nothing is stale yet;
    ``archive_started`` keeps it quiet until the archive has rows.
    """
    c = F.col
    bound = as_of - dt.timedelta(days)
    at_bound = (c("oldest") == F.lit(bound)) & (c("archived_today") == 0)
    if archive_started:
        at_bound = at_bound & (c("archived_rows") > 0)
    one = F.lit(1)
    rules = {
        "DQ-01": (c("today_rows") != c("expected_rows"),
                  F.abs(c("today_rows") - c("expected_rows")),
                  _text("l1_today_count=", c("today_rows"), ", expected=", c("expected_rows"))),
        "DQ-02": (F.abs(c("today_open") - c("sku_open")) > TOLERANCE, one,
                  _text("l1_sum=", c("today_open"), ", sku_sum=", c("sku_open"), ", diff=",
                        c("today_open") - c("sku_open"))),
        "DQ-03": (c("uneven_rows") > 0, c("uneven_rows"),
                  _text("sample_ad_id=", c("uneven_document"), ", sample_mat=",
                        c("uneven_material"), ", max_abs_diff=", c("uneven_gap"))),
        "DQ-06": (c("open_rows") != c("open_only_rows"),
                  F.abs(c("open_rows") - c("open_only_rows")),
                  _text("l1_open=", c("open_rows"), ", l2=", c("open_only_rows"))),
        "DQ-07": (c("stale_rows") > 0, c("stale_rows"),
                  _text("oldest_snapshot_date=", c("oldest"), ", retention_boundary=", F.lit(bound))),
        "DQ-08": (at_bound, one,
                  _text("archive_rows_archived_today=", c("archived_today"),
                        ", l1_min_snapshot_date=", c("oldest"))),
        "DQ-09": (c("today_rows") == 0, one, _text("today_count=", c("today_rows"))),
    }
    failed = [F.when(rules[check][0], F.struct(*_result(check, as_of, *rules[check][1:])))
              for check in checks]
    return numbers.select(F.explode(F.array_compact(F.array(*failed))).alias("r")).select("r.*")


def row_count(snapshot: DataFrame, sku: DataFrame, as_of: dt.date) -> DataFrame:
    """DQ-01: today's slice has every open row and every row cleared today."""
    return fact_checks(facts(as_of, snapshot, sku), ["DQ-01"], as_of)


def open_sum(snapshot: DataFrame, sku: DataFrame, as_of: dt.date) -> DataFrame:
    """DQ-02: today's open sum is that of the material fact."""
    return fact_checks(facts(as_of, snapshot, sku), ["DQ-02"], as_of)


def bucket_sums(snapshot: DataFrame, as_of: dt.date) -> DataFrame:
    """DQ-03: the buckets of each of today's open rows add up."""
    return fact_checks(facts(as_of, snapshot), ["DQ-03"], as_of)


CLOSED_KEY = [k for k in SNAPSHOT_KEY if k not in ("snapshot_date", "snapshot_state")]


def snapshot_prints(snapshot: DataFrame) -> DataFrame:
    """Fingerprints of the rows of a snapshot, to be kept per date: of the grain, and of the key
    that a cleared item may have once only."""
    cleared = F.col("snapshot_state") == "CLEARED"
    return snapshot.select(
        "snapshot_date", *fingerprint(SNAPSHOT_KEY),
        *[F.when(cleared, c).alias(f"closed_{name}")
          for name, c in zip(PRINT, fingerprint(CLOSED_KEY))])


def _closed_prints(kept: DataFrame) -> DataFrame:
    rows = kept.where(F.col(f"closed_{PRINT[0]}").isNotNull())
    return rows.select(*[F.col(f"closed_{name}").alias(name) for name in PRINT])


def closed_once(snapshot: DataFrame, as_of: dt.date, kept: DataFrame | None = None) -> DataFrame:
    """DQ-04: a cleared item is in one slice only.

    ``kept`` are the ``snapshot_prints`` of the same rows; without them they are computed.
    """
    copies = repeated(snapshot.where("snapshot_state = 'CLEARED'"), CLOSED_KEY,
                      None if kept is None else _closed_prints(kept))
    return _repeat_check("DQ-04", copies, as_of, [
        ("sample_ad_id=", F.min(DOCUMENT_ID)), (", sample_mat=", F.min("material_number")),
        (", max_dups=", F.max("copies"))])


def unique_grain(snapshot: DataFrame, as_of: dt.date, kept: DataFrame | None = None) -> DataFrame:
    """DQ-05: no key is in the snapshot twice."""
    return _repeat_check("DQ-05", repeated(snapshot, SNAPSHOT_KEY, kept), as_of, [
        ("sample_snap_date=", F.min("snapshot_date")), (", sample_ad_id=", F.min(DOCUMENT_ID)),
        (", max_dups=", F.max("copies"))])


def _repeat_check(check: str, repeated: DataFrame, as_of: dt.date,
                  detail: list[tuple[str, Column]]) -> DataFrame:
    text = [piece for label, value in detail for piece in (label, value)]
    found = repeated.agg(F.count("*").alias("n"), _text(*text).alias("detail")).where("n > 0")
    return found.select(*_result(check, as_of, F.col("n"), F.col("detail")))


def open_only_count(snapshot: DataFrame, open_only: DataFrame, as_of: dt.date) -> DataFrame:
    """DQ-06: the open-only table has every open row."""
    return fact_checks(facts(as_of, snapshot, open_only=open_only), ["DQ-06"], as_of)


def retention(snapshot: DataFrame, as_of: dt.date, days: int = RETENTION_DAYS) -> DataFrame:
    """DQ-07: no slice is older than the window."""
    return fact_checks(facts(as_of, snapshot, days=days), ["DQ-07"], as_of, days)


def archive_inflow(snapshot: DataFrame, archive: DataFrame, as_of: dt.date,
                   days: int = RETENTION_DAYS, archive_started: bool = False) -> DataFrame:
    """DQ-08: once the window rolls, the archive receives rows."""
    return fact_checks(facts(as_of, snapshot, archive=archive, days=days), ["DQ-08"], as_of, days,
                       archive_started)


def freshness(snapshot: DataFrame, as_of: dt.date) -> DataFrame:
    """DQ-09: today's slice is there."""
    return fact_checks(facts(as_of, snapshot), ["DQ-09"], as_of)


def run_checks(snapshot: DataFrame, sku: DataFrame, open_only: DataFrame, archive: DataFrame,
               as_of: dt.date, days: int = RETENTION_DAYS, archive_started: bool = False,
               dispute: str = "disjoint", kept: DataFrame | None = None,
               late: DataFrame | None = None) -> DataFrame:
    """All nine; empty when the load is healthy.

    ``kept`` are the fingerprints of the snapshot, ``late`` the late clearings of today's slice.
    """
    numbers = facts(as_of, snapshot, sku, open_only, archive, days, dispute, late)
    counted = [c for c in NAMES if c not in ("DQ-04", "DQ-05")]
    return reduce(DataFrame.unionByName, [
        fact_checks(numbers, counted, as_of, days, archive_started),
        closed_once(snapshot, as_of, kept), unique_grain(snapshot, as_of, kept)])


def slice_bucket_check(rows: DataFrame) -> DataFrame:
    """Count of open rows whose buckets do not add up, before a slice is loaded."""
    bad = (F.col("snapshot_state") == "OPEN") & (bucket_gap() > TOLERANCE)
    return rows.where(bad).agg(F.count("*").alias("bucket_violations"))


def assert_healthy(checks: DataFrame) -> None:
    """Fail the run when any check gave a row; there are nine at most."""
    failed = checks.orderBy("check_id").collect()
    if failed:
        raise DataQualityError("; ".join(
            f"{r.check_id} {r.check_name}: {r.violation_count} ({r.sample_detail})"
            for r in failed))
