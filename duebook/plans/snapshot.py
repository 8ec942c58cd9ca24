"""The daily snapshot of the material fact: slices, retention, archive and the daily run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from duebook.operators.aging import CLEARED_ON, STATUS, aging_as_of
from duebook.operators.diff import CHANGED, keyed_diff
from duebook.operators.quality import RETENTION_DAYS, assert_healthy, run_checks, snapshot_prints
from duebook.schemas import (ITEM_BUCKETS, MATERIAL_BUCKETS, SNAPSHOT_COLUMNS, SNAPSHOT_KEY,
                             require_columns)
from duebook.sources import tables

from .sku import AMOUNT

DAY = "snapshot_date"
LAYOUT = ["company_code"]


def closed_once_slice(sku: DataFrame, as_of: dt.date, status: str = STATUS,
                      cleared_on: str = CLEARED_ON) -> DataFrame:
    """Every open row, and the rows cleared on this very day."""
    state = F.col(status)
    rows = sku.where((state == "OPEN")
                     | ((state == "CLEARED") & (F.col(cleared_on) == F.lit(as_of))))
    return rows.select(F.lit(as_of).alias(DAY), state.alias("snapshot_state"), *sku.columns)


LATE_KEY = [k for k in SNAPSHOT_KEY if k not in (DAY, "snapshot_state")]


def late_clearings(sku: DataFrame, newest: DataFrame, as_of: dt.date, lookback_days: int,
                   keys: Sequence[str] = LATE_KEY, status: str = STATUS,
                   cleared_on: str = CLEARED_ON) -> DataFrame:
    """Rows of the fact whose clearing became known too late for the slice of its day.

    These are cleared within ``lookback_days`` before ``as_of`` and still open in ``newest``,
    the newest slice: their state differs between the two.  In today's slice they are
    cleared, so the next run does not find them again.
    """
    state = F.col(status)
    cleared = sku.where((state == "CLEARED") & (F.col(cleared_on) < F.lit(as_of))
                        & (F.col(cleared_on) >= F.date_sub(F.lit(as_of), lookback_days)))
    was_open = newest.where("snapshot_state = 'OPEN'")
    changes = keyed_diff(was_open.select(*keys, F.lit("OPEN").alias("state")),
                         cleared.select(*keys, F.lit("CLEARED").alias("state")), keys, ["state"])
    late = changes.where(F.col("change") == CHANGED).select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return cleared.join(late, same, "left_semi")


def slice_with_late(sku: DataFrame, newest: DataFrame, as_of: dt.date, lookback_days: int,
                    keys: Sequence[str] = LATE_KEY, status: str = STATUS,
                    cleared_on: str = CLEARED_ON) -> DataFrame:
    """``closed_once_slice`` and the late clearings, each once, on the day they are found."""
    rows = closed_once_slice(sku, as_of, status, cleared_on)
    late = late_clearings(sku, newest, as_of, lookback_days, keys, status, cleared_on)
    return rows.unionByName(late.select(F.lit(as_of).alias(DAY), F.col(status).alias("snapshot_state"),
                                        *sku.columns))


def snapshot_slice(sku: DataFrame, as_of: dt.date, dispute: str = "disjoint",
                   newest: DataFrame | None = None, lookback_days: int = 0,
                   layout: Sequence[str] | None = None) -> DataFrame:
    """Today's rows with both sets of buckets as of today.

    With ``newest``, the newest slice before today, clearings of the last ``lookback_days``
    that it does not know yet are among them.  ``layout`` lays them out by day and these columns
    for a write; the buckets follow from a row and are not shuffled with it.
    """
    day = F.lit(as_of)
    rows = (closed_once_slice(sku, as_of) if newest is None or not lookback_days
            else slice_with_late(sku, newest, as_of, lookback_days))
    if layout is not None:
        rows = tables.clustered(rows, DAY, *layout)
    rows = aging_as_of(rows, day, AMOUNT, ITEM_BUCKETS, status="snapshot_state", dispute=dispute)
    rows = aging_as_of(rows, day, "material_actual_rate_functional_amount", MATERIAL_BUCKETS,
                       status="snapshot_state", dispute=dispute)
    return require_columns(rows, SNAPSHOT_COLUMNS).select(*SNAPSHOT_COLUMNS)


def retain(df: DataFrame, as_of: dt.date, days: int = RETENTION_DAYS, column: str = DAY) -> DataFrame:
    """Rows of the window before today."""
    day = F.col(column)
    return df.where((day >= F.date_sub(F.lit(as_of), days)) & (day < F.lit(as_of)))


def stale(df: DataFrame, as_of: dt.date, days: int = RETENTION_DAYS, column: str = DAY) -> DataFrame:
    """Rows older than the window, stamped with the day they leave."""
    return df.where(F.col(column) < F.date_sub(F.lit(as_of), days)).withColumn(
        "archived_on_date", F.lit(as_of))


def open_only(df: DataFrame) -> DataFrame:
    return df.where("snapshot_state = 'OPEN'")


def profile(df: DataFrame, column: str = DAY) -> DataFrame:
    """Size and date range of a batch, to look at before it is loaded."""
    day: Column = F.col(column)
    return df.agg(F.count("*").alias("rows"), F.min(day).alias("oldest"), F.max(day).alias("newest"))


@dataclass(frozen=True)
class SnapshotTables:
    """Names of the catalog tables of the daily run.

    ``prints`` keeps the fingerprints of the snapshot per date, so that the checks for repeated
    keys read 32 bytes a row and not the snapshot; ``journal`` the steps a day has finished.
    """

    hot: str
    archive: str
    open_only: str
    check_history: str | None = None
    prints: str | None = None
    journal: str | None = None


STEPS = ["archived", "appended", "retained", "open_only", "printed", "checked"]


def finished_steps(spark: SparkSession, journal: str | None, as_of: dt.date) -> set[str]:
    if journal is None or not spark.catalog.tableExists(journal):
        return set()
    return {r.step for r in spark.table(journal).where(F.col("run_date") == F.lit(as_of))
            .select("step").distinct().collect()}


def newest_slice(spark: SparkSession, table: str, as_of: dt.date, days: int) -> DataFrame | None:
    """The last slice before a day, if it is in the window of that day."""
    window = as_of - dt.timedelta(days)
    before = [d for d in tables.partition_dates(spark, table) if window <= d < as_of]
    return spark.table(table).where(F.col(DAY) == F.lit(before[-1])) if before else None


def daily_run(sku: DataFrame, names: SnapshotTables, as_of: dt.date, days: int = RETENTION_DAYS,
              force: bool = False, dispute: str = "disjoint", check: bool = True,
              archive_started: bool = False, lookback_days: int = 0, resume: bool = False) -> None:
    """Archive, append, retain, refresh the open-only table, keep fingerprints, check.

    Each step reads and writes only the partitions that change: the stale ones and today's.
    Nothing is dropped before what stands in its place is written: stale dates once they are
    archived, today's slice by the job that writes the new one.  Any step may be run again.  A
    day before the newest slice is refused, as it would take later slices away; ``force`` does so.

    ``lookback_days`` adds clearings that became known late.  With ``resume`` the steps that the
    journal has for this day are left out: a run that was stopped goes on after its last
    whole step, given the same fact.
    """
    spark = sku.sparkSession
    done = finished_steps(spark, names.journal, as_of) if resume else set()
    if names.journal and not resume:
        _forget(spark, names.journal, as_of)
    today = laid_out = None
    if not {"appended", "checked"} <= done:
        if not spark.catalog.tableExists(names.hot):
            tables.create(snapshot_slice(sku, as_of, dispute), names.hot, DAY)
        newest = newest_slice(spark, names.hot, as_of, days) if lookback_days else None
        late = late_clearings(sku, newest, as_of, lookback_days) if newest is not None else None
        today, laid_out = [snapshot_slice(sku, as_of, dispute, newest, lookback_days, layout)
                           for layout in (None, LAYOUT)]
        tables.create(today, names.open_only, DAY)
        tables.create(today.withColumn("archived_on_date", F.lit(as_of)), names.archive, DAY)
    present = tables.partition_dates(spark, names.hot)
    later = [d for d in present if d > as_of]
    if later and not force:
        raise ValueError(f"{names.hot} already has a slice of {later[-1]}, after {as_of}")
    old = [d for d in present if d < as_of - dt.timedelta(days)]

    def archive() -> None:
        if old:
            leaving = stale(spark.table(names.hot), as_of, days)
            tables.keyed_upsert(leaving, names.archive, SNAPSHOT_KEY, DAY, dates=old, cluster=None)
            # they are kept by now, so their old copies need not lie beside today's slice
            for table in (names.hot, names.open_only):
                tables.drop_partitions(spark, table, DAY, old)

    def append() -> None:
        tables.replace_partitions(laid_out, names.hot)
        if as_of in present and today.isEmpty():
            tables.drop_partitions(spark, names.hot, DAY, [as_of])

    def retire() -> None:
        tables.drop_partitions(spark, names.hot, DAY, [*old, *later])

    def refresh() -> None:
        kept = tables.partition_dates(spark, names.hot)
        in_open = tables.partition_dates(spark, names.open_only)
        wanted = [d for d in kept if d not in in_open or d == as_of]
        rows = open_only(spark.table(names.hot)).where(F.col(DAY).isin(wanted))
        if wanted:
            # read from files that are laid out already
            tables.replace_partitions(rows, names.open_only)
        filled = {r[0] for r in rows.select(DAY).distinct().collect()} if as_of in in_open else {as_of}
        tables.drop_partitions(spark, names.open_only, DAY, [
            d for d in in_open if d not in kept or (d == as_of and d not in filled)])

    def fingerprint() -> None:
        if names.prints:
            keep_prints(spark, names.hot, names.prints, as_of)

    def checked() -> None:
        if not check:
            return
        kept = spark.table(names.prints) if names.prints else None
        checks = run_checks(spark.table(names.hot), sku, spark.table(names.open_only),
                            spark.table(names.archive), as_of, days, archive_started, dispute, kept, late)
        if names.check_history:
            tables.create(checks, names.check_history, "run_date")
            found = spark.createDataFrame(checks.collect(), checks.schema)     # nine rows at most
            tables.replace_partitions(found, names.check_history)
            if found.isEmpty():
                tables.drop_partitions(spark, names.check_history, "run_date", [as_of])
            checks = found
        assert_healthy(checks)

    for step, run in zip(STEPS, (archive, append, retire, refresh, fingerprint, checked)):
        if step not in done:
            run()
            if names.journal:
                _record(spark, names.journal, as_of, step)


def keep_prints(spark: SparkSession, hot: str, prints: str, as_of: dt.date) -> None:
    """Bring the kept fingerprints in line with the dates of a snapshot: add, renew today, drop."""
    rows = snapshot_prints(spark.table(hot))
    tables.create(rows, prints, DAY)
    kept, known = tables.partition_dates(spark, hot), tables.partition_dates(spark, prints)
    wanted = [d for d in kept if d not in known or d == as_of]
    if wanted:
        tables.replace_partitions(rows.where(F.col(DAY).isin(wanted)), prints)
    tables.drop_partitions(spark, prints, DAY, [d for d in known if d not in kept])


def _record(spark: SparkSession, journal: str, as_of: dt.date, step: str) -> None:
    row = spark.createDataFrame([(step, as_of)], "step string, run_date date")
    tables.create(row, journal, "run_date")
    row.coalesce(1).write.insertInto(journal)


def _forget(spark: SparkSession, journal: str, as_of: dt.date) -> None:
    if spark.catalog.tableExists(journal):
        tables.drop_partitions(spark, journal, "run_date", [as_of])


def backfill(sku_of, names: SnapshotTables, dates: Iterable[dt.date], **options) -> None:
    """``daily_run`` over dates in order; ``sku_of(date)`` gives the material fact of a day.

    With ``resume=True`` and a journal, days that were checked are left out and the day on which
    a run was stopped goes on where it was.
    """
    for day in sorted(dates):
        if options.get("resume") and names.journal:
            spark = SparkSession.active()
            if STEPS[-1] in finished_steps(spark, names.journal, day):
                continue
        daily_run(sku_of(day), names, day, **options)
