import datetime as dt
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from duebook.operators import quality
from duebook.plans import snapshot
from duebook.schemas import SKU_COLUMNS, SNAPSHOT_COLUMNS
from duebook.session import shared_folder
from duebook.sources import tables
from tests.helpers import day, rows

START = day("2001-03-01")


@pytest.fixture
def db(spark):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}'")
    return name


def sku(spark, items):
    """Material rows from (document, clearing date or None, amount)."""
    known = {
        "company_code": F.lit("0001"), "accounting_document_id": F.col("doc"),
        "accounting_document_item_clearing_date": F.col("cleared"),
        "accounting_document_item_clearing_status_name":
            F.when(F.col("cleared").isNull(), "OPEN").otherwise("CLEARED"),
        "accounting_document_item_due_date": F.lit(START),
        "accounting_document_item_payment_reason_code": F.lit(""),
        "accounting_document_breakdown_item_id": F.lit(None).cast("int"),
        "accounting_document_item_actual_rate_functional_amount": F.col("amount").cast("double"),
        "material_actual_rate_functional_amount": F.col("amount"),
        "material_open_functional_amount":
            F.when(F.col("cleared").isNull(), F.col("amount")).otherwise(0).cast("decimal(36,3)"),
        "billing_document_id": F.col("doc"), "billing_document_item_id": F.lit("1"),
        "material_number": F.lit("M"),
    }
    df = spark.createDataFrame([(d, c, Decimal(a)) for d, c, a in items],
                               "doc string, cleared date, amount decimal(36,3)")
    return df.select(*[known.get(c, F.lit(None).cast("string")).alias(c) for c in SKU_COLUMNS])


def test_upsert_is_idempotent_with_null_keys(spark, db):
    batch = spark.createDataFrame([("a", None, 1, START), ("b", 1, 2, START)],
                                  "doc string, part int, v int, d date")
    for _ in range(2):
        tables.keyed_upsert(batch, f"{db}.t", ["doc", "part", "d"], "d")
    changed = batch.where("doc = 'a'").withColumn("v", F.lit(9))
    other = batch.withColumn("d", F.date_add("d", 1))
    tables.keyed_upsert(changed.unionByName(other), f"{db}.t", ["doc", "part", "d"], "d")
    assert rows(spark.table(f"{db}.t").select("doc", "v", F.col("d").cast("string"))) == [
        ("a", 1, "2001-03-02"), ("a", 9, "2001-03-01"), ("b", 2, "2001-03-01"), ("b", 2, "2001-03-02")]


def test_full_load_may_read_what_it_replaces(spark, db):
    tables.full_load(spark.range(10), f"{db}.t")
    tables.full_load(spark.table(f"{db}.t").where("id < 3"), f"{db}.t")
    assert spark.table(f"{db}.t").count() == 3


def test_a_week_of_runs(spark, db):
    names = snapshot.SnapshotTables(f"{db}.hot", f"{db}.archive", f"{db}.open_only", f"{db}.checks")
    window, last = 2, 4

    def state(today):
        """b clears on day 1; c clears on day 2 but is only known to be cleared on day 3."""
        on = [START + dt.timedelta(n) for n in range(last + 1)]
        return sku(spark, [("a", None, "10"), ("b", on[1] if today >= on[1] else None, "20"),
                           ("c", on[2] if today >= on[3] else None, "30")])

    days = [START + dt.timedelta(n) for n in range(last + 1)]
    for today in days:
        snapshot.daily_run(state(today), names, today, days=window, archive_started=True)
    hot, archive = spark.table(names.hot), spark.table(names.archive)
    assert hot.select(SNAPSHOT_COLUMNS).columns == SNAPSHOT_COLUMNS
    seen = hot.select("snapshot_date", "accounting_document_id", "snapshot_state").unionByName(
        archive.select("snapshot_date", "accounting_document_id", "snapshot_state"))
    n = {d: i for i, d in enumerate(days)}
    found = sorted((n[r[0]], r[1], r[2]) for r in seen.collect())
    assert found == sorted([(i, "a", "OPEN") for i in range(5)]
                           + [(0, "b", "OPEN"), (1, "b", "CLEARED")]
                           + [(i, "c", "OPEN") for i in range(3)])
    assert sorted(n[d] for d in tables.partition_dates(spark, names.hot)) == [2, 3, 4]
    assert sorted(n[d] for d in tables.partition_dates(spark, names.archive)) == [0, 1]
    assert {r[0] for r in archive.select("archived_on_date").distinct().collect()} == {days[3], days[4]}
    assert spark.table(names.open_only).count() == hot.where("snapshot_state = 'OPEN'").count()

    before = rows(hot.select("snapshot_date", "accounting_document_id"))
    snapshot.daily_run(state(days[-1]), names, days[-1], days=window, archive_started=True)
    assert rows(spark.table(names.hot).select("snapshot_date", "accounting_document_id")) == before
    with pytest.raises(ValueError):
        snapshot.daily_run(state(days[1]), names, days[1], days=window)


def test_a_bad_load_stops_the_run(spark, db):
    names = snapshot.SnapshotTables(f"{db}.hot", f"{db}.archive", f"{db}.open_only")
    twice = sku(spark, [("a", None, "10"), ("a", None, "10")])
    with pytest.raises(quality.DataQualityError, match="DQ-05"):
        snapshot.daily_run(twice, names, START)


def test_archive_check_and_its_guard(spark):
    as_of = START + dt.timedelta(60)
    hot = snapshot.snapshot_slice(sku(spark, [("a", None, "1")]), START)
    archive = hot.withColumn("archived_on_date", F.lit(as_of)).limit(0)
    assert quality.archive_inflow(hot, archive, as_of).count() == 1
    assert quality.archive_inflow(hot, archive, as_of, archive_started=True).count() == 0
    assert quality.archive_inflow(hot, archive, as_of - dt.timedelta(1)).count() == 0


def test_healthy_snapshot_gives_no_rows(spark):
    facts = sku(spark, [("a", None, "1"), ("b", START, "2")])
    hot = snapshot.snapshot_slice(facts, START)
    archive = hot.withColumn("archived_on_date", F.lit(START)).limit(0)
    checks = quality.run_checks(hot, facts, snapshot.open_only(hot), archive, START)
    assert checks.schema.fieldNames() == quality.CHECK_SCHEMA.fieldNames()
    assert checks.count() == 0


def test_slice_is_read_with_a_pruned_partition(spark, db):
    facts = sku(spark, [("a", None, "1")])
    hot = snapshot.snapshot_slice(facts, START)
    tables.create(hot, f"{db}.hot", "snapshot_date")
    tables.replace_partitions(hot, f"{db}.hot")
    kept = snapshot.retain(spark.table(f"{db}.hot"), START + dt.timedelta(1))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_full_load_recovers_after_a_stop(spark, db):
    table = f"{db}.loaded"
    tables.full_load(spark.range(3), table)
    # stopped after the old table was set aside
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__old")
    spark.range(9).write.saveAsTable(f"{table}__next")
    tables.recover(spark, table)
    assert spark.table(table).count() == 3
    tables.full_load(spark.table(table).where("id > 0"), table)
    assert spark.table(table).count() == 2
    assert not spark.catalog.tableExists(f"{table}__old")
    # stopped in a first load
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__next")
    tables.full_load(spark.range(1), table)
    assert spark.table(table).count() == 1


def test_upsert_refuses_repeated_keys_and_takes_null_dates(spark, db):
    table = f"{db}.upserted"
    batch = spark.sql("select 1 k, date'2001-01-01' d, 'a' v union all select 2, null, 'b'")
    tables.keyed_upsert(batch, table, ["k", "d"], "d")
    tables.keyed_upsert(batch.withColumn("v", F.lit("c")), table, ["k", "d"], "d")
    assert sorted((r.k, r.v) for r in spark.table(table).collect()) == [(1, "c"), (2, "c")]
    with pytest.raises(ValueError, match="more than once"):
        tables.keyed_upsert(batch.union(batch), table, ["k", "d"], "d")


class Stopped(Exception):
    pass


def test_full_load_never_leaves_the_table_absent(spark, db, monkeypatch):
    """Stopped after each of its steps, there are the old rows or the new ones."""
    table = f"{db}.pointed"
    tables.full_load(spark.range(3), table)
    sql, parquet = type(spark).sql, type(spark.range(1).write).parquet

    def stop(*_, **__):
        raise Stopped

    def after(step):
        def run(*args, **kwargs):
            step(*args, **kwargs)
            raise Stopped
        return run
    steps = [(type(spark.range(1).write), "parquet", stop, 3), (type(spark.range(1).write), "parquet", after(parquet), 3),
             (type(spark.catalog), "refreshTable", stop, 7), (tables, "_file_system", None, 7)]
    for owner, name, new, expected in steps:
        if new is not None:
            with monkeypatch.context() as m:
                m.setattr(owner, name, new)
                with pytest.raises(Stopped):
                    tables.full_load(spark.range(7), table)
        assert spark.table(table).count() == expected, name
    for n in range(4):
        tables.full_load(spark.table(table).union(spark.range(1)), table)
        assert spark.table(table).count() == 8 + n
        assert len(tables.versions(spark, table)) <= tables.VERSIONS
    assert sql is type(spark).sql
    # other columns: by renames
    tables.full_load(spark.range(2).selectExpr("id", "'x' text"), table)
    assert spark.table(table).columns == ["id", "text"]


def test_a_run_goes_on_after_its_last_whole_step(spark, db, monkeypatch):
    """Stopped after each step in turn and resumed, three days end as if undisturbed."""
    days = [START + dt.timedelta(n) for n in range(4)]

    def state(today):
        return sku(spark, [("a", None, "10"), ("b", days[1] if today >= days[1] else None, "20")])

    def names(tag):
        return snapshot.SnapshotTables(*[f"{db}.{tag}_{t}" for t in (
            "hot", "archive", "open_only", "checks", "prints", "journal")])

    def content(n):
        return [rows(spark.table(t).select(*[F.col(c).cast("string") for c in sorted(spark.table(t).columns)]))
                for t in (n.hot, n.archive, n.open_only, n.prints)]
    plain = names("plain")
    snapshot.backfill(state, plain, days, days=1, archive_started=True)
    stopped, record = names("stopped"), snapshot._record
    for at, step in enumerate(snapshot.STEPS):
        def stop(spark_, journal, as_of, done, step=step, day=days[1 + at % 3]):
            record(spark_, journal, as_of, done)
            if (done, as_of) == (step, day):
                raise Stopped
        monkeypatch.setattr(snapshot, "_record", stop)
        if at == 0:
            with pytest.raises(Stopped):
                snapshot.backfill(state, stopped, days, days=1, archive_started=True)
        elif step not in snapshot.finished_steps(spark, stopped.journal, days[1 + at % 3]):
            with pytest.raises(Stopped):
                snapshot.backfill(state, stopped, days, days=1, archive_started=True, resume=True)
    monkeypatch.setattr(snapshot, "_record", record)
    snapshot.backfill(state, stopped, days, days=1, archive_started=True, resume=True)
    assert content(stopped) == content(plain)
    assert snapshot.finished_steps(spark, stopped.journal, days[-1]) == {*snapshot.STEPS}


def test_late_clearings_are_found_once_and_the_checks_know(spark, db):
    names = snapshot.SnapshotTables(f"{db}.l_hot", f"{db}.l_archive", f"{db}.l_open", prints=f"{db}.l_prints")
    days = [START + dt.timedelta(n) for n in range(5)]
    for n, today in enumerate(days):
        known = [("a", None, "10"), ("b", days[1] if n >= 3 else None, "20"), ("c", days[2] if n >= 2 else None, "30")]
        snapshot.daily_run(sku(spark, known), names, today, archive_started=True, lookback_days=3)
    cleared = spark.table(names.hot).where("snapshot_state = 'CLEARED'")
    assert rows(cleared.select("accounting_document_id", F.col("snapshot_date").cast("string"))) == [
        ("b", "2001-03-04"), ("c", "2001-03-03")]
    # kept fingerprints: a day adds its own
    assert spark.table(names.prints).count() == spark.table(names.hot).count()
    again = cleared.withColumn("snapshot_date", F.lit(days[4]))
    tables.replace_partitions(spark.table(names.hot).where(F.col("snapshot_date") == F.lit(days[4]))
                              .unionByName(again), names.hot)
    snapshot.keep_prints(spark, names.hot, names.prints, days[4])
    found = quality.closed_once(spark.table(names.hot), days[4], spark.table(names.prints)).collect()
    assert [(r.check_id, r.violation_count) for r in found] == [("DQ-04", 2)]


def test_a_rerun_without_rows_leaves_no_slice(spark, db):
    names = snapshot.SnapshotTables(f"{db}.e_hot", f"{db}.e_archive", f"{db}.e_open")
    facts = sku(spark, [("a", None, "10")])
    snapshot.daily_run(facts, names, START)
    snapshot.daily_run(facts.limit(0), names, START, check=False)
    assert spark.table(names.hot).count() == spark.table(names.open_only).count() == 0


def test_upsert_with_given_dates_refuses_repeated_keys_too(spark, db):
    batch = spark.sql("select 1 k, date'2001-01-01' d, 'a' v")
    with pytest.raises(ValueError, match="more than once"):
        tables.keyed_upsert(batch.union(batch), f"{db}.dated", ["k", "d"], "d", dates=[day("2001-01-01")])


def test_a_curve_skips_files_for_either_column(spark, tmp_path):
    """Files whose statistics admit a filter, against a layout by the first column alone."""
    import pyarrow.parquet as pq
    rows_ = spark.range(40_000).selectExpr("date'2001-01-01' d", "cast(id * 7919 % 97 as int) company",
                                           "lpad(cast(id * 104729 % 9973 as string), 6, '0') account", "id")
    rows_ = rows_.unionByName(spark.sql("select date'2001-01-01' d, cast(null as int) company, 'x' account, -1L id"))
    tables.clustered_on_curve(rows_, "d", ["company", "account"], files=16).write.parquet(str(tmp_path / "curve"))
    rows_.repartitionByRange(16, "d", "company").sortWithinPartitions("d", "company").write.parquet(
        str(tmp_path / "plain"))

    def admitted(layout, column, value):
        files = [pq.ParquetFile(f).metadata for f in sorted((tmp_path / layout).glob("*.parquet"))]
        at = [m.row_group(0).column(n) for m in files for n in range(m.num_columns)
              if m.row_group(0).column(n).path_in_schema == column]
        return sum(c.statistics.min <= value <= c.statistics.max for c in at), len(files)
    for company in (3, 50, 90):
        found, total = admitted("curve", "company", company)
        assert total == 16 and found <= total / 2
    for account in ("000100", "005000", "009000"):
        found, total = admitted("curve", "account", account)
        assert found <= 0.7 * total < admitted("plain", "account", account)[0]
    assert rows(spark.read.parquet(str(tmp_path / "curve")).select("id")) == rows(rows_.select("id"))
