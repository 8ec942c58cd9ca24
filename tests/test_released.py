"""Steps are stored and give back their shuffles, so that the disk holds those of one step at a time."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from duebook import session
from duebook.plans import delta, invoice, sku, snapshot
from duebook.sources import tables
from tests.conftest import DATA
from tests.test_invoice import exchanges, sources, without_broadcast  # noqa: F401
from workload import snapshots
from workload.frames import AS_OF, Frames
from workload.receivables import material_fact
from workload.registry import database


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def released(spark, before):
    """Whether no shuffle file is there that was not before; they are removed in the background."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.2)
    return False


@pytest.mark.parametrize("write", ["stored", "full_load", "replace_partitions"])
def test_writes_give_back_their_shuffles(spark, write):
    name = database(spark)
    rows = spark.range(5000).repartition(7, "id").select("id", F.lit(dt.date(2024, 1, 1)).alias("day"))
    if write == "replace_partitions":
        tables.create(rows, f"{name}.t", "day")
    before = shuffle_files(spark)
    if write == "stored":
        found, = session.stored(t=rows)
    else:
        getattr(tables, write)(rows, f"{name}.t")
        found = spark.table(f"{name}.t")
    assert released(spark, before)
    assert found.count() == 5000
    files = [f for f in found.inputFiles()]
    assert files and all(f"{session.CODEC}." in os.path.basename(f) for f in files)


def test_the_setting_is_put_back(spark):
    def now():
        return spark.conf.get(session._CLEANUP)
    was = now()
    with session.released_shuffles(spark):
        with session.released_shuffles(spark):
            assert now() == "true"
        assert now() == "true"
    assert now() == was


def test_passing_steps_are_removed_and_results_stay(spark):
    with session.passing_steps(spark):
        with session.passing_steps(spark) as kept:
            step, = session.stored(step=spark.range(3))
            result, = kept(result=step.where("id > 0"))
        with pytest.raises(Exception):
            spark.read.parquet(os.path.dirname(step.inputFiles()[0]))
        assert [r.id for r in result.collect()] == [1, 2]
        folder = os.path.dirname(result.inputFiles()[0])
    with pytest.raises(Exception):
        spark.read.parquet(folder)


@pytest.mark.parametrize("hot_rows", [None, 20])
def test_the_fact_reads_what_the_large_tables_said(sources, hot_rows):  # noqa: F811
    """Flow and billing lines come from the order lines; these are read before, for the stored steps."""
    fact = invoice.invoice_fact(sources, AS_OF, hot_rows=hot_rows)
    assert not [file for file in fact.inputFiles() if "lineitem" in file]


def test_the_ledger_is_shuffled_once_where_the_other_tables_are_small(spark, sources, without_broadcast):  # noqa: F811
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    fact = invoice.invoice_columns(invoice.invoice_base(sources, AS_OF), sources["security_tags"])
    assert len(exchanges(fact._jdf.queryExecution().executedPlan(), "saknr")) == 1


def test_lines_meet_their_documents_in_a_step_of_their_own(spark, sources, without_broadcast):  # noqa: F811
    f = Frames(spark, DATA)
    facts, = session.stored(facts=invoice.invoice_fact(sources, AS_OF, split_hot_keys=False))
    rows = sku.sku_fact(facts, f["billing_lines"], f["materials_current"], AS_OF, split_hot_keys=False)
    plan = rows._jdf.queryExecution().executedPlan()
    assert len(exchanges(plan, "material_quantity")) == 1
    assert not [file for file in rows.inputFiles() if "part.parquet" in file]


def test_the_material_fact_reads_stored_items(spark, without_broadcast):  # noqa: F811
    plan = material_fact(Frames(spark, DATA))._jdf.queryExecution().executedPlan()
    assert len(exchanges(plan, "accounting_document_type_code")) == 1
    assert not exchanges(plan, "blart")


def laid_out(node):
    """Columns of the rows that a plan rebalances for a write."""
    if node.getClass().getSimpleName() == "RebalancePartitions":
        return [node.output().apply(i).name() for i in range(node.output().size())]
    parts = [laid_out(node.children().apply(i)) for i in range(node.children().size())]
    return [name for part in parts for name in part]


def test_a_slice_is_laid_out_without_its_buckets(spark):
    facts, = session.stored(facts=material_fact(Frames(spark, DATA)))
    rows = snapshot.snapshot_slice(facts, AS_OF, layout=snapshot.LAYOUT)
    moved = laid_out(rows._jdf.queryExecution().optimizedPlan())
    assert "company_code" in moved
    assert not {*moved} & {*snapshot.ITEM_BUCKETS, *snapshot.MATERIAL_BUCKETS}
    plain = snapshot.snapshot_slice(facts, AS_OF)
    assert rows.columns == plain.columns
    assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()


def test_daily_runs_keep_the_fact_and_not_what_led_to_it(spark, monkeypatch):
    folders, real = [], session.shared_folder
    monkeypatch.setattr(session, "shared_folder", lambda s: folders.append(real(s)) or folders[-1])
    snapshots.run_days(Frames(spark, DATA), [])
    left = [name for x in folders if os.path.isdir(x) for name in os.listdir(x)]
    assert folders and not {"lines", "facts", "resolved", "centers"} & {*left}


def test_the_delta_is_stored_before_it_is_merged(sources):  # noqa: F811
    one = sources["open_items"].orderBy("belnr").limit(1)
    fact, = session.stored(fact=invoice.invoice_fact(sources, AS_OF, split_hot_keys=False))
    found, _ = delta.delta_fact(sources, {"open_items": one}, fact, AS_OF)
    assert found.count() and all("/rows/" in file for file in found.inputFiles())
