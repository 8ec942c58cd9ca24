"""Each registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from duebook.operators import quality
from duebook.schemas import ARCHIVE_COLUMNS, INVOICE_COLUMNS, SKU_COLUMNS, SNAPSHOT_COLUMNS
from tests.conftest import DATA
from tests.helpers import connect, same_as_oracle
from workload import ORACLES, QUERIES, snapshots
from workload.frames import Frames

# These two are compared with their SQL below, with their checks watched.
KEYS = sorted({*QUERIES} - {"daily_run", "backfill"})


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_widths():
    assert (len(INVOICE_COLUMNS), len(SKU_COLUMNS), len(SNAPSHOT_COLUMNS), len(ARCHIVE_COLUMNS)) == (
        57, 87, 89, 90)


@pytest.mark.parametrize("key", KEYS)
def test_same_rows(spark, con, key):
    same_as_oracle(QUERIES[key](spark, DATA), con, ORACLES[key])


@pytest.mark.parametrize("key", ["join_as_of", "join_lateral_top1", "prorate", "dq_01", "dq_all",
                                 "join_scalar_compare", "tariff_percentage"])
def test_no_cross_join(spark, key):
    plan = QUERIES[key](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_scan_is_narrow_and_filtered(spark):
    df = QUERIES["scan_projected"](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double>" in plan


def test_reconciliation_reads_the_fact_and_not_the_snapshot(spark):
    """Rows and amounts that the snapshot lost do not vanish from what is expected of it."""
    expected = {}
    for lost in (False, True):
        f = Frames(spark, DATA)
        if lost:
            f._built["snapshot"] = f["snapshot"].where("snapshot_date = date'2001-06-30'")
        for check in (snapshots.dq_01, snapshots.dq_02):
            expected.setdefault(check.__name__, []).append(check(f).first().sample_detail)
    for details in expected.values():
        assert details[0] == details[1]


@pytest.mark.parametrize("key", ["daily_run", "backfill"])
def test_registered_runs_are_checked(spark, con, monkeypatch, key):
    checked = []
    monkeypatch.setattr(snapshots.snapshot, "assert_healthy",
                        lambda checks: checked.append(quality.assert_healthy(checks)))
    same_as_oracle(QUERIES[key](spark, DATA), con, ORACLES[key])
    assert len(checked) == (4 if key == "daily_run" else 3)


def test_checks_of_whole_tables_fire_on_one_date_only(spark, con):
    for key, date in (("dq_08_dates", "2001-06-16"), ("dq_09_dates", "2001-07-01")):
        found = QUERIES[key](spark, DATA)
        same_as_oracle(found, con, ORACLES[key])
        assert [r.run_date for r in found.collect()] == [date]
