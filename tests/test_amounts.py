import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from duebook.operators.aging import aging_as_of, aging_live
from duebook.operators.prorate import prorate
from tests.helpers import day, rows

AS_OF = day("2001-06-30")
NAMES = ["open", "disputed", "current", "past", "cleared"]
COLUMNS = dict(status="status", due="due", cleared_on="cleared_on", reason="reason")


def spread(spark, lines, **options):
    df = spark.createDataFrame([(d, i, None if w is None else Decimal(w), 100.0) for d, i, w in lines],
                               "doc string, item string, w decimal(18,2), amount double")
    found = prorate(df, "doc", "w", "item", {"amount": "part"}, **options)
    return {(r.doc, r.item): (r.factor, r.part) for r in found.collect()}


def test_shares_follow_the_weight(spark):
    found = spread(spark, [("a", "1", "3"), ("a", "2", "1"), ("b", "1", "-2"), ("b", "2", "-2")])
    assert found[("a", "1")] == (Decimal("0.7500000000"), Decimal("75.000"))
    assert found[("b", "1")] == (Decimal("0.5000000000"), Decimal("50.000"))


def test_a_third_keeps_ten_digits(spark):
    found = spread(spark, [("a", str(n), "1") for n in range(3)])
    assert found[("a", "0")] == (Decimal("0.3333333333"), Decimal("33.333"))


def test_zero_total_is_split_evenly_and_a_lone_line_takes_all(spark):
    lines = [("a", "1", "5"), ("a", "2", "-5"), ("b", "1", "0")]
    assert spread(spark, lines)[("a", "1")][1] == Decimal("50.000")
    assert spread(spark, lines)[("b", "1")][1] == Decimal("100.000")
    assert spread(spark, lines, null_single=True)[("b", "1")] == (None, None)


@pytest.fixture(scope="module")
def every_case(spark):
    reasons = [None, "", "01", "ABC"]
    dues = [day("2001-06-29"), AS_OF, day("2001-07-01"), None]
    cleared = [None, AS_OF]
    cases = [(n, *c, Decimal("10.000")) for n, c in enumerate(itertools.product(
        ["OPEN", "CLEARED"], reasons, dues, cleared))]
    return spark.createDataFrame(cases, "n int, status string, reason string, due date, "
                                        "cleared_on date, amount decimal(18,3)")


@pytest.mark.parametrize("dispute", ["disjoint", "overlap"])
def test_as_of_buckets_always_add_up(every_case, dispute):
    for r in aging_as_of(every_case, F.lit(AS_OF), "amount", NAMES, dispute=dispute, **COLUMNS).collect():
        parts = r.current + r.past + (r.disputed if dispute == "disjoint" else 0)
        assert r.open == parts
        assert (r.open, r.cleared) == ((10, 0) if r.status == "OPEN" else (0, 10))
        assert r.disputed == (10 if r.status == "OPEN" and r.reason == "01" and r.cleared_on is None else 0)


def test_live_buckets_lose_rows_without_reason_or_due_date(every_case):
    for r in aging_live(every_case, F.lit(AS_OF), "amount", NAMES, **COLUMNS).collect():
        if r.status == "OPEN" and (r.reason is None or (r.due is None and r.reason != "01")):
            assert r.current == r.past == 0 and r.open == 10
        # the clearing date alone decides here, whatever the status
        assert r.disputed == (10 if r.cleared_on is None and r.reason == "01" else 0)


def test_a_missing_amount_is_missing_in_its_buckets(spark):
    df = spark.createDataFrame([("OPEN", None, AS_OF, None, None)],
                               "status string, reason string, due date, cleared_on date, amount decimal(18,3)")
    assert rows(aging_as_of(df, F.lit(AS_OF), "amount", NAMES, **COLUMNS).select(*NAMES)) == [
        (None, Decimal("0.000"), None, None, Decimal("0.000"))]
