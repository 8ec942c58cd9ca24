from decimal import Decimal

from pyspark.sql import functions as F

from duebook import functions as fn
from tests.helpers import day


def values(spark, column, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(column).collect()]


def test_dates_of_any_shape_do_not_stop_the_job(spark):
    data = [("",), ("00000000",), ("20010630",), ("2001-06-30",), ("20011399",), (None,)]
    found = values(spark, fn.parse_yyyymmdd(F.col("x")), data, "x string")
    assert found == [None, None, day("2001-06-30"), None, None, None]


def test_text_helpers(spark):
    data = [("007",), ("000",), (" ",), ("",), (None,)]
    assert values(spark, fn.strip_zeros(F.col("x")), data, "x string") == ["7", "", " ", "", None]
    assert values(spark, fn.strip_zeros_regex(F.col("x")), data, "x string") == ["7", "", " ", "", None]
    assert values(spark, fn.not_blank(F.col("x")), data, "x string") == [True, True, False, False, False]
    assert values(spark, fn.not_empty(F.col("x")), data, "x string") == [True, True, True, False, False]
    assert values(spark, fn.differs(F.col("x"), "007"), data, "x string") == [False, True, True, True, True]
    assert values(spark, fn.not_of_length(F.col("x"), 3), data, "x string") == [False, False, True, True, None]


def test_signed_amount_and_scale(spark):
    data = [(Decimal("1.2345"), "H"), (Decimal("1.2345"), "S"), (None, "H")]
    found = values(spark, fn.signed_amount(F.col("a"), F.col("d")), data, "a decimal(18,4), d string")
    assert found == [Decimal("-1.235"), Decimal("1.235"), None]
    assert values(spark, fn.currency_scale(F.col("d")), [(0,), (3,), (None,)], "d int") == [100.0, 0.1, 1.0]


def test_conversion_with_a_missing_part_is_null(spark):
    data = [(10.0, 2.0, 1.0, 4.0), (10.0, None, 1.0, 1.0), (10.0, 2.0, 0.0, 1.0)]
    column = fn.convert_amount(F.col("a"), F.col("r"), F.col("f"), F.col("t"))
    assert values(spark, column, data, "a double, r double, f double, t double") == [80.0, None, None]


def test_due_date_takes_the_first_term_that_is_not_zero(spark):
    data = [
        ("20010101", "20010201", "S", None, "0", "10", "5", 30, "2001-01-11"),
        ("", "20010201", "S", None, "0", "", "n/a", 30, "2001-03-03"),
        ("00000000", "20010201", "S", None, "0", "0", "0", None, "2001-02-01"),
        (None, "20010201", "H", "", "45", "0", "0", 30, "2001-02-01"),
        (None, "20010201", "H", "R1", "45", "0", "0", 30, "2001-03-18"),
    ]
    df = spark.createDataFrame(data, "b string, d string, s string, r string, d3 string, d2 string, "
                                     "d1 string, t int, want string")
    due = fn.due_date(F.col("b"), F.col("d"), F.col("s"), F.col("r"),
                      [F.col("d3"), F.col("d2"), F.col("d1")], F.col("t"))
    assert all(str(r.due) == r.want for r in df.select(due.alias("due"), "want").collect())


def test_security_key_ignores_order_and_repeats(spark):
    data = [(3, 1, None), (1, 3, 3)]
    found = values(spark, fn.security_key(F.col("a"), F.col("b"), F.col("c")), data, "a int, b int, c int")
    assert found == ["0-1-3", "1-3"]
