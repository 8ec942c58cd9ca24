import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from duebook.operators.fanout import fan_out, hot_grid
from duebook.operators.lookups import as_of_join, lookup_join, tiered_lookup, top1, valid_on, validity_join
from duebook.operators.skew import Hot, hot_keys, key_hash
from tests.helpers import day, rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have key 7, a sixth none."""
    random.seed(1)
    keys = [7] * 300 + [None] * 150 + [random.randrange(40) for _ in range(450)]
    return spark.createDataFrame([(i, k, f"2001{1 + i % 12:02d}15") for i, k in enumerate(keys)],
                                 "id int, k int, at string")


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(k, f"v{k}") for k in range(0, 40, 3)] + [(7, "v7")], "k int, v string")


@pytest.fixture(scope="module", params=["10MB", "-1"], ids=["broadcast", "shuffle"])
def threshold(spark, request):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield
    spark.conf.set(key, before)


def test_hot_keys_finds_the_heavy_key_only(spark, skewed):
    hot = hot_keys(skewed, {"k": ["k"]}, hot_rows=100)["k"]
    seven = spark.range(1).selectExpr("7 k")
    heavy = seven.select(key_hash(seven, ["k"])).first()[0]
    assert hot.rows == 900 and list(hot.counts) == [heavy]
    assert not hot_keys(skewed, {"k": ["k"]})["k"]


@pytest.mark.parametrize("split", [False, True])
def test_lookup_join_equals_left_join(skewed, table, threshold, split):
    hot = hot_keys(skewed, {"k": ["k"]}, hot_rows=100)["k"] if split else None
    found = lookup_join(skewed, table, ["k"], hot=hot).select("id", "k", "v")
    assert rows(found) == rows(skewed.join(table, "k", "left").select("id", "k", "v"))


def test_any_set_of_hot_keys_gives_the_same_rows(spark, skewed, table):
    every = [r[0] for r in skewed.select(F.xxhash64("k")).distinct().collect()]
    found = lookup_join(skewed, table, ["k"], hot=Hot(900, dict.fromkeys(every, 1)))
    assert rows(found.select("id", "v")) == rows(skewed.join(table, "k", "left").select("id", "v"))


def test_rows_without_key_are_spread(skewed, table, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(skewed, table, ["k"])
        tasks = joined.where("k is null").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks == 4


@pytest.mark.parametrize("split", [False, True])
def test_as_of_join_equals_ranked_fan_out(spark, skewed, threshold, split):
    changes = spark.createDataFrame(
        [(k, f"2001{m:02d}{d:02d}", f"{k}/{m}/{d}") for k in (7, 8, 9) for m in (3, 6, 9) for d in (1, 15)],
        "k int, since string, v string")
    hot = hot_keys(skewed, {"k": ["k"]}, hot_rows=100)["k"] if split else None
    found = as_of_join(skewed, changes, ["k"], "at", "since", hot=hot)
    pairs = skewed.alias("a").join(changes.alias("b"), F.expr("a.k = b.k and b.since <= a.at"), "left")
    ranked = top1(pairs.select("a.id", "b.since", "b.v"), ["id"], [F.col("since").desc_nulls_last()])
    assert rows(found.select("id", "since", "v")) == rows(ranked)


def test_as_of_join_takes_one_of_equal_dates(spark):
    left = spark.createDataFrame([(1, "20010301")], "k int, at string")
    changes = spark.createDataFrame([(1, "20010301", "b"), (1, "20010301", "a")], "k int, since string, v string")
    assert [r.v for r in as_of_join(left, changes, ["k"], "at", "since").collect()] == ["a"]


def test_tiers_are_asked_in_order(spark):
    left = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("d", "1")], "acct string, co string")
    own = spark.createDataFrame([("a", "1", 10), ("b", "2", 20), ("d", "1", None)], "acct string, co string, key int")
    anywhere = spark.createDataFrame([("a", 11), ("b", 21)], "acct string, key int")
    found = tiered_lookup(left, [("OWN", own, ["acct", "co"]), ("ANY", anywhere, ["acct"])],
                          "key", "tier", "NONE")
    assert rows(found.select("acct", "key", "tier")) == [
        ("a", 10, "OWN"), ("b", 21, "ANY"), ("c", None, "NONE"), ("d", None, "NONE")]


def test_top1_orders_nulls_first_and_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", "2"), ("a", None), ("b", "1")], "k string, o string")
    first = top1(df, ["k"], [F.col("o")])
    plan = first._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert rows(first) == [("a", None), ("b", "1")]


def test_valid_on_includes_both_ends(spark):
    df = spark.createDataFrame([(1, day("2001-01-01"), day("2001-06-30")),
                                (2, day("2001-07-01"), day("2001-12-31"))], "id int, f date, t date")
    for text, want in (("2001-06-30", 1), ("2001-07-01", 2), ("2001-01-01", 1)):
        assert [r.id for r in valid_on(df, F.lit(day(text)), "f", "t").collect()] == [want]


@pytest.mark.parametrize("keep", [False, True])
@pytest.mark.parametrize("split", [False, True])
def test_fan_out_equals_join(spark, skewed, threshold, keep, split):
    lines = spark.createDataFrame([(7, n) for n in range(200)] + [(k, k) for k in range(20)], "k int, n int")
    totals = lines.groupBy("k").agg(F.sum("n").alias("total"))
    grid = None
    if split:
        sides = [hot_keys(df, {"k": ["k"]}, hot_rows=100)["k"] for df in (skewed, lines)]
        grid = hot_grid(skewed, *sides, least=50)
        assert [(r[1], r[2]) for r in grid.collect()] == [(7, 5)]
    found = fan_out(skewed, lines, ["k"], grid, [totals], keep_unmatched=keep)
    how = "left" if keep else "inner"
    want = skewed.join(lines, "k", how).join(totals, "k", "left")
    columns = ["id", "k", "n", "total"]
    assert rows(found.select(columns)) == rows(want.select(columns))


MIXED = [("int", "bigint"), ("decimal(18,2)", "decimal(20,2)"), ("decimal(10,0)", "decimal(10,2)"),
         ("int", "decimal(12,2)"), ("date", "timestamp"), ("float", "double")]


def _keys(df, kind):
    day = F.expr("date_add(date'2001-01-01', cast(k as int))")
    return df.withColumn("k", (day if kind in ("date", "timestamp") else F.col("k")).cast(kind))


@pytest.mark.parametrize("ours, theirs", MIXED)
@pytest.mark.parametrize("split", [False, True])
def test_keys_of_different_types(spark, threshold, ours, theirs, split):
    left = _keys(spark.range(1000).selectExpr("id", "if(id % 3 = 0, 7, id % 50) k"), ours)
    right = _keys(spark.range(50).selectExpr("id k", "id v"), theirs)
    hot = hot_keys(left, {"k": ["k"]}, hot_rows=100)["k"] if split else None
    found = lookup_join(left, right, ["k"], hot=hot)
    want = left.join(right.withColumnRenamed("k", "r"), F.col("k") == F.col("r"), "left").drop("r")
    assert rows(found.select("id", "v")) == rows(want.select("id", "v"))
    lines = _keys(spark.range(300).selectExpr("if(id % 2 = 0, 7, id % 50) k", "id n"), theirs)
    grid = None
    if split:
        sides = [hot_keys(df, {"k": ["k"]}, hot_rows=100)["k"] for df in (left, lines)]
        grid = hot_grid(left, *sides, least=50)
        assert grid is not None
    pairs = fan_out(left, lines, ["k"], grid)
    both = left.join(lines.withColumnRenamed("k", "r"), F.col("k") == F.col("r"))
    assert rows(pairs.select("id", "n")) == rows(both.select("id", "n"))


def test_keys_that_cannot_be_compared_are_refused(spark, threshold):
    left = spark.range(500).selectExpr("id", "7 k")
    right = spark.createDataFrame([("7", 1)], "k string, v int")
    hot = hot_keys(left, {"k": ["k"]}, hot_rows=100)["k"]
    with pytest.raises(TypeError):
        lookup_join(left, right, ["k"], hot=hot)


def test_a_repeated_lookup_key_repeats_rows_whether_hot_or_not(spark, threshold):
    left = spark.range(500).selectExpr("id", "if(id % 3 = 0, 8, 7) k")
    right = spark.createDataFrame([(7, 1), (7, 2), (8, 3)], "k int, v int")
    hot = hot_keys(left, {"k": ["k"]}, hot_rows=100)["k"]
    assert len(hot.counts) == 2
    want = rows(left.join(right, "k", "left").select("id", "v"))
    assert rows(lookup_join(left, right, ["k"], hot=hot).select("id", "v")) == want
    assert rows(lookup_join(left, right, ["k"]).select("id", "v")) == want


def test_numbers_beyond_the_common_type_have_hashes_of_their_own(spark):
    df = spark.range(50).selectExpr("cast(id as decimal(38,0)) * cast(1e30 as decimal(38,0)) k")
    assert df.select(key_hash(df, ["k"])).distinct().count() == 50


def test_unmatched_rows_are_found_in_one_pass(spark, skewed):
    """Also for a key that the grid cuts and the right side lacks; the left side is scanned once."""
    lines = spark.createDataFrame([(k, k) for k in range(20) if k != 7], "k int, n int")
    heavy = hot_keys(skewed, {"k": ["k"]}, hot_rows=100)["k"]
    grid = hot_grid(skewed, heavy, Hot(900, {h: 500 for h in heavy.counts}), least=50)
    assert grid.first()["__rp"] == 10
    found = fan_out(skewed, lines, ["k"], grid, keep_unmatched=True)
    assert rows(found.select("id", "k", "n")) == rows(skewed.join(lines, "k", "left").select("id", "k", "n"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    at = f"#{skewed._jdf.queryExecution().analyzed().output().apply(0).exprId().id()}"
    assert plan.count("LogicalRDD [id") + plan.count("LocalRelation [id") == 1, (at, plan)


def test_filters_reach_the_scan_through_a_lookup(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 k", "id % 3 company").write.parquet(str(tmp_path / "items"))
    items = spark.read.parquet(str(tmp_path / "items"))
    right = spark.createDataFrame([(1, "a")], "k long, v string")
    plan = lookup_join(items, right, ["k"]).where("company = 1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(company,1)" in plan


def test_validity_join_equals_range_join(spark, threshold):
    random.seed(3)
    first, last = day("2001-01-01"), day("2003-12-31")

    def some(low=0, high=1094):
        return first + dt.timedelta(random.randrange(low, high))
    left = [(n, random.choice(["EUR", "USD", None, "XXX"]), some() if n % 9 else None) for n in range(400)]
    left += [(900, "EUR", day("1990-01-01")), (901, "USD", last), (902, "USD", first)]
    right = []
    for key in ("EUR", "USD", "JPY"):
        for n in range(40):
            start = some(-200, 1000)
            right.append((key, start, random.choice([None, start, start + dt.timedelta(random.randrange(0, 400))]), n))
    right += [("EUR", None, last, 1), ("EUR", day("2002-05-01"), day("2002-04-01"), 2), (None, first, last, 3),
              ("USD", day("2010-01-01"), None, 4), ("USD", day("1980-01-01"), day("1985-01-01"), 5)]
    items = spark.createDataFrame(left, "id int, k string, at date")
    rates = spark.createDataFrame(right, "k string, f date, t date, v int")
    for width in (7, 64, 5_000):
        found = validity_join(items, rates, ["k"], "at", "f", "t", first, last, width)
        assert found.columns == ["k", "id", "at", "v"] or sorted(found.columns) == ["at", "id", "k", "v"]
        want = []
        for i, k, at in left:
            fits = [(-f.toordinal(), v) for key, f, t, v in right if key is not None and key == k and at and f
                    and first <= at <= last and f <= at and (t is None or at <= t)]
            want.append((i, min(fits)[1] if fits else None))
        assert rows(found.select("id", "v")) == sorted(want, key=repr)
