"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import staged

ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Each linked id with the smallest id it can reach, as ``id`` and ``component``.

    Large-star and small-star steps in turn: each hangs the neighbours of a node below the
    smallest of them, until nothing changes and every component is a star.  The list is
    written twice per round and never grows; no group of neighbours is gathered, minima are
    combined per task before the shuffle.  Links of an id with itself, repeated links and nulls are left out; an empty
    list gives no rows.
    """
    edges = staged(links.where(f"{a} != {b}").select(F.greatest(a, b).alias("u"),
                                                     F.least(a, b).alias("v")).distinct())
    before = _state(edges)
    for _ in range(ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u and v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = staged(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = staged(small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .union(least.select("u", F.col("m").alias("v"))).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no end after {ROUNDS} rounds")
    return (edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))
