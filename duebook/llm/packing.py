"""Packing by length: optimal bucket boundaries from the global histogram, batches inside.

A training batch pads its rows to one length.  Boundaries are chosen over the histogram of
all lengths so that the padding is the least possible for that number of buckets; a batch
then holds as many rows of a bucket as the token budget allows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, staged

MAX_LENGTH = 2048        # tokens of a row; longer documents go on in further rows
BUDGET = 65_536          # padded tokens of a batch
BUCKETS = 12
SHARD_ROWS = 200_000     # rows that are numbered together, at most about twice as many


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` ranges of lengths with the least total padding.

    ``cost(i, j)`` is the padding of lengths i+1..j padded to the j-th.  Row k of the table is
    the least padding of the first j lengths in k buckets.  Ties take the smaller boundary.
    """
    n = len(lengths)
    if not n:
        return []
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    rows = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    best = np.full(n + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    choices = []
    for _ in range(min(buckets, n)):
        after, chosen = best.copy(), np.full(n + 1, -1)
        for j in range(1, n + 1):
            total = best[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            i = int(np.argmin(total))
            if total[i] < after[j]:
                after[j], chosen[j] = total[i], i
        best = after
        choices.append(chosen)
    bounds, j = [], n
    for chosen in reversed(choices):
        if j and chosen[j] >= 0:
            bounds.append(int(lengths[j - 1]))
            j = int(chosen[j])
    return sorted(bounds)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def length_buckets(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   length: Column | None = None, max_length: int = MAX_LENGTH,
                   budget: int = BUDGET, buckets: int = BUCKETS) -> DataFrame:
    """``key``, piece, start, n_tokens, bucket_length, batch, slot and padding.

    ``length`` counts the tokens of a document, by default its words.  A document longer than
    ``max_length`` goes on in further pieces, each a row that starts at token ``start``; every
    token is in one piece.  Documents without tokens, null texts too, have one piece of no
    tokens: bucket length 0, batch null and slot null, as nothing is to be padded.

    ``batch`` is unique over all buckets; its rows times its bucket length are within the
    budget (a budget below the bucket length gives batches of one row).  Within a bucket rows
    are numbered per shard, a hash class of the key; the number of shards follows the number
    of rows, so no task numbers more than a fixed number, and each shard of a bucket has
    at most one batch that is not full.  Repeated keys give rows of their own; their order is arbitrary.
    """
    size = F.col("__size")
    sized = docs.select(F.col(key), (word_count(F.col(text)) if length is None else length)
                        .cast("long").alias("__size"))
    pieces = F.greatest(F.lit(1), F.ceil(size / F.lit(max_length))).cast("long")
    rows = (sized.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)))
            .withColumn("start", F.col("piece") * max_length)
            .withColumn("n_tokens", F.least(F.lit(max_length), size - F.col("start")))
            .drop("__size"))
    rows = staged(rows)
    # at most max_length + 1 rows come to the driver, for any number of documents
    histogram = rows.groupBy("n_tokens").count().orderBy("n_tokens").collect()
    filled = [(r["n_tokens"], r["count"]) for r in histogram if r["n_tokens"]]
    lengths, counts = np.array(filled, np.int64).reshape(-1, 2).T
    bounds = best_boundaries(lengths, counts, buckets)
    shards = max(1, -(-int(counts.sum()) // SHARD_ROWS))

    bound = F.coalesce(*[F.when(F.col("n_tokens") <= b, F.lit(b)) for b in bounds],
                       F.lit(0)) if bounds else F.lit(0)
    rows = rows.withColumns({
        "bucket_length": F.when(F.col("n_tokens") > 0, bound).otherwise(0).cast("long"),
        "__shard": F.pmod(F.xxhash64(key, "piece"), F.lit(shards))})
    empty = rows.where("n_tokens = 0").withColumn("__at", F.lit(None).cast("int"))
    order = Window.partitionBy("bucket_length", "__shard").orderBy("n_tokens", key, "piece")
    full = rows.where("n_tokens > 0").withColumn("__at", F.row_number().over(order) - 1)
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_length")))
    number = F.struct(F.col("bucket_length").alias("bucket_length"), F.col("__shard").alias("shard"),
                      F.floor(F.col("__at") / room).alias("number"))
    return full.unionByName(empty).select(
        key, "piece", "start", "n_tokens", "bucket_length",
        F.when(F.col("__at").isNotNull(), F.concat_ws("-", *[number[c] for c in (
            "bucket_length", "shard", "number")])).alias("batch"),
        F.pmod(F.col("__at"), room).cast("long").alias("slot"),
        (F.col("bucket_length") - F.col("n_tokens")).alias("padding"))
