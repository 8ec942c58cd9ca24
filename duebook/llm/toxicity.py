"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed n-grams.  Each feature is its presence times the log ratio of
its rates in toxic and other texts; a logistic regression weighs them.  Counts and weights
come from a bounded sample of the labelled texts, scores are given to every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import by_batch, list_array, splitmix, staged, texts_of

SAMPLE = 20_000          # labelled texts the classifier is fitted to, the first by hash of their key
SIZES = (4, 5, 6)        # bytes of an n-gram
DIMENSIONS = 1 << 22     # hashed n-grams
TASKS = 6                # tasks that count n-grams of the sample
SMOOTHING = 0.5
LEAST_RATIO = 1.5        # n-grams with a lower log ratio are left out: they say little, and
LEAST_COUNT = 3          # long texts hold many of them; so are those of too few texts
TOXIC_WEIGHT = 8.0       # weight of a toxic text in the fit, where they are the rarer ones
THRESHOLD = 0.7

_OTHER = np.full(256, 32, np.uint8)      # letters in lower case, all else a space
for _c in range(26):
    _OTHER[97 + _c] = _OTHER[65 + _c] = 97 + _c
_OTHER[128:] = np.arange(128, 256)


def grams(text: bytes) -> np.ndarray:
    """Buckets of all n-grams, with repeats.  Each run of other signs than letters is one space."""
    data = _OTHER[np.frombuffer(b" " + text + b" ", np.uint8)]
    space = data == 32
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    data = data[keep].astype(np.uint64)
    parts = []
    for size in SIZES:
        n = len(data) - size + 1
        if n > 0:
            code = np.full(n, size, np.uint64)
            for at in range(size):
                code = (code << np.uint64(8)) | data[at:at + n]
            parts.append(splitmix(code) & np.uint64(DIMENSIONS - 1))
    return np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)


def held_out(key: Column) -> Column:
    """A third of the keys, by checksum; their labels are never learned from."""
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts per n-gram and class, summed in the task."""
    counts = np.zeros((2, DIMENSIONS), np.int32)
    for batch in batches:
        for text, label in zip(texts_of(batch.column(0)), batch.column(1).to_pylist()):
            counts[label, np.unique(grams(text))] += 1
    found = np.flatnonzero(counts.any(axis=0))
    for at in range(0, len(found), 100_000):
        part = found[at:at + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(counts[0, part]), pa.array(counts[1, part])],
            ["gram", "other", "toxic"])


def _fit(ends: np.ndarray, index: np.ndarray, scale: np.ndarray, y: np.ndarray,
         rounds: int = 120, penalty: float = 2e-3) -> tuple[np.ndarray, float]:
    """Logistic regression over sparse rows ``index[ends[i]:ends[i + 1]]`` with values ``scale``."""
    row = np.repeat(np.arange(len(y)), np.diff(ends))
    value = scale[index]
    w, b = np.full(len(scale), 0.05), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    weight = np.where(y > 0, TOXIC_WEIGHT, 1.0)
    weight /= weight.mean()
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, rounds + 1):
        z = b + np.bincount(row, w[index] * value, len(y))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        off = weight * (p - y)
        g = np.bincount(index, off[row] * value, len(scale)) / len(y) + penalty * w
        gb = float(off.mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        one, two = 1 - 0.9 ** step, 1 - 0.99 ** step
        w -= 0.03 * (m / one) / (np.sqrt(v / two) + 1e-9)
        b -= 0.03 * (mb / one) / (np.sqrt(vb / two) + 1e-9)
    return w, b


def toxicity_model(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
                   sample: int) -> tuple[np.ndarray, float]:
    """Weight per n-gram bucket (0 where left out) and bias."""
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
    chosen = staged(usable.groupBy(F.col(key).alias("__key")).agg(F.max(label).cast("int").alias("__label"))
                    .orderBy(F.xxhash64("__key"), "__key").limit(sample), 1)
    some = (docs.where(F.col(text).isNotNull())
            .join(F.broadcast(chosen), docs[key] == F.col("__key"))     # ``sample`` rows at most
            .select(text, "__label"))
    some = staged(some).repartition(TASKS)
    totals = dict(some.groupBy("__label").count().collect())
    weights = np.zeros(DIMENSIONS, np.float32)
    if len(totals) < 2:
        return weights, 30.0 * (1 if 1 in totals else -1)
    counted = (some.mapInArrow(_count, "gram int, other int, toxic int")
               .groupBy("gram").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")))
    rate = [(F.col(c) + SMOOTHING) / float(totals[n] + 2 * SMOOTHING)
            for n, c in enumerate(("other", "toxic"))]
    # at most one row per bucket
    found = (counted.where(F.col("other") + F.col("toxic") >= LEAST_COUNT)
             .select("gram", F.log(rate[1] / rate[0]).alias("r"))
             .where(F.col("r") >= LEAST_RATIO).toArrow())
    gram = np.asarray(found["gram"]).astype(np.int64)
    ratio = np.zeros(DIMENSIONS, np.float32)
    ratio[gram] = np.asarray(found["r"])

    def sparse(column: pa.Array) -> list[pa.Array]:
        rows = []
        for t in texts_of(column):
            g = grams(t)
            rows.append(np.unique(g[ratio[g] != 0]))
        return [list_array(rows, pa.int32())]
    rows = by_batch(some, [text], [T.StructField("x", T.ArrayType(T.IntegerType()))], sparse,
                    ["__label"]).toArrow()
    column = rows["x"].combine_chunks()
    place = np.zeros(DIMENSIONS, np.int64)
    place[gram] = np.arange(len(gram))
    w, bias = _fit(np.asarray(column.offsets), place[np.asarray(column.flatten())],
                   ratio[gram].astype(np.float64), np.asarray(rows["__label"]).astype(float))
    weights[gram] = w * ratio[gram]
    return weights, bias


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """``key``, held_out, score (0 to 1) and predicted (1 from 0.7 on), a row per row of ``docs``.

    Only the text is scored.  Null, empty and letterless texts score what the bias gives.
    Equal texts score the same; repeated keys are rows of their own; a null key is not held
    out and never learned from.  A key labelled both ways counts as toxic.  Without labels
    of both classes all texts score 0, or 1 if only toxic ones are given.  An empty table
    gives no rows.
    """
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    labels = labels.select(F.col(key).alias("id"), F.col(label).alias("label"))
    weights, bias = toxicity_model(docs, labels, "id", "text", "label", sample)
    shared = docs.sparkSession.sparkContext.broadcast(weights)       # DIMENSIONS floats

    def score(column: pa.Array) -> list[pa.Array]:
        w, scores = shared.value, []
        for t in texts_of(column):
            g = grams(t or b"")
            z = bias + float(w[np.unique(g[w[g] != 0])].sum(dtype=np.float64))
            scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return [pa.array(scores, pa.float64())]
    scored = by_batch(docs, ["text"], [T.StructField("score", T.DoubleType())], score, ["id"])
    return scored.select(F.col("id").alias(key), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
