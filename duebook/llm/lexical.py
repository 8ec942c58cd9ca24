"""Ranked lexical search over hashed max-sketches.

1. A document becomes the sorted hashes of its terms with their numbers, and a sketch: each
   term falls on one of ``WIDTH`` coordinates, which keeps the greatest number of any term
   on it.  What a term adds to a score grows with its number, so that a coordinate bounds
   the impact of all its terms.  Numbers of documents, terms and documents per term follow.
2. Items are searched in batches of bounded size.  The weights of a batch make a matrix of
   coordinates by items; the sketches of a group of documents times it are upper bounds of
   all their scores at once.
3. Each task scores the documents of an item exactly, in the order of falling bounds, until a
   bound is below the worst of the best so far.  The best of all tasks are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import WordHasher, by_batch, staged, texts_of

BITS = 13
WIDTH = 1 << BITS            # coordinates of a sketch
ITEMS = 512                  # items of a batch
ITEM_CHARS = 1 << 20         # and their characters, but for one that is longer itself
GROUP = 128                  # documents whose bounds are computed at once

_ALNUM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def term_hasher() -> WordHasher:
    """64-bit hashes of all terms: runs of ASCII letters and digits and of all that is not ASCII."""
    hasher = WordHasher(lower=True)
    hasher.space[:128] = True
    hasher.space[list(_ALNUM)] = False
    return hasher


def coordinates(terms: np.ndarray) -> np.ndarray:
    return (terms >> np.uint64(64 - BITS)).astype(np.int64)


def sketch(terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of sorted terms that are not empty, and the greatest number on each."""
    place = coordinates(terms)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return place[first].astype(np.uint16), np.maximum.reduceat(counts, first).astype(np.uint32)


def _index():
    hasher = term_hasher()

    def run(column: pa.Array) -> list[pa.Array]:
        rows = []
        for text in texts_of(column):
            found = hasher(text or b"")
            if not len(found):
                rows.append((0, None, None, None, None))
                continue
            terms, counts = np.unique(found, return_counts=True)
            places, peaks = sketch(terms, counts)
            rows.append((len(found), terms.tobytes(), counts.astype(np.uint32).tobytes(),
                         places.tobytes(), peaks.tobytes()))
        columns = list(zip(*rows)) or [()] * 5
        return [pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]]
    return run


def sketch_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n, terms, counts, places and peaks of all documents with a term."""
    fields = [T.StructField("n", T.LongType())] + [
        T.StructField(c, T.BinaryType()) for c in ("terms", "counts", "places", "peaks")]
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return by_batch(rows, ["text"], fields, _index(), ["id"]).where("n > 0")


class Asked:
    """The items of a batch: their terms, and weights once the documents per term are known."""

    def __init__(self, items: list[tuple[int | None, str]]):
        hasher = term_hasher()
        self.ids = [i for i, _ in items]
        found = [np.unique(hasher((t or "").encode()), return_counts=True) for _, t in items]
        self.terms = np.unique(np.concatenate([np.empty(0, np.uint64), *[t for t, _ in found]]))
        self.times = np.zeros((len(items), len(self.terms)), np.int64)
        for row, (terms, times) in zip(self.times, found):
            row[np.searchsorted(self.terms, terms)] = times

    def weigh(self, documents: int, held: dict[int, int]) -> None:
        """``held``: documents with each term, by its place."""
        logs = [math.floor(1000 * math.log((2 * documents + 2) / (2 * held.get(n, 0) + 1)))
                for n in range(len(self.terms))]
        self.weights = self.times * np.array(logs, np.int64)
        places = coordinates(self.terms)
        used, column = np.unique(places, return_inverse=True)
        self.column = np.full(WIDTH, -1)          # column of a coordinate that an item looks up
        self.column[used] = np.arange(len(used))
        bound = np.zeros((len(used), len(self.ids)))
        np.add.at(bound, column, self.weights.T)
        # single precision loses less than the factor adds
        self.bound = (bound * (1 + 1e-4)).astype(np.float32)


def impacts(counts: np.ndarray, m: int) -> np.ndarray:
    counts = counts.astype(np.int64)
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


def _held(terms: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                data = b"".join(batch.column(0).slice(at, GROUP).to_pylist())
                found = np.frombuffer(data, np.uint64)
                place = np.minimum(np.searchsorted(terms, found), len(terms) - 1)
                total += np.bincount(place[terms[place] == found], minlength=len(terms))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])],
                                         ["place", "held"])
    return run


FOUND = "slot int, item long, id long, score long"


def _search(asked: Asked, documents: int, total: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = len(asked.ids)
        best: list[list[tuple]] = [[] for _ in range(items)]    # (-score, id is null, id)
        floor = np.ones(items)                                  # of a score worth a look

        def exact(row: tuple, m: int) -> tuple[np.ndarray, np.ndarray]:
            terms, counts = np.frombuffer(row[2], np.uint64), np.frombuffer(row[3], np.uint32)
            place = np.minimum(np.searchsorted(asked.terms, terms), len(asked.terms) - 1)
            hit = asked.terms[place] == terms
            return place[hit], impacts(counts[hit], m)

        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                rows = list(zip(*[c.to_pylist() for c in batch.slice(at, GROUP).columns]))
                lengths = [25 + 75 * row[1] * documents // total for row in rows]
                peaks = np.zeros((len(rows), len(asked.bound)), np.float32)
                for n, (row, m) in enumerate(zip(rows, lengths)):
                    column = asked.column[np.frombuffer(row[4], np.uint16)]
                    used = column >= 0
                    peaks[n, column[used]] = impacts(np.frombuffer(row[5], np.uint32)[used], m)
                bounds = peaks @ asked.bound + 1
                known: dict[int, tuple] = {}
                for item in np.flatnonzero((bounds >= floor).any(axis=0)).tolist():
                    column, mine, weights = bounds[:, item], best[item], asked.weights[item]
                    for n in np.argsort(-column, kind="stable").tolist():
                        if column[n] < floor[item]:
                            break
                        if n not in known:
                            known[n] = exact(rows[n], lengths[n])
                        place, impact = known[n]
                        score = int(weights[place] @ impact)
                        if score > 0:
                            ident = rows[n][0]
                            mine.append((-score, ident is None, ident or 0))
                            if len(mine) > k:
                                mine.sort()
                                mine.pop()
                            if len(mine) == k:
                                floor[item] = -max(mine)[0]
        out = [(slot, asked.ids[slot], None if null else ident, -score)
               for slot, found in enumerate(best) for score, null, ident in found]
        columns = list(zip(*out)) or [()] * 4
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                         ["slot", "item", "id", "score"])
    return run


def ranked_search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", k: int = 10) -> DataFrame:
    """item_id, rank, doc_id and score: the ``k`` best documents of each item, best first.

    Scores are whole numbers above 0, of the terms' weights and saturated counts; equal scores are
    in the order of ids, a null id last.  Null and empty texts hold no terms, and an item
    without terms or hits has no rows.  A repeated item (id and text) is searched once; items
    of one id with different texts have a list each.  A repeated document is ranked each time
    it occurs.  Ids are whole numbers; other columns are not read.  Terms are told apart by 64-bit
    hashes.
    """
    spark = docs.sparkSession
    index = staged(sketch_index(docs, key, text))
    documents, total = index.agg(F.count("*"), F.sum("n")).first()
    wanted = staged(items.where(F.col(item_text).isNotNull()).select(
        F.col(item).cast("long").alias("id"), F.col(item_text).alias("text")).distinct())
    count, chars = wanted.agg(F.count("*"), F.sum(F.length("text"))).first()
    if not documents or not count:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    batches = max(1, math.ceil(count / ITEMS), math.ceil(chars / ITEM_CHARS))
    batch = F.pmod(F.xxhash64("id", "text"), F.lit(batches))
    result = None
    for number in range(batches):
        # about ITEMS rows and ITEM_CHARS characters
        asked = Asked([tuple(r) for r in wanted.where(batch == number).orderBy("id", "text").collect()])
        if not len(asked.terms):
            continue
        held = index.select("terms").mapInArrow(_held(asked.terms), "place long, held long")
        asked.weigh(documents, dict(held.groupBy("place").agg(F.sum("held")).collect()))
        found = index.select("id", "n", "terms", "counts", "places", "peaks").mapInArrow(
            _search(asked, documents, total, k), FOUND)
        order = Window.partitionBy("slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        best = staged(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
        result = best if result is None else result.unionByName(best)
    if result is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return result.select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"),
                         F.col("id").alias("doc_id"), "score")
