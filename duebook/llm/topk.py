"""Exact top-k search by inner product: branch and bound over columns.

1. Vectors are turned into whole numbers and stored in blocks with a vertical layout: all
   values of the first dimension, then all of the second, and so on.
2. A task holds some blocks and reads the queries as a stream, a chunk at a time.  Partial
   scores grow by a few dimensions at a time, those with the greatest mass in the chunk first.
3. What the other dimensions can still add is at most the product of the two remaining lengths.
   A candidate whose bound is below the k-th best score of its query is left; while many are
   alive whole columns are compacted, later single pairs of query and candidate.
4. Blocks are searched in waves, a small share of all first.  The k-th best scores of a wave are
   the floors of the next one, so that it gives back few rows however many tasks there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import staged

SCALE = 256
BLOCK = 1_024                # vectors of a block
BLOCK_BYTES = 1 << 18        # and its size at most, if it holds more than one vector
SLOT_BYTES = 1 << 25         # blocks that a task holds
CHUNK = 128                  # queries that are searched at once
FIRST = 64                   # blocks of the first wave at most
GROWTH = 8                   # each wave has so many times the blocks of all before
SEEDS = 64                   # candidates scored in full where nothing is known of a query yet
DENSE = 1 / 16               # share of pairs alive below which pairs are followed one by one
LARGEST = 2.0 ** 62          # sum of squares that keeps every score a 64-bit number
LOWEST = np.iinfo(np.int64).min

PACKED = "dim int, n int, ids binary, marks binary, data binary, norm double"


def whole_vectors(column: pa.Array) -> list[np.ndarray | None]:
    """floor(256 x) of each vector; none for rows that take no part."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)   # null becomes nan
    sizes = np.array([-1 if s is None else s for s in pc.list_value_length(column).to_pylist()],
                     np.int64)
    ends = np.cumsum(np.maximum(sizes, 0))
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(values * SCALE)
        squares = np.concatenate([[0.0], np.cumsum(np.where(np.abs(values) < 2.0 ** 31, 0, 1))])
    found: list[np.ndarray | None] = []
    for size, end in zip(sizes, ends):
        part = values[end - max(size, 0):end]
        # a component beyond 31 bits, infinite or not a number, counts in ``squares``
        if size < 0 or squares[end] > squares[end - size] or (part * part).sum() >= LARGEST:
            found.append(None)
        else:
            found.append(part.astype(np.int32))
    return found


def _block(rows: list[tuple[int, np.ndarray]], vertical: bool) -> tuple:
    ids, values = np.array([i for i, _ in rows], np.int64), np.stack([v for _, v in rows])
    norm = math.sqrt((values.astype(np.float64) ** 2).sum(axis=1).max(initial=0))
    data = np.ascontiguousarray(values.T if vertical else values)
    return values.shape[1], len(rows), ids.tobytes(), None, data.tobytes(), norm


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      ["dim", "n", "ids", "marks", "data", "norm"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vertical blocks of the vectors of a partition, one length each."""
    waiting: dict[int, list] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            for ident, vector in zip(part.column(0).to_pylist(), whole_vectors(part.column(1))):
                if vector is None:
                    continue
                rows = waiting.setdefault(len(vector), [])
                rows.append((ident, vector))
                if len(rows) >= max(1, min(BLOCK, BLOCK_BYTES // (4 * max(1, len(vector))))):
                    yield _packed([_block(rows, True)])
                    del waiting[len(vector)]
    for rows in waiting.values():
        yield _packed([_block(rows, True)])


def _queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = whole_vectors(batch.column(1))
        good = [n for n, v in enumerate(vectors) if v is not None]
        yield pa.RecordBatch.from_arrays(
            [pa.array([batch.column(0)[n].as_py() for n in good], pa.int64()),
             pa.array([vectors[n].tobytes() for n in good], pa.binary())], ["query", "data"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries with their marks and floors, in chunks of one length."""
    waiting: dict[int, list] = {}

    def given(rows: list) -> pa.RecordBatch:
        ids, data, marks, floors = zip(*rows)
        both = np.array([marks, floors], np.int64)
        return _packed([(len(data[0]) // 4, len(rows), np.array(ids, np.int64).tobytes(), both.tobytes(),
                         b"".join(data), 0.0)])

    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            rows = waiting.setdefault(len(row[1]), [])
            rows.append(row)
            if len(rows) == CHUNK:
                yield given(rows)
                del waiting[len(row[1])]
    for rows in waiting.values():
        yield given(rows)


class Best:
    """The k best candidates of each query of a chunk, ties to the smaller id."""

    def __init__(self, queries: np.ndarray, floors: np.ndarray, k: int):
        self.k, self.queries = k, queries
        self.floors = floors                       # scores below cannot be among the k best
        self.at = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.scores = np.empty(0, np.int64)

    def add(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        keep = (scores >= self.floors[at]) & (ids != self.queries[at])
        at = np.concatenate([self.at, at[keep]])
        ids = np.concatenate([self.ids, ids[keep]])
        scores = np.concatenate([self.scores, scores[keep]])
        order = np.lexsort((ids, -scores, at))
        at, ids, scores = at[order], ids[order], scores[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        kth = place == self.k - 1
        self.floors = self.floors.copy()
        self.floors[at[kth]] = np.maximum(self.floors[at[kth]], scores[kth])
        keep = place < self.k
        self.at, self.ids, self.scores = at[keep], ids[keep], scores[keep]


def search_block(queries: np.ndarray, best: Best, block: np.ndarray, ids: np.ndarray,
                 norm: float) -> int:
    """Adds the candidates of a vertical block to ``best``; gives the pairs followed to the end."""
    size, n = block.shape
    lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    top = float(lengths.max(initial=0)) * norm
    # doubles hold whole numbers exactly up to 2^53, and no partial sum is larger than ``top``
    kind = np.float64 if top < 2.0 ** 52 else np.int64
    slack = 1 + top * 1e-12                        # more than the bounds lose as doubles
    reach = lengths * norm * (1 + 1e-9) + slack
    able = np.flatnonzero(reach >= best.floors)
    if not len(able):
        return 0
    left = queries[able].astype(kind)
    if (best.floors[able] == LOWEST).any():
        few = np.unique(np.linspace(0, n - 1, min(n, SEEDS)).astype(np.int64))
        scores = (left @ block[:, few].astype(kind)).astype(np.int64)
        seeds = Best(best.queries[able], best.floors[able], best.k)
        at, column = np.divmod(np.arange(scores.size), len(few))
        seeds.add(at, ids[few][column], scores.ravel())
        floors = np.maximum(best.floors[able], seeds.floors)
    else:
        floors = best.floors[able]
    order = np.argsort(-np.abs(left).sum(axis=0), kind="stable")
    step = max(4, -(-size // 8))
    squares = block.astype(np.float64) ** 2
    alive = np.arange(n)
    partial = np.zeros((len(able), n), kind)
    pairs = None                                   # query and column of each pair, when few are left
    done = 0
    while done < size:
        dims, rest = order[done:done + step], order[done + step:]
        done += step
        if pairs is None:
            partial += left[:, dims] @ block[np.ix_(dims, alive)].astype(kind)
        else:
            a, c = pairs
            partial += np.einsum("np,pn->p", block[np.ix_(dims, c)].astype(kind), left[np.ix_(a, dims)])
        if not len(rest):
            break
        mine = np.sqrt((left[:, rest].astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
        theirs = np.sqrt(squares[rest].sum(axis=0))
        if pairs is None:
            live = partial + mine[:, None] * theirs[alive] + slack >= floors[:, None]
            some = live.any(axis=0)
            if live.mean() < DENSE:
                a, c = np.nonzero(live)
                partial = partial[a, c]
                pairs = a, alive[c]
            elif some.mean() < 0.75:
                alive, partial = alive[some], partial[:, some]
        else:
            a, c = pairs
            live = partial + mine[a] * theirs[c] + slack >= floors[a]
            partial, pairs = partial[live], (a[live], c[live])
    if pairs is None:
        a, c = np.nonzero(partial >= floors[:, None])
        pairs, partial = (a, alive[c]), partial[a, c]
    a, c = pairs
    best.add(able[a], ids[c], partial.astype(np.int64))
    return len(a)


FOUND = "query long, mark long, vec long, score long"


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, blocks = None, []
        for batch in batches:
            for number, kind, size, n, ids, marks, data, norm in zip(
                    *[c.to_pylist() for c in batch.columns]):
                if number != task:
                    task, blocks = number, []
                ids = np.frombuffer(ids, np.int64)
                values = np.frombuffer(data, np.int32)
                if kind == 0:
                    blocks.append((norm, values.reshape(size, n), ids))
                    continue
                marks, floors = np.frombuffer(marks, np.int64).reshape(2, n)
                best = Best(ids, floors, k)
                for norm, block, owners in sorted(blocks, key=lambda b: -b[0]):
                    if block.shape[0] == size:
                        search_block(values.reshape(n, size), best, block, owners, norm)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[best.at]), pa.array(marks[best.at]), pa.array(best.ids),
                     pa.array(best.scores)], ["query", "mark", "vec", "score"])
    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query", "mark").orderBy(F.desc("score"), "vec")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: str = "vec_id % 50 = 0", key: str = "vec_id",
          vector: str = "embedding", k: int = 5, first: int = FIRST) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` best inner products of every query row.

    Components count as floor(256 x).  Queries are the rows for which the SQL condition
    ``is_query`` holds, candidates are all rows but those with the query's own id.  Ties go to
    the smaller id.  Rows take no part that have a null key, a null vector or null or
    non-finite components, nor those with squares that sum to 2^62 or more, as scores are
    64-bit numbers.  Vectors of different lengths have no inner product.  A repeated row is a
    candidate each time and a query once; rows of one id with different vectors are queries of
    their own, with a list each.  Other columns are not read.  No queries or candidates: no rows.
    """
    spark = vectors.sparkSession
    usable = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull())
    asked = usable.where(is_query)
    columns = [F.col(key).cast("long").alias("id"), F.col(vector).alias("v")]
    blocks = staged(usable.select(columns).mapInArrow(_pack, PACKED).withColumn(
        "place", F.pmod(F.xxhash64("ids"), F.lit(1 << 30)) / F.lit(1 << 30)))
    queries = staged(asked.select(columns).mapInArrow(_queries, "query long, data binary")
                     .dropDuplicates(["query", "data"]).withColumn("mark", F.xxhash64("data")))
    count, held = blocks.agg(F.count("*"), F.coalesce(F.sum(F.length("data")), F.lit(0))).first()
    shares = [1.0]
    while shares[0] * count > first:
        shares.insert(0, shares[0] / GROWTH)
    cores = spark.sparkContext.defaultParallelism
    chunks_in_all = max(1, queries.count() // CHUNK)
    best, begin = None, 0.0
    for end in shares:
        known = queries
        if best is None:
            known = known.withColumn("floor", F.lit(LOWEST))
        else:
            floors = best.where(F.col("rank") == k).select("query", "mark", F.col("score").alias("floor"))
            known = known.join(floors, ["query", "mark"], "left").withColumn(
                "floor", F.coalesce("floor", F.lit(LOWEST)))
        slots = max(1, math.ceil((end - begin) * held / SLOT_BYTES))
        groups = max(1, min(chunks_in_all, math.ceil(2 * cores / slots)))
        slot = F.pmod(F.xxhash64(F.lit(1), "ids"), F.lit(slots))
        group = F.pmod(F.xxhash64(F.lit(2), "ids"), F.lit(groups))
        # each task holds the blocks of a slot and reads the chunks of a group
        held_blocks = (blocks.where((F.col("place") >= begin) & (F.col("place") < end)).drop("place")
                       .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
                       .withColumns({"task": slot * groups + F.col("other"), "kind": F.lit(0)}))
        asking = (known.select("query", "data", "mark", "floor").mapInArrow(_chunks, PACKED)
                  .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
                  .withColumns({"task": F.col("other") * groups + group, "kind": F.lit(1)}))
        both = held_blocks.drop("other").unionByName(asking.drop("other"))
        both = (both.repartition(slots * groups, "task").sortWithinPartitions("task", "kind")
                .select("task", "kind", "dim", "n", "ids", "marks", "data", "norm"))
        found = both.mapInArrow(_search(k), FOUND)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = staged(_ranked(staged(found), k))
        begin = end
    return best.select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"),
                       F.col("vec").alias("vec_id"), "score")
