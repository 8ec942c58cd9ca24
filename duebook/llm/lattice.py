"""Embedding near-duplicates by lattice hashing.

1. Each of several tables projects the unit vectors at random onto eight dimensions and decodes
   the result to the nearest point of the E8 lattice, the densest in eight dimensions.  A
   vector lies in its own cell and in the neighbouring cells next nearest to it.
2. The smallest id of a cell's own vectors is its pivot; all cells of one pivot make a
   canopy.  A vector that probes the cell is a guest of the canopy.
3. Members and guests of a canopy are compared block by block in double precision.  A pair
   may meet in several canopies; it is counted in the first one of both only, so that links
   can be summed per vector without a row per pair.  What leaves a block is the number of
   links per vector, and a spanning forest of the links, from which components follow.

Equal vectors are one class from the start, with the smallest id and a count, so copies cost no
comparisons however many there are.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import by_batch, list_array, splitmix, staged
from .components import components

TABLES = 16
PROBES = 6               # neighbouring cells of a vector besides its own
SCALE = 1.3              # lattice cells per unit length after projection
BLOCK = 512
LIMIT = 0.95


def roots() -> np.ndarray:
    """The 240 shortest vectors of the lattice: the steps to neighbouring cells."""
    found = []
    for a, b in itertools.combinations(range(8), 2):
        for x, y in itertools.product((-1.0, 1.0), repeat=2):
            v = np.zeros(8)
            v[a], v[b] = x, y
            found.append(v)
    found += [np.array(s) / 2 for s in itertools.product((-1.0, 1.0), repeat=8) if np.prod(s) > 0]
    return np.array(found)


def nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum: round, and where the sum is odd
    round the coordinate that is farthest from whole the other way."""
    y = np.rint(x)
    off = x - y
    odd = (y.sum(axis=1) % 2 != 0)
    worst = np.abs(off).argmax(axis=1)
    rows = np.flatnonzero(odd)
    step = np.where(off[rows, worst[rows]] >= 0, 1.0, -1.0)
    y[rows, worst[rows]] += step
    return y


def nearest_point(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: of whole coordinates with even sum, or of those shifted by a half."""
    whole, half = nearest_even(x), nearest_even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


class Hasher:
    """Cell numbers of unit vectors: per table the own cell first, then the probed ones."""

    def __init__(self, size: int, tables: int, probes: int, seed: int = 3):
        draw = np.random.default_rng(seed)
        self.size, self.tables, self.probes = size, tables, probes
        self.planes = draw.normal(0, 1, (tables, size, 8))
        self.shift = draw.uniform(0, 1, (tables, 8))
        self.roots = roots()

    def _number(self, table: int, points: np.ndarray) -> np.ndarray:
        code = np.full(len(points), table + 1, np.uint64)
        for column in (points * 2).astype(np.int64).T:
            code = splitmix(code * np.uint64(0x9E3779B97F4A7C15) + column.view(np.uint64))
        return code.view(np.int64)

    def __call__(self, unit: np.ndarray) -> np.ndarray:
        cells = np.empty((len(unit), self.tables, 1 + self.probes), np.int64)
        for table in range(self.tables):
            x = unit @ self.planes[table] * SCALE + self.shift[table]
            own = nearest_point(x)
            cells[:, table, 0] = self._number(table, own)
            # a root r is the nearer the larger its product with what is left of x
            near = np.argsort(-((x - own) @ self.roots.T), axis=1, kind="stable")[:, :self.probes]
            for n in range(self.probes):
                cells[:, table, 1 + n] = self._number(table, own + self.roots[near[:, n]])
        return cells


def unit_vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, and which rows have one.

    Rows that are null, empty, zero or hold null or non-finite components have none; of the rest
    those of the most common length count (vectors of different lengths have no cosine).
    """
    rows = column.to_pylist()
    sizes = [len(r) if r else 0 for r in rows]
    size = max(sizes, default=0)
    unit, good = np.zeros((len(rows), max(size, 1))), np.zeros(len(rows), bool)
    for n, row in enumerate(rows):
        if sizes[n] and None not in row:
            v = np.array(row, np.float64)
            if np.isfinite(v).all() and (top := np.abs(v).max()) > 0:
                v = v / top
                unit[n, :len(v)] = v / np.sqrt(v @ v)
                good[n] = True
    return unit, good


def _hashes(tables: int, probes: int):
    hashers: dict[int, Hasher] = {}

    def run(column: pa.Array) -> list[pa.Array]:
        unit, good = unit_vectors(column)
        sizes = np.array([len(r) if r else 0 for r in column.to_pylist()])
        cells: list[np.ndarray] = [np.empty(0, np.int64)] * len(unit)
        for size in np.unique(sizes[good]):
            at = np.flatnonzero(good & (sizes == size))
            hasher = hashers.setdefault(int(size), Hasher(int(size), tables, probes))
            # the length is part of a cell, so only vectors of one length meet
            found = splitmix(hasher(unit[at, :size]).view(np.uint64) ^ np.uint64(size)).view(np.int64)
            for n, c in zip(at, found.reshape(len(at), -1)):
                cells[n] = c
        return [list_array(cells, pa.int64())]
    return run


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x
    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[p] = q
            kept.append((x, y))
    return kept


def _compare(limit: float):
    def compare(key: tuple, table: pa.Table) -> pa.Table:
        """Links between two blocks of a canopy that no earlier canopy of both has."""
        canopy, x, y = (k.as_py() for k in key)
        block, ids = np.asarray(table["block"]), np.asarray(table["id"])
        unit = np.asarray(table["v"].combine_chunks().flatten()).astype(np.float64)
        unit = unit.reshape(len(ids), -1)
        unit /= np.abs(unit).max(axis=1, keepdims=True)
        unit /= np.sqrt(np.einsum("nd,nd->n", unit, unit))[:, None]
        column = table["canopies"].combine_chunks()
        flat, ends = np.asarray(column.flatten()), np.asarray(column.offsets)
        ends = ends - ends[0]
        one, two = np.flatnonzero(block == x), np.flatnonzero(block == y)
        near = unit[one] @ unit[two].T >= limit - 1e-9
        if x == y:
            near &= ids[one][:, None] < ids[two][None, :]
        a, b = np.nonzero(near)
        a, b = one[a], two[b]
        # in double precision without the order of a product of matrices
        keep = np.zeros(len(a), bool)
        for at in range(0, len(a), 1 << 14):
            keep[at:at + (1 << 14)] = np.einsum(
                "nd,nd->n", unit[a[at:at + (1 << 14)]], unit[b[at:at + (1 << 14)]]) >= limit
        a, b = a[keep], b[keep]
        if len(a):
            # canopies of a vector below this one, as rows of a table: a pair with one in common was
            # compared there
            values, place = np.unique(flat, return_inverse=True)
            early = np.searchsorted(values, canopy)
            member = np.zeros((len(ids), early), bool)
            owner = np.repeat(np.arange(len(ids)), np.diff(ends))
            member[owner[place < early], place[place < early]] = True
            first = np.zeros(len(a), bool)
            for at in range(0, len(a), 1 << 14):
                first[at:at + (1 << 14)] = ~(member[a[at:at + (1 << 14)]]
                                             & member[b[at:at + (1 << 14)]]).any(axis=1)
            a, b = a[first], b[first]
        # a link to a class is one to each of its members
        copies = np.asarray(table["copies"])
        counts = np.bincount(np.concatenate([a, b]), np.concatenate([copies[b], copies[a]]),
                             len(ids)).astype(np.int64)
        linked = np.flatnonzero(counts)
        joined = _forest(ids[a], ids[b])
        return pa.table({
            "id": pa.array([*ids[linked], *[p for p, _ in joined]], pa.int64()),
            "n": pa.array([*counts[linked], *[0] * len(joined)], pa.int64()),
            "other": pa.array([*[None] * len(linked), *[q for _, q in joined]], pa.int64())})
    return compare


def embedding_links(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                    limit: float = LIMIT, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """``key``, n_links, component_id and kept, one row per row of ``vectors``.

    Two vectors are linked if their cosine is ``limit`` or more and they share a canopy; each
    such pair is confirmed in double precision.  ``component_id`` is the smallest key
    reachable by links.  Null, empty and zero vectors and those with null or non-finite
    components are linked with nothing, nor are vectors of different lengths.  ``key`` is a
    whole number; a row with a null key is linked with nothing, has a null component and is kept.
    Equal vectors are linked.  A repeated row (key and vector) counts once and gets its result each
    time; different vectors of one key are vectors of their own, with a count each and the component
    of all that either reaches.  An empty table gives no rows.  Other columns are not read.
    """
    mark = [F.xxhash64(F.lit(n), F.col(vector)).alias(f"mark{n}") for n in (1, 2)]
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), *mark)
    marks = ["mark1", "mark2"]
    usable = rows.where("id is not null and v is not null")
    # one row per different vector, told by 128 bits: the smallest id and how many ids have it
    grouped = usable.groupBy(*marks).agg(
        F.min("id").alias("least"), F.min_by("v", "id").alias("v"))
    sizes = usable.select(*marks, "id").distinct().groupBy(*marks).agg(F.count("*").alias("copies"))
    # a key may be the smallest of several vectors, so a class has a number of its own
    classes = staged(grouped.join(sizes, marks).withColumn("id", F.xxhash64("mark1", "mark2")))
    fields = [T.StructField("cells", T.ArrayType(T.LongType()))]
    hashed = staged(by_batch(classes, ["v"], fields, _hashes(tables, probes),
                             ["id", "v", "copies", "least", *marks], rows=2048))
    width = 1 + probes
    entries = hashed.select("id", F.posexplode("cells").alias("at", "cell"))
    homes = (entries.where(F.col("at") % width == 0).groupBy("cell")
             .agg(F.min("id").alias("pivot")))
    # members and guests of cells that are someone's own; cells only probed drop out, and
    # two vectors meet if one lies in its own cell where the other lies or probes
    placed = staged(entries.join(staged(homes), "cell").select("pivot", "id").distinct())
    many = placed.groupBy("pivot").agg(F.count("*").alias("n")).where("n > 1")
    many = staged(many.withColumnRenamed("pivot", "canopy"))
    placed = staged(placed.join(many, F.col("pivot") == F.col("canopy"))
                    .select("canopy", "n", "id"))
    lists = placed.groupBy("id").agg(F.array_sort(F.collect_set("canopy")).alias("canopies"))
    parts = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    facts = staged(hashed.select("id", "v", "copies").join(lists, "id"))  # at most tables * width canopies
    spread = (placed.withColumn("parts", parts)
              .withColumn("block", F.pmod(F.xxhash64("id", "canopy"), F.col("parts")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .join(facts, "id")
              .select("canopy", F.least("block", "other").alias("x"),
                      F.greatest("block", "other").alias("y"), "block", "id", "v", "copies", "canopies"))
    found = staged(spread.groupBy("canopy", "x", "y").applyInArrow(
        _compare(limit), "id long, n long, other long"))
    counts = found.where("other is null").groupBy(F.col("id").alias("c")).agg(F.sum("n").alias("n"))
    linked = hashed.where(F.size("cells") > 0).select("id", "copies", "least", *marks)
    linked = staged(linked.join(counts, F.col("id") == F.col("c"), "left").select(
        "id", "least", *marks, (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n")))
    # components over keys: links of classes, and of each key with the least one of its class
    least = linked.select("id", "least")
    edges = found.where("other is not null").select(F.col("id").alias("p"), F.col("other").alias("q"))
    named = (edges.join(least.select(F.col("id").alias("p"), F.col("least").alias("a")), "p")
             .join(least.select(F.col("id").alias("q"), F.col("least").alias("b")), "q").select("a", "b"))
    held = usable.join(linked.select(*marks, "least", "n"), marks)
    copies = held.where("id != least").select(F.col("id").alias("a"), F.col("least").alias("b")).distinct()
    several = usable.select("id", *marks).distinct().groupBy("id").count().where("count > 1").limit(1).count()
    links = named.unionByName(copies) if several else named
    group = staged(components(links))
    group = group.select(F.col("id").alias("g"), "component")
    told = linked.select(*[F.col(m).alias(f"c_{m}") for m in marks], "least", "n")
    result = rows.select("id", *marks).join(
        told, (F.col("mark1") == F.col("c_mark1")) & (F.col("mark2") == F.col("c_mark2"))
        & F.col("id").isNotNull(), "left")
    # where every key has one vector, copies share the component of their least key
    reached = F.col("id") if several else F.coalesce("least", "id")
    result = result.withColumn("r", reached).join(group, F.col("r") == F.col("g"), "left")
    component = F.when(F.col("least").isNotNull(), F.coalesce("component", "r")).otherwise(
        F.coalesce("component", "id") if several else F.col("id"))
    return result.select(F.col("id").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"),
                         F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
