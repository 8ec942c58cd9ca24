"""Near-duplicates by b-bit MinHash.

1. Per text: a hash of its whole shingle set, 128 minima, of which each keeps its low four
   bits, packed into eight longs, and 32 band keys of four full minima each.
2. Texts with equal sets are one class; only its smallest id goes on.
3. Ids that share a band form buckets.  Buckets of the same members count once.  The smallest
   id of a bucket is its pivot; all buckets of one pivot make a canopy, so that two ids that
   share a bucket share a canopy.
4. All members of a canopy are compared with its pivot: first the packed bits
   (collision-corrected similarity by bit counts), then, if the estimate is not more than
   five deviations below the limit, the full sets.  Links make components; a canopy whose
   members are in one component is done.
5. In the others the pairs of different components are compared in the same way, block by
   block: a canopy is cut into blocks of a few hundred members and each pair of blocks is a
   task of its own that gives back a spanning forest of the links it finds, no pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import WordHasher, by_batch, list_array, numbered, splitmix, staged, texts_of
from .components import components

MINIMA = 128
BITS = 4
ROWS = 4                  # minima per band: 0.41 of the bands of a pair at 0.8 agree, of 32
BANDS = MINIMA // ROWS
SLACK = 0.2               # five deviations of the estimate at similarity 0.8
BLOCK = 256               # members of a block
CELLS = 4_096             # shingles that are counted at once in a block

_LONGS = T.ArrayType(T.LongType())


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle, no words none."""
    width = min(size, len(words))
    if not width:
        return words
    total = np.full(len(words) - width + 1, width, np.uint64)
    for n in range(width):
        total = splitmix(total * np.uint64(0x9E3779B97F4A7C15) + words[n:len(words) - width + 1 + n])
    return np.unique(total)


def _mix32(x: np.ndarray) -> np.ndarray:
    x = x * np.uint32(0x85EBCA6B)
    return x ^ (x >> np.uint32(15))


def minima(hashes: np.ndarray, seeds: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """128 minima of 32-bit hashes, by pieces of bounded size."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 1024):
        x = (short[at:at + 1024, None] ^ seeds) * odd
        x ^= x >> np.uint32(15)
        np.minimum(best, x.min(axis=0), out=best)
    return best


def pack(best: np.ndarray) -> np.ndarray:
    """Low bits of the mixed minima, sixteen to a long."""
    low = (_mix32(best) & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, 64 // BITS)
    shifts = (np.arange(64 // BITS) * BITS).astype(np.uint64)
    return np.bitwise_or.reduce(low << shifts, axis=1)


def _signer(size: int):
    hasher = WordHasher(lower=True)
    draw = np.random.default_rng(20)
    seeds = draw.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
    odd = draw.integers(0, 1 << 31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    band = splitmix(np.arange(1, BANDS + 1, dtype=np.uint64))

    def sign(column: pa.Array) -> list[pa.Array]:
        counts, sets, keys, packed = [], [], [], []
        for text in texts_of(column):
            found = shingle_hashes(hasher(text or b""), size)
            counts.append(len(found))
            if not len(found):
                sets.append(None)
                keys.append(np.empty(0, np.int64))
                packed.append(np.empty(0, np.int64))
                continue
            mixed = splitmix(found)
            order = np.array([found.sum(dtype=np.uint64), mixed.sum(dtype=np.uint64)])
            sets.append(order.tobytes())
            best = minima(found, seeds, odd)
            key = band.copy()
            for row in best.reshape(BANDS, ROWS).T:
                key = splitmix(key ^ row)
            keys.append(key.view(np.int64))
            packed.append(pack(best).view(np.int64))
        return [pa.array(counts, pa.int64()), pa.array(sets, pa.binary()),
                list_array(keys, pa.int64()), list_array(packed, pa.int64())]
    return sign


def signatures(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """id, n_shingles, set_hash, bands, bits; the last three are null or empty without words."""
    fields = [T.StructField("n_shingles", T.LongType()), T.StructField("set_hash", T.BinaryType()),
              T.StructField("bands", _LONGS), T.StructField("bits", _LONGS)]
    return by_batch(docs, [text], fields, _signer(size), [key]).withColumnRenamed(key, "id")


def shingle_sets(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    hasher = WordHasher(lower=True)

    def sets(column: pa.Array) -> list[pa.Array]:
        return [list_array([shingle_hashes(hasher(t or b""), size).view(np.int64)
                            for t in texts_of(column)], pa.int64())]
    found = by_batch(docs, [text], [T.StructField("shingles", _LONGS)], sets, [key])
    return found.withColumnRenamed(key, "id")


def similarity(a: Column, b: Column) -> Column:
    """Similarity estimated from two packed signatures, corrected for chance agreement.

    Agreeing groups of four bits are counted: the xor is folded so that one bit per group
    tells a difference.
    """
    def agreeing(total: Column, x: Column) -> Column:
        for step in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
        return total + F.lit(64 // BITS) - F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    agree = F.aggregate(F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y)), F.lit(0), agreeing)
    chance = 1 / (1 << BITS)
    return (agree / F.lit(float(MINIMA)) - F.lit(chance)) / F.lit(1 - chance)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` whose full sets meet the limit."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - shared
    return both.where(shared * 100 >= union * percent).select("a", "b")


def _shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``a`` with all of ``b``."""
    values, place = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    often = np.bincount(place, minlength=len(values)) > 1
    rank = np.where(often, np.cumsum(often) - 1, -1)
    place, width = rank[place], int(often.sum())
    owner = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in [*a, *b]])
    owner, place = owner[place >= 0], place[place >= 0]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    total = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, width, CELLS):
        lo, hi = np.searchsorted(place, [at, at + CELLS])
        grid = np.zeros((len(a) + len(b), min(CELLS, width - at)), np.float32)
        grid[owner[lo:hi], place[lo:hi] - at] = 1
        total += grid[:len(a)] @ grid[len(a):].T
    return total.astype(np.int64)


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``similarity`` of all rows of ``a`` with all of ``b``."""
    agree = np.zeros((len(a), len(b)), np.int32)
    for n in range(a.shape[1]):
        x = a[:, None, n] ^ b[None, :, n]
        for step in (1, 2):
            x |= x >> np.uint64(step)
        agree += 64 // BITS - np.bitwise_count(x & np.uint64(0x1111111111111111)).astype(np.int32)
    chance = 1 / (1 << BITS)
    return (agree / MINIMA - chance) / (1 - chance)


def _forest(links: np.ndarray) -> np.ndarray:
    """Links that join what the ones before have not joined yet."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x
    kept = []
    for a, b in links.tolist():
        x, y = root(a), root(b)
        if x != y:
            parent[x] = y
            kept.append((a, b))
    return np.array(kept, np.int64).reshape(-1, 2)


def _runs(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and where each row's begin and end."""
    whole = column.combine_chunks()
    ends = np.asarray(whole.offsets)
    return np.asarray(whole.flatten()), ends - ends[0]


def _members(flat: np.ndarray, ends: np.ndarray, below: int) -> np.ndarray:
    """Rows by values less than ``below``: 1 where the row holds the value."""
    values, place = np.unique(flat, return_inverse=True)
    count = int(np.searchsorted(values, below))
    member = np.zeros((len(ends) - 1, count), np.float32)
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    member[owner[place < count], place[place < count]] = 1
    return member


def _block_links(rows: DataFrame, bits: DataFrame, sets: DataFrame, percent: int,
                 least: float) -> DataFrame:
    """Links between different components of a canopy, a spanning forest per pair of blocks."""
    parts = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("id", "canopy"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    lists = rows.groupBy("id").agg(F.array_sort(F.collect_set("canopy")).alias("canopies"))
    facts = staged(lists.join(bits, "id").join(sets, "id"))     # a canopy per band at most
    spread = (rows.withColumn("parts", parts).withColumn("own", own)
              .withColumn("other", other).join(facts, "id")
              .select("canopy", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                      "own", "id", "component", "bits", "shingles", "canopies"))

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        canopy, x, y = (k.as_py() for k in key)
        own = np.asarray(table["own"])
        ids, group = np.asarray(table["id"]), np.asarray(table["component"])
        packed = np.asarray(table["bits"].combine_chunks().flatten()).view(np.uint64)
        packed = packed.reshape(-1, MINIMA * BITS // 64)
        flat, ends = _runs(table["shingles"])
        one, two = np.flatnonzero(own == x), np.flatnonzero(own == y)
        found = _agreeing(packed[one], packed[two]) >= least
        found &= group[one][:, None] != group[two][None, :]
        if x == y:
            found &= ids[one][:, None] < ids[two][None, :]
        # a pair with an earlier canopy in common is compared there
        early = _members(*_runs(table["canopies"]), canopy)
        found &= early[one] @ early[two].T == 0
        one, two = one[found.any(axis=1)], two[found.any(axis=0)]
        links = np.empty((0, 2), np.int64)
        if len(one):
            found = found[found.any(axis=1)][:, found.any(axis=0)]
            size = np.diff(ends)
            shared = _shared_counts([flat[ends[n]:ends[n + 1]] for n in one],
                                    [flat[ends[n]:ends[n + 1]] for n in two])
            union = size[one][:, None] + size[two][None, :] - shared
            a, b = np.nonzero(found & (100 * shared >= percent * union))
            links = _forest(np.stack([ids[one[a]], ids[two[b]]], axis=1))
        return pa.table({"a": pa.array(links[:, 0], pa.int64()), "b": pa.array(links[:, 1], pa.int64())})
    return staged(spread.groupBy("canopy", "x", "y").applyInArrow(compare, "a long, b long"))


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5,
                percent: int = 80) -> DataFrame:
    """``key``, n_shingles, class_id, component_id and kept, one row per document.

    Two documents are linked if their sets of ``size``-word shingles (words lower-cased A-Z;
    a shorter text is one shingle) have a Jaccard similarity of ``percent`` percent or more.
    ``component_id`` is the smallest key reachable by links; ``kept`` marks that document.
    Null, empty and blank texts have no shingles and are linked with nothing.  ``key`` is a
    whole number; rows that repeat a key all get its result, a row with a null key is kept and
    linked with nothing.  Other columns are not read.  An empty table gives no rows.
    """
    docs = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text))
    signed = staged(signatures(docs, key, text, size))
    classes = staged(signed.where("set_hash is not null and id is not null").groupBy("set_hash")
                     .agg(F.min("id").alias("class_id")))
    known = (signed.select("id", "n_shingles", "set_hash")
             .join(classes, "set_hash", "left").drop("set_hash")
             .withColumn("class_id", F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id"))))
    known = staged(known)
    first = known.where("id = class_id and n_shingles > 0").select("id").distinct()
    banded = signed.join(first, "id").select("id", F.explode("bands").alias("band"))
    buckets = (banded.groupBy("band")
               .agg(F.count("*").alias("n"), F.min("id").alias("pivot"),
                    F.sum(F.xxhash64("id") % (1 << 40)).alias("mark"))
               .where("n > 1").dropDuplicates(["n", "pivot", "mark"]))
    buckets = staged(buckets.select("band", "pivot"))
    members = staged(banded.join(buckets.select("band"), "band"))
    involved = staged(members.select("id").distinct())
    bits = staged(signed.select("id", "bits").join(involved, "id"))
    sets = staged(shingle_sets(docs.join(involved, docs[key] == involved["id"], "left_semi"),
                               key, text, size))

    least = percent / 100 - SLACK
    left = bits.withColumnsRenamed({"id": "a", "bits": "bits_a"})
    right = bits.withColumnsRenamed({"id": "b", "bits": "bits_b"})
    canopies = staged(members.join(buckets, "band").select("pivot", "id").distinct())
    pairs = canopies.where("id != pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b"))
    near = staged(pairs.join(right, "b").join(left, "a")
                  .where(similarity(F.col("bits_a"), F.col("bits_b")) >= least).select("a", "b"))
    links = staged(_verified(near, sets, percent))
    group = staged(components(links))

    placed = staged(canopies.join(group, "id", "left")
                    .withColumn("component", F.coalesce("component", "id")))
    still = staged(placed.groupBy("pivot").agg(F.min("component").alias("lo"),
                                               F.max("component").alias("hi"), F.count("*").alias("n"))
                   .where("lo != hi").select(F.col("pivot").alias("canopy"), "n"))
    open_rows = staged(placed.join(still, F.col("pivot") == F.col("canopy"))
                       .select("canopy", "n", "id", "component"))
    if not open_rows.isEmpty():
        links = links.union(_block_links(open_rows, bits, sets, percent, least))
        group = staged(components(links))
    named = group.select(F.col("id").alias("class_id"), F.col("component").alias("component_id"))
    result = known.join(named, "class_id", "left").withColumn(
        "component_id", F.coalesce("component_id", "class_id"))
    return result.select(F.col("id").alias(key), "n_shingles", "class_id", "component_id",
                         F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5,
               percent: int = 80) -> DataFrame:
    """The documents without those that repeat an earlier one, all columns as they are."""
    plain, names = numbered(docs)
    groups = near_groups(plain.select(names[key], names[text]), names[key], names[text], size, percent)
    dropped = groups.where("not kept").select(F.col(names[key]).alias("dropped"))
    kept = plain.join(dropped, plain[names[key]] == F.col("dropped"), "left_anti")
    return kept.toDF(*docs.columns)
