"""Prefix trie of conversations by adaptive radix trees.

1. A turn becomes a fixed-width big-endian id: 16 bytes of the SHA-256 of role and text.
2. Conversations that share a base meet in one sorted stream, which rebuilds them turn by turn
   and cuts them into segments of ``DEPTH`` turns.  A key is the id of the node the segment
   hangs from and the ids of its turns, so its size is bounded however long a conversation is.
3. Equal keys are counted before anything else, so copies weigh as much as one key.
4. The distinct keys are dealt into ranges and sorted.  Each task reads its range as a stream
   and builds one adaptive radix tree per block of ``BLOCK`` turns: nodes of 4, 16, 48 or 256
   children that grow as needed, unary chains compressed to one path.  Nodes of the result are
   the byte depths that are whole turns.
5. Blocks share only the nodes on the way to their first and last key.  How far those are shared
   is known from the neighbouring keys; each shared node is counted by the last block that has
   it, members and sums are added up over the blocks.  All other nodes are complete at once.
6. Deeper segments come first; what hangs below the end of a segment is added to its key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import by_batch, staged, words
from pyspark.sql import types as T

ID = 16                  # bytes of a turn id
ROOT = bytes(ID)         # id of the node without turns
DEPTH = 4_096            # turns of a segment
BLOCK = 65_536           # turns of the keys of one tree
HEADS = 3                # most turns taken from the base
FAMILY = 20              # conversations c to c + 19 take the base c


# --- the tree --------------------------------------------------------------------------------

class Few:
    """Up to 4 or 16 children: their first bytes in order, and the children beside."""

    __slots__ = ("size", "bytes", "kids")

    def __init__(self, size: int = 4):
        self.size, self.bytes, self.kids = size, bytearray(), []

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, kid):
        at = self.bytes.find(byte)
        if at >= 0:
            self.kids[at] = kid
            return self
        if len(self.kids) == self.size:
            grown = Few(16) if self.size == 4 else Indexed()
            for old, its in zip(self.bytes, self.kids):
                grown.put(old, its)
            return grown.put(byte, kid)
        at = 0
        while at < len(self.bytes) and self.bytes[at] < byte:
            at += 1
        self.bytes.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def ordered(self) -> list:
        return self.kids


class Indexed:
    """Up to 48 children, found by an index of 256 bytes."""

    __slots__ = ("index", "kids")

    def __init__(self):
        self.index, self.kids = bytearray(256), []

    def get(self, byte: int):
        at = self.index[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid):
        at = self.index[byte]
        if at:
            self.kids[at - 1] = kid
            return self
        if len(self.kids) == 48:
            full = Full()
            for old in range(256):
                if self.index[old]:
                    full.put(old, self.get(old))
            return full.put(byte, kid)
        self.kids.append(kid)
        self.index[byte] = len(self.kids)
        return self

    def ordered(self) -> list:
        return [self.kids[at - 1] for at in self.index if at]


class Full:
    """A slot for each of the 256 bytes."""

    __slots__ = ("slots",)

    def __init__(self):
        self.slots = [None] * 256

    def get(self, byte: int):
        return self.slots[byte]

    def put(self, byte: int, kid):
        self.slots[byte] = kid
        return self

    def ordered(self) -> list:
        return [kid for kid in self.slots if kid is not None]


class Node:
    """A branching or a key's end: the compressed path to it, and its byte depth."""

    __slots__ = ("path", "end", "value", "kids")

    def __init__(self, path: bytes, end: int, value: int = -1):
        self.path, self.end, self.value, self.kids = path, end, value, Few()


def common(a: bytes, b: bytes) -> int:
    """Bytes that two strings have in common from their start."""
    size = min(len(a), len(b))
    differ = int.from_bytes(a[:size]) ^ int.from_bytes(b[:size])
    return size - (differ.bit_length() + 7) // 8


def insert(root: Node, key: bytes, value: int) -> None:
    node, at = root, 0
    while at < len(key):
        kid = node.kids.get(key[at])
        if kid is None:
            node.kids = node.kids.put(key[at], Node(key[at:], len(key), value))
            return
        if not key.startswith(kid.path, at):
            same = common(kid.path, key[at:at + len(kid.path)])
            upper = Node(kid.path[:same], at + same)
            kid.path = kid.path[same:]
            upper.kids = upper.kids.put(kid.path[0], kid)
            node.kids = node.kids.put(key[at], upper)
            kid = upper
        node, at = kid, kid.end
    node.value = value


def tree(keys: list[bytes]) -> Node:
    root = Node(b"", 0)
    for n, key in enumerate(keys):
        insert(root, key, n)
    return root


def _ids(key: bytes, size: int) -> list[bytes]:
    """Ids of the nodes on the way to a key, down to a byte depth; the first is the key's own."""
    found, digest = [key[:ID]], hashlib.sha256(key[:ID])
    for at in range(ID, size, ID):
        digest.update(key[at:at + ID])
        found.append(digest.digest()[:ID])
    return found


FIELDS = {"rel": pa.int64(), "conv": pa.int64(), "n": pa.int64(), "children": pa.int64(),
          "leaves": pa.int64(), "saved": pa.int64(), "sha": pa.string(), "id": pa.binary(),
          "open": pa.bool_(), "parent": pa.int64(), "parent_id": pa.binary()}
NODE = ("rel long, conv long, n long, children long, leaves long, saved long, sha string, "
        "id binary, open boolean, parent long, parent_id binary")


def block_nodes(rows: list[tuple], back: int, ahead: int, first_layer: bool) -> list[list]:
    """Nodes of the tree over a block of sorted keys, as columns in the order of ``FIELDS``.

    A row is (key, words per turn, members, smallest member, hash of the ends, and children,
    leaves and saved words below the key).  ``back`` and ``ahead`` are the bytes that the first
    key shares with the one before the block, and the last with the one after it.
    """
    keys = [r[0] for r in rows]
    last = len(rows) - 1
    back_ids, ahead_ids = _ids(keys[0], back), _ids(keys[-1], ahead)
    order, above, stack = [], [], [(tree(keys), -1)]
    while stack:
        node, parent = stack.pop()
        stack += [(kid, len(order)) for kid in reversed(node.kids.ordered())]
        order.append(node)
        above.append(parent)
    size = len(order)
    n, least, low, high = [0] * size, [None] * size, [last] * size, [0] * size
    tops, leaves, saved = [0] * size, [0] * size, [0] * size
    bottom, top = [-1] * size, [-1] * size
    out: list[list] = [[] for _ in FIELDS]
    add = [column.append for column in out]
    for at in range(size - 1, 0, -1):            # children before their parents
        node, value = order[at], order[at].value
        if value >= 0:
            _, _, members, smallest, _, more_tops, more_leaves, more_saved = rows[value]
            n[at] += members
            least[at] = smallest if least[at] is None else min(smallest, least[at])
            low[at], high[at] = min(value, low[at]), max(value, high[at])
            tops[at] += more_tops
            leaves[at] += more_leaves
            saved[at] += more_saved
        start, depth = node.end - len(node.path), node.end // ID * ID
        if depth > start:
            bottom[at] = len(out[0])
            counts = rows[low[at]][1]
            end_hash = rows[value][4] if value >= 0 else None
            while depth > start:
                rel = depth // ID - 1
                after = high[at] == last and depth <= ahead
                before = low[at] == 0 and depth <= back
                if not tops[at] and not after and (rel or first_layer):
                    leaves[at] = 1
                if rel:
                    saved[at] += int(counts[rel - 1]) * (n[at] - (not after))
                shared = after or before
                own_id = (ahead_ids[rel] if after else back_ids[rel] if before
                          else None if rel else keys[low[at]][:ID])
                for put, item in zip(add, (rel, least[at], n[at], tops[at], leaves[at], saved[at],
                                           end_hash if depth == node.end else None, own_id, shared)):
                    put(item)
                tops[at] = 0 if after else 1
                top[at] = len(out[0]) - 1
                depth -= ID
        up = above[at]
        n[up] += n[at]
        least[up] = least[at] if least[up] is None else min(least[at], least[up])
        low[up], high[up] = min(low[at], low[up]), max(high[at], high[up])
        tops[up] += tops[at]
        leaves[up] += leaves[at]
        saved[up] += saved[at]
    # the parent of a node is the next one on its path, or the lowest one above its tree node
    parent_of = list(range(1, len(out[0]) + 1))
    nearest = [-1] * size
    for at in range(1, size):
        up = above[at]
        nearest[at] = bottom[up] if bottom[up] >= 0 else nearest[up]
        if top[at] >= 0:
            parent_of[top[at]] = nearest[at]
    _, conv, *_, ident, shared = out[:9]
    out[9] = [conv[p] if p >= 0 and not shared[p] else None for p in parent_of]
    out[10] = [ident[p] if p >= 0 and shared[p] else None for p in parent_of]
    return out


# --- conversations as keys ---------------------------------------------------------------------

SEGMENT = "layer int, conv long, key binary, words array<long>, end binary, last boolean"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rebuilt conversations as segments, from turns sorted by base, base first, and turn."""
    found: list[list] = [[] for _ in range(6)]
    heads: list[tuple[bytes, int]] = []
    state = {"base": None, "conv": None, "skip": 0, "prefix": ROOT, "layer": 0, "size": 0}
    ids, counts = [], []

    def cut(last: bool) -> None:
        key = b"".join([state["prefix"], *ids])
        end = hashlib.sha256(key).digest()[:ID] if ids else state["prefix"]
        for column, item in zip(found, (state["layer"], state["conv"], key, list(counts), end, last)):
            column.append(item)
        state["size"] += len(key)
        state["prefix"] = end
        state["layer"] += 1
        ids.clear()
        counts.clear()

    def push(ident: bytes, count: int) -> None:
        ids.append(ident)
        counts.append(count)
        if len(ids) == DEPTH:
            cut(False)

    def given() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(found[0], pa.int32()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.binary()),
             pa.array(found[3], pa.list_(pa.int64())), pa.array(found[4], pa.binary()),
             pa.array(found[5], pa.bool_())], ["layer", "conv", "key", "words", "end", "last"])
        for column in found:
            column.clear()
        state["size"] = 0
        return batch

    for batch in batches:
        for base, conv, head, ident, count in zip(*[c.to_pylist() for c in batch.columns]):
            if conv != state["conv"]:
                if state["conv"] is not None:
                    cut(True)
                if base != state["base"]:
                    heads.clear()
                state.update(base=base, conv=conv, prefix=ROOT, layer=0, skip=0)
                if conv != base:
                    state["skip"] = head
                    for turn in heads[:head]:
                        push(*turn)
                if state["size"] > 1 << 23:
                    yield given()
            if conv == base and len(heads) < HEADS:
                heads.append((ident, count))
            if state["skip"]:
                state["skip"] -= 1
            else:
                push(ident, count)
                if state["size"] > 1 << 23:
                    yield given()
    if state["conv"] is not None:
        cut(True)
        yield given()


def segments(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """All rebuilt conversations, cut into segments."""
    c = F.col("conv")
    said, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    digest = F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256)
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.unhex(F.substring(digest, 1, 2 * ID)).alias("ident"),
        F.size(words(said)).alias("count"))
    rows = rows.select((c - c % FAMILY).alias("base"), "conv",
                       (F.crc32(c.cast("string").cast("binary")) % 4).cast("int").alias("head"),
                       "ident", "count", "turn")
    dealt = rows.repartition("base").sortWithinPartitions(
        "base", F.when(c == F.col("base"), 0).otherwise(1), "conv", F.col("turn").asc_nulls_first(), "ident")
    return dealt.select("base", "conv", "head", "ident", "count").mapInArrow(_segments, SEGMENT)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lists of one end, which come piece by piece in order."""
    current, digest = None, None
    for batch in batches:
        ends, hashes = [], []
        for end, piece in zip(*[c.to_pylist() for c in batch.columns]):
            if end != current:
                if digest is not None:
                    ends.append(current)
                    hashes.append(digest.hexdigest())
                current, digest = end, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array(ends, pa.binary()), pa.array(hashes, pa.string())],
                                         ["end", "sha"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()),
                                          pa.array([digest.hexdigest()], pa.string())], ["end", "sha"])


def end_hashes(found: DataFrame) -> DataFrame:
    """end, sha: over the sorted ids of the conversations that end at a node.

    Ids are sorted and joined in pieces of at most 65,536 numbers in parallel; what goes over the
    pieces of a node in order is the hash alone.
    """
    pieces = found.where("last").groupBy("end", F.shiftright("conv", 16).alias("slot")).agg(
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("piece"))
    return (pieces.repartition("end").sortWithinPartitions("end", "slot").select("end", "piece")
            .mapInArrow(_hash_ends, "end binary, sha string"))


# --- trees over ranges of keys -------------------------------------------------------------------

def _trees(first_layer: bool, block: int):
    names = list(FIELDS)

    def given(rows, back, ahead):
        columns = block_nodes(rows, back // ID * ID, ahead // ID * ID, first_layer)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, FIELDS.values())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        part, turns, shared, edge = None, 0, 0, 0    # edge: shared with the next range
        for batch in batches:
            for number, back, ahead, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if rows and (number != part or turns + len(row[1]) > block):
                    reach = common(rows[-1][0], row[0]) if number == part else edge
                    yield given(rows, shared, reach)
                    rows, turns = [], 0
                    shared = reach if number == part else back
                if number != part:
                    part, shared, edge = number, back, ahead
                rows.append(tuple(row))
                turns += len(row[1]) + 1
        if rows:
            yield given(rows, shared, edge)
    return run


def _layer_nodes(spark, keys: DataFrame, first_layer: bool, block: int) -> DataFrame:
    """Nodes of the trees over all keys of a layer, with those shared by blocks still in parts."""
    ranged = staged(keys.repartitionByRange("key").withColumn("part", F.spark_partition_id()))
    edges = ranged.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    edges = staged(edges)
    # numbers of the ranges only, at most as many as there are partitions
    numbers = sorted(r.part for r in edges.select("part").collect())
    pairs = spark.createDataFrame([*zip(numbers, numbers[1:])], "part int, next int")
    beyond = edges.select(F.col("part").alias("next"), F.col("low").alias("beyond"))
    meet = edges.join(pairs, "part").join(beyond, "next").select("part", "next", "high", "beyond")

    def shared(high: pa.Array, low: pa.Array) -> list[pa.Array]:
        return [pa.array([common(a, b) for a, b in zip(high.to_pylist(), low.to_pylist())], pa.int32())]
    meet = staged(by_batch(meet, ["high", "beyond"], [T.StructField("n", T.IntegerType())], shared,
                           ["part", "next"]))
    ahead = meet.select("part", F.col("n").alias("ahead"))
    back = meet.select(F.col("next").alias("part"), F.col("n").alias("back"))
    zero = F.lit(0)
    placed = (ranged.join(ahead, "part", "left").join(back, "part", "left")
              .select("part", F.coalesce("back", zero).alias("back"), F.coalesce("ahead", zero).alias("ahead"),
                      "key", "words", "n", "least", "sha", "children", "leaves", "saved"))
    placed = placed.repartition("part").sortWithinPartitions("part", "key")
    return staged(placed.mapInArrow(_trees(first_layer, block), NODE))


def prefix_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256, the hash of the ids of the members that end there.

    Turns without a conversation id take no part.  A null role or text counts as empty, a null
    turn number comes first; turns of equal number are in the order of their ids, repeated
    rows are turns of their own.  A conversation may end up without turns and then ends at the
    root.  An empty table gives no node.  Other columns are not read.  ``conv`` is a whole
    number.  Turns are told apart by 128 bits of SHA-256.
    """
    spark = turns.sparkSession
    found = staged(segments(turns, conv, turn, role, text))
    grouped = found.groupBy("layer", "end").agg(
        F.count("*").alias("n"), F.min("conv").alias("least"), F.first("key").alias("key"),
        F.first("words").alias("words"))
    keys = staged(grouped.join(end_hashes(found), "end", "left"))
    layers = keys.agg(F.max("layer")).first()[0]
    result, below = None, None
    none = F.lit(0).cast("long")
    for layer in range(-1 if layers is None else layers, -1, -1):
        rows = keys.where(F.col("layer") == layer)
        if below is None:
            rows = rows.withColumns({"children": none, "leaves": none, "saved": none})
        else:
            rows = rows.join(below, "end", "left").withColumns(
                {c: F.coalesce(c, none) for c in ("children", "leaves", "saved")})
        nodes = _layer_nodes(spark, rows.drop("layer", "end"), layer == 0, block)
        sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
        merged = staged(nodes.where("open").groupBy("id").agg(
            F.first("rel").alias("rel"), F.min("conv").alias("conv"), *sums, F.max("sha").alias("sha"),
            F.max("parent").alias("parent"), F.max("parent_id").alias("parent_id")))
        every = nodes.where("not open").drop("open").unionByName(merged)
        below = every.where("rel = 0").select(F.col("id").alias("end"), "children", "leaves", "saved")
        shown = every if layer == 0 else every.where("rel > 0")
        upper = merged.select(F.col("id").alias("upper"), F.col("conv").alias("upper_conv"))
        joined = (shown.where("parent_id is not null").join(upper, F.col("parent_id") == F.col("upper"))
                  .withColumn("parent", F.col("upper_conv")).drop("upper", "upper_conv"))
        shown = shown.where("parent_id is null").unionByName(joined).withColumn(
            "depth", F.col("rel") + layer * DEPTH)
        result = shown if result is None else result.unionByName(shown)
    if result is None:
        result = spark.createDataFrame([], NODE + ", depth long")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return result.select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
        F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("sha", nothing).alias("ends_sha256"))
