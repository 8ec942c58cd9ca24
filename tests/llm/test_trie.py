"""The prefix trie against a plain dictionary of prefixes, and the radix tree itself."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from duebook.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"


def turn_id(role, text):
    said = f"{len(role or '')}:{role or ''}{text or ''}"
    return hashlib.sha256(said.encode()).hexdigest()


def expected(rows):
    """Nodes by their sequence of turns: a set of members each, no tree."""
    original = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            original[conv].append((turn is not None, turn or 0, turn_id(role, text), role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in original.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    found = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        kids = {n for n in below if len(n) == len(node) + 1}
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        found.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids),
            sum(not any(len(m) > len(n) and m[:len(n)] == n for m in below) for n in below),
            sum((len(members[n]) - 1) * len(re.findall("[^\x20\x09-\x0d]+", n[-1][1])) for n in below if n),
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


def conversations(seed, convs=160, vocabulary=4, longest=9):
    draw = random.Random(seed)
    said = ["", None, "a", "two words", "Straße  und\tmehr\n", "x" * 5_000, "0", "y z"][:vocabulary + 2]
    rows = []
    for c in draw.sample(range(-100, 400), convs):
        for turn in range(draw.randrange(1, longest)):
            rows.append((c, turn, draw.choice(["user", None, ""]), draw.choice(said)))
    rows += [(None, 0, "user", "no conversation"), (5_001, None, "user", "null turn"), (5_001, 0, None, "b"),
             (5_002, 1, "user", "a"), (5_002, 1, "user", "a"), (5_002, 1, "user", "b")]
    rows += [(6_000, t, "user", "deep") for t in range(40)] + [(6_020, t, "user", "deep") for t in range(33)]
    rows += [(6_040, t, "user", "deep") for t in range(6)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("depth,block", [(trie.DEPTH, trie.BLOCK), (3, 8), (trie.DEPTH, 5), (2, 1)])
def test_nodes_equal_brute_force(spark, monkeypatch, depth, block):
    """Also with segments and trees so small that most nodes are shared by several of them."""
    monkeypatch.setattr(trie, "DEPTH", depth)
    rows = conversations(depth + block)
    if depth < 9:
        rows = [r for r in rows if (r[0] or 0) < 6_000 or r[1] < 9]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for extra in ("conv", "key", "end", "children", "part"):
        frame = frame.withColumn(extra, F.lit("clash"))
    found = trie.prefix_trie(frame, block=block)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(empty).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)).collect() == []


def test_conversations_without_turns_end_at_the_root(spark):
    """All ids whose head is longer than they are, without a base."""
    ids = [c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 >= 1]
    rows = [(c, 0, "user", "only") for c in ids]
    found = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(r) for r in found] == expected(rows)
    assert found[0].depth == 0 and found[0].n_convs == len(ids) and found[0].n_leaves == 1


def test_tree_layouts_and_paths():
    """Nodes grow from 4 over 16 and 48 to 256 children, keep their order and compress paths."""
    for n, kind in ((4, trie.Few), (16, trie.Few), (48, trie.Indexed), (49, trie.Full), (256, trie.Full)):
        keys = [bytes([b]) + b"rest" * 4 for b in range(n)]
        shuffled = random.Random(n).sample(keys, n)
        kids = trie.tree(shuffled).kids
        assert isinstance(kids, kind)
        assert [k.path for k in kids.ordered()] == keys
        assert all(k.end == 17 and not k.kids.ordered() for k in kids.ordered())
    root = trie.tree([b"abcdef", b"abcxyz", b"abc", b"abcdeg"])
    top, = root.kids.ordered()
    assert (top.path, top.value) == (b"abc", 2)
    assert [k.path for k in top.kids.ordered()] == [b"de", b"xyz"]
    assert trie.common(b"", b"abc") == 0 and trie.common(b"abd", b"abc") == 2
    assert trie.common(b"\0\0", b"\0\0\1") == 2 and trie.common(b"\0\1", b"\1\1") == 0


def test_hash_of_ends_over_many_pieces(spark):
    ids = [*range(-70_000, 70_000, 7), 1 << 40]
    rows = spark.createDataFrame([(0, i, b"k", [], b"e", True) for i in ids], trie.SEGMENT).repartition(7)
    found, = trie.end_hashes(rows).collect()
    assert found.sha == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
