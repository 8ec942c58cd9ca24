"""Near-duplicate operators against brute force, on small frames with all odd cases."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from duebook.llm import lattice, minhash
from duebook.llm.components import components

VOCABULARY = [f"w{n}" for n in range(400)]


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]


def shingles(text, size):
    ws = words_of(text)
    width = min(size, len(ws))
    return {tuple(ws[i:i + width]) for i in range(len(ws) - width + 1)} if ws else set()


def grouped(ids, links):
    group = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(group[a], group[b])
            if (group[a], group[b]) != (low, low):
                group[a] = group[b] = low
                changed = True
    return group


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies around the limit, chains, short, empty and null texts, one very long."""
    draw = random.Random(5)
    found = []
    for _ in range(12):
        base = [draw.choice(VOCABULARY) for _ in range(draw.randrange(20, 120))]
        found += [base, list(base)]
        for share in (0.01, 0.02, 0.03, 0.05, 0.08):
            copy = [draw.choice(VOCABULARY) if draw.random() < share else w for w in base]
            found.append(copy)
        found.append(base[:len(base) * 5 // 6])
    rows = [" ".join(ws) for ws in found]
    rows += [None, "", " \t\n ", "One", "one", "one two", "ONE\ttwo", "one two three four",
             "É a b c", "é a b c", "long " * 30_000]
    return list(enumerate(rows, 1))


@pytest.mark.parametrize("size", [4, 5])
def test_groups_equal_brute_force(spark, texts, size):
    sets = {i: shingles(t, size) for i, t in texts}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = grouped(sets, links)
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("id", F.lit("x"))
    found = {r.doc_id: r for r in minhash.near_groups(docs, size=size).collect()}
    assert {i: r.component_id for i, r in found.items()} == want
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(s) for i, s in sets.items()}
    assert {i for i, r in found.items() if r.kept} == {i for i, c in want.items() if i == c}


def test_open_pairs_of_a_large_group_in_blocks(spark, monkeypatch):
    """Members that are not like their pivot but like each other, over several blocks."""
    draw = random.Random(9)
    base = [draw.choice(VOCABULARY) for _ in range(60)]
    rows = []
    for n in range(120):
        ws = list(base)
        for at in draw.sample(range(60), 2):
            ws[at] = f"x{n}-{at}"
        rows.append((n, " ".join(ws)))
    sets = {i: shingles(t, 5) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    monkeypatch.setattr(minhash, "BLOCK", 16)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_groups(docs).collect()}
    assert found == grouped(sets, links)


def test_keep_first_keeps_columns_and_odd_rows(spark):
    docs = spark.createDataFrame(
        [(2, "a b c d e f", "p"), (1, "a b c d e f", "q"), (3, None, None), (None, "a b c d e f", "r"),
         (4, "other words stand here now", None)], "doc_id long, text string, kept string")
    found = minhash.keep_first(docs)
    assert found.columns == docs.columns
    assert sorted(map(str, found.collect())) == sorted(
        str(r) for r in docs.collect() if r.doc_id != 2)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_groups(docs).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert lattice.embedding_links(vectors).count() == 0


def test_estimate_is_near_the_similarity(spark):
    draw = np.random.default_rng(1)
    hasher_seeds = draw.integers(0, 1 << 32, minhash.MINIMA, dtype=np.uint32)
    odd = draw.integers(0, 1 << 31, minhash.MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    errors = []
    for _ in range(60):
        pool = draw.integers(0, 1 << 63, 600, dtype=np.uint64)
        a, b = pool[:500], pool[60:560]
        packed = [minhash.pack(minhash.minima(x, hasher_seeds, odd))[None] for x in (a, b)]
        errors.append(float(minhash._agreeing(*packed)[0, 0]) - 440 / 560)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (20, 20), (4, 5), (5, 1), (100, 7)]
    links += [(1000 + n, 1001 + n) for n in range(60)]
    found = components(spark.createDataFrame(links + links[:3], "a long, b long"))
    ids = {i for ab in links for i in ab} - {20}
    assert {r.id: r.component for r in found.collect()} == grouped(ids, [x for x in links if x[0] != x[1]])


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(3)
    rows = []
    for size, count in ((16, 12), (16, 40), (8, 6)):
        centre = draw.normal(0, 1, size)
        rows += [(centre + draw.normal(0, 0.07, size)).tolist() for _ in range(count)]
    rows += draw.normal(0, 1, (40, 16)).tolist()
    rows += [None, [], [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [1.0] * 16, [2.0] * 16,
             [float("inf")] * 16, [1e-30] * 16, rows[0], [-x for x in rows[0]]]
    return list(enumerate(rows, 10))


def test_links_equal_brute_force(spark, vectors):
    def unit(v):
        if not v or None in v:
            return None
        v = np.array(v, np.float32).astype(float)
        if not np.isfinite(v).all() or not v.any():
            return None
        v = v / np.abs(v).max()
        return v / np.sqrt(v @ v)
    units = {i: unit(v) for i, v in vectors}
    links = [(a, b) for a, b in itertools.combinations(units, 2)
             if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b])
             and units[a] @ units[b] >= 0.95]
    want, degree = grouped(units, links), {i: sum(i in ab for ab in links) for i in units}
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    for name in ("id", "v", "least", "copies", "n", "mark1", "c", "g", "component"):
        frame = frame.withColumn(name, F.lit(1))
    found = lattice.embedding_links(frame).collect()
    assert {r.vec_id: r.n_links for r in found} == degree
    assert {r.vec_id: r.component_id for r in found} == want
    assert {r.vec_id for r in found if r.kept} == {i for i, c in want.items() if i == c}


def test_copies_and_repeated_rows(spark, vectors):
    """Two thousand copies of one vector, rows that repeat, and a key with two vectors."""
    near = [(i, v) for i, v in vectors[:12]]
    copies = [(10_000 + n, vectors[0][1]) for n in range(2_000)] + [(5, vectors[0][1])]
    frame = spark.createDataFrame(near + copies + near[:4] * 2, "vec_id long, embedding array<float>")
    found = lattice.embedding_links(frame).collect()
    assert len(found) == 12 + 2_001 + 8
    plain = {r.vec_id: r for r in lattice.embedding_links(
        spark.createDataFrame(near, "vec_id long, embedding array<float>")).collect()}
    assert plain[10].n_links > 0
    by_key = {}
    for r in found:
        assert by_key.setdefault(r.vec_id, r) == r
    for i, _ in near:
        touches = i == 10 or plain[i].component_id == plain[10].component_id
        assert by_key[i].component_id == (5 if touches else plain[i].component_id)
    assert by_key[5].n_links == by_key[10_007].n_links == plain[10].n_links + 2_001
    twice = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (2, [0.0, 1.0]), (4, [1.0, 1.0]),
                                   (9, [0.0, 0.0]), (8, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in lattice.embedding_links(twice).collect()) == [
        (1, 1, 1, True), (2, 1, 1, False), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True), (8, 0, 8, True),
        (9, 0, 9, True)]


def test_nearest_lattice_point_is_nearest():
    draw = np.random.default_rng(4)
    x = draw.normal(0, 2, (300, 8))
    own = lattice.nearest_point(x)
    steps = lattice.roots()
    assert len(steps) == 240 and np.allclose((steps ** 2).sum(axis=1), 2)
    best = ((x - own) ** 2).sum(axis=1)
    others = ((x[:, None] - own[:, None] - steps[None]) ** 2).sum(axis=2).min(axis=1)
    assert (best <= others + 1e-9).all() and (best <= 1 + 1e-9).all()


def test_recall_at_the_limit():
    """Pairs at a cosine of exactly 0.95 in 64 dimensions share a cell nearly always."""
    draw = np.random.default_rng(5)
    a, b = draw.normal(0, 1, (2, 2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    hasher = lattice.Hasher(64, lattice.TABLES, lattice.PROBES)
    p, q = hasher(a), hasher(0.95 * a + np.sqrt(1 - 0.95 ** 2) * b)
    met = ((p == q[:, :, :1]).any(axis=2) | (q == p[:, :, :1]).any(axis=2)).any(axis=1)
    assert met.mean() > 0.99
