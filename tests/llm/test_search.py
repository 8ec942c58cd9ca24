"""Top-k search and lexical search against brute force, with all odd cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from duebook.llm import lexical, topk

VECTORS = "vec_id long, embedding array<float>"


def whole(vector):
    if vector is None or any(c is None or not math.isfinite(c) for c in vector):
        return None
    found = [math.floor(256 * float(np.float32(c))) for c in vector]
    return found if sum(c * c for c in found) < 2 ** 62 else None


def best_by_hand(rows, k, every=50):
    usable = [(i, v) for i, x in rows if i is not None and (v := whole(x)) is not None]
    asked = {(i, tuple(v)) for i, v in usable if i % every == 0}
    found = []
    for query, mine in asked:
        scored = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in usable
                        if i != query and len(v) == len(mine))
        found += [(query, rank, i, -score) for rank, (score, i) in enumerate(scored[:k], 1)]
    return sorted(found)


def vectors(seed, n=400, size=12):
    draw = random.Random(seed)
    base = [[draw.gauss(0, 0.4) for _ in range(size)] for _ in range(n // 2)]
    rows = [(i, draw.choice(base) if i % 3 else [draw.gauss(0, 0.5) for _ in range(size)]) for i in range(n)]
    rows += [(-50, base[0]), (-7, base[0]), (1_000, None), (1_050, []), (1_051, []), (1_100, [None] * size),
             (1_101, [math.nan] * size), (1_102, [math.inf] + [0.0] * (size - 1)), (1_150, [0.0] * size),
             (None, base[1]), (1_200, [1.0, 2.0]), (1_201, [3.0, 4.0]), (1_250, [0.5] * 700),
             (1_251, [0.25] * 700), (1_300, [1e30] * size), (1_350, [4e6] * size), (1_352, [4e6] * size),
             (150, base[2]), (200, rows[200][1]), (17, rows[17][1]), (2 ** 40, base[3])]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("first,slot,block", [(topk.FIRST, topk.SLOT_BYTES, topk.BLOCK),
                                               (1, 1 << 11, 16), (2, 1 << 12, 7)])
def test_top_k_equals_brute_force(spark, monkeypatch, first, slot, block):
    """Also in several waves, with small blocks and many tasks."""
    monkeypatch.setattr(topk, "SLOT_BYTES", slot)
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "CHUNK", 3)
    rows = vectors(block)
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    for extra in ("id", "rank", "data", "score", "task"):
        frame = frame.withColumn(extra, F.lit("clash"))
    found = topk.top_k(frame, first=first)
    assert sorted(tuple(r) for r in found.collect()) == best_by_hand(rows, 5)


def test_top_k_of_nothing(spark):
    none = spark.createDataFrame([], VECTORS)
    assert topk.top_k(none).collect() == []
    assert topk.top_k(spark.createDataFrame([(1, [1.0]), (2, [2.0])], VECTORS)).collect() == []
    alone = topk.top_k(spark.createDataFrame([(50, [1.0])], VECTORS))
    assert alone.collect() == []


@pytest.mark.parametrize("scale", [1, 10 ** 6])
def test_bounds_leave_most_pairs_early_and_lose_none(scale):
    """Doubles for small numbers, 64-bit whole numbers for those they cannot hold."""
    draw = np.random.default_rng(4)
    x = draw.normal(size=(2_000, 64))
    v = (np.floor(256 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64) * scale).astype(np.int32)
    ids = np.arange(len(v))
    best, followed = topk.Best(ids[:60].copy(), np.full(60, topk.LOWEST), 5), 0
    for at in range(0, len(v), 512):
        block = np.ascontiguousarray(v[at:at + 512].T)
        norm = float(np.sqrt((block.astype(float) ** 2).sum(axis=0).max()))
        followed += topk.search_block(v[:60], best, block, ids[at:at + 512], norm)
    scores = v[:60].astype(np.int64) @ v.T.astype(np.int64)
    expected = [(q, c, scores[q, c]) for q in range(60)
                for c in sorted((c for c in range(len(v)) if c != q), key=lambda c: (-scores[q, c], c))[:5]]
    assert list(zip(best.at, best.ids, best.scores)) == expected
    assert followed < 0.1 * 60 * len(v)


# --- lexical search ------------------------------------------------------------------------------

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def ranked_by_hand(docs, items, k=10):
    held = [(i, Counter(ts), len(ts)) for i, t in docs if (ts := terms_of(t))]
    count, total = len(held), sum(n for *_, n in held)
    df = Counter(t for _, ts, _ in held for t in ts)
    found = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        scored = []
        for doc, ts, n in held:
            m = 25 + (75 * n * count) // total
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                        * ((1_000_000_000 * ts[t]) // (1000 * ts[t] + 8 * m)) for t in terms_of(text) if ts[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        found += [(item, rank, doc, -score)
                  for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(found, key=repr)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(9)
    vocabulary = [f"t{n}" for n in range(300)] + ["Straße", "été", "日本語", "naïve", "İx"]
    weights = [1 / (n + 1) for n in range(len(vocabulary))]

    def some(n):
        words = draw.choices(vocabulary, weights, k=n)
        return draw.choice([" ", ", ", "_", "\n", "\x00"]).join(w.upper() if draw.random() < 0.2 else w for w in words)
    docs = [(i, some(draw.choice([1, 5, 20, 80, 300]))) for i in range(300)]
    docs += [(1_000 + i, docs[i][1]) for i in range(25)] + [(7, docs[7][1]), (None, docs[3][1]), (900, None),
            (901, ""), (902, " .,_[]{}~@/\x7f "), (903, "t1 " * 40_000), (904, "ÄÖ äö"), (-5, docs[3][1])]
    items = [(i, some(draw.choice([1, 3, 10, 40]))) for i in range(30)]
    items += [(30, None), (31, ""), (32, "nothing known here"), (33, "t1 t1 t1 t1"), (None, "t5 t6"),
              (34, docs[5][1]), (35, "Straße ÉTÉ été"), (0, items[0][1]), (0, "t2 another"), (36, "?!")]
    return docs, items


@pytest.mark.parametrize("items_at_once,width", [(512, 13), (7, 4)])
def test_ranked_search_equals_brute_force(spark, monkeypatch, corpus, items_at_once, width):
    """Also in several batches, and with sketches so narrow that most bounds are loose."""
    docs, items = corpus
    monkeypatch.setattr(lexical, "ITEMS", items_at_once)
    monkeypatch.setattr(lexical, "BITS", width)
    monkeypatch.setattr(lexical, "WIDTH", 1 << width)
    table = spark.createDataFrame(docs, DOCS).repartition(5)
    asked = spark.createDataFrame(items, ITEMS)
    for extra in ("id", "n", "terms", "slot", "rank"):
        table, asked = table.withColumn(extra, F.lit("clash")), asked.withColumn(extra, F.lit(1))
    found = lexical.ranked_search(table, asked)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == ranked_by_hand(docs, items)


def test_ranked_search_of_nothing(spark, corpus):
    docs, items = corpus
    no_docs, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame(docs[:5], DOCS)
    blank = spark.createDataFrame([(1, "."), (2, None)], DOCS)
    assert lexical.ranked_search(no_docs, spark.createDataFrame(items, ITEMS)).collect() == []
    assert lexical.ranked_search(blank, spark.createDataFrame(items, ITEMS)).collect() == []
    assert lexical.ranked_search(some, no_items).collect() == []
    assert lexical.ranked_search(some, spark.createDataFrame([(1, "-"), (2, None)], ITEMS)).collect() == []


def test_sketch_keeps_the_greatest_number_of_each_coordinate():
    draw = np.random.default_rng(1)
    terms = np.unique(draw.integers(0, 1 << 63, 5_000, dtype=np.uint64) * np.uint64(2))
    counts = draw.integers(1, 50, len(terms)).astype(np.uint32)
    places, peaks = lexical.sketch(terms, counts)
    expected = {}
    for term, count in zip(terms.tolist(), counts.tolist()):
        place = term >> (64 - lexical.BITS)
        expected[place] = max(count, expected.get(place, 0))
    assert dict(zip(places.tolist(), peaks.tolist())) == expected
    assert len(expected) < len(terms)
