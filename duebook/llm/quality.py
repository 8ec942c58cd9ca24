"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every text.  Expectation-maximisation over
the counts of vote patterns, of which there are few whatever the corpus, estimates how often
each labeller is right and so the posterior of every pattern.  The posteriors label a
bounded sample that a linear scorer over hashed features is fitted to; it scores all texts.
No given label is used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import WordHasher, by_batch, list_array, numbered, splitmix, staged, texts_of

SAMPLE = 5_000           # texts the scorer is fitted to, the first by hash of their key
DIMENSIONS = 2_048       # hashed features
THRESHOLD = 0.4          # a text is kept from this score on
GOOD, BAD, NONE = 1, 0, 2

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>{}[]^~\\=+_@"]] = True
_PIPE = np.zeros(256, bool)
_PIPE[ord("|")] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
# classes of bytes: a class of their own for symbols and marks, one each for groups of letters
_CLASS = np.zeros(256, np.int64)
_CLASS[:] = 1
_CLASS[97:123] = 2
_CLASS[65:91] = 3
_CLASS[48:58] = 4
_CLASS[128:] = 5
for _n, _c in enumerate(" \n.,|#*$%&<>:;-/'\"()"):
    _CLASS[ord(_c)] = 6 + _n
_CLASSES = 32


def measures(text: bytes, hasher: WordHasher) -> dict[str, np.ndarray | float]:
    """What labellers and features are made of; all zero for a text without words."""
    data, start, end = hasher.spans(text)
    words = hasher(text)
    n = len(words)
    same = np.zeros(n, bool)
    seen = np.zeros(n, bool)
    if n:
        same[1:] = words[1:] == words[:-1]
        _, first = np.unique(words, return_index=True)
        seen[:] = True
        seen[first] = False
    total = np.concatenate([[0], np.cumsum(_SYMBOLS[data])])
    marked = total[end] - total[start] if n else np.zeros(0, np.int64)
    lines = [x for x in text.split(b"\n") if x.strip()]
    pipes = int(np.count_nonzero(_PIPE[data]))
    return {
        "n": n, "same": same, "seen": seen, "marked": marked, "length": end - start, "data": data,
        "lines": len(lines), "repeated_lines": len(lines) - len(set(lines)), "pipes": pipes,
        "letters": np.count_nonzero(_LETTER[data]) / max(1, len(data) - np.count_nonzero(
            hasher.space[data]))}


def votes(m: dict) -> list[int]:
    """Votes of the labellers.  Each looks at one or two measures and may abstain."""
    n = m["n"]
    if not n:
        return [BAD] * LABELLERS
    same, seen = m["same"].mean(), m["seen"].mean()
    marked, pipes = (m["marked"] > 0).mean(), m["pipes"] / n
    # one line that comes twice says little
    lines = m["repeated_lines"] / m["lines"] if m["repeated_lines"] > 1 else 0.0

    def side(value, bad_from, good_to):
        return BAD if value >= bad_from else GOOD if value <= good_to else NONE
    return [
        side(same, 0.12, 0.03),                                  # a word right after itself
        side(seen - 0.12 * np.log10(max(n, 10)), 0.45, 0.3) if n >= 30 else NONE,  # poor vocabulary
        side(marked, 0.12, 0.04),                                # words with symbols
        side(1 - m["letters"], 0.2, 0.1),                      # other than letters
        side(pipes, 0.12, 0.02),                                 # table marks
        side(lines, 0.3, 0.0) if m["lines"] >= 3 else NONE,      # lines that come again
        side(lines + same + marked, 0.3, 0.1),                  # any of these together
    ]


LABELLERS = 7


def features(m: dict) -> np.ndarray:
    """Relative frequencies of hashed events, one float per dimension.

    Events are classes of three bytes in a row, and for each word its length with whether it
    follows itself, was seen before in the text or holds a symbol, and repeated lines.
    """
    found = np.zeros(DIMENSIONS, np.float32)
    n = m["n"]
    if not n:
        return found
    kind = _CLASS[m["data"]]
    if len(kind) >= 3:
        code = (kind[:-2] * _CLASSES + kind[1:-1]) * _CLASSES + kind[2:]
        counts = np.bincount(code, minlength=_CLASSES ** 3)
        code = np.flatnonzero(counts)
        spot = (splitmix(code.astype(np.uint64)) % np.uint64(DIMENSIONS)).astype(np.int64)
        found += np.bincount(spot, counts[code] / len(kind), DIMENSIONS).astype(np.float32)
    word = (np.minimum(m["length"], 15) * 8 + m["same"] * 4 + m["seen"] * 2 + (m["marked"] > 0))
    for event, counts, total in ((1 << 20, np.bincount(word, minlength=128), n),
                                 (1 << 21, np.bincount(word % 8, minlength=8), n),
                                 (1 << 22, np.array([0, m["repeated_lines"]]), max(1, m["lines"])),
                                 (1 << 23, np.array([0, min(m["pipes"], n)]), n)):
        code = np.flatnonzero(counts)
        spot = (splitmix((code + event).astype(np.uint64)) % np.uint64(DIMENSIONS)).astype(np.int64)
        found += np.bincount(spot, counts[code] / total, DIMENSIONS).astype(np.float32)
    return np.sqrt(found)


def _vote(column: pa.Array) -> list[pa.Array]:
    hasher = WordHasher(lower=False)
    coded = []
    for text in texts_of(column):
        code = 0
        for vote in votes(measures(text or b"", hasher)):
            code = code * 3 + vote
        coded.append(code)
    return [pa.array(coded, pa.int32())]


def _features(column: pa.Array) -> list[pa.Array]:
    hasher = WordHasher(lower=False)
    rows = [features(measures(t or b"", hasher)) for t in texts_of(column)]
    return [list_array(rows, pa.float32())]


def weak_labels(patterns: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], np.ndarray]:
    """Posterior of "good" per vote pattern, and each labeller's rates by class and vote.

    Starts from "bad if any labeller says so"; labellers are taken as independent within a
    class, and every rate has one pseudo-count.
    """
    codes = sorted(patterns)
    counts = np.array([patterns[c] for c in codes], float)
    cast = np.array([[c // 3 ** (LABELLERS - 1 - k) % 3 for k in range(LABELLERS)] for c in codes])
    if not codes:
        return {}, np.full((LABELLERS, 2, 3), 1 / 3)
    good = np.where((cast == BAD).any(axis=1), 0.1, 0.95)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        rates = np.stack([[(weight * (cast[:, k] == v)).sum(axis=1) + 1 for v in (BAD, GOOD, NONE)]
                          for k in range(LABELLERS)]).transpose(0, 2, 1)
        rates /= rates.sum(axis=2, keepdims=True)
        prior = (weight.sum(axis=1) + 1) / (counts.sum() + 2)
        told = np.log(prior)[None] + sum(np.log(rates[k][:, cast[:, k]]).T for k in range(LABELLERS))
        after = 1 / (1 + np.exp(np.clip(told[:, 0] - told[:, 1], -500, 500)))
        if np.abs(after - good).max() < 1e-9:
            break
        good = after
    return dict(zip(codes, good.tolist())), rates


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 400, penalty: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels, classes weighted alike; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    if not len(x):
        return np.zeros(x.shape[1], np.float32)
    share = np.clip(y.mean(), 0.02, 0.98)
    weight = ((y / share + (1 - y) / (1 - share)) / 2).astype(np.float32)
    y = y.astype(np.float32)
    w, m, v = (np.zeros(x.shape[1], np.float32) for _ in range(3))
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) / len(x) + penalty * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return w


def quality_model(docs: DataFrame, key: str, text: str, sample: int = SAMPLE) -> np.ndarray:
    """Weights of the scorer.  Votes come from all texts, the fit from ``sample`` of them.

    The sample are the texts with the smallest hashes of key and text, each once, so that it is the
    same in any partitioning and however often a key or a text is repeated.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).withColumn(
        "mark", F.xxhash64("id", "text"))
    voted = staged(by_batch(rows, ["text"], [T.StructField("votes", T.IntegerType())], _vote, ["id", "mark"]))
    patterns = {r["votes"]: r["count"] for r in voted.groupBy("votes").count().collect()}
    posterior, _ = weak_labels(patterns)
    chosen = voted.where("id is not null").select("mark", "votes").distinct()
    chosen = staged(chosen.orderBy("mark", "votes").limit(sample), 1)
    # at most ``sample`` marks; of copies of a row any one, as they are equal
    some = (rows.join(F.broadcast(chosen), "mark").where("id is not null")
            .groupBy("mark", "votes").agg(F.min("text").alias("text")))
    found = by_batch(some, ["text"], [T.StructField("x", T.ArrayType(T.FloatType()))], _features,
                     ["mark", "votes"]).orderBy("mark").toArrow()
    x = np.asarray(found["x"].combine_chunks().flatten()).reshape(-1, DIMENSIONS)
    return fit(x, np.array([posterior[v] for v in found["votes"].to_pylist()]))


def _scored(docs: DataFrame, key: str, text: str, keep: list[str], sample: int) -> DataFrame:
    w = quality_model(docs, key, text, sample)

    def score(column: pa.Array) -> list[pa.Array]:
        hasher = WordHasher(lower=False)
        scores = []
        for t in texts_of(column):
            m = measures(t or b"", hasher)
            z = float(features(m) @ w[:-1] + w[-1])
            scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))) if m["n"] else 0.0)
        return [pa.array(scores, pa.float64())]
    return by_batch(docs, [text], [T.StructField("__score", T.DoubleType())], score, keep)


def quality_scores(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   sample: int = SAMPLE) -> DataFrame:
    """``key``, score between 0 and 1, and kept: score at least 0.4; one row per row of ``docs``.

    Null, empty and blank texts score 0 and are rejected.  Whole texts are read, of any
    length.  Equal texts have equal scores; repeated and null keys are scored like others
    (null keys are not in the sample).  Other columns are not read.  An empty table gives no
    rows.
    """
    plain = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = _scored(plain, "id", "text", ["id"], sample)
    return rows.select(F.col("id").alias(key), F.col("__score").alias("score"),
                       (F.col("__score") >= THRESHOLD).alias("kept"))


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text",
              sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that ``quality_scores`` keeps, all columns as they are."""
    plain, names = numbered(docs)
    rows = _scored(plain, names[key], names[text], plain.columns, sample)
    return rows.where(F.col("__score") >= THRESHOLD).drop("__score").toDF(*docs.columns)
