"""Unigram segmentation into pieces and back.

The text is split with white space as a mark in front of words; the best segmentation by
summed log scores is found with Viterbi over a double-array trie of the pieces.  Characters
that no piece covers are written as byte pieces.  As no piece goes on across a mark, words
are segmented one by one, many distinct words at a time, and remembered within a task.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import by_batch, list_array, texts_of

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0    # below the lowest score of a piece
REMEMBERED = 200_000      # words a task keeps before it starts anew
LONG = 64                 # bytes; longer words are segmented one by one
NORMAL, CONTROL, USER, BYTE = 1, 3, 4, 6
UNIGRAM = 1


def _fields(data: bytes):
    """(number, value) of the fields of one serialized message."""
    at = 0

    def varint(at):
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value, at
            shift += 7
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 1:
            value, at = data[at:at + 8], at + 8
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at:at + size], at + size
        else:
            value, at = data[at:at + 4], at + 4
        yield tag >> 3, value


@dataclass
class Pieces:
    """Pieces by id with their log scores and kinds, and whether a first mark is added.

    A unigram file holds log scores.  A file of merges holds ranks, best first, as 0, -1, -2
    and so on; by Zipf's law the log score of a rank is minus its logarithm.
    """

    texts: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    prefix: bool

    @classmethod
    def load(cls, path: str = MODEL) -> "Pieces":
        with open(path, "rb") as file:
            data = file.read()
        texts, scores, kinds, prefix, model = [], [], [], True, UNIGRAM
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                texts.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                model = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                prefix = bool(dict(_fields(value)).get(3, 1))
        scores = np.array(scores)
        return cls(texts, scores if model == UNIGRAM else -np.log1p(-np.minimum(scores, 0)),
                   np.array(kinds), prefix)


def double_array(keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value of a trie over (bytes, value); state 0 is the root.

    The child of state s by byte b is base[s] + b + 1 if check there is s.
    """
    root: dict = {}
    for key, value in keys:
        node = root
        for byte in key:
            node = node.setdefault(byte, {})
        node[-1] = value
    size = 1 << 20
    while size < 4 * sum(len(k) for k, _ in keys):
        size *= 2
    base, check, value = (np.full(size, n, np.int32) for n in (0, -1, -1))
    free = np.ones(size, bool)
    free[0], check[0] = False, 0
    todo, lowest, last = [(0, root)], 1, 0
    for state, node in todo:
        children = np.array(sorted(b for b in node if b >= 0), np.int64)
        value[state] = node.get(-1, -1)
        if not len(children):
            continue
        # the first free place for the first child at which all others are free too
        at, step, offsets = lowest, 64, children - children[0]
        while True:
            places = at + np.flatnonzero(free[at:at + step])
            places = places[places > children[0]]
            fits = places[free[places[:, None] + offsets].all(axis=1)]
            if len(fits):
                break
            at, step = at + step, min(step * 2, 1 << 14)
        start = int(fits[0]) - int(children[0]) - 1
        base[state] = start
        spots = start + 1 + children
        check[spots], free[spots] = state, False
        last = max(last, int(spots[-1]))
        todo += [(start + 1 + b, node[b]) for b in children.tolist()]
        while not free[lowest]:
            lowest += 1
    # past the end no state is anyone's child
    return tuple(x[:last + 300].copy() for x in (base, check, value))


class Unigram:
    """Encoder and decoder; small enough to be sent to tasks (some 100,000 trie states)."""

    def __init__(self, pieces: Pieces):
        inside = [(t, n) for n, (t, k) in enumerate(zip(pieces.texts, pieces.kinds))
                  if k in (NORMAL, USER)]
        if any(MARK in t.lstrip(MARK) for t, _ in inside):
            raise ValueError("a piece goes on across a white-space mark")
        self.base, self.check, self.value = double_array([(t.encode(), n) for t, n in inside])
        self.scores = pieces.scores
        self.unknown = float(min(pieces.scores[n] for _, n in inside)) - UNKNOWN_PENALTY
        self.bytes = np.full(256, -1, np.int32)
        raw = []
        for n, (t, k) in enumerate(zip(pieces.texts, pieces.kinds)):
            if k == BYTE:
                self.bytes[int(t[3:5], 16)] = n
                raw.append(bytes([int(t[3:5], 16)]))
            else:
                raw.append(t.encode() if k in (NORMAL, USER) else b"")
        if (self.bytes < 0).any():
            raise ValueError("byte fallback needs a piece for each byte")
        self.is_byte = pieces.kinds == BYTE
        self.prefix = pieces.prefix
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(x) for x in raw], np.int64)
        self.raw_start = np.concatenate([[0], np.cumsum(self.raw_size)[:-1]])
        # signs that are in no longer piece stand alone in any segmentation
        joined = {c for t, _ in inside if len(t) > 1 for c in t}
        alone = "".join(re.escape(c) for c in "\n\r\t" if c not in joined)
        self.words = re.compile(f"[{alone}]|{MARK}*[^{MARK}{alone}]+|{MARK}+" if alone
                                else f"{MARK}*[^{MARK}]+|{MARK}+")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)

    # --- Viterbi -------------------------------------------------------------------------

    def _trace(self, back: list[tuple[int, int]], word: bytes) -> list[int]:
        ids, at = [], len(word)
        while at:
            start, piece = back[at]
            ids += [piece] if piece >= 0 else self.bytes[list(word[start:at])].tolist()[::-1]
            at = start
        return ids[::-1]

    def _one(self, word: bytes) -> list[int]:
        """Best segmentation of one word, byte position by byte position."""
        n = len(word)
        best, back = [-np.inf] * (n + 1), [(0, -1)] * (n + 1)
        best[0] = 0.0
        for s in range(n):
            if (word[s] & 0xC0) == 0x80:
                continue
            end = s + 1
            while end < n and (word[end] & 0xC0) == 0x80:
                end += 1
            state, single = 0, False
            for at in range(s, n):
                child = int(self.base[state]) + word[at] + 1
                if self.check[child] != state:
                    break
                state = child
                piece = int(self.value[state])
                if piece >= 0:
                    single |= at + 1 == end
                    score = best[s] + float(self.scores[piece])
                    if score > best[at + 1]:
                        best[at + 1], back[at + 1] = score, (s, piece)
            if not single and best[s] + self.unknown > best[end]:
                best[end], back[end] = best[s] + self.unknown, (s, -1)
        return self._trace(back, word)

    def _many(self, words: list[bytes]) -> list[list[int]]:
        """The same for many short words at once, all at one byte position in each step."""
        sizes = np.array([len(w) for w in words])
        width, count = int(sizes.max()), len(words)
        grid = np.zeros((count, width + 1), np.int32)
        flat = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(count), sizes)
        column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        grid[row, column] = flat
        first = (grid & 0xC0) != 0x80        # also past the end, where zeros stand
        ends = np.zeros_like(grid)
        ends[:, width] = width
        for at in range(width - 1, -1, -1):
            ends[:, at] = np.where(first[:, at + 1], at + 1, ends[:, at + 1])
        best = np.full((count, width + 1), -np.inf)
        start = np.zeros((count, width + 1), np.int32)
        chosen = np.full((count, width + 1), -1, np.int32)
        best[:, 0] = 0.0
        for s in range(width):
            rows = np.flatnonzero((sizes > s) & first[:, s])
            if not len(rows):
                continue
            end, here = ends[rows, s], best[rows, s]
            single = np.zeros(len(rows), bool)
            live, state, at = np.arange(len(rows)), np.zeros(len(rows), np.int32), s
            while len(live) and at < width:
                inside = sizes[rows[live]] > at
                live, state = live[inside], state[inside]
                child = self.base[state] + grid[rows[live], at] + 1
                good = self.check[child] == state
                live, state = live[good], child[good]
                at += 1
                piece = self.value[state]
                hit = piece >= 0
                if hit.any():
                    who, piece = live[hit], piece[hit]
                    single[who] |= end[who] == at
                    score = here[who] + self.scores[piece]
                    better = score > best[rows[who], at]
                    to = rows[who[better]]
                    best[to, at], start[to, at] = score[better], s
                    chosen[to, at] = piece[better]
            score = here + self.unknown
            better = ~single & (score > best[rows, end])
            to, end = rows[better], end[better]
            best[to, end], start[to, end], chosen[to, end] = score[better], s, -1
        # back from the ends, one piece of all words in each step
        found = np.zeros((count, width), np.int32)
        pieces, unknown = np.zeros(count, np.int64), np.zeros(count, bool)
        rows, at = np.arange(count), sizes.copy()
        while len(rows):
            piece = chosen[rows, at]
            unknown[rows[piece < 0]] = True
            found[rows, pieces[rows]] = piece
            pieces[rows] += 1
            at = start[rows, at]
            rows, at = rows[at > 0], at[at > 0]
        ids = [row[:n][::-1] for row, n in zip(found.tolist(), pieces.tolist())]
        for n in np.flatnonzero(unknown):
            ids[n] = self._trace(list(zip(start[n].tolist(), chosen[n].tolist())), words[n])
        return ids

    # --- texts ---------------------------------------------------------------------------

    def _learn(self, words: list[str]) -> None:
        raw = [w.encode() for w in words]
        order = sorted((n for n, w in enumerate(raw) if len(w) <= LONG), key=lambda n: len(raw[n]))
        ids: list[list[int]] = [[]] * len(raw)
        for at in range(0, len(order), 4096):
            part = order[at:at + 4096]
            for n, found in zip(part, self._many([raw[n] for n in part])):
                ids[n] = found
        for n, w in enumerate(raw):
            if len(w) > LONG:
                ids[n] = self._one(w)
        size = np.array([len(x) for x in ids], np.int64)
        new = np.array([x for word in ids for x in word], np.int32)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(size) - size])
        self.sizes = np.concatenate([self.sizes, size])
        self.flat = np.concatenate([self.flat, new])
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.known) > REMEMBERED:
            self._forget()
        split = []
        for text in texts:
            text = text.replace(" ", MARK)
            split.append(self.words.findall(MARK + text if self.prefix and text else text))
        new = list({w for words in split for w in words} - self.known.keys())
        if new:
            self._learn(new)
        return [gathered(self.flat, self.starts, self.sizes,
                         np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))
                for words in split]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: byte pieces as bytes, marks as spaces, without the first mark."""
        raw = gathered(self.raw, self.raw_start, self.raw_size, np.asarray(ids, np.int64))
        text = raw.tobytes().decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``flat[starts[i]:starts[i] + sizes[i]]`` of all i in ``which``, one after another."""
    size = sizes[which]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts[which] - (ends - size), size)
    return flat[shift + np.arange(total)]


def _shared(df: DataFrame, model: str):
    return df.sparkSession.sparkContext.broadcast(Unigram(Pieces.load(model)))


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """``key``, ids, n_pieces, n_byte_pieces and round_trip (decoding gives the text again).

    A null text has null ids and an empty one no ids; both have 0 pieces and round_trip true.
    Marks in the text itself decode as spaces, round_trip is false for them.  Whole texts of
    any length are encoded; repeated rows and null keys are rows like others.  Other columns
    are not read.  An empty table gives no rows.
    """
    shared = _shared(docs, model)

    def run(column: pa.Array) -> list[pa.Array]:
        unigram = shared.value
        texts = column.to_pylist()
        ids = unigram.encode([t or "" for t in texts])
        lists = list_array(ids, pa.int32())
        if column.null_count:
            lists = pa.array([None if t is None else i for t, i in zip(texts, lists.to_pylist())],
                             pa.list_(pa.int32()))
        return [lists, pa.array([len(x) for x in ids], pa.int64()),
                pa.array([int(unigram.is_byte[x].sum()) for x in ids], pa.int64()),
                pa.array([unigram.decode(x) == (t or "") for x, t in zip(ids, texts)])]
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType()),
              T.StructField("n_byte_pieces", T.LongType()), T.StructField("round_trip", T.BooleanType())]
    return by_batch(docs, [text], fields, run, [key])


def decode(coded: DataFrame, ids: str = "ids", keep: list[str] | None = None,
           model: str = MODEL) -> DataFrame:
    """``keep`` (default: all other columns) and text; null ids give a null text."""
    shared = _shared(coded, model)

    def run(column: pa.Array) -> list[pa.Array]:
        return [pa.array([None if x is None else shared.value.decode(np.array(x, np.int64))
                          for x in column.to_pylist()], pa.string())]
    keep = [c for c in coded.columns if c != ids] if keep is None else keep
    return by_batch(coded, [ids], [T.StructField("__text", T.StringType())], run, keep).select(
        *[F.col(f"`{c}`") for c in keep if c != "text"], F.col("__text").alias("text"))
