"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from duebook.session import shared_folder

SPACES = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACES}]+"        # the words of all contracts, for Spark, DuckDB and re


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def staged(df: DataFrame, files: int | None = None) -> DataFrame:
    """``df`` written to the cluster's shared folder and read from there.

    Cuts the plan in two: the part before is computed once, survives lost executors, and
    its true size is known to the joins that follow.
    """
    path = f"{shared_folder(df.sparkSession)}/stage"
    (df.coalesce(files) if files else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column | str) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column | str) -> Column:
    """Words of a text as an array; null gives an empty one."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)),
                      F.array().cast("array<string>"))


def by_batch(df: DataFrame, columns: list[str], fields: list[T.StructField],
             fn: Callable[..., list[pa.Array]], keep: list[str], rows: int = 256) -> DataFrame:
    """Add ``fields`` computed from ``columns`` by a function of Arrow arrays.

    ``keep`` are columns that go through unchanged.  A batch is handled ``rows`` rows at a
    time, so memory follows the longest rows and not the batch.
    """
    names = [f.name for f in fields]
    more = [c for c in columns if c not in keep]
    source = df.select(*[F.col(f"`{c}`").alias(f"k{n}") for n, c in enumerate([*keep, *more])])
    args = [[*keep, *more].index(c) for c in columns]
    schema = T.StructType([*source.schema.fields[:len(keep)], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                arrays = part.columns
                yield pa.RecordBatch.from_arrays(
                    [*arrays[:len(keep)], *fn(*[arrays[a] for a in args])],
                    [*part.schema.names[:len(keep)], *names])

    found = source.mapInArrow(run, schema)
    return found.select(*[F.col(f"k{n}").alias(c) for n, c in enumerate(keep)],
                        *[F.col(n) for n in names])


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns named c0, c1 and so on, and the new name of each old one.

    For operators that hand all columns through: no name of theirs can then clash.
    """
    names = {c: f"c{n}" for n, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


# --- hashing of words inside tasks -----------------------------------------------------------

def splitmix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of all words of a text, from prefix sums over its bytes.

    The hash of a word is a polynomial in an odd base over one random number per byte value;
    as the base has an inverse, it follows from the difference of two prefix sums.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, lower: bool):
        values = splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        if lower:
            values[65:91] = values[97:123]
        self.values = values
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            size = 1 << size.bit_length()
            back = pow(self.BASE, -1, 1 << 64)
            for name, base in (("powers", self.BASE), ("inverse", back)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def spans(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of the text, and first and one-past-last byte of each word."""
        data = np.frombuffer(text, np.uint8)
        inside = np.empty(len(data) + 2, np.int8)
        inside[0] = inside[-1] = 0
        np.logical_not(self.space[data], out=inside[1:-1].view(bool))
        edge = np.diff(inside)
        return data, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

    def __call__(self, text: bytes) -> np.ndarray:
        data, start, end = self.spans(text)
        if not len(start):
            return np.empty(0, np.uint64)
        self._grow(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[:len(data)], out=sums[1:])
        return splitmix((sums[end] - sums[start]) * self.inverse[start])


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one numpy array per row."""
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def texts_of(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist() if len(column) else []
