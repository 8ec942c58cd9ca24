"""Session settings the library relies on, and the shared folder it may write to."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str = "duebook", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset.

    Both are folders every executor can reach; nothing is put on one machine's own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/duebook/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_GUARD = Lock()
_INSIDE: dict[str, tuple[int, str]] = {}     # application -> blocks that are open, the setting before

#: Codec of what is stored: a third to a half of the bytes are saved where rows repeat their text.
CODEC = "zstd"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Plans made meanwhile give back their shuffle files when their job ends.

    Without it they stay until the driver happens to collect what refers to them, and the disk
    holds the shuffles of all jobs of a run at once.  For writes, whose plan runs once.
    """
    app = spark.sparkContext.applicationId
    with _GUARD:
        inside, before = _INSIDE.get(app, (0, spark.conf.get(_CLEANUP, "false")))
        _INSIDE[app] = inside + 1, before
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _GUARD:
            inside, before = _INSIDE.pop(app)
            if inside > 1:
                _INSIDE[app] = inside - 1, before
            else:
                spark.conf.set(_CLEANUP, before)


_STEPS: ContextVar[list[str] | None] = ContextVar("steps", default=None)


@contextmanager
def passing_steps(spark: SparkSession) -> Iterator[Callable[..., list[DataFrame]]]:
    """What ``stored`` writes meanwhile is removed at the end: what reads it is stored by then.

    Gives a ``stored`` for results, which stay as long as what is stored around this block.
    """
    around, folders = _STEPS.get(), []
    token = _STEPS.set(folders)
    try:
        yield lambda **frames: _stored(frames, around)
    finally:
        _STEPS.reset(token)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(**frames: DataFrame) -> list[DataFrame]:
    """Write frames to scratch folders, side by side, and read them back.

    The shuffles that led to them are given back, and their real sizes are known to the joins
    that follow.
    """
    return _stored(frames, _STEPS.get())


def _stored(frames: dict[str, DataFrame], steps: list[str] | None) -> list[DataFrame]:
    spark = next(iter(frames.values())).sparkSession
    paths = {name: f"{shared_folder(spark)}/{name}" for name in frames}
    if steps is not None:
        steps.extend(paths.values())
    with released_shuffles(spark):
        plans = {name: df.select("*") for name, df in frames.items()}
        with ThreadPoolExecutor(len(plans)) as pool:
            list(pool.map(lambda n: plans[n].write.option("compression", CODEC).parquet(paths[n]), plans))
    return [spark.read.schema(df.schema).parquet(paths[name]) for name, df in frames.items()]
