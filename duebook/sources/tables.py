"""Writing catalog tables: full load, keyed upsert, partition replacement and retention.

Plain parquet tables of the session catalog.  Nothing is deleted before its replacement is
written: a full load is written to a folder of its own to which the table is then pointed, an upsert
replaces whole date partitions when its job commits, retention drops partitions without
reading them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from duebook.operators.fingerprints import repeated
from duebook.session import CODEC, released_shuffles

_MODE = "spark.sql.sources.partitionOverwriteMode"
_ONE_WRITE = Lock()
NO_DATE = "__HIVE_DEFAULT_PARTITION__"     # the catalog's name for a null date


def clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Lay rows out by ``columns`` for a write.

    The rebalance hint lets adaptive execution cut a heavy value into several files of the
    advisory size and merge light ones, which a fixed ``repartition`` on them cannot.
    """
    return df.hint("rebalance", *columns).sortWithinPartitions(*columns)


SAMPLED = 4_096          # rows that the bounds of a layout are taken from


def range_bounds(df: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list]:
    """At most ``2 ** bits - 1`` values per column that cut its rows into ranges of like size.

    From at most ``SAMPLED`` rows, one per bucket of a hash over the row, combined per task first.
    """
    parts = [F.col(c) for c in columns]
    bucket = F.pmod(F.xxhash64(F.lit(1), *[F.col(c) for c in df.columns]), F.lit(SAMPLED))
    chosen = df.groupBy(bucket.alias("__bucket")).agg(
        F.min_by(F.struct(*parts), F.xxhash64(F.lit(2), *[F.col(c) for c in df.columns])).alias("r")).collect()
    found = {}
    for c in columns:
        values = sorted(r.r[c] for r in chosen if r.r[c] is not None)
        cuts = [values[len(values) * n // (1 << bits)] for n in range(1, 1 << bits)] if values else []
        found[c] = sorted({*cuts})
    return found


def interleaved(bounds: dict[str, list], bits: int) -> Column:
    """Position on a curve that keeps rows near which are near in every column; nulls come first."""
    code = F.lit(0)
    for place, (column, cuts) in enumerate(bounds.items()):
        rank = F.lit(0)
        for cut in cuts:
            rank = rank + F.coalesce((F.col(column) >= F.lit(cut)).cast("int"), F.lit(0))
        for bit in range(bits):
            code = code + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(1), bit * len(bounds)
                                      + len(bounds) - 1 - place)
    return code


def clustered_on_curve(df: DataFrame, partition: str, columns: Sequence[str], bits: int = 4,
                       files: int | None = None) -> DataFrame:
    """Lay rows out for a write such that a filter on any of ``columns`` reads few files of a date.

    Rows of a date are dealt into ranges of the interleaved position of their columns, whose bounds
    come from the rows themselves.
    """
    curve = interleaved(range_bounds(df, columns, bits), bits).alias("__curve")
    placed = df.withColumn("__curve", curve)
    keys = [partition, "__curve"]
    placed = placed.repartitionByRange(files, *keys) if files else placed.repartitionByRange(*keys)
    return placed.sortWithinPartitions(*keys, *columns).drop("__curve")


def create(df: DataFrame, table: str, partition: str) -> None:
    """Create an empty table with the columns of ``df``, if it is not there."""
    if not df.sparkSession.catalog.tableExists(table):
        df.limit(0).write.option("compression", CODEC).partitionBy(partition).saveAsTable(table)


def recover(spark: SparkSession, table: str) -> None:
    """Bring back a table whose full load was stopped between its two renames.

    The old rows come back if they were set aside, else those of a first load that was written.
    """
    beside, aside = f"{table}__next", f"{table}__old"
    if not spark.catalog.tableExists(table):
        for copy in (aside, beside):
            if spark.catalog.tableExists(copy):
                spark.sql(f"ALTER TABLE {copy} RENAME TO {table}")
                break
    elif spark.catalog.tableExists(aside):
        spark.sql(f"DROP TABLE {aside}")


VERSIONS = 2             # loads of a table that are kept, the current one among them


def _folder(spark: SparkSession, table: str) -> str:
    """Where the versions of a table lie: beside the tables of its database."""
    name, _, database = table[::-1].partition(".")
    root = spark.catalog.getDatabase(database[::-1] or spark.catalog.currentDatabase()).locationUri
    return f"{root.rstrip('/')}/{name[::-1]}__versions"


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def versions(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the version folders of a table, oldest first; whole or not."""
    files, root = _file_system(spark, _folder(spark, table))
    if not files.exists(root):
        return []
    return sorted(int(f.getPath().getName()) for f in files.listStatus(root))


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0].data_type


def full_load(df: DataFrame, table: str, partition: str | None = None, keep: int = VERSIONS) -> None:
    """Replace a table; it may be read by ``df`` itself.

    The rows are written to a version folder of their own, then the catalog is pointed to it by
    one change: at any time the table is there, with all its old rows or all its new ones.  The
    last ``keep`` versions stay, so queries that began before the change can end.

    A table with partitions, or whose columns change, has more than one entry to change: it is
    written beside and renamed in two steps, and ``recover`` puts it in place after a stop, as the
    next load does by itself.
    """
    spark = df.sparkSession
    recover(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}__next")     # of a load by renames that was stopped
    there = spark.catalog.tableExists(table)
    if partition or (there and (spark.table(table).dtypes != df.dtypes or any(
            c.isPartition for c in spark.catalog.listColumns(table)))):
        _load_by_renames(df, table, partition)
        return
    found = versions(spark, table)
    folder = f"{_folder(spark, table)}/{found[-1] + 1 if found else 1}"
    with released_shuffles(spark):
        df.select("*").write.option("compression", CODEC).parquet(folder)
    if there:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=folder, source="parquet", schema=df.schema)
    for old in found[:len(found) + 1 - keep]:
        files, path = _file_system(spark, f"{_folder(spark, table)}/{old}")
        files.delete(path, True)


def _load_by_renames(df: DataFrame, table: str, partition: str | None) -> None:
    spark = df.sparkSession
    beside, aside = f"{table}__next", f"{table}__old"
    with released_shuffles(spark):
        writer = df.select("*").write.option("compression", CODEC)
        (writer.partitionBy(partition) if partition else writer).saveAsTable(beside)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {aside}")


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """The setting is that of the session, so one write at a time has it."""
    with _ONE_WRITE:
        before = spark.conf.get(_MODE)
        spark.conf.set(_MODE, "dynamic")
        try:
            yield
        finally:
            spark.conf.set(_MODE, before)


def replace_partitions(df: DataFrame, table: str) -> None:
    """Overwrite exactly the partitions that ``df`` has rows for; ``df`` may read them."""
    spark = df.sparkSession
    with _dynamic_overwrite(spark), released_shuffles(spark):
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def partition_dates(spark: SparkSession, table: str) -> list[dt.date]:
    """Dates of a date-partitioned table, from the catalog alone; without the one of null dates."""
    found = [row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return sorted(dt.date.fromisoformat(text) for text in found if text != NO_DATE)


def drop_partitions(spark: SparkSession, table: str, column: str, dates: Sequence[dt.date]) -> None:
    if dates:
        parts = ", ".join(f"PARTITION ({column} = DATE '{d}')" for d in dates)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")


def upserted(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows, and the target rows none of them replaces.

    Keys compare null-safe: a row with a missing key part replaces its older self, where
    plain equality would add it a second time.
    """
    new = source.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return target.join(new, same, "left_anti").unionByName(source)


def keyed_upsert(source: DataFrame, table: str, keys: Sequence[str], partition: str,
                 dates: Sequence[dt.date] | None = None,
                 cluster: Sequence[str] | None = ()) -> None:
    """Update the rows whose key matches, insert the others.

    ``partition`` is part of the key, so only the dates of the source are rewritten, and
    only those that exist already are read.  ``dates`` saves the pass that lists them.
    ``cluster`` lays the rows out by partition and these columns; ``None`` keeps the layout
    of the source where nothing has to be merged into it.

    A key that the batch holds twice is an error, as the table would get both rows.  Without
    ``dates`` the batch is written beside the table first, so it is computed once; with them it
    should be a stored table or part of one.
    """
    spark = source.sparkSession
    create(source, table, partition)
    batch = f"{table}__batch"
    if dates is None:
        spark.sql(f"DROP TABLE IF EXISTS {batch}")
        with released_shuffles(spark):
            source.select("*").write.option("compression", CODEC).saveAsTable(batch)
        source = spark.table(batch)
        dates = [row[0] for row in source.select(partition).distinct().collect()]
    twice = repeated(source, keys).limit(1).collect()
    if twice:
        raise ValueError(f"the batch for {table} holds a key more than once: {twice[0]}")
    present = sorted({d for d in dates if d is not None} & {*partition_dates(spark, table)})
    old = F.col(partition).isin(present)
    if None in dates:
        old = old | F.col(partition).isNull()
    result = source
    if present or None in dates:
        result = upserted(spark.table(table).where(old), source, keys)
    if present or cluster is not None:
        result = clustered(result, partition, *(cluster or ()))
    replace_partitions(result, table)
    spark.sql(f"DROP TABLE IF EXISTS {batch}")
