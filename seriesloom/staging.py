"""Tables written to the shared folder so that later stages start from a fact.

A staged table cuts the lineage, survives the loss of executors, gives one
fixed row placement to everything that reads it, and carries its real size into
the planner, which then decides about broadcasting on that size.  All tables of
a session lie in one folder, which its driver removes when it ends.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: dict[str, str] = {}
_OWNERS: list[dict[str, DataFrame]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a private one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="seriesloom-"))
    return context.getCheckpointDir().rstrip("/")


def session_dir(spark: SparkSession) -> str:
    """The session's own folder below the shared one."""
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        folder = f"{shared_dir(spark)}/seriesloom-{app}-{uuid.uuid4().hex[:8]}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _FOLDERS[app] = folder
    return _FOLDERS[app]


def scratch_path(spark: SparkSession, label: str = "table") -> str:
    """A fresh path below the session's folder."""
    return f"{session_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "staged") -> DataFrame:
    """Write ``df`` once and return the table read back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    if _OWNERS:
        _OWNERS[-1][path] = table
    return table


@contextmanager
def passing() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the tables that are staged inside when the block ends, also by an error.

    The block gets a function that keeps a staged table; it then belongs to the block around, if there is
    one, or to the session.  Nothing that still reads the other tables may leave the block.
    """
    owned: dict[str, DataFrame] = {}
    _OWNERS.append(owned)

    def keep(table: DataFrame) -> DataFrame:
        path = next(path for path, staged in owned.items() if staged is table)
        del owned[path]
        outer = _OWNERS[: _OWNERS.index(owned)]
        if outer:
            outer[-1][path] = table
        return table

    try:
        yield keep
    finally:
        _OWNERS.remove(owned)
        for path, table in owned.items():
            _delete(table.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def bucketed_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame, Sequence[str], str], DataFrame]]:
    """A function that writes a table in buckets of some keys and returns it; the tables go when the block ends.

    Tables of a block have the same number of buckets, so joins and groupings on their keys need no exchange.
    """
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names: dict[str, str] = {}

    def lay_out(df: DataFrame, keys: Sequence[str], label: str = "laid_out") -> DataFrame:
        path = scratch_path(spark, label)
        name = f"{label}_{uuid.uuid4().hex}"
        names[name] = path
        df.write.bucketBy(buckets, *keys).option("path", path).saveAsTable(name)
        return spark.table(name)

    try:
        yield lay_out
    finally:
        for name, path in names.items():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            _delete(spark, path)
