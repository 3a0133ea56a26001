"""Cutting lineage on shared storage, and letting go of what is no longer read."""

from __future__ import annotations

import gc
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitmatch.session import delete_path, scratch_path

# paths written inside each open scope, innermost last
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scratch_scopes", default=())


def cut_lineage(df: DataFrame, name: str = "stage", outlive: bool = False, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared ``spark.checkpoint.dir``
    and return a scan of it.

    The rows survive executor loss (they live in shared storage, not in
    executor memory or local disks); the plan above is not recomputed; and
    unlike an RDD checkpoint the scan is columnar, so later readers get
    column pruning and filter pushdown, and with ``partition_by`` read only the
    partitions they ask for.  The write is a single job.  Inside a
    :func:`scratch_scope` the table is deleted at the scope's end, or with
    ``outlive`` at the end of the next outer one.
    """
    path = scratch_path(df.sparkSession, name)
    scopes = _SCOPES.get()
    holder = scopes[:-1] if outlive else scopes
    if holder:
        holder[-1].append(path)
    df.write.mode("overwrite").parquet(path, partitionBy=list(partition_by) or None)
    out = df.sparkSession.read.parquet(path)
    out._stored_at = path
    return out


def let_go(df: DataFrame) -> None:
    """Delete the table behind a frame of :func:`cut_lineage`; nothing may read that frame any more."""
    path = df.__dict__.pop("_stored_at", None)
    if path:
        delete_path(df.sparkSession, path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that the block stored (but for ``outlive`` ones) at its end, after an error too.

    The block must finish its jobs: a lazy frame that still reads one of these
    tables cannot be used afterwards.  The shuffle files of finished jobs go as well, once
    the JVM has noticed that nothing refers to them.
    """
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in paths:
            delete_path(spark, path)
        gc.collect()
        spark._jvm.System.gc()


def number_rows(df: DataFrame, out: str = "_row") -> DataFrame:
    """``df`` with a number per row that every later reading gives the same row.

    Rows of a plain file scan are numbered by file and place in the file, so nothing is
    copied (the join brings one small row per file).  Other frames are stored once with
    their numbers.  Numbers are unique, not dense.
    """
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_at"))
        paths = sorted(r[0] for r in placed.select("_path").distinct().collect())     # a row a file
    except AnalysisException:
        return cut_lineage(df.withColumn(out, F.monotonically_increasing_id()), "numbered_rows")
    spark = df.sparkSession
    files = spark.createDataFrame([(p, i) for i, p in enumerate(paths)], "_path string, _file bigint")
    number = (F.shiftleft(F.col("_file"), 40) + F.col("_at")).alias(out)
    return placed.join(F.broadcast(files), "_path").select(*[F.col(c) for c in df.columns], number)
