"""Broadcast hints only for frames whose size is bounded by construction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded(df: DataFrame) -> DataFrame:
    """Hint a broadcast for literal rows, a fixed list of traits, or a top-n with
    a small n.  Every other join is left to the optimizer, which broadcasts by
    bytes (``spark.sql.autoBroadcastJoinThreshold``), at run time too."""
    return F.broadcast(df)
