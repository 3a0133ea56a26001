"""Global rank without funnelling rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traitmatch.plans.lineage import cut_lineage
from traitmatch.plans.sizing import bounded
from traitmatch.session import shuffle_partitions


def global_rank(df: DataFrame, order: Sequence[Column], out: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Number rows 1..n in ``order`` (``row_number`` over a total order).

    The same plan at every size: rows are range-partitioned and sorted in
    parallel; in that stage each row records its partition index and its
    position inside the partition, and the result is written once, so the
    positions are data and cannot change on a retry.  Counting rows per partition
    gives one row per partition; a running sum over those few rows gives each
    partition's start (at most one row per partition, hence broadcast), and
    rank = start + position + 1.  ``order`` must be a total order (end it with a
    unique key).
    """
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    pid = F.spark_partition_id()
    # monotonically_increasing_id = (partition index << 33) + row index
    pos = F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)
    positioned = cut_lineage(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                             .select("*", pid.alias("_pid"), pos.alias("_pos")), "rank")
    sizes = positioned.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (positioned.join(bounded(starts), "_pid")
            .select((F.col("_start") + F.col("_pos") + 1).cast("bigint").alias(out), *df.columns))
