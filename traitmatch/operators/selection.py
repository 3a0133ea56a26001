"""Exact keyed order statistics without a task per key.

A median needs the value at one or two positions of a key's sorted values.  Sorting a key
in one task does not scale to a hot key with many distinct values, so the position
is narrowed down instead.  Values fall into buckets by a monotone function; the
counts per bucket tell which bucket holds a position, and only that bucket's rows
are looked at again, in order.  Buckets are functions of the value alone: nothing is
sampled or stored, the plan is lazy, and a retried task gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per unit of log(1 + |v|): values about 0.1 % apart (0.001 apart around 0) share one.  A key has at most
# 2 * 712 * 1024 of them, and some 7,000 between 1 and 1000.
RESOLUTION = 1024
_LARGEST = 712.0     # above log(1 + the greatest double)


def _bucket(v: Column) -> Column:
    """Number of a value's bucket; rises with the value, NaN last (as Spark orders it)."""
    log = F.signum(v) * F.log1p(F.abs(v))
    held = F.least(F.greatest(log, F.lit(-_LARGEST)), F.lit(_LARGEST))
    return F.floor(F.when(F.isnan(v), F.lit(_LARGEST + 1.0)).otherwise(held) * F.lit(float(RESOLUTION))).cast("bigint")


def _holding(parts: Column) -> Column:
    """Of a key's sorted ``(bucket, n)`` parts (``_all`` rows): those that hold a middle position, each with the rows before it."""
    low, high = F.expr("(_all - 1) div 2"), F.expr("_all div 2")
    none = F.array().cast("array<struct<bucket:bigint,start:bigint>>")

    def step(acc, x):
        after = acc["run"] + x["n"]
        hit = (acc["run"] <= high) & (after > low)
        here = F.array(F.struct(x["bucket"].alias("bucket"), acc["run"].alias("start")))
        return F.struct(after.alias("run"), F.when(hit, F.concat(acc["found"], here)).otherwise(acc["found"]).alias("found"))

    return F.aggregate(parts, F.struct(F.lit(0).cast("bigint").alias("run"), none.alias("found")), step, lambda acc: acc["found"])


def middle_of_counts(counts: DataFrame, keys: Sequence[str], value: str, n: str, out: str = "median") -> DataFrame:
    """Exact median per key of values that occur ``n`` times each (one row per key and value).

    The mean of the two middle values; keys without a row have none, a NULL key is a
    key.  No task sorts or gathers the rows of a key: rows are summed per bucket (one row gathers the
    bucket counts of a key, whose number ``RESOLUTION`` bounds), and only the rows of a
    bucket that holds a middle position are sorted, of which a key has one or two.
    """
    keys = list(keys)
    rows = (counts.select(*keys, F.col(value).cast("double").alias("_v"), F.col(n).alias("_n"))
            .withColumn("_b", _bucket(F.col("_v"))))
    parts = F.array_sort(F.collect_list(F.struct(F.col("_b").alias("bucket"), F.col("_n").alias("n"))))
    listed = (rows.groupBy(*keys, "_b").agg(F.sum("_n").alias("_n"))
              .groupBy(*keys).agg(parts.alias("_parts"), F.sum("_n").alias("_all")))
    found = (listed.select(*[F.col(k).alias(f"_f_{k}") for k in keys], "_all", F.explode(_holding(F.col("_parts"))).alias("_hit"))
             .select(*[f"_f_{k}" for k in keys], "_all", F.col("_hit.bucket").alias("_f_b"), F.col("_hit.start").alias("_start")))
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(found[f"_f_{k}"]) for k in keys], rows["_b"] == found["_f_b"])
    in_order = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.join(found, same).withColumn("_upto", F.col("_start") + F.sum("_n").over(in_order))
    covers = lambda pos: (F.col("_upto") > pos) & (F.col("_upto") - F.col("_n") <= pos)
    low, high = covers(F.expr("(_all - 1) div 2")), covers(F.expr("_all div 2"))
    return (placed.where(low | high).groupBy(*keys)
            .agg((F.max(F.when(low, F.col("_v"))) * 0.5 + F.max(F.when(high, F.col("_v"))) * 0.5).alias(out)))
