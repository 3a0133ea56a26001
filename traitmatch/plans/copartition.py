"""Tables stored by key, so that later joins and aggregates on it move no rows.

A stored part is bucketed by the key: Spark knows from the catalog where each
key lies and plans no exchange on it.  A bucket cannot be split, so keys that hold more
rows than half a bucket's share are kept apart in a plain table, whose joins and
aggregates are ordinary ones that AQE can split.  Each operation runs on both parts and is exact.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitmatch.plans.lineage import cut_lineage
from traitmatch.plans.sizing import bounded
from traitmatch.sources.files import materialize


def heavy_keys(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """The keys with more than half a bucket's share of the rows: at most ``2 * buckets``, stored once.

    The counts are pre-aggregated in the map tasks; the total is a scalar subquery over them.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    limit = counts.agg((F.sum("_n") / F.lit(2.0 * buckets)).alias("_limit")).scalar()
    return cut_lineage(counts.where(F.col("_n") > limit).select(key), "heavy_keys")


@dataclass
class KeyedTable:
    """Rows of all keys: ``light`` bucketed by ``key``, ``heavy`` plain (``None`` if no key is heavy)."""

    key: str
    light: DataFrame
    heavy: DataFrame | None
    names: tuple[str, ...] = ()

    def rows(self) -> DataFrame:
        return self.light if self.heavy is None else self.light.unionByName(self.heavy)

    def with_parts(self, fn: Callable[[DataFrame], DataFrame]) -> KeyedTable:
        """``fn`` on each part: any operation that treats rows alone or groups them by the key."""
        return KeyedTable(self.key, fn(self.light), None if self.heavy is None else fn(self.heavy))

    def join(self, other: KeyedTable, how: str = "left") -> KeyedTable:
        """Rows with the row(s) of their key in ``other``, which is stored with the same heavy keys and buckets."""
        heavy = None if self.heavy is None else self.heavy.join(other.heavy, self.key, how)
        return KeyedTable(self.key, self.light.join(other.light, self.key, how), heavy)

    def stored(self, name: str, buckets: int, moved: bool = False) -> KeyedTable:
        """This table written to shared storage; ``moved`` if its light rows lie by key already."""
        light = self.light if moved else self.light.repartition(buckets, self.key)
        unique = f"{name}_{uuid.uuid4().hex[:8]}"
        return KeyedTable(self.key, materialize(light, unique, as_="table", bucket_by=self.key, buckets=buckets),
                          None if self.heavy is None else cut_lineage(self.heavy, f"{name}_heavy"), (unique,))


def store_keyed(df: DataFrame, key: str, name: str, heavy: DataFrame, buckets: int) -> KeyedTable:
    """``df`` stored by ``key``; ``heavy`` (see :func:`heavy_keys`) names the keys kept apart."""
    if heavy.isEmpty():
        return KeyedTable(key, df, None).stored(name, buckets)
    few = bounded(heavy)                                   # at most 2 * buckets keys
    apart = KeyedTable(key, df.join(few, key, "left_anti"), df.join(few, key, "left_semi"))
    return apart.stored(name, buckets)
