"""Stored sketch states that merge: quantiles, most frequent values, distinct counts.

A state is one small binary per key (a few kB whatever the number of rows).  States of
single days or years are stored once and merged for any span of them, so an
estimate never reads the rows again.  Three forms each: accumulate rows, combine
states, estimate from a state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILE_K = 800             # values held per level of a quantile state
RANK_ERROR = 0.01            # bound used for it: over twice the 99 % error of such a state (0.4 %)
TOP_K_ITEMS = 10_000         # values tracked by a most-frequent state; exact below as many distinct values
DISTINCT_LG_K = 14           # registers of a distinct state: 2 ** 14
DISTINCT_ERROR = 0.03        # bound used for it: over three standard errors (0.8 %)


# --- quantiles (A13 approx) --------------------------------------------------------

def quantile_states(df: DataFrame, keys: Sequence[str], value: str, k: int = QUANTILE_K) -> DataFrame:
    """``keys.., state``: a quantile state of each key's values (NULLs are left out; no row for a key without one)."""
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    return rows.groupBy(*keys).agg(F.expr(f"kll_sketch_agg_double(_v, {int(k)})").alias("state"))


def combine_quantile_states(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys.., state``: the states of each key merged into one."""
    return states.groupBy(*keys).agg(F.expr("kll_merge_agg_double(state)").alias("state"))


def quantile_of(state: str = "state", q: float = 0.5) -> Column:
    """The value at rank ``q`` of a state, within ``RANK_ERROR`` of that rank."""
    return F.expr(f"kll_sketch_get_quantile_double(`{state}`, {float(q)}D)")


# --- most frequent values (A10 approx) -----------------------------------------------

def top_states(df: DataFrame, keys: Sequence[str], value: str, items: int = TOP_K_ITEMS) -> DataFrame:
    """``keys.., state``: counts of each key's most frequent values (NULLs are left out).

    Exact while a key has fewer than three quarters of ``items`` distinct values; beyond,
    counts are off by at most the rows over ``items``' share.
    """
    rows = df.where(F.col(value).isNotNull())
    return rows.groupBy(*keys).agg(F.expr(f"approx_top_k_accumulate(`{value}`, {int(items)})").alias("state"))


def combine_top_states(states: DataFrame, keys: Sequence[str] = (), items: int = TOP_K_ITEMS) -> DataFrame:
    return states.groupBy(*keys).agg(F.expr(f"approx_top_k_combine(state, {int(items)})").alias("state"))


def most_frequent(state: str = "state", ties: int = 1000) -> Column:
    """The most frequent value of a state; of several with that count (looked for among the
    first ``ties``) the smallest."""
    top = F.expr(f"approx_top_k_estimate(`{state}`, {int(ties)})")
    best = F.array_max(F.transform(top, lambda x: x["count"]))
    return F.array_min(F.transform(F.filter(top, lambda x: x["count"] == best), lambda x: x["item"]))


# --- distinct counts (A12 approx) ------------------------------------------------------

def distinct_states(df: DataFrame, keys: Sequence[str], value: str, lg_k: int = DISTINCT_LG_K) -> DataFrame:
    """``keys.., state``: a distinct-count state of each key's values, of any type (NULLs are left out)."""
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.xxhash64(value).alias("_v"))
    return rows.groupBy(*keys).agg(F.hll_sketch_agg("_v", F.lit(lg_k)).alias("state"))


def combine_distinct_states(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return states.groupBy(*keys).agg(F.hll_union_agg("state").alias("state"))


def distinct_of(state: str = "state") -> Column:
    """The estimated number of distinct values, within ``DISTINCT_ERROR`` (relative)."""
    return F.hll_sketch_estimate(state)
