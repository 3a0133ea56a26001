"""Keyed medians by bucket selection, sketches, distinct counts and fitted histograms against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_plans import physical
from traitmatch.operators import relational as rel, sketches


def middle(values):
    v = sorted(values)
    return v[(len(v) - 1) // 2] * 0.5 + v[len(v) // 2] * 0.5


@pytest.mark.parametrize("seed", range(3))
def test_medians_equal_sorting(spark, seed):
    rng = random.Random(seed)
    draw = {"small": lambda: float(rng.randint(-3, 3)), "clock": lambda: 1.7e9 + rng.random() * 5, "unit": rng.random,
            "huge": lambda: rng.choice([1e300, -1e300, 0.0, 5e-324, -2.5]), None: lambda: rng.gauss(0, 100)}
    data = [(k, rng.choice([None, f(), f(), f()])) for k, f in draw.items() for _ in range(rng.randint(1, 120))]
    data += [("none", None)] * 3 + [("one", 4.5)]
    df = spark.createDataFrame(data, "k string, v double")
    want = {k: middle([v for x, v in data if x == k and v is not None])
            for k in {k for k, v in data if v is not None}}
    assert {r.k: r.median for r in rel.median_by(df, "k", "v").collect()} == pytest.approx(want)
    window = rel.median_window(df, "k", "v")
    assert window.count() == len(data)
    shown = {r.k: r.median for r in window.where("median is not null").select("k", "median").distinct().collect()}
    assert shown == pytest.approx(want)
    assert window.where("median is null").select("k").distinct().collect() == [("none",)]


def test_infinite_values_and_nan(spark):
    df = spark.createDataFrame([("a", float("inf")), ("a", float("-inf")), ("a", 3.0), ("b", float("nan")), ("b", 1.0), ("b", 2.0)],
                               "k string, v double")
    assert rows(rel.median_by(df, "k", "v")) == [("a", 3.0), ("b", 2.0)]      # NaN is the greatest value
    assert rel.median_by(df.limit(0), "k", "v").count() == 0


def test_one_hot_key_with_distinct_values_needs_no_window_on_it(spark):
    """All rows on one key, all values distinct: sorted rows are those of one bucket."""
    df = spark.range(0, 50_001).select(F.lit("hot").alias("k"), (F.col("id") * 0.37 - 900).alias("v"))
    median = rel.median_by(df, "k", "v")
    assert rows(median) == [("hot", pytest.approx(25_000 * 0.37 - 900))]
    plan = physical(median)
    windows = [b for b in plan.split("\n\n") if "Window" in b.split("\n")[0] and "Arguments" in b]
    assert windows and all("_b#" in b for b in windows)       # partitioned by key and bucket
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_quantile_states_merge_within_the_bound(spark):
    df = spark.range(0, 60_000).select((F.col("id") % 7).alias("day"), F.pow(F.rand(3) * 10, F.lit(3)).alias("v")).cache()
    days = sketches.quantile_states(df, ["day"], "v")
    assert days.count() == 7 and days.select(F.max(F.length("state"))).first()[0] < 40_000
    for q in (0.1, 0.5, 0.9):
        guess = sketches.combine_quantile_states(days).select(sketches.quantile_of("state", q)).first()[0]
        rank = df.where(F.col("v") <= guess).count() / 60_000
        assert abs(rank - q) <= sketches.RANK_ERROR
    df.unpersist()


def test_top_states_merge_and_break_ties(spark):
    df = spark.createDataFrame([(1, "b"), (1, "b"), (2, "a"), (2, "a"), (2, "c"), (3, None)], "day int, v string")
    merged = sketches.combine_top_states(sketches.top_states(df, ["day"], "v"))
    assert merged.select(sketches.most_frequent()).first()[0] == "a"          # a and b twice each
    many = spark.range(0, 30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v"),
                                         (F.col("id") % 4).alias("day"))
    merged = sketches.combine_top_states(sketches.top_states(many, ["day"], "v", items=64), items=64)
    assert merged.select(sketches.most_frequent(ties=3)).first()[0] == "hot"


def test_distinct_counts_exact_and_merged(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", None), (None, 5)], "k string, v int")
    assert rows(rel.count_distinct(df, "k", "v")) == sorted([("a", 2), ("b", 0), (None, 1)], key=repr)
    assert rows(rel.count_distinct(df, "k", "v", approx=True)) == sorted([("a", 2), ("b", 0), (None, 1)], key=repr)
    big = spark.range(0, 80_000).select((F.col("id") % 5).alias("day"), (F.col("id") % 20_000).alias("v"))
    merged = sketches.combine_distinct_states(sketches.distinct_states(big, ["day"], "v"))
    guess = merged.select(sketches.distinct_of()).first()[0]
    assert abs(guess - 20_000) <= sketches.DISTINCT_ERROR * 20_000


def test_average_of_distinct_or_all(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 4.0), ("b", None)], "k string, v double")
    assert rows(rel.avg_distinct(df, "k", "v")) == [("a", 2.5), ("b", None)]
    assert rows(rel.avg_distinct(df, "k", "v", distinct=False)) == [("a", 2.0), ("b", None)]


@pytest.mark.parametrize("values", [[0, 7, 180], [5], [3, 3, 3], [], [0, 100], [-0.013, 0.02, 0.001], [-250, 1e6], [0.1, 0.7]])
def test_fitted_histogram(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    bins = [tuple(r) for r in rel.round_histogram(df, "v").orderBy("bin").collect()]
    assert sum(n for *_, n in bins) == len(values) and len(bins) <= 20
    if not values:
        return
    assert [b for b, *_ in bins] == list(range(len(bins)))
    width = bins[0][2] - bins[0][1]
    mantissa = width / 10 ** math.floor(math.log10(width) + 1e-9)
    assert min(abs(mantissa - m) for m in (1, 2, 5)) < 1e-6
    assert bins[0][1] <= min(values) and max(values) <= bins[-1][2]
    for _, lo, hi, n in bins:
        assert n == sum(lo <= v < hi or (v == hi == max(values) and hi == bins[-1][2]) for v in values)
