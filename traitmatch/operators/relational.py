"""Generic relational operators (inventory rows P, J, A, W, O, U).

Thin where Spark already has the operator; each adds only the semantics
the talent models need (NULL handling, tie-breaks, zero fills).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traitmatch.operators.selection import middle_of_counts
from traitmatch.operators.sketches import (distinct_of, distinct_states, most_frequent, quantile_of, quantile_states,
                                           top_states)
from traitmatch.plans.ranking import global_rank
from traitmatch.plans.sizing import bounded
from traitmatch.sources.files import constants

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- projections and filters -------------------------------------------------

def tag(df: DataFrame, **literals) -> DataFrame:
    """Constant tag columns."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in literals.items()])


def where_between(df: DataFrame, col: ColumnOrName, lo, hi) -> DataFrame:
    """Inclusive range; NULL never passes."""
    return df.where(_c(col).between(lo, hi))


def where_in(df: DataFrame, col: ColumnOrName, values: Iterable, negate: bool = False) -> DataFrame:
    """P5: IN / NOT IN a literal list; a NULL value passes neither."""
    cond = _c(col).isin(list(values))
    return df.where(~cond if negate else cond)


def where_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """P6."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def flag_members(df: DataFrame, key: str, ids: DataFrame, out: str = "is_benchmark") -> DataFrame:
    """``key IN UNNEST(ids)`` as a boolean column (never NULL).

    The optimizer broadcasts the id set when its bytes allow it.
    """
    marks = ids.select(F.col(key)).distinct().select(key, F.lit(True).alias(out))
    return (df.join(marks, key, "left")
            .withColumn(out, F.coalesce(F.col(out), F.lit(False))))


def where_flag(df: DataFrame, col: str, value: bool) -> DataFrame:
    """``col IS TRUE`` / ``col IS FALSE`` (NULL passes neither)."""
    return df.where(F.col(col).eqNullSafe(F.lit(value)))


def case(branches: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """P10: searched CASE; the first matching branch wins."""
    expr = None
    for cond, value in branches:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if otherwise is not None:
        expr = expr.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return expr


def where_optional(df: DataFrame, choices: Mapping[str, object], all_value: str = "All") -> DataFrame:
    """Equality filters applied only for chosen values (``"All"`` = no filter)."""
    for col, value in choices.items():
        if value is not None and value != all_value:
            df = df.where(F.col(col) == F.lit(value))
    return df


# --- joins ---------------------------------------------------------------------

def star_join(fact: DataFrame, dims: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Left-join small dimensions on integer keys; unmatched keys give NULL.

    ``dims`` items are ``(fact_key, dim, dim_key, out_name)``; each dimension
    contributes its ``name`` column as ``out_name``.  Dimensions are
    broadcast by the optimizer when their size is known to be small (literal
    rows or small files); nothing is forced.
    """
    out = fact
    for fact_key, dim, dim_key, out_name in dims:
        d = dim.select(F.col(dim_key).alias(f"_k_{out_name}"), F.col("name").alias(out_name))
        out = out.join(d, out[fact_key] == d[f"_k_{out_name}"], "left").drop(f"_k_{out_name}")
    return out


def left_join(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left equi-join; duplicate keys on the right fan out."""
    return left.join(right, key, "left")


def inner_join(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """J3/J5."""
    return left.join(right, key, "inner")


def with_group_value(df: DataFrame, agg: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Each row joined to its own group's aggregate (left join on the
    group key).  Store the aggregate first where a key may be hot: a join of the
    rows with a stored table is one that AQE can split, while a join right above
    the aggregation shares its shuffle and is not split."""
    return df.join(agg, key, "left")


def drop_unmatched(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose joined column stayed NULL."""
    return df.dropna(subset=[col])


def explode_when(df: DataFrame, cond: Column, arr: Column, out: str) -> DataFrame:
    """``LEFT JOIN UNNEST(arr) ON cond`` -- rows meeting ``cond`` become
    one row per item (or one NULL row for an empty list); other rows keep
    one row with a NULL item."""
    return df.select("*", F.explode_outer(F.when(cond, arr)).alias(out))


# --- aggregates ------------------------------------------------------------------

def count_by(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    """Rows per key; a NULL key value is its own group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias(out))


def median_by(df: DataFrame, keys: str | Sequence[str], value: ColumnOrName, out: str = "median",
              approx: bool = False) -> DataFrame:
    """Exact median (mean of the two middle values, NULLs ignored) per group.

    Rows are first counted per (key, value), which pre-aggregates a hot key in
    each map task; the middle is then selected without a task per key (see
    :mod:`traitmatch.operators.selection`).  Groups without a value have no
    row.  ``approx=True`` estimates from a sketch state of bounded size
    (:mod:`traitmatch.operators.sketches`).
    """
    v = _c(value).cast("double")
    keys = [keys] if isinstance(keys, str) else list(keys)
    valued = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull())
    if approx:
        return quantile_states(valued, keys, "_v").select(*keys, quantile_of("state", 0.5).alias(out))
    return median_of_counts(valued.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")), keys, "_v", "_n", out)


def median_of_counts(counts: DataFrame, keys: Sequence[str], value: str, n: str, out: str = "median") -> DataFrame:
    """A13 of values that occur ``n`` times each (one row per key and value)."""
    return middle_of_counts(counts, keys, value, n, out)


def median_window(df: DataFrame, keys: str | Sequence[str], value: ColumnOrName, out: str = "median") -> DataFrame:
    """``PERCENTILE_CONT(value, 0.5) OVER (PARTITION BY keys)``: every row with the median
    of its group (NULL without a value in it).  The rows meet the medians in a join; no window holds a key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    medians = median_by(df, keys, value, out).withColumnsRenamed({k: f"_m_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(medians[f"_m_{k}"])
    return df.join(medians, same, "left").drop(*[f"_m_{k}" for k in keys])


def mode_value(df: DataFrame, col: str, approx: bool = False) -> Column:
    """A10: the most frequent non-NULL value as a scalar-subquery column.

    Ties resolve to the smallest value.  Values are counted by a distributed
    aggregate; the winner is a plain minimum over (value, count) rows, so no task
    holds a map of all values.  Attaching it to rows needs no join.  ``approx``
    estimates from a sketch state of bounded size.
    """
    values = df.where(F.col(col).isNotNull())
    if approx:
        one = top_states(values, [], col).select(most_frequent().alias("v"))
    else:
        counts = values.groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        one = counts.select(F.min_by("_v", F.struct((-F.col("_n")).alias("n"), F.col("_v").alias("v"))).alias("v"))
    return one.scalar()


def mode_rows(df: DataFrame, key: str, col: str) -> DataFrame:
    """A11 as rows: ``(key, col)`` for every value whose count equals its key's maximum (NULL counts as a value)."""
    counts = df.groupBy(key, col).agg(F.count(F.lit(1)).alias("_freq"))
    top = counts.groupBy(key).agg(F.max("_freq").alias("_top"))
    return counts.join(top, key).where(F.col("_freq") == F.col("_top")).select(key, col)


def modes_with_ties(df: DataFrame, key: str, col: str, out: str = "modes") -> DataFrame:
    """Per key, every value whose count equals the maximum, as a sorted
    array; a winning NULL is kept as a trailing NULL item.

    The array form is for few winners per key; :func:`mode_rows` gives them as
    rows, without gathering any key in one row.
    """
    winners = mode_rows(df, key, col)
    non_null = F.sort_array(F.collect_list(col))
    has_null = F.max(F.col(col).isNull().cast("int")) == 1
    return winners.groupBy(key).agg(
        F.when(has_null, F.concat(non_null, F.array(F.lit(None).cast("string")))).otherwise(non_null).alias(out))


def conditional_sums(df: DataFrame, key: str, group: str, value: str, groups: Mapping[str, str],
                     total: str | None = None) -> DataFrame:
    """A5: ``SUM(CASE WHEN group = g THEN value ELSE 0 END)`` per output column; ``total`` names the plain sum."""
    plain = [F.sum(value).alias(total)] if total else []
    return df.groupBy(key).agg(*plain, *[
        F.sum(F.when(F.col(group) == g, F.col(value)).otherwise(F.lit(0.0))).alias(name)
        for name, g in groups.items()])


def collect_sorted(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    """All non-NULL values of a group in a fixed (sorted) order."""
    return df.groupBy(key).agg(F.sort_array(F.collect_list(col)).alias(out))


def avg_distinct(df: DataFrame, key: str, col: str, out: str = "avg", distinct: bool = True) -> DataFrame:
    """Mean of the distinct values per group (``AVG(DISTINCT x)``), or of all with ``distinct=False``.

    Values are made distinct per group before the shuffle, so equal ones of a hot group collapse in the map tasks.
    """
    rows = df.select(key, col).distinct() if distinct else df
    return rows.groupBy(key).agg(F.avg(col).alias(out))


def count_distinct(df: DataFrame, key: str | Sequence[str], col: str, out: str = "n_distinct",
                   approx: bool = False) -> DataFrame:
    """Number of distinct non-NULL values per group (0 where all are NULL; a NULL group counts too).

    Exact: rows are made distinct per (group, value) first, so no task holds the values
    of a group.  ``approx`` estimates from one state of bounded size per group.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not approx:
        return df.select(*keys, col).distinct().groupBy(*keys).agg(F.count(col).alias(out))
    states = distinct_states(df, keys, col).select(*keys, distinct_of().alias(out))
    zero = df.select(*keys, F.lit(0).cast("bigint").alias(out))
    return states.unionByName(zero).groupBy(*keys).agg(F.max(out).alias(out))


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int = 20) -> DataFrame:
    """Equal-width histogram on ``[lo, hi]`` with every bin present.

    Values equal to ``hi`` fall into the last bin; values outside the range
    are clamped into the first / last bin.  Counting is a partial aggregate;
    the zero fill joins a ``bins``-row constant.
    """
    spark = df.sparkSession
    width = (hi - lo) / bins
    b = F.least(F.lit(bins - 1), F.greatest(F.lit(0),
                F.floor((F.col(col).cast("double") - F.lit(lo)) / F.lit(width)).cast("int")))
    counts = (df.where(F.col(col).isNotNull()).select(b.alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    frame = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (frame.join(counts, "bin", "left")
            .select("bin",
                    (F.lit(lo) + F.col("bin") * F.lit(width)).cast("double").alias("bin_lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).cast("double").alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("count")))


def round_histogram(df: DataFrame, col: str, max_bins: int = 20) -> DataFrame:
    """Histogram over the values' own range, in at most ``max_bins`` bins of a round width.

    The width is the least of 1, 2 or 5 times a power of ten that covers the range
    with at most ``max_bins`` bins whose edges are multiples of it.  A value on an edge belongs
    to the bin above it, the last edge to the last bin.  Every bin is present; no
    value (or only NULL and NaN) gives no bin, one distinct value one bin.  Two aggregates: the
    bounds (one row, met by scalar subqueries), then partial counts.
    """
    v = F.col("_v")
    values = df.select(F.col(col).cast("double").alias("_v")).where(v.isNotNull() & ~F.isnan(v))
    span = F.col("hi") - F.col("lo")
    # the widths from the power of ten below span / max_bins on; the first that is wide enough wins
    power = F.floor(F.log10(F.greatest(span, F.lit(1e-300)) / F.lit(float(max_bins)))).cast("int")
    widths = F.flatten(F.transform(F.sequence(power, power + 2), lambda p: F.transform(
        F.array(F.lit(1.0), F.lit(2.0), F.lit(5.0)), lambda m: F.when(p < 0, m / F.pow(F.lit(10.0), -p)).otherwise(
            m * F.pow(F.lit(10.0), p)))))
    first, last = lambda w: F.floor(F.col("lo") / w), lambda w: F.greatest(
        F.ceil(F.col("hi") / w), F.floor(F.col("lo") / w) + 1)
    fits = F.filter(widths, lambda w: last(w) - first(w) <= max_bins)
    plan = (values.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi")).where(F.col("lo").isNotNull())
            .select("lo", "hi", F.when(span > 0, fits[0]).otherwise(F.lit(1.0)).alias("w"))
            .select("w", first(F.col("w")).cast("bigint").alias("first"), last(F.col("w")).cast("bigint").alias("end")))
    width, end = (plan.select(c).scalar() for c in ("w", "end"))
    at = F.least(F.floor(v / width).cast("bigint"), end - 1).alias("_at")
    counts = values.select(at).groupBy("_at").agg(F.count(F.lit(1)).alias("_n"))
    bins = plan.select("w", "first", F.explode(F.sequence(F.col("first"), F.col("end") - 1)).alias("_bin"))
    edge = lambda n: F.round(n * F.col("w"), 9)
    return (bins.join(counts, F.col("_bin") == F.col("_at"), "left")
            .select((F.col("_bin") - F.col("first")).cast("int").alias("bin"), edge(F.col("_bin")).alias("bin_lo"),
                    edge(F.col("_bin") + 1).alias("bin_hi"), F.coalesce("_n", F.lit(0)).cast("bigint").alias("count")))


def arg_extreme(df: DataFrame, label: str, value: str, ordinal: str,
                keys: Sequence[str] = ()) -> DataFrame:
    """Label of the largest and of the smallest value; ties go to the
    first label in ``ordinal`` order."""
    hi = F.max_by(label, F.struct(F.col(value), -F.col(ordinal)))
    lo = F.min_by(label, F.struct(F.col(value), F.col(ordinal)))
    return df.groupBy(*keys).agg(hi.alias(f"max_{label}"), F.max(value).alias(f"max_{value}"),
                                 lo.alias(f"min_{label}"), F.min(value).alias(f"min_{value}"))


def row_count(df: DataFrame, out: str = "n") -> DataFrame:
    """Number of rows, as a one-row frame."""
    return df.groupBy().agg(F.count(F.lit(1)).alias(out))


# --- windows, sorting, top-k ----------------------------------------------------------

def row_number_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "rn") -> DataFrame:
    """W2."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top_n_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 5,
             out: str | None = None) -> DataFrame:
    """First ``n`` rows per group.  The filter on ``row_number`` lets Spark
    plan a ``WindowGroupLimit`` that keeps only ``n`` rows per group before
    the shuffle, so a hot group costs no more than a normal one."""
    ranked = row_number_by(df, keys, order, out or "_rn").where(F.col(out or "_rn") <= n)
    return ranked if out else ranked.drop("_rn")


def best_label(value: str, label: str) -> Column:
    """The label with the highest value as an aggregate (ties: smallest label; a NULL value only wins over none)."""
    v = F.col(value)
    return F.min_by(label, F.struct(v.isNull().alias("n"), (-v).alias("v"), F.col(label).alias("l")))


def top_1_by(df: DataFrame, key: str, value: str, label: str, out: str, fill: str | None = None,
             nulls: bool = False) -> DataFrame:
    """Per key, the label with the highest value; an aggregate, so it pre-aggregates before the shuffle.

    Rows without a value are left out, or with ``nulls`` only win where a key has no other.
    """
    rows = df if nulls else where_not_null(df, value)
    res = rows.groupBy(key).agg(best_label(value, label).alias(out))
    return res if fill is None else res.fillna({out: fill})


def sort_result(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """O1/O2: a total sort (range-partitioned, parallel)."""
    return df.orderBy(*order)


def pick_first(df: DataFrame, key: str, wanted: DataFrame, order: Sequence[Column], n: int = 3) -> DataFrame:
    """O3: rows whose ``key`` is among ``wanted``, first ``n`` in ``order``
    (a top-n: each partition keeps its best ``n`` before the merge)."""
    return df.join(wanted.select(key).distinct(), key, "left_semi").orderBy(*order).limit(n)


def sorted_options(df: DataFrame, kind: str, value: str, order: Sequence[Column]) -> DataFrame:
    """Distinct ``(kind, value)`` choices with their position in sorted order
    inside their kind: one window over the distinct values, no global sort."""
    vals = df.where(F.col(value).isNotNull()).distinct()
    return vals.select(kind, value, F.row_number().over(Window.partitionBy(kind).orderBy(*order))
                       .cast("bigint").alias("ordinal"))


# --- set operations and reshaping ------------------------------------------------------------

def union_all(*dfs: DataFrame) -> DataFrame:
    """Positional union of frames with the same columns."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df)
    return out


def wide_to_long(df: DataFrame, ids: Sequence[str], spec: Sequence[tuple[Column, Mapping[str, str]]],
                 value_name: str = "value") -> DataFrame:
    """One output row per (input row, spec item); NULL values keep their row.

    ``spec`` items are ``(value_column, {tag_column: tag_value, ...})``.  The
    rows are produced by one ``inline`` generator: a single map-only pass.
    """
    structs = []
    for value, tags in spec:
        fields = [F.lit(v).cast("string").alias(k) for k, v in tags.items()]
        structs.append(F.struct(*fields, value.cast("string").alias(value_name)))
    return df.select(*ids, F.inline(F.array(*structs)))


def long_to_wide(df: DataFrame, key: str, value: str, keys: Sequence[str],
                 name_fn=lambda k: k, group_by: Sequence[str] = ()) -> DataFrame:
    """U4: pivot to one column per fixed key value (``any_value`` of each)."""
    aggs = [F.max(F.when(F.col(key) == k, F.col(value))).alias(name_fn(k)) for k in keys]
    return df.groupBy(*group_by).agg(*aggs)


def reindex(df: DataFrame, key: str, ordered_keys: Sequence[str], value_cols: Sequence[str],
            fill=0.0) -> DataFrame:
    """Force a fixed, ordered key set; missing keys get ``fill``."""
    spark = df.sparkSession
    frame = bounded(constants(spark, [(k, i) for i, k in enumerate(ordered_keys)], f"{key} string, ordinal int"))
    joined = frame.join(df, key, "left")
    return joined.select(key, "ordinal",
                         *[F.coalesce(F.col(c).cast("double"), F.lit(float(fill))).alias(c) for c in value_cols])
