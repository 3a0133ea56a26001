"""Benchmark profile, scoring, weighting and the match result."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitmatch.functions import (
    array_member, array_overlap_count, array_to_json, clamp, join_items, json_to_array, norm, null_if_zero, num_to_text,
    round_numeric, to_double,
)
from traitmatch.operators.relational import (conditional_sums, flag_members, inner_join, median_of_counts, sort_result,
                                             where_flag, with_group_value)
from traitmatch.operators.traits import (
    COGNITIVE, COMPETENCY, CONTEXTUAL, PERSONALITY, STRENGTH_TRAIT, STRENGTHS, select_traits,
)
from traitmatch.plans.copartition import KeyedTable, heavy_keys, store_keyed
from traitmatch.plans.lineage import cut_lineage
from traitmatch.plans.sizing import bounded
from traitmatch.session import shuffle_partitions
from traitmatch.sources.files import constants

# --- fixed values ----------------------------------------------------------------------
TRAIT_WEIGHTS = [
    ("SEA", 0.084375), ("QDD", 0.084375), ("FTC", 0.084375), ("IDS", 0.084375),
    ("VCU", 0.084375), ("STO_LIE", 0.084375), ("CSI", 0.084375), ("CEX_GDR", 0.084375),
    ("IQ", 0.01), ("GTQ", 0.01), ("Pauli", 0.01), ("Faxtor", 0.01), ("Tiki", 0.01),
    ("MBTI", 0.00714), ("DISC", 0.00714),
    ("Papi_P", 0.00714), ("Papi_S", 0.00714), ("Papi_G", 0.00714), ("Papi_T", 0.00714), ("Papi_W", 0.00714),
    ("Strength", 0.05),
    ("Education", 0.035), ("Major", 0.035), ("Position", 0.035), ("Area", 0.035), ("Tenure", 0.035),
]
# raw-sum column -> (trait group, divisor of the group ratio)
GROUP_TOTALS = {
    "competency_raw": (COMPETENCY, 0.675),
    "cognitive_raw": (COGNITIVE, 0.05),
    "personality_raw": (PERSONALITY, 0.05),
    "strengths_raw": (STRENGTHS, 0.05),
    "contextual_raw": (CONTEXTUAL, 0.175),
}
INVERSE_TRAITS = ("Papi_S", "Papi_G", "Papi_T")
LIST_DISPLAY_TRAITS = ("DISC", "Education", "Major", "Position", "Area", "MBTI")
STRENGTH_SLOTS = 5.0
# -------------------------------------------------------------------------------------------

RESULT_COLUMNS = ["employee_id", "directorate", "role", "grade", "tgv_name", "tv_name",
                  "baseline_score", "user_score", "tv_match_rate", "tgv_match_rate",
                  "final_match_rate", "is_benchmark"]


def benchmark_frame(spark: SparkSession, ids: Sequence[str] | DataFrame) -> DataFrame:
    """Benchmark ids as a one-column frame: literal rows for a list (size known to
    the optimizer), the distinct ids of a given frame otherwise (lazy, no hint)."""
    if isinstance(ids, DataFrame):
        return ids.select("employee_id").distinct()
    return constants(spark, [(str(i),) for i in dict.fromkeys(ids)], "employee_id string")


def benchmark_rows(long: DataFrame, ids: DataFrame) -> DataFrame:
    """Scored-trait rows of the benchmark employees (semi join)."""
    return select_traits(long).join(ids, "employee_id", "left_semi")


def benchmark_profile_from_rows(bench: DataFrame) -> DataFrame:
    """Per trait present in the benchmark rows, its type and the
    three targets (JSON / text).  At most one row per scored trait (26).

    The benchmark rows are first counted per (trait, value); the three small
    branches share that aggregate's shuffle:

    * numeric: exact median over the counts;
    * categorical: every value with the top count (ties kept, NULL kept);
    * strength: the distinct union of all themes, made distinct per theme
      before it is gathered, so its size is bounded by the theme vocabulary.
    """
    freq = bench.groupBy("tv_name", "tv_type", "user_score").agg(F.count(F.lit(1)).alias("freq"))
    base = freq.groupBy("tv_name").agg(F.max("tv_type").alias("_type"))
    numbers = (freq.where(F.col("tv_type") == "numeric").select("tv_name", to_double("user_score").alias("_v"), "freq")
               .where(F.col("_v").isNotNull()).groupBy("tv_name", "_v").agg(F.sum("freq").alias("_n")))
    middle = (median_of_counts(numbers, ["tv_name"], "_v", "_n")
              .select("tv_name", num_to_text("median").alias("numeric_target")))
    cat = _categorical_modes(freq)
    items = (freq.where(F.col("tv_name") == STRENGTH_TRAIT)
             .select("tv_name", F.explode(json_to_array("user_score")).alias("item"))
             .where(F.col("item").isNotNull()).distinct()
             .groupBy("tv_name").agg(array_to_json(F.sort_array(F.collect_list("item"))).alias("strength_target")))
    return (base.join(middle, "tv_name", "left").join(cat, "tv_name", "left").join(items, "tv_name", "left")
            .select("tv_name", F.col("_type").alias("tv_type"), "strength_target", "numeric_target",
                    "categorical_target"))


def _categorical_modes(freq: DataFrame) -> DataFrame:
    """Per categorical trait: the JSON list of values with the top count."""
    cat = freq.where(F.col("tv_type") == "categorical")
    top = cat.groupBy("tv_name").agg(F.max("freq").alias("_top"))
    winners = cat.join(top, "tv_name").where(F.col("freq") == F.col("_top"))
    non_null = F.sort_array(F.collect_list("user_score"))
    has_null = F.max(F.col("user_score").isNull().cast("int")) == 1
    listed = F.when(has_null, F.concat(non_null, F.array(F.lit(None).cast("string")))).otherwise(non_null)
    return winners.groupBy("tv_name").agg(array_to_json(listed).alias("categorical_target"))


def categorical_targets(long: DataFrame, ids: DataFrame) -> DataFrame:
    """Per categorical trait, all most frequent benchmark values (JSON)."""
    return (benchmark_profile_from_rows(benchmark_rows(long, ids))
            .where(F.col("tv_type") == "categorical")
            .select("tv_name", F.col("categorical_target").alias("hybrid_categorical_target")))


def numeric_targets(long: DataFrame, ids: DataFrame) -> DataFrame:
    """Per numeric trait, the exact median of the benchmark values (text)."""
    return (benchmark_profile_from_rows(benchmark_rows(long, ids))
            .where(F.col("tv_type") == "numeric")
            .select("tv_name", F.col("numeric_target").alias("numeric_target_val")))


def strength_target(long: DataFrame, ids: DataFrame) -> DataFrame:
    """The distinct union of the benchmarks' themes (JSON)."""
    return (benchmark_profile_from_rows(benchmark_rows(long, ids))
            .where(F.col("tv_name") == STRENGTH_TRAIT)
            .select("tv_name", "strength_target"))


def benchmark_profile(long: DataFrame, ids: DataFrame) -> DataFrame:
    """D19."""
    return benchmark_profile_from_rows(benchmark_rows(long, ids))


def _listed(tv_name: Column) -> Column:
    return (tv_name == STRENGTH_TRAIT) | tv_name.isin(list(LIST_DISPLAY_TRAITS))


def _display(tv_name: Column, target: Column) -> Column:
    """Baseline as shown: JSON lists unpacked to ``a, b`` for the list traits."""
    return F.when(_listed(tv_name), join_items(json_to_array(target))).otherwise(target)


def scoring_targets(profile: DataFrame) -> DataFrame:
    """The profile prepared for scoring: target lists parsed and normalised,
    and the display text of each target rendered, once per trait (at most 26
    rows) -- no row of the big side parses a target."""
    name = F.col("tv_name")
    return profile.select(
        "tv_name", "strength_target", "numeric_target", "categorical_target",
        F.transform(json_to_array("strength_target"), norm).alias("_t_strength"),
        to_double("numeric_target").alias("_t_numeric"),
        F.transform(json_to_array("categorical_target"), norm).alias("_t_categorical"),
        _display(name, F.col("strength_target")).alias("_d_strength"),
        _display(name, F.col("numeric_target")).alias("_d_numeric"),
        _display(name, F.col("categorical_target")).alias("_d_categorical"))


def match_score_expr() -> Column:
    """The per-row match score of 2.9.1 (first matching branch wins).

    Expects the columns of :func:`scoring_targets` next to the user row.
    """
    u = F.col("user_score")
    ud, td = to_double(u), F.col("_t_numeric")
    overlap = array_overlap_count(json_to_array(u), F.col("_t_strength"))
    strength = F.when(u.isNull() | F.col("_t_strength").isNull(), F.lit(0.0)).otherwise(
        overlap.cast("double") / F.lit(STRENGTH_SLOTS) * F.lit(100.0))
    inverse = clamp((F.lit(2.0) * td - ud) / null_if_zero(td) * F.lit(100.0))
    direct = clamp(ud / null_if_zero(td) * F.lit(100.0))
    categorical = F.when(array_member(u, F.col("_t_categorical")), F.lit(100.0)).otherwise(F.lit(0.0))
    return (F.when(F.col("tv_name") == STRENGTH_TRAIT, strength)
             .when(F.col("tv_type") == "numeric",
                   F.when(F.col("tv_name").isin(list(INVERSE_TRAITS)), inverse).otherwise(direct))
             .otherwise(categorical))


def _by_branch(strength: str, numeric: str, other: str) -> Column:
    return (F.when(F.col("tv_name") == STRENGTH_TRAIT, F.col(strength))
             .when(F.col("tv_type") == "numeric", F.col(numeric))
             .otherwise(F.col(other)))


def match_scores(long: DataFrame, profile: DataFrame, with_display: bool = False) -> DataFrame:
    """Score every scored-trait row against the profile (0..100 or NULL).

    One target row per scored trait is kept (26 at most), which bounds what is
    broadcast whatever frame is given as the profile; scoring is map-only.
    ``with_display`` adds ``baseline_display``, the target as the result
    shows it (taken from the per-trait rendering, not parsed per row).
    """
    targets = select_traits(profile).dropDuplicates(["tv_name"])
    joined = select_traits(long).join(bounded(scoring_targets(targets)), "tv_name", "left")
    cols = ["employee_id", "tgv_name", "tv_name", "tv_type", "user_score",
            _by_branch("strength_target", "numeric_target", "categorical_target").alias("target_val_display"),
            match_score_expr().alias("match_score")]
    if with_display:
        cols.append(_by_branch("_d_strength", "_d_numeric", "_d_categorical").alias("baseline_display"))
    return joined.select(*cols)


def weights_frame(spark: SparkSession, weights: Sequence[tuple[str, float]] = TRAIT_WEIGHTS) -> DataFrame:
    return constants(spark, [(k, float(w)) for k, w in weights], "tv_name string, weight double")


def weighted_scores(scores: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """``match_score * weight``; traits without a weight drop out."""
    w = weights if weights is not None else bounded(weights_frame(scores.sparkSession))
    return (inner_join(scores, w, "tv_name")
            .withColumn("weighted_score", F.col("match_score") * F.col("weight")))


def aggregate_scores(weighted: DataFrame) -> DataFrame:
    """Final rate and the five raw group sums per employee.

    NULL scores are skipped by SUM (a missing trait lowers the total).  A
    grouped aggregate with map-side partial sums.
    """
    return conditional_sums(weighted, "employee_id", "tgv_name", "weighted_score",
                            {name: group for name, (group, _) in GROUP_TOTALS.items()}, total="final_match_rate")


def group_ratio_expr() -> Column:
    expr = None
    for name, (group, total) in GROUP_TOTALS.items():
        value = F.col(name) / F.lit(total)
        cond = F.col("tgv_name") == group
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(F.lit(0.0))


def group_ratios(weighted: DataFrame, agg: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Each row with its employee's final rate and its group's ratio.

    Pass a stored ``agg`` (see :func:`employee_rates`) where one employee may
    hold many rows: a join with a stored table is one that AQE can split, while a
    join directly above the aggregation shares its shuffle and is not split.
    ``keep`` passes extra columns through.
    """
    return (with_group_value(weighted, agg, "employee_id")
            .select("employee_id", "tgv_name", "tv_name", "user_score",
                    F.col("target_val_display").alias("baseline_score"), "match_score",
                    "final_match_rate", group_ratio_expr().alias("tgv_match_ratio"), *keep))


def result_order() -> list[Column]:
    return [F.col("is_benchmark").desc(), F.col("final_match_rate").desc_nulls_last(),
            F.col("employee_id").asc_nulls_first(), F.col("tgv_name").asc_nulls_first()]


def employee_rates(weighted: DataFrame, stg_emp: DataFrame) -> DataFrame:
    """Per employee: final rate, raw group sums, and the metadata the result shows."""
    meta = stg_emp.select("employee_id", "directorate", F.col("position").alias("role"), "grade")
    return aggregate_scores(weighted).join(meta, "employee_id", "left")


def _shown(detailed: DataFrame, idf: DataFrame) -> DataFrame:
    """The columns of the result, from scored rows with their employee's rates and metadata."""
    any_id = idf.groupBy().agg((F.count("employee_id") > 0).alias("some"))
    joined = flag_members(detailed, "employee_id", idf).where(any_id.scalar())
    return joined.select(
        "employee_id", "directorate", "role", "grade", "tgv_name", "tv_name",
        F.col("baseline_display").alias("baseline_score"),
        F.when(F.col("tv_name") == STRENGTH_TRAIT, join_items(json_to_array("user_score")))
        .otherwise(F.col("user_score")).alias("user_score"),
        F.col("match_score").alias("tv_match_rate"),
        round_numeric("tgv_match_ratio", 2).alias("tgv_match_rate"),
        round_numeric("final_match_rate", 2).alias("final_match_rate"),
        "is_benchmark",
    )


SHOWN_META = ["baseline_display", "directorate", "role", "grade"]


def talent_match(long: DataFrame, stg_emp: DataFrame, ids: Sequence[str] | DataFrame,
                 sort: bool = True, materialize: bool = True, rates: DataFrame | None = None) -> DataFrame:
    """D24 (flagship): score every employee against the benchmark profile.

    One row per employee x scored trait with metadata, display strings,
    rounded rates and the ``is_benchmark`` flag.  Without any benchmark id the
    result is empty.

    The scored rows meet one per-employee table (rates and metadata) in one join.
    With ``materialize=True`` the long table and the per-employee table are
    written once to the shared checkpoint folder: the staging plan behind them
    runs once, and AQE can split a hot employee in the join.  Pass ``False`` when
    ``long`` is a stored table already (and ``rates`` when those are stored too);
    then building the frame starts no job.  :func:`stored_match` is the form whose tables
    are stored by employee.
    """
    spark = long.sparkSession
    if materialize:
        long = cut_lineage(select_traits(long), "long_traits")
    idf = benchmark_frame(spark, ids)
    profile = benchmark_profile(long, idf)
    weighted = weighted_scores(match_scores(long, profile, with_display=True))
    if rates is None:
        rates = employee_rates(weighted, stg_emp)
        if materialize:
            rates = cut_lineage(rates, "employee_rates")
    out = _shown(group_ratios(weighted, rates, keep=SHOWN_META), idf)
    return sort_result(out, result_order()) if sort else out


@dataclass
class StoredMatch:
    """The match tables stored by ``employee_id``: nothing that joins or groups them by it moves rows."""

    scored: KeyedTable      # scored and weighted rows (D20, D21)
    rates: KeyedTable       # per employee: final rate, group sums, metadata (D22)
    result: KeyedTable      # the rows of D24

    def tables(self) -> tuple[str, ...]:
        return (*self.scored.names, *self.rates.names, *self.result.names)


def stored_match(long: DataFrame, stg_emp: DataFrame, ids: Sequence[str] | DataFrame, buckets: int | None = None,
                 profile: DataFrame | None = None) -> StoredMatch:
    """D20-D24 with scored rows, rates and result stored by employee.

    Scored rows move once, into their buckets; the per-employee sums, the join back and the result's
    aggregates then run where the rows lie.  Employees with more rows than half a
    bucket's share are kept apart (see :mod:`traitmatch.plans.copartition`).
    """
    spark = long.sparkSession
    buckets = buckets or shuffle_partitions(spark)
    idf = benchmark_frame(spark, ids)
    profile = benchmark_profile(long, idf) if profile is None else profile
    weighted = weighted_scores(match_scores(long, profile, with_display=True))
    heavy = heavy_keys(select_traits(long), "employee_id", buckets)
    scored = store_keyed(weighted, "employee_id", "scored_rows", heavy, buckets)
    meta = stg_emp.select("employee_id", "directorate", F.col("position").alias("role"), "grade")
    named = store_keyed(meta, "employee_id", "employee_meta", heavy, buckets)
    rates = scored.with_parts(aggregate_scores).join(named).stored("employee_rates", buckets, moved=True)
    rates = KeyedTable(rates.key, rates.light, rates.heavy, (*rates.names, *named.names))
    detailed = KeyedTable(scored.key, group_ratios(scored.light, rates.light, keep=SHOWN_META),
                          None if scored.heavy is None else group_ratios(scored.heavy, rates.heavy, keep=SHOWN_META))
    result = detailed.with_parts(lambda part: _shown(part, idf)).stored("match_result", buckets, moved=True)
    return StoredMatch(scored, rates, result)


def talent_match_candidates(long: DataFrame, stg_emp: DataFrame, ids: Sequence[str] | DataFrame,
                            sort: bool = True, materialize: bool = True,
                            rates: DataFrame | None = None) -> DataFrame:
    """The match result without the benchmark employees, best first."""
    out = where_flag(talent_match(long, stg_emp, ids, sort=False, materialize=materialize, rates=rates), "is_benchmark", False)
    return sort_result(out, [F.col("final_match_rate").desc_nulls_last(), F.col("employee_id"), F.col("tgv_name")]) \
        if sort else out
