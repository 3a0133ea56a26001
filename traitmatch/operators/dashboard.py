"""Dashboard data: directory, filters, ranking, histograms, comparisons
(D26-D37).  Every output is a DataFrame; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitmatch.functions import as_float, code_prefix, display_label, to_double
from traitmatch.operators.relational import (
    arg_extreme, avg_distinct, best_label, drop_unmatched, histogram, inner_join, left_join, long_to_wide, pick_first, reindex,
    round_histogram, row_count, sort_result, sorted_options, top_1_by, where_flag, where_optional,
)
from traitmatch.operators.traits import SCORED_TRAITS, TRAIT_GROUPS
from traitmatch.plans.ranking import global_rank
from traitmatch.plans.sizing import bounded
from traitmatch.sources.files import constants
from traitmatch.sources.fixtures import CURRENT_YEAR

# --- fixed values ------------------------------------------------------------------
UNKNOWN = "Unknown"
NO_GROUP = "N/A"
ALL = "All"
COMPETENCY_FIELDS = ["SEA", "QDD", "FTC", "IDS", "VCU", "STO_LIE", "CSI", "CEX_GDR"]
KEY_COMPETENCY_MIN = 4.5
DEFAULT_COMPETENCY_LINE = "Standard Competencies based on Benchmark Median"
# -------------------------------------------------------------------------------------


def employee_directory(stg_emp: DataFrame, perf: DataFrame, year: int = CURRENT_YEAR) -> DataFrame:
    """Id, name, role, grade, that year's rating (0 when missing) and a
    ``name (id)`` display label; missing role/grade -> ``Unknown``; sorted by name."""
    py = perf.where(F.col("year") == year).select("employee_id", F.col("rating").alias("_rating"))
    named = (left_join(stg_emp, py, "employee_id")
            .select("employee_id", "fullname",
                    F.coalesce(F.col("position"), F.lit(UNKNOWN)).alias("role"),
                    F.coalesce(F.col("grade"), F.lit(UNKNOWN)).alias("grade"),
                    as_float(F.coalesce(F.col("_rating"), F.lit(0))).alias("rating"),
                    display_label("fullname", "employee_id").alias("display")))
    return sort_result(named, [F.col("fullname").asc_nulls_first(), F.col("employee_id")])


def filter_directory(directory: DataFrame, role: str = ALL, grade: str = ALL,
                     rating: str | float = ALL) -> DataFrame:
    """Cascading optional filters role -> grade -> rating."""
    out = where_optional(directory, {"role": role, "grade": grade})
    if rating is not None and rating != ALL:
        out = out.where(F.col("rating") == F.lit(float(rating)))
    return out


def filter_options(directory: DataFrame, role: str = ALL, grade: str = ALL) -> DataFrame:
    """The choices each filter offers given the earlier choices:
    ``(kind, value, ordinal)`` -- roles and grades ascending, ratings above 0
    descending (as text, e.g. ``3.0``)."""
    step1 = where_optional(directory, {"role": role})
    step2 = where_optional(step1, {"grade": grade})
    none = F.lit(None).cast("double")
    roles = directory.select(F.lit("role").alias("kind"), F.col("role").alias("value"), none.alias("_number"))
    grades = step1.select(F.lit("grade").alias("kind"), F.col("grade").alias("value"), none.alias("_number"))
    ratings = step2.where(F.col("rating") > 0).select(
        F.lit("rating").alias("kind"), F.col("rating").cast("string").alias("value"), F.col("rating").alias("_number"))
    return sorted_options(roles.unionByName(grades).unionByName(ratings), "kind", "value",
                          [F.col("_number").desc(), F.col("value")])


def default_benchmarks(directory: DataFrame, defaults: DataFrame, n: int = 3) -> DataFrame:
    """The default ids still present in the (filtered) directory, first
    ``n`` in directory order (by name)."""
    return (pick_first(directory, "employee_id", defaults,
                       [F.col("fullname").asc_nulls_first(), F.col("employee_id")], n)
            .select("employee_id", "display"))


def top_group(result: DataFrame) -> DataFrame:
    """Per employee the trait group with the highest group rate (ties:
    group name; a NULL rate only wins when all are NULL)."""
    return top_1_by(result, "employee_id", "tgv_match_rate", "tgv_name", "top_tgv", nulls=True)


def candidates(result: DataFrame, directory: DataFrame) -> DataFrame:
    """The rows of D31 without their rank: one aggregation by employee gives rate,
    flag and best group, and meets the directory on the same key."""
    per_emp = result.groupBy("employee_id").agg(
        F.max("directorate").alias("directorate"), F.max("final_match_rate").alias("final_match_rate"),
        F.max("is_benchmark").alias("is_benchmark"),
        F.coalesce(best_label("tgv_match_rate", "tgv_name"), F.lit(NO_GROUP)).alias("top_tgv"))
    named = drop_unmatched(directory.select("employee_id", "fullname", "role", "grade"), "fullname")
    return (inner_join(where_flag(per_emp, "is_benchmark", False), named, "employee_id")
            .select("employee_id", "fullname", "role", "grade", "directorate", "top_tgv", "final_match_rate"))


def candidate_order() -> list[Column]:
    return [F.col("final_match_rate").desc_nulls_last(), F.col("employee_id").asc()]


def ranked_candidates(result: DataFrame, directory: DataFrame) -> DataFrame:
    """One row per named, non-benchmark employee, ranked by final rate
    (ties by id), with the best trait group (``N/A`` if none)."""
    return global_rank(candidates(result, directory), candidate_order())


def best_candidate(result: DataFrame, directory: DataFrame) -> DataFrame:
    """The id ranked first (a top-1, without ranking the rest)."""
    return candidates(result, directory).orderBy(*candidate_order()).limit(1).select("employee_id")


def candidate_count(result: DataFrame, directory: DataFrame) -> DataFrame:
    """The number of candidates, one row."""
    return row_count(candidates(result, directory), "n_candidates")


def rate_histogram(candidates: DataFrame, bins: int = 20, data_range: bool = False) -> DataFrame:
    """Candidate count per bin of the final rate: ``bins`` equal bins on 0..100, or with
    ``data_range`` at most ``bins`` bins of a round width over the rates' own range."""
    if data_range:
        return round_histogram(candidates, "final_match_rate", bins)
    return histogram(candidates, "final_match_rate", 0.0, 100.0, bins)


def group_averages(result: DataFrame, distinct: bool = True) -> DataFrame:
    """Per trait group, the mean over the *distinct* candidate group rates
    (two candidates with the same rate count once).

    ``distinct=False`` counts every candidate: one rate per candidate and group, however many traits
    the group has.
    """
    cand = where_flag(result, "is_benchmark", False)
    if not distinct:
        cand = cand.select("employee_id", "tgv_name", "tgv_match_rate").distinct()
    return sort_result(avg_distinct(cand, "tgv_name", "tgv_match_rate", "avg_match_rate", distinct), [F.col("avg_match_rate")])


def _id_frame(result: DataFrame, ids: str | DataFrame) -> DataFrame:
    """One or a few ids as a frame to semi-join with: a literal row, or the
    distinct ids of a given frame."""
    if isinstance(ids, DataFrame):
        return ids.select("employee_id").distinct()
    return bounded(constants(result.sparkSession, [(ids,)], "employee_id string"))


def compare_to_benchmark(result: DataFrame, candidate: str | DataFrame) -> DataFrame:
    """Per trait group (fixed order): benchmark distinct-average,
    candidate rate, both 0-filled, and candidate minus benchmark."""
    bench = avg_distinct(where_flag(result, "is_benchmark", True), "tgv_name", "tgv_match_rate", "benchmark_avg")
    cand_rows = result.join(_id_frame(result, candidate), "employee_id", "left_semi")
    cand = (cand_rows.select("tgv_name", "tgv_match_rate").distinct()
            .groupBy("tgv_name").agg(F.max("tgv_match_rate").alias("candidate_rate")))
    both = bench.join(cand, "tgv_name", "full")
    filled = reindex(both, "tgv_name", TRAIT_GROUPS, ["benchmark_avg", "candidate_rate"], fill=0.0)
    return filled.withColumn("diff", F.col("candidate_rate") - F.col("benchmark_avg"))


def strongest_and_gap(comparison: DataFrame) -> DataFrame:
    """The group with the largest and the smallest difference (ties:
    first group in the fixed order)."""
    ext = arg_extreme(comparison, "tgv_name", "diff", "ordinal")
    return ext.select(F.col("max_tgv_name").alias("strongest"), F.col("max_diff").alias("strongest_diff"),
                      F.col("min_tgv_name").alias("weakest"), F.col("min_diff").alias("weakest_diff"))


def baseline_profile(result: DataFrame, traits: Sequence[str] = SCORED_TRAITS) -> DataFrame:
    """The distinct (trait, baseline) pairs as one wide row with a
    ``baseline_<trait>`` column per scored trait; ``N/A`` where there is none."""
    pairs = result.select("tv_name", "baseline_score").distinct()
    wide = long_to_wide(pairs, "tv_name", "baseline_score", traits, name_fn=lambda t: f"baseline_{t.lower()}")
    return wide.select(*[F.coalesce(c, F.lit(NO_GROUP)).alias(c) for c in wide.columns])


def key_competencies(result: DataFrame, pillars: DataFrame, minimum: float = KEY_COMPETENCY_MIN) -> DataFrame:
    """Competency traits whose baseline is at least ``minimum``, as
    ``Label (value)`` lines in the fixed competency order; a composite uses the
    label of its first part; one default line when none qualifies."""
    spark = result.sparkSession
    order = constants(spark, [(c, i + 1) for i, c in enumerate(COMPETENCY_FIELDS)], "tv_name string, ordinal int")
    values = (result.select("tv_name", "baseline_score").distinct()
              .join(bounded(order), "tv_name")
              .groupBy("tv_name", "ordinal").agg(F.max("baseline_score").alias("baseline_score"))
              .withColumn("value", to_double("baseline_score"))
              .where(F.col("value") >= F.lit(minimum)))
    labels = pillars.select(F.col("pillar_code").alias("_code"), F.col("pillar_label").alias("_label"))
    lines = (values.join(labels, code_prefix(F.col("tv_name")) == F.col("_code"), "left")
             .select("ordinal", "tv_name",
                     F.concat(F.coalesce(F.col("_label"), F.upper(F.col("tv_name"))), F.lit(" ("),
                              F.col("value").cast("string"), F.lit(")")).alias("line")))
    fallback = (lines.groupBy().agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == 0)
                .select(F.lit(0).alias("ordinal"), F.lit(None).cast("string").alias("tv_name"),
                        F.lit(DEFAULT_COMPETENCY_LINE).alias("line")))
    return lines.unionByName(fallback)
