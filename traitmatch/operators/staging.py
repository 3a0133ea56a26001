"""Staging models: clean and impute the raw talent tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitmatch.functions import map_value
from traitmatch.operators.relational import (inner_join, left_join, median_by, mode_value, star_join, top_n_by,
                                             where_between, where_not_null)
from traitmatch.sources.fixtures import CURRENT_YEAR

# --- fixed values ------------------------------------------------------------------
COMPETENCY_INVALID_SCORES = (0, 6, 99)
JUNK_THEMES = ("", "nan", "none")
MBTI_UNKNOWN_INPUT = "inftj"
MBTI_UNKNOWN = "UNKNOWN"
COGNITIVE_EXCLUDED_DEPARTMENT = 4
DISC_WORD_CODES = {
    "Dominant-Influencer": "DI",
    "Dominant-Steadiness": "DS",
    "Dominant-Conscientious": "DC",
    "Influencer-Dominant": "ID",
    "Influencer-Steadiness": "IS",
    "Influencer-Conscientious": "IC",
    "Steadiness-Dominant": "SD",
    "Steadiness-Influencer": "SI",
    "Steadiness-Conscientious": "SC",
    "Conscientious-Dominant": "CD",
    "Conscientious-Influencer": "CI",
    "Conscientious-Steadiness": "CS",
    "Dominance": "D",
    "Influence": "I",
    "Steadiness": "S",
    "Conscientiousness": "C",
}
# ---------------------------------------------------------------------------------------


def impute_group_median(df: DataFrame, key: str, value: str, invalid: Sequence[int] = (),
                        median_where: Column | None = None, out: str = "score_imputed",
                        approx: bool = False) -> DataFrame:
    """Sentinel values -> NULL, then NULL -> median of the valid values of
    the same ``key``; NULL stays when the group has no valid value.

    The medians start from counts per (key, value), so a hot key is
    pre-aggregated before the shuffle; how they join back is the optimizer's choice.
    """
    v = F.col(value)
    is_invalid = v.isin(list(invalid)) if invalid else F.lit(False)
    valid = df.where(v.isNotNull() & ~is_invalid)
    if median_where is not None:
        valid = valid.where(median_where)
    medians = median_by(valid, key, value, out="_median", approx=approx)
    cleaned = F.when(~is_invalid, v.cast("double"))
    return (df.join(medians, key, "left")
            .select(*df.columns, F.coalesce(cleaned, F.col("_median")).alias(out)))


def stg_competencies(comp: DataFrame, year: int = CURRENT_YEAR,
                     invalid: Sequence[int] = COMPETENCY_INVALID_SCORES) -> DataFrame:
    """Competency scores of ``year``, imputed with that year's pillar medians."""
    this_year = comp.where(F.col("year") == year)
    return (impute_group_median(this_year, "pillar_code", "score", invalid)
            .select("employee_id", "pillar_code", "year", "score_imputed"))


def stg_competencies_yearly(comp: DataFrame, median_year: int = CURRENT_YEAR,
                            invalid: Sequence[int] = COMPETENCY_INVALID_SCORES) -> DataFrame:
    """D3: all years, imputed with the medians of ``median_year``."""
    return (impute_group_median(comp, "pillar_code", "score", invalid,
                                median_where=F.col("year") == median_year)
            .select("employee_id", "pillar_code", "year", "score_imputed"))


def stg_papi(papi: DataFrame) -> DataFrame:
    """PAPI scores imputed with the scale median (0 is a valid score)."""
    return (impute_group_median(papi, "scale_code", "score")
            .select("employee_id", "scale_code", "score_imputed"))


def stg_performance_yearly(perf: DataFrame, before: int = CURRENT_YEAR) -> DataFrame:
    """History ratings: not NULL, 1..5, before ``before``."""
    rated = where_between(where_not_null(perf, "rating"), "rating", 1, 5)
    return rated.where(F.col("year") < before).select("employee_id", "year", "rating")


def stg_strengths(strengths: DataFrame, n: int = 5) -> DataFrame:
    """Drop junk themes, keep the first ``n`` by rank per employee.

    Ties in ``rank`` are broken by theme.  The theme text itself is kept
    untrimmed.
    """
    junk = F.lower(F.trim(F.col("theme"))).isin(list(JUNK_THEMES))
    clean = strengths.where(F.col("theme").isNotNull() & ~junk)
    return (top_n_by(clean, ["employee_id"], [F.col("rank"), F.col("theme")], n)
            .select("employee_id", "theme"))


def _rated(perf: DataFrame, year: int) -> DataFrame:
    return perf.where((F.col("year") == year) & F.col("rating").between(1, 5))


def cognitive_medians(employees: DataFrame, psych: DataFrame, perf: DataFrame,
                      year: int = CURRENT_YEAR,
                      exclude_dept: int = COGNITIVE_EXCLUDED_DEPARTMENT) -> DataFrame:
    """Per department, medians of ``iq`` and ``gtq`` over employees rated
    1..5 in ``year`` with iq or gtq present; one department excluded.
    Duplicate psych/performance rows count as often as they occur."""
    e = employees.where(F.col("department_id") != exclude_dept).select("employee_id", "department_id")
    p = psych.select("employee_id", "iq", "gtq")
    py = _rated(perf, year).select("employee_id")
    rows = (e.join(p, "employee_id").join(py, "employee_id")
            .where(F.col("iq").isNotNull() | F.col("gtq").isNotNull()))
    # one (department, test, value) row per score, so both medians share one pass
    tests = rows.select("department_id", F.inline(F.array(*[
        F.struct(F.lit(t).alias("test"), F.col(t).cast("double").alias("value")) for t in ("iq", "gtq")])))
    medians = median_by(tests, ["department_id", "test"], "value")
    return medians.groupBy("department_id").agg(*[
        F.max(F.when(F.col("test") == t, F.col("median"))).alias(f"median_{t}") for t in ("iq", "gtq")])


def clean_mbti_value(c: Column) -> Column:
    return (F.when(F.lower(F.trim(c)) == MBTI_UNKNOWN_INPUT, F.lit(MBTI_UNKNOWN))
             .otherwise(F.upper(F.trim(c))))


def clean_mbti(psych: DataFrame) -> DataFrame:
    """``inftj`` (any case, spaces) -> ``UNKNOWN``; else trimmed upper case."""
    return psych.select("employee_id", clean_mbti_value(F.col("mbti")).alias("mbti_val"))


def mbti_mode(psych: DataFrame, approx: bool = False) -> Column:
    """The most frequent clean MBTI over all psych rows (a scalar column;
    ties -> smallest value)."""
    return mode_value(clean_mbti(psych), "mbti_val", approx=approx)


def disc_code(disc: Column, disc_word: Column, mapping: Mapping[str, str] = DISC_WORD_CODES) -> Column:
    """``UPPER(TRIM(COALESCE(disc, code_of(TRIM(disc_word)))))``."""
    return F.upper(F.trim(F.coalesce(disc, map_value(F.trim(disc_word), mapping))))


def clean_disc(psych: DataFrame) -> DataFrame:
    return psych.select("employee_id", disc_code(F.col("disc"), F.col("disc_word")).alias("disc"),
                        "disc_word")


def stg_employees(employees: DataFrame, psych: DataFrame, perf: DataFrame,
                  dims: Mapping[str, DataFrame], year: int = CURRENT_YEAR,
                  exclude_dept: int = COGNITIVE_EXCLUDED_DEPARTMENT) -> DataFrame:
    """One denormalised row per employee rated 1..5 in ``year``.

    Eight dimension names, imputed iq/gtq (NULL in the excluded department),
    MBTI with the global mode as fallback, DISC code, test scores and the
    rating.  Duplicate psych or performance rows fan out, as in the source
    model (the MBTI lookup is its own join on purpose).
    """
    e = star_join(employees, [
        ("department_id", dims["dim_departments"], "department_id", "department"),
        ("position_id", dims["dim_positions"], "position_id", "position"),
        ("grade_id", dims["dim_grades"], "grade_id", "grade"),
        ("education_id", dims["dim_education"], "education_id", "education_level"),
        ("major_id", dims["dim_majors"], "major_id", "major"),
        ("company_id", dims["dim_companies"], "company_id", "company"),
        ("area_id", dims["dim_areas"], "area_id", "area"),
        ("directorate_id", dims["dim_directorates"], "directorate_id", "directorate"),
    ])
    cog = cognitive_medians(employees, psych, perf, year, exclude_dept)
    mode = mbti_mode(psych)
    p = psych.select("employee_id", "iq", "gtq", "disc", "disc_word", "pauli", "tiki", "faxtor")
    mc = clean_mbti(psych)
    py = _rated(perf, year).select("employee_id", "rating")
    described = left_join(left_join(left_join(e, p, "employee_id"), cog, "department_id"), mc, "employee_id")
    joined = inner_join(described, py, "employee_id")
    in_excluded = F.col("department_id") == exclude_dept
    return joined.select(
        "employee_id", "fullname", "nip",
        F.col("years_of_service_months").alias("tenure_months"),
        "department_id", "company", "area", "department", "position", "directorate", "grade",
        "education_level", "major",
        F.when(in_excluded, F.lit(None).cast("double"))
        .otherwise(F.coalesce(F.col("iq").cast("double"), F.col("median_iq"))).alias("iq_imputed"),
        F.when(in_excluded, F.lit(None).cast("double"))
        .otherwise(F.coalesce(F.col("gtq").cast("double"), F.col("median_gtq"))).alias("gtq_imputed"),
        F.coalesce(F.col("mbti_val"), mode).alias("mbti_final"),
        disc_code(F.col("disc"), F.col("disc_word")).alias("disc"),
        "disc_word",
        F.col("pauli").alias("pauli_score"),
        F.col("tiki").alias("tiki_score"),
        F.col("faxtor").alias("faxtor_score"),
        "rating",
    )
