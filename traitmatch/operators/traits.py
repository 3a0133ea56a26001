"""The long employee-by-trait table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitmatch.functions import array_to_json, num_to_text
from traitmatch.operators.relational import union_all, wide_to_long

LONG_COLUMNS = ["employee_id", "tgv_name", "tv_name", "user_score", "tv_type"]

# --- fixed values ---------------------------------------------------------------
COMPETENCY = "Competency"
COGNITIVE = "Psychometric (Cognitive)"
PERSONALITY = "Psychometric (Personality)"
STRENGTHS = "Behavioral (Strengths)"
CONTEXTUAL = "Contextual (Background)"
TRAIT_GROUPS = [COMPETENCY, COGNITIVE, PERSONALITY, STRENGTHS, CONTEXTUAL]

COMPOSITES = {"STO_LIE": ("STO", "LIE"), "CEX_GDR": ("CEX", "GDR")}
PAPI_SCALES = ("Papi_P", "Papi_S", "Papi_G", "Papi_T", "Papi_W")
STRENGTH_TRAIT = "Strength"

# stg_employees column -> (trait group, trait, type), in output order
EMPLOYEE_TRAITS = [
    ("iq_imputed", COGNITIVE, "IQ", "numeric"),
    ("gtq_imputed", COGNITIVE, "GTQ", "numeric"),
    ("pauli_score", COGNITIVE, "Pauli", "numeric"),
    ("faxtor_score", COGNITIVE, "Faxtor", "numeric"),
    ("tiki_score", COGNITIVE, "Tiki", "numeric"),
    ("mbti_final", PERSONALITY, "MBTI", "categorical"),
    ("disc", PERSONALITY, "DISC", "categorical"),
    ("education_level", CONTEXTUAL, "Education", "categorical"),
    ("major", CONTEXTUAL, "Major", "categorical"),
    ("position", CONTEXTUAL, "Position", "categorical"),
    ("area", CONTEXTUAL, "Area", "categorical"),
    ("tenure_months", CONTEXTUAL, "Tenure", "numeric"),
]

SCORED_TRAITS = [
    "SEA", "QDD", "FTC", "IDS", "VCU", "STO_LIE", "CSI", "CEX_GDR",
    "IQ", "GTQ", "Pauli", "Faxtor", "Tiki",
    "MBTI", "DISC", "Papi_P", "Papi_S", "Papi_G", "Papi_T", "Papi_W",
    "Strength",
    "Education", "Major", "Position", "Area", "Tenure",
]
# -----------------------------------------------------------------------------------

_COMPOSITE_PARTS = [code for parts in COMPOSITES.values() for code in parts]


def strength_arrays(stg_strengths: DataFrame) -> DataFrame:
    """One JSON array of themes per employee (sorted for a stable order)."""
    return (stg_strengths.groupBy("employee_id")
            .agg(array_to_json(F.sort_array(F.collect_list("theme"))).alias("strength_json")))


def competency_composites(stg_comp: DataFrame) -> DataFrame:
    """Competency rows of the long table.

    Pillars outside the composites pass through; each composite is the mean
    of its available parts and exists only for employees with at least one
    part row.  Both composites come from one aggregation.
    """
    plain = (stg_comp.where(~F.col("pillar_code").isin(_COMPOSITE_PARTS))
             .select("employee_id", F.lit(COMPETENCY).alias("tgv_name"),
                     F.col("pillar_code").alias("tv_name"),
                     num_to_text("score_imputed").alias("user_score"),
                     F.lit("numeric").alias("tv_type")))
    aggs = []
    for name, parts in COMPOSITES.items():
        in_parts = F.col("pillar_code").isin(list(parts))
        aggs += [F.count(F.when(in_parts, F.lit(1))).alias(f"n_{name}"),
                 F.avg(F.when(in_parts, F.col("score_imputed"))).alias(f"v_{name}")]
    per_emp = stg_comp.where(F.col("pillar_code").isin(_COMPOSITE_PARTS)).groupBy("employee_id").agg(*aggs)
    items = F.array(*[F.struct(F.lit(name).alias("tv_name"), F.col(f"n_{name}").alias("n"),
                               F.col(f"v_{name}").alias("v")) for name in COMPOSITES])
    composite = (per_emp.select("employee_id", F.inline(items))
                 .where(F.col("n") > 0)
                 .select("employee_id", F.lit(COMPETENCY).alias("tgv_name"), "tv_name",
                         num_to_text("v").alias("user_score"), F.lit("numeric").alias("tv_type")))
    return plain.unionByName(composite)


def employee_traits(stg_emp: DataFrame) -> DataFrame:
    """The twelve per-employee traits, unpivoted; NULL values keep their row."""
    spec = []
    for column, group, trait, kind in EMPLOYEE_TRAITS:
        value = num_to_text(column) if kind == "numeric" else F.col(column)
        spec.append((value, {"tgv_name": group, "tv_name": trait, "tv_type": kind}))
    return wide_to_long(stg_emp, ["employee_id"], spec, value_name="user_score").select(*LONG_COLUMNS)


def papi_traits(stg_papi: DataFrame) -> DataFrame:
    return (stg_papi.where(F.col("scale_code").isin(list(PAPI_SCALES)))
            .select("employee_id", F.lit(PERSONALITY).alias("tgv_name"),
                    F.col("scale_code").alias("tv_name"),
                    num_to_text("score_imputed").alias("user_score"),
                    F.lit("numeric").alias("tv_type")))


def strength_traits(stg_strengths: DataFrame) -> DataFrame:
    return (strength_arrays(stg_strengths)
            .select("employee_id", F.lit(STRENGTHS).alias("tgv_name"),
                    F.lit(STRENGTH_TRAIT).alias("tv_name"),
                    F.col("strength_json").alias("user_score"),
                    F.lit("array").alias("tv_type")))


def unpivot_traits(stg_comp: DataFrame, stg_emp: DataFrame, stg_papi_df: DataFrame,
                   stg_strengths_df: DataFrame) -> DataFrame:
    """The long table ``employee_id, tgv_name, tv_name, user_score, tv_type``
    (all text): competencies, cognitive, personality, PAPI, strengths,
    background -- 26 traits in 5 groups."""
    return union_all(
        competency_composites(stg_comp).select(*LONG_COLUMNS),
        employee_traits(stg_emp),
        papi_traits(stg_papi_df).select(*LONG_COLUMNS),
        strength_traits(stg_strengths_df).select(*LONG_COLUMNS),
    )


def select_traits(long: DataFrame) -> DataFrame:
    """Keep the 26 scored traits (a literal IN list, pushed to the scan)."""
    return long.where(F.col("tv_name").isin(SCORED_TRAITS))
