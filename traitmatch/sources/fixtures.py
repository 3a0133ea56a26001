"""Talent tables derived from the driver's TPC-H-style test tables.

The test data holds no HR data, so the six fact tables are derived from
``customer``, ``orders``, ``lineitem`` and ``part`` with the documented recipe
(FIXTURES.md section 3).  Every derived row grows with the input tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from traitmatch.sources.dims import dimension_frames

# "Current year" of the derived data (the source system used 2025).
CURRENT_YEAR = 2000

# --- fixed values of the derivation recipe ----------------------------------
PILLAR_BY_PART_MOD10 = ["GDR", "CEX", "IDS", "QDD", "STO", "SEA", "VCU", "LIE", "FTC", "CSI"]
PAPI_LETTERS_BY_SUPP_MOD7 = "PSGTWNA"
DISC_LETTERS = "DIISSCCD"
DISC_WORD_BY_MOD6 = ["Dominant-Influencer", "Steadiness", " Conscientious-Steadiness ",
                     "Influence", "Unmapped", None]
JUNK_THEME_BY_BRAND = {"Brand#7": " NaN ", "Brand#8": "", "Brand#9": None}
# -----------------------------------------------------------------------------

DRIVER_TABLES = ("customer", "orders", "lineitem", "part")
FACT_TABLES = ("employees", "profiles_psych", "performance_yearly",
               "competencies_yearly", "papi_scores", "strengths")


@dataclass
class TalentTables:
    """The 16 source tables: six facts and ten dimensions."""

    employees: DataFrame
    profiles_psych: DataFrame
    performance_yearly: DataFrame
    competencies_yearly: DataFrame
    papi_scores: DataFrame
    strengths: DataFrame
    dims: dict[str, DataFrame]

    def as_dict(self) -> dict[str, DataFrame]:
        out = {name: getattr(self, name) for name in FACT_TABLES}
        out.update(self.dims)
        return out


def _emp(custkey: Column) -> Column:
    return F.concat(F.lit("EMP"), custkey.cast("string"))


def _read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Parquet scan of one driver table, pruned to the named columns."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def derive_employees(customer: DataFrame) -> DataFrame:
    k, nation = F.col("c_custkey"), F.col("c_nationkey")
    return customer.select(
        _emp(k).alias("employee_id"),
        F.col("c_name").alias("fullname"),
        F.concat(F.lit("N"), k.cast("string")).alias("nip"),
        (k % 180).cast("int").alias("years_of_service_months"),
        (nation % 6 + 1).cast("int").alias("department_id"),
        (k % 7 + 1).cast("int").alias("position_id"),
        (k % 3 + 1).cast("int").alias("grade_id"),
        (k % 4 + 1).cast("int").alias("education_id"),
        (k % 7 + 1).cast("int").alias("major_id"),
        (k % 4 + 1).cast("int").alias("company_id"),
        (nation % 5).cast("int").alias("area_id"),
        (k % 3 + 1).cast("int").alias("directorate_id"),
    )


def derive_profiles_psych(customer: DataFrame) -> DataFrame:
    k, nation = F.col("c_custkey"), F.col("c_nationkey")
    ie = F.when(k % 2 == 0, F.lit("I")).otherwise(F.lit("E"))
    ns = F.when(nation % 2 == 0, F.lit("N")).otherwise(F.lit("S"))
    mbti = (F.when(k % 17 == 0, F.lit(" inftj "))
             .when(k % 19 == 0, F.lit(None).cast("string"))
             .when(k % 3 == 0, F.concat(F.lit(" "), F.lower(F.concat(ie, F.lit("NTJ")))))
             .otherwise(F.concat(ie, ns, F.lit("FP"))))
    disc = F.when(k % 4 != 0, F.substring(F.lit(DISC_LETTERS), ((k % 4) * 2 + 1).cast("int"), 2))
    words = F.array(*[F.lit(w).cast("string") for w in DISC_WORD_BY_MOD6])
    return customer.select(
        _emp(k).alias("employee_id"),
        F.when(k % 5 != 0, 80 + (k * 7) % 61).cast("double").alias("iq"),
        F.when(k % 8 != 0, 10 + (k * 3) % 41).cast("double").alias("gtq"),
        mbti.alias("mbti"),
        disc.alias("disc"),
        F.element_at(words, (k % 6 + 1).cast("int")).alias("disc_word"),
        (40 + k % 61).cast("double").alias("pauli"),
        (k % 10).cast("double").alias("tiki"),
        F.when(k % 9 != 0, 50 + k % 50).cast("double").alias("faxtor"),
    )


def derive_performance_yearly(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    raw = (F.when(key % 11 == 0, F.lit(99))
            .when(key % 13 == 0, F.lit(None).cast("int"))
            .otherwise(F.substring("o_orderpriority", 1, 1).cast("int")))
    return (orders
            .groupBy(F.col("o_custkey"), F.year("o_orderdate").alias("year"))
            .agg(F.max(raw).cast("int").alias("rating"))
            .select(_emp(F.col("o_custkey")).alias("employee_id"), "year", "rating"))


def order_line_rollup(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """One pass over the order lines for all three line-based fact tables.

    ``orders`` join ``lineitem`` (left join ``part`` for the brand) is
    aggregated once with GROUPING SETS -- (customer, pillar, year), (customer,
    PAPI scale), (customer, brand) -- so ``lineitem`` is scanned and shuffled
    once, and each map task pre-aggregates all three groupings.  The
    ``g_*`` flags tell the sets apart; ``n_part`` counts only lines with a
    matching part, which is what an inner join with ``part`` would count.
    """
    lines = (orders.join(lineitem, orders["o_orderkey"] == lineitem["l_orderkey"])
             .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
             .select("o_custkey", F.year("o_orderdate").alias("year"),
                     (F.col("l_partkey") % 10).alias("code_ix"), (F.col("l_suppkey") % 7).alias("scale_ix"),
                     "p_brand", "p_partkey", "l_quantity", "l_linenumber"))
    return (lines.groupingSets([["o_custkey", "code_ix", "year"], ["o_custkey", "scale_ix"],
                                ["o_custkey", "p_brand"]],
                               "o_custkey", "code_ix", "year", "scale_ix", "p_brand")
            .agg(F.floor(F.sum("l_quantity")).cast("bigint").alias("q"),
                 F.sum("l_linenumber").alias("n"),
                 F.count("p_partkey").alias("n_part"),
                 F.grouping("code_ix").alias("g_code"),
                 F.grouping("scale_ix").alias("g_scale"),
                 F.grouping("p_brand").alias("g_brand")))


def competencies_from_rollup(rollup: DataFrame) -> DataFrame:
    codes = F.array(*[F.lit(c) for c in PILLAR_BY_PART_MOD10])
    score = (F.when(F.col("n") % 17 == 0, F.lit(None).cast("int"))
              .when(F.col("q") % 8 == 7, F.lit(99))
              .otherwise(F.col("q") % 8))
    return (rollup.where(F.col("g_code") == 0)
            .select(_emp(F.col("o_custkey")).alias("employee_id"),
                    F.element_at(codes, (F.col("code_ix") + 1).cast("int")).alias("pillar_code"),
                    F.col("year").cast("int").alias("year"), score.cast("int").alias("score")))


def papi_from_rollup(rollup: DataFrame) -> DataFrame:
    letter = F.substring(F.lit(PAPI_LETTERS_BY_SUPP_MOD7), (F.col("scale_ix") + 1).cast("int"), 1)
    score = F.when(F.col("q") % 10 != 9, F.col("q") % 10)
    return (rollup.where(F.col("g_scale") == 0)
            .select(_emp(F.col("o_custkey")).alias("employee_id"),
                    F.concat(F.lit("Papi_"), letter).alias("scale_code"), score.cast("int").alias("score")))


def strengths_from_rollup(rollup: DataFrame) -> DataFrame:
    counts = (rollup.where((F.col("g_brand") == 0) & (F.col("n_part") > 0))
              .select(_emp(F.col("o_custkey")).alias("employee_id"), "p_brand", F.col("n_part").alias("n")))
    by_employee = Window.partitionBy("employee_id").orderBy(F.col("n").desc(), F.col("p_brand"))
    theme = F.col("p_brand")
    for brand, junk in JUNK_THEME_BY_BRAND.items():
        theme = F.when(F.col("p_brand") == brand, F.lit(junk).cast("string")).otherwise(theme)
    return counts.select("employee_id",
                         F.row_number().over(by_employee).cast("int").alias("rank"),
                         theme.alias("theme"))


def read_driver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four driver tables the derivation reads, pruned to the used columns."""
    return {
        "customer": _read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey"),
        "orders": _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"),
        "lineitem": _read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                          "l_linenumber", "l_quantity"),
        "part": _read(spark, sf_dir, "part", "p_partkey", "p_brand"),
    }


def load_talent_tables(spark: SparkSession, sf_dir: str, rollup: DataFrame | None = None) -> TalentTables:
    """Derive the 16 talent source tables from ``sf_dir`` (lazy DataFrames).

    ``rollup`` may be a stored :func:`order_line_rollup`; otherwise it is
    built lazily (Spark reuses its exchange when several facts meet in one
    plan).
    """
    src = read_driver_tables(spark, sf_dir)
    if rollup is None:
        rollup = order_line_rollup(src["orders"], src["lineitem"], src["part"])
    return TalentTables(
        employees=derive_employees(src["customer"]),
        profiles_psych=derive_profiles_psych(src["customer"]),
        performance_yearly=derive_performance_yearly(src["orders"]),
        competencies_yearly=competencies_from_rollup(rollup),
        papi_scores=papi_from_rollup(rollup),
        strengths=strengths_from_rollup(rollup),
        dims=dimension_frames(spark),
    )


def benchmark_ids(tables: TalentTables, year: int = CURRENT_YEAR, n: int = 3) -> DataFrame:
    """The ``n`` employees rated 1..5 in ``year`` with the most competency rows
    that year; ties by rating descending, then ``employee_id``.

    A top-n report, so the limit is the feature; the result holds at most ``n``
    rows, which is the size bound the matching operators rely on.
    """
    rated = (tables.performance_yearly
             .where((F.col("year") == year) & F.col("rating").between(1, 5))
             .select("employee_id", "rating"))
    counts = (tables.competencies_yearly.where(F.col("year") == year)
              .groupBy("employee_id").agg(F.count(F.lit(1)).alias("n_rows")))
    return (counts.join(rated, "employee_id")
            .orderBy(F.col("n_rows").desc(), F.col("rating").desc(), F.col("employee_id"))
            .limit(n)
            .select("employee_id"))
