"""Registered query keys: one Spark builder per inventory line.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
derived tables.  The operators build lazily; the catalog stores shared tables
(derived sources, staging, match result) under the checkpoint folder on first use,
so those builders start write jobs.  The matching SQL for the DuckDB oracle lives in
:mod:`traitmatch.plans.oracle` under the same key and column names.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitmatch.functions import (array_member, array_overlap_count, first_item, join_items, json_to_array, norm,
                                  round_numeric, run_date_text)
from traitmatch.operators import checks, dashboard, matching, relational as rel, sketches, staging, traits
from traitmatch.sources import files, typed
from traitmatch.sources.fixtures import (CURRENT_YEAR, DRIVER_TABLES, FACT_TABLES, TalentTables, benchmark_ids,
                                        load_talent_tables, order_line_rollup, read_driver_tables)
from traitmatch.plans.lineage import cut_lineage
from traitmatch.plans.sizing import bounded
from traitmatch.session import (drop_scratch, fit_partitions, folder_bytes, input_listing, scratch_path,
                                unfit_partitions)

LANDING_DATE = "2000-01-01"
DIRECTORY_FILTER = {"role": "HRBP", "grade": "IV", "rating": "3.0"}


class StoredTables:
    """The derived source tables; each aggregated fact table is written once,
    on first use, under the shared checkpoint folder (the role the landed and
    loaded raw tables play in production).  The two per-customer projections
    stay lazy: they are a cheap scan away."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._raw = load_talent_tables(spark, sf_dir)
        self.employees = self._raw.employees
        self.profiles_psych = self._raw.profiles_psych
        self.dims = self._raw.dims

    @cached_property
    def _lines(self) -> TalentTables:
        # the three line-based facts share one stored GROUPING SETS pass
        src = read_driver_tables(self._spark, self._sf_dir)
        # a partition per grouping: each fact reads its own rows only
        rollup = cut_lineage(order_line_rollup(src["orders"], src["lineitem"], src["part"]), "order_lines",
                             partition_by=["g_code", "g_scale", "g_brand"])
        return load_talent_tables(self._spark, self._sf_dir, rollup=rollup)

    @cached_property
    def performance_yearly(self) -> DataFrame:
        return cut_lineage(self._raw.performance_yearly, "performance_yearly")

    @cached_property
    def competencies_yearly(self) -> DataFrame:
        return self._lines.competencies_yearly

    @cached_property
    def papi_scores(self) -> DataFrame:
        return self._lines.papi_scores

    @cached_property
    def strengths(self) -> DataFrame:
        # read once (by the strengths model), so not stored separately
        return self._lines.strengths

    def as_dict(self) -> dict[str, DataFrame]:
        out = {name: getattr(self, name) for name in FACT_TABLES}
        out.update(self.dims)
        return out


class Context:
    """Shared, lazily built frames for one session and one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def t(self) -> StoredTables:
        return StoredTables(self.spark, self.sf_dir)

    @cached_property
    def ids(self) -> DataFrame:
        # stored once (a top-n of three rows), so every use sees the same ids
        return cut_lineage(matching.benchmark_frame(self.spark, benchmark_ids(self.t)), "benchmark_ids")

    @cached_property
    def stg_comp(self):
        return staging.stg_competencies(self.t.competencies_yearly)

    @cached_property
    def stg_emp(self):
        # read by the long table, the metadata join and the directory
        return cut_lineage(staging.stg_employees(self.t.employees, self.t.profiles_psych,
                                                 self.t.performance_yearly, self.t.dims), "stg_employees")

    @cached_property
    def stg_papi(self):
        return staging.stg_papi(self.t.papi_scores)

    @cached_property
    def stg_strengths(self):
        return staging.stg_strengths(self.t.strengths)

    def _concurrently(self, *steps) -> None:
        """Run independent preparation steps as concurrent Spark jobs.

        Each step touches a different lazily built attribute whose inputs are
        already built, so no two threads build the same thing.  Spark runs
        jobs submitted from several driver threads at the same time, which
        fills the cores when each job alone has only a few tasks.
        """
        with ThreadPoolExecutor(max_workers=len(steps)) as pool:
            for future in [pool.submit(step) for step in steps]:
                future.result()

    @cached_property
    def long(self):
        t = self.t
        self._concurrently(lambda: t.performance_yearly, lambda: t._lines)
        self._concurrently(lambda: self.ids, lambda: self.stg_comp, lambda: self.stg_papi, lambda: self.stg_emp)
        # One stored table; every later model scans it.
        return cut_lineage(traits.unpivot_traits(self.stg_comp, self.stg_emp, self.stg_papi, self.stg_strengths),
                           "long_traits")

    @cached_property
    def profile(self):
        # a row per trait, read by every scoring pass
        return cut_lineage(matching.benchmark_profile(self.long, self.ids), "profile")

    @cached_property
    def weighted(self):
        return matching.weighted_scores(matching.match_scores(self.long, self.profile))

    @cached_property
    def rates(self):
        # stored, so that the join of the scored rows with it can be split at a hot employee
        return cut_lineage(matching.employee_rates(self.weighted, self.stg_emp), "employee_rates")

    @cached_property
    def result(self):
        # the dashboard models read the match result several times each
        return cut_lineage(matching.talent_match(self.long, self.stg_emp, self.ids, sort=False, materialize=False,
                                                 rates=self.rates),
                           "match_result")

    @cached_property
    def stored(self):
        # scored rows, rates and result by employee: later joins and aggregates on it move no rows
        return matching.stored_match(self.long, self.stg_emp, self.ids, profile=self.profile)

    @cached_property
    def directory(self):
        return dashboard.employee_directory(self.stg_emp, self.t.performance_yearly)

    @cached_property
    def ranked(self):
        return dashboard.ranked_candidates(self.result, self.directory)

    @cached_property
    def comparison(self):
        return dashboard.compare_to_benchmark(self.result, dashboard.best_candidate(self.result, self.directory))

    @cached_property
    def example(self):
        return checks.example_model(self.t.performance_yearly, "rating", name="example_model")


def context(spark: SparkSession, sf_dir: str) -> Context:
    """The session's context of a folder; a changed file in the folder makes a new one.

    Contexts are held by the session object itself, so they end with it.
    """
    held = spark.__dict__.setdefault("_traitmatch_contexts", {})
    listing = input_listing(spark, sf_dir)
    if sf_dir not in held or held[sf_dir][0] != listing:
        fit_partitions(spark, folder_bytes(spark, [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in DRIVER_TABLES]))
        held[sf_dir] = (listing, Context(spark, sf_dir))
    return held[sf_dir][1]


def release(spark: SparkSession) -> None:
    """Forget the session's contexts, delete the tables written for them and take back the sized settings."""
    for _, held in spark.__dict__.pop("_traitmatch_contexts", {}).values():
        if "stored" in held.__dict__:
            for name in held.stored.tables():
                spark.sql(f"DROP TABLE IF EXISTS {name}")
    drop_scratch(spark)
    unfit_partitions(spark)


def _q(fn: Callable[[Context], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(context(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# --- sources and sinks -----------------------------------------------------------------

def csv_roundtrip(c: Context) -> DataFrame:
    """Land the employees as CSV and read them back with type inference."""
    uri = files.land_raw(c.t.employees, scratch_path(c.spark, "landing"), LANDING_DATE, "employees")
    return files.read_csv(c.spark, uri)


def _landing_root(c: Context) -> str:
    """Land all 16 source tables (independent write jobs, submitted together)."""
    root = scratch_path(c.spark, "landing")
    tables = c.t.as_dict()
    with ThreadPoolExecutor(max_workers=8) as pool:
        for future in [pool.submit(files.land_raw, df, root, LANDING_DATE, name) for name, df in tables.items()]:
            future.result()
    return root


def _rating_days(c: Context) -> str:
    """Land the ratings of every year as that year's own table and day: what is found depends on the data."""
    root = scratch_path(c.spark, "landing")
    (c.t.performance_yearly.withColumn("_dir", F.concat(F.col("year"), F.lit("-12-31")))
     .repartition("_dir").write.partitionBy("_dir").option("header", True).csv(f"{root}/raw"))
    days = [r[0] for r in c.t.performance_yearly.select("year").distinct().collect()]      # a handful of years
    for year in days:
        day = c.spark.read.option("header", True).csv(f"{root}/raw/_dir={year}-12-31")
        files.land_raw(day, root, f"{year}-12-31", f"ratings_{year}")
    return root


def csv_discover(c: Context) -> DataFrame:
    """The tables found in a landing folder holding all 16 sources."""
    return files.discover_tables(c.spark, _landing_root(c)).select("table_name")


def landed_days(c: Context) -> DataFrame:
    """Tables and days found in a landing folder with one table per rating year."""
    return files.landed_tables(c.spark, f"{_rating_days(c)}/landing_zone").select("table_name", "day")


def load_all(c: Context) -> DataFrame:
    """S1-S5 in one call: two landed days; the newest of each table is loaded and audited as it is written."""
    root = scratch_path(c.spark, "landing")
    old, new = c.t.performance_yearly.where(F.col("year") < CURRENT_YEAR), c.t.performance_yearly
    files.land_raw(old, root, "1999-12-31", "performance_yearly")
    files.land_raw(new, root, LANDING_DATE, "performance_yearly")
    files.land_raw(c.t.strengths, root, "1999-12-31", "strengths")
    return files.load_all(c.spark, root, scratch_path(c.spark, "tables"), {
        "performance_yearly": "employee_id string, year int, rating int",
        "strengths": "employee_id string, rank int, theme string"})


def _rating_lines(c: Context) -> str:
    """The ratings as CSV lines without a header, some of them spoilt by the number in their id."""
    n = F.substring("employee_id", 4, 12).cast("bigint") % 97
    rating = F.coalesce(F.col("rating").cast("string"), F.lit(""))
    line = (F.when(n == 0, F.concat_ws(",", "employee_id", "year"))
            .when(n == 1, F.concat_ws(",", "employee_id", "year", F.concat(F.lit("x"), rating)))
            .when(n == 2, F.concat_ws(",", "employee_id", "year", rating, F.lit("more")))
            .when(n == 3, F.concat_ws(",", F.lit(""), F.col("year"), rating))
            .otherwise(F.concat_ws(",", "employee_id", "year", rating)))
    path = scratch_path(c.spark, "lines")
    c.t.performance_yearly.select(line.alias("value")).write.text(path)
    return path


RATING_COLUMNS = ["employee_id", "year", "rating"]


def csv_rejects(c: Context) -> DataFrame:
    """A CSV with spoilt lines, types detected, loaded in one pass: the lines kept apart, with reasons."""
    rows = typed.read_typed(c.spark, _rating_lines(c), required=["employee_id"], columns=RATING_COLUMNS)
    target = scratch_path(c.spark, "table")
    files.load_checked(rows, target, "ratings", "employee_id")
    return files.loaded_rejects(c.spark, target)


def csv_loaded(c: Context) -> DataFrame:
    """The rows of that CSV which fit, with the detected types."""
    rows = typed.read_typed(c.spark, _rating_lines(c), required=["employee_id"], columns=RATING_COLUMNS)
    target = scratch_path(c.spark, "table")
    files.load_checked(rows, target, "ratings", "employee_id")
    return files.loaded_rows(c.spark, target)


def landed_partition(c: Context) -> DataFrame:
    """S3: two days landed as partitions of one table, one of them landed again; the rows of that day."""
    root, ratings = scratch_path(c.spark, "landing"), c.t.performance_yearly
    past = ratings.where(F.col("year") < CURRENT_YEAR)
    files.land_day(past, root, "1999-12-31", "ratings")
    files.land_day(ratings, root, LANDING_DATE, "ratings")
    path = files.land_day(rel.where_not_null(past, "rating"), root, "1999-12-31", "ratings")
    return files.landed_between(c.spark, path, last="1999-12-31").withColumn("ingest_date", run_date_text("ingest_date"))


def land_raw(c: Context) -> DataFrame:
    """S3: rows landed under the dated folder, read back with their date."""
    root = scratch_path(c.spark, "landing")
    files.land_raw(c.t.performance_yearly, root, LANDING_DATE, "performance_yearly")
    schema = "employee_id string, year int, rating int"
    df = files.read_csv(c.spark, f"{root}/landing_zone/manual/*/performance_yearly.csv", schema)
    day = F.regexp_extract(F.col("_metadata.file_path"), r"/manual/([0-9-]+)/", 1)
    return df.select("employee_id", "year", "rating", day.alias("ingest_date"))


def load_overwrite(c: Context) -> DataFrame:
    """A second load replaces the first completely."""
    target = scratch_path(c.spark, "table")
    files.load_table(c.t.strengths.select("employee_id", "theme"), target)
    return files.load_table(c.stg_strengths, target)


def stream_load(c: Context) -> DataFrame:
    """S3/S4 as a stream: land a table, load it with an ``availableNow`` file
    stream (full replace), read the loaded table."""
    from traitmatch.streaming import load_landed

    root = scratch_path(c.spark, "landing")
    files.land_raw(c.t.performance_yearly, root, LANDING_DATE, "performance_yearly")
    target = scratch_path(c.spark, "table")
    load_landed(c.spark, root, "performance_yearly", "employee_id string, year int, rating int", target,
                checkpoint=scratch_path(c.spark, "stream"))
    return files.read_table(c.spark, target)


def load_audit(c: Context) -> DataFrame:
    """Row count of each of the 16 source tables."""
    return files.load_audit(c.t.as_dict())


def inline_weights(c: Context) -> DataFrame:
    """The literal weight table joined to the trait row counts."""
    counts = rel.count_by(c.long, "tv_name", out="n_rows")
    w = matching.weights_frame(c.spark)
    return (w.join(counts, "tv_name", "left")
            .select("tv_name", "weight", F.coalesce(F.col("n_rows"), F.lit(0)).cast("bigint").alias("n_rows")))


def model_chain(c: Context) -> DataFrame:
    """A materialised model read by name by a second model."""
    c.example  # materialise the first model
    return checks.filtered_model(c.spark, "example_model")


def sql_parametrised(c: Context) -> DataFrame:
    """The sources registered by name, and a SQL model whose year is a
    bound parameter (a named marker, never text substitution)."""
    files.register_sources(c.spark, c.t.as_dict())
    return c.spark.sql(
        "SELECT employee_id, year, rating FROM performance_yearly "
        "WHERE rating IS NOT NULL AND rating BETWEEN 1 AND 5 AND year < :before",
        args={"before": CURRENT_YEAR})


def sql_ordinal_group(c: Context) -> DataFrame:
    """Rows per (pillar, year) with an ordinal GROUP BY, in Spark SQL."""
    files.register_sources(c.spark, c.t.as_dict())
    return c.spark.sql("SELECT pillar_code, year, CAST(count(*) AS BIGINT) AS n_rows "
                       "FROM competencies_yearly GROUP BY 1, 2")


def check_unique(c: Context) -> DataFrame:
    return checks.check_unique(c.example, "id")


def check_not_null(c: Context) -> DataFrame:
    return checks.check_not_null(c.example, "id")


# --- filters ----------------------------------------------------------------------------

def filter_ratings(c: Context) -> DataFrame:
    """Rated 1..5 this year, outside department 4, iq or gtq present."""
    e = rel.where_in(c.t.employees, "department_id", [4], negate=True)
    py = rel.where_between(c.t.performance_yearly.where(F.col("year") == CURRENT_YEAR), "rating", 1, 5)
    rows = (e.select("employee_id", "department_id")
            .join(c.t.profiles_psych.select("employee_id", "iq", "gtq"), "employee_id")
            .join(py.select("employee_id", "rating"), "employee_id"))
    return rows.where(F.col("iq").isNotNull() | F.col("gtq").isNotNull())


def filter_in_list(c: Context) -> DataFrame:
    """The long table restricted to the 26 scored traits."""
    return traits.select_traits(c.long)


def benchmark_flag(c: Context) -> DataFrame:
    """Every staged employee with its benchmark flag."""
    return rel.flag_members(c.stg_emp.select("employee_id", "fullname"), "employee_id", c.ids)


def case_disc_map(c: Context) -> DataFrame:
    """DISC code from the code column or the mapped word."""
    return staging.clean_disc(c.t.profiles_psych)


# --- joins ------------------------------------------------------------------------------------

def star_join(c: Context) -> DataFrame:
    """Employees with the eight dimension names."""
    d = c.t.dims
    return rel.star_join(c.t.employees, [
        ("department_id", d["dim_departments"], "department_id", "department"),
        ("position_id", d["dim_positions"], "position_id", "position"),
        ("grade_id", d["dim_grades"], "grade_id", "grade"),
        ("education_id", d["dim_education"], "education_id", "education_level"),
        ("major_id", d["dim_majors"], "major_id", "major"),
        ("company_id", d["dim_companies"], "company_id", "company"),
        ("area_id", d["dim_areas"], "area_id", "area"),
        ("directorate_id", d["dim_directorates"], "directorate_id", "directorate"),
    ]).select("employee_id", "department", "position", "grade", "education_level", "major", "company",
              "area", "directorate")


def left_join_year_on(c: Context) -> DataFrame:
    """All employees with this year's rating (NULL when none)."""
    py = c.t.performance_yearly.where(F.col("year") == CURRENT_YEAR).select("employee_id", "rating")
    return c.t.employees.select("employee_id").join(py, "employee_id", "left")


def cross_join_mode(c: Context) -> DataFrame:
    """Each psych row with the global MBTI mode attached."""
    mode = staging.mbti_mode(c.t.profiles_psych)
    return (staging.clean_mbti(c.t.profiles_psych)
            .select("employee_id", "mbti_val", mode.alias("mbti_mode"),
                    F.coalesce(F.col("mbti_val"), mode).alias("mbti_final")))


def array_overlap(c: Context) -> DataFrame:
    """Distinct themes of each employee found in the benchmark theme list."""
    rows = c.long.where(F.col("tv_name") == traits.STRENGTH_TRAIT).join(
        bounded(c.profile.select("tv_name", "strength_target")), "tv_name", "left")
    tnorm = F.transform(json_to_array("strength_target"), norm)
    overlap = array_overlap_count(json_to_array("user_score"), tnorm)
    return rows.select("employee_id", overlap.cast("int").alias("overlap_count"))


def array_membership(c: Context) -> DataFrame:
    """Whether each categorical value is in its trait's target list."""
    cat = c.long.where(F.col("tv_type") == "categorical").where(F.col("tv_name").isin(traits.SCORED_TRAITS))
    joined = cat.join(bounded(c.profile.select("tv_name", "categorical_target")), "tv_name", "left")
    member = array_member("user_score", F.transform(json_to_array("categorical_target"), norm))
    return joined.select("employee_id", "tv_name", "user_score", member.alias("is_member"))


def lateral_strengths(c: Context) -> DataFrame:
    """Benchmark rows; Strength rows unnested to one row per theme."""
    bench = matching.benchmark_rows(c.long, c.ids)
    out = rel.explode_when(bench, F.col("tv_name") == traits.STRENGTH_TRAIT, json_to_array("user_score"), "s_item")
    return out.select("employee_id", "tv_name", "s_item")


# --- aggregates ----------------------------------------------------------------------------------

def median_by_key(c: Context) -> DataFrame:
    """Exact median of valid competency scores per pillar this year."""
    comp = c.t.competencies_yearly
    valid = comp.where((F.col("year") == CURRENT_YEAR) & F.col("score").isNotNull()
                       & ~F.col("score").isin(list(staging.COMPETENCY_INVALID_SCORES)))
    return rel.median_by(valid, "pillar_code", "score", out="median_score")


def median_window(c: Context) -> DataFrame:
    """PAPI scale medians through the window form, then DISTINCT."""
    rows = rel.median_window(c.t.papi_scores, "scale_code", "score", out="median_score")
    return rel.where_not_null(rows, "median_score").select("scale_code", "median_score").distinct()


def mode_value(c: Context) -> DataFrame:
    """A10: the most frequent clean MBTI (one row)."""
    return c.spark.range(1).select(staging.mbti_mode(c.t.profiles_psych).alias("mbti_mode"))


def _pillar_scores(c: Context) -> DataFrame:
    return (rel.where_in(rel.where_not_null(c.t.competencies_yearly, "score"), "score",
                         staging.COMPETENCY_INVALID_SCORES, negate=True).select("pillar_code", "year", "score", "employee_id"))


def median_sketch(c: Context) -> DataFrame:
    """A13 approx: states of single years, stored and merged over all years; held against the exact median."""
    scores = _pillar_scores(c)
    years = cut_lineage(sketches.quantile_states(scores, ["pillar_code", "year"], "score"), "year_states")
    merged = sketches.combine_quantile_states(years, ["pillar_code"]).select(
        "pillar_code", sketches.quantile_of("state", 0.5).alias("_estimate"))
    placed = scores.join(merged, "pillar_code").groupBy("pillar_code").agg(
        F.count(F.lit(1)).alias("n_scores"), F.count_if(F.col("score") < F.col("_estimate")).alias("_below"),
        F.count_if(F.col("score") <= F.col("_estimate")).alias("_upto"))
    off = sketches.RANK_ERROR * F.col("n_scores")
    within = (F.col("_below") <= F.col("n_scores") / 2 + off) & (F.col("_upto") >= F.col("n_scores") / 2 - off)
    exact = rel.median_by(scores, "pillar_code", "score", out="exact_median")
    return placed.join(exact, "pillar_code").select("pillar_code", "n_scores", "exact_median", within.alias("within_bound"))


def mode_sketch(c: Context) -> DataFrame:
    """A10 approx: states per department, stored and merged: the most frequent clean MBTI (exact for so few values)."""
    rows = staging.clean_mbti(c.t.profiles_psych).join(c.t.employees.select("employee_id", "department_id"), "employee_id")
    states = cut_lineage(sketches.top_states(rows, ["department_id"], "mbti_val"), "mbti_states")
    return sketches.combine_top_states(states).select(sketches.most_frequent().alias("mbti_mode"))


def count_distinct(c: Context) -> DataFrame:
    """Employees with a valid score per pillar, exactly."""
    return rel.count_distinct(_pillar_scores(c), "pillar_code", "employee_id", out="n_employees")


def distinct_sketch(c: Context) -> DataFrame:
    """A12 approx: states of single years, stored and merged over all years; held against the exact count."""
    scores = _pillar_scores(c)
    years = cut_lineage(sketches.distinct_states(scores, ["pillar_code", "year"], "employee_id"), "distinct_states")
    merged = sketches.combine_distinct_states(years, ["pillar_code"]).select("pillar_code", sketches.distinct_of().alias("_guess"))
    exact = rel.count_distinct(scores, "pillar_code", "employee_id", out="n_employees")
    within = F.abs(F.col("_guess") - F.col("n_employees")) <= sketches.DISTINCT_ERROR * F.col("n_employees")
    return exact.join(merged, "pillar_code").select("pillar_code", "n_employees", within.alias("within_bound"))


def mode_with_ties(c: Context) -> DataFrame:
    """Per categorical trait over all employees, every top value (JSON)."""
    cat = c.long.where(F.col("tv_type") == "categorical")
    modes = rel.modes_with_ties(cat, "tv_name", "user_score", out="modes")
    return modes.select("tv_name", F.to_json("modes").alias("modes"))


def conditional_sum(c: Context) -> DataFrame:
    """A5: trait rows per group and employee as five conditional sums."""
    groups = {"competency_rows": traits.COMPETENCY, "cognitive_rows": traits.COGNITIVE,
              "personality_rows": traits.PERSONALITY, "strengths_rows": traits.STRENGTHS,
              "contextual_rows": traits.CONTEXTUAL}
    return c.long.groupBy("employee_id").agg(*[
        F.sum(F.when(F.col("tgv_name") == g, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(name)
        for name, g in groups.items()])


def array_agg_themes(c: Context) -> DataFrame:
    """Themes per employee as a sorted JSON array."""
    return traits.strength_arrays(c.stg_strengths).select("employee_id", F.col("strength_json").alias("themes"))


def string_agg_themes(c: Context) -> DataFrame:
    """Themes per employee joined with ', '."""
    arr = rel.collect_sorted(c.stg_strengths, "employee_id", "theme", "arr")
    return arr.select("employee_id", join_items("arr").alias("themes_text"))


def avg_distinct(c: Context) -> DataFrame:
    """Per department, the mean of the distinct IQ values."""
    rows = c.t.employees.select("employee_id", "department_id").join(
        c.t.profiles_psych.select("employee_id", "iq"), "employee_id")
    return (rel.avg_distinct(rows, "department_id", "iq", out="avg_iq")
            .select("department_id", F.round("avg_iq", 6).alias("avg_iq")))


def histogram(c: Context) -> DataFrame:
    """Tenure months of all employees in 20 equal bins on 0..180."""
    return rel.histogram(c.t.employees, "years_of_service_months", 0.0, 180.0, 20)


def round_histogram(c: Context) -> DataFrame:
    """Tenure months of all employees in at most 20 bins of a round width over their range."""
    return rel.round_histogram(c.t.employees, "years_of_service_months", 20)


# --- windows / top-k -------------------------------------------------------------------------------

def top5_strengths(c: Context) -> DataFrame:
    """The first five valid themes per employee with their position."""
    junk = F.lower(F.trim(F.col("theme"))).isin(list(staging.JUNK_THEMES))
    clean = c.t.strengths.where(F.col("theme").isNotNull() & ~junk)
    return rel.top_n_by(clean, ["employee_id"], [F.col("rank"), F.col("theme")], 5, out="rn") \
        .select("employee_id", "theme", "rn")


def top1_group(c: Context) -> DataFrame:
    """Best trait group per employee."""
    return dashboard.top_group(c.result)


def global_rank(c: Context) -> DataFrame:
    """All scored employees ranked by final rate (ties by id)."""
    per_emp = c.result.select("employee_id", "final_match_rate").distinct()
    return rel.global_rank(per_emp, [F.col("final_match_rate").desc_nulls_last(), F.col("employee_id")])


# --- reshaping -----------------------------------------------------------------------------------------

def unpivot_traits(c: Context) -> DataFrame:
    return c.long


def composites(c: Context) -> DataFrame:
    return traits.competency_composites(c.stg_comp)


def pivot_baseline(c: Context) -> DataFrame:
    """U4: per employee, the eight competency values as columns."""
    comp = c.long.where(F.col("tgv_name") == traits.COMPETENCY)
    return rel.long_to_wide(comp, "tv_name", "user_score", dashboard.COMPETENCY_FIELDS,
                            name_fn=lambda t: t.lower(), group_by=["employee_id"])


# --- staging -------------------------------------------------------------------------------------------

def stg_competencies(c): return c.stg_comp
def stg_competencies_yearly(c): return staging.stg_competencies_yearly(c.t.competencies_yearly)
def stg_papi(c): return c.stg_papi
def stg_performance_yearly(c): return staging.stg_performance_yearly(c.t.performance_yearly)
def stg_strengths(c): return c.stg_strengths
def cognitive_medians(c): return staging.cognitive_medians(c.t.employees, c.t.profiles_psych, c.t.performance_yearly)
def clean_mbti(c): return staging.clean_mbti(c.t.profiles_psych)
def clean_disc(c): return staging.clean_disc(c.t.profiles_psych)
def stg_employees(c): return c.stg_emp


# --- matching -------------------------------------------------------------------------------------------

def categorical_targets(c): return matching.categorical_targets(c.long, c.ids)
def numeric_targets(c): return matching.numeric_targets(c.long, c.ids)
def strength_target(c): return matching.strength_target(c.long, c.ids)
def benchmark_profile(c): return c.profile
def match_scores(c): return matching.match_scores(c.long, c.profile)


def weighted_scores(c: Context) -> DataFrame:
    return c.weighted.select("employee_id", "tgv_name", "tv_name", "match_score", "weight", "weighted_score")


def aggregate_scores(c: Context) -> DataFrame:
    agg = matching.aggregate_scores(c.weighted)
    return agg.select("employee_id", *[round_numeric(col, 6).alias(col) for col in agg.columns[1:]])


def group_ratios(c: Context) -> DataFrame:
    out = matching.group_ratios(c.weighted, c.rates)
    return out.select("employee_id", "tgv_name", "tv_name", "match_score",
                      round_numeric("final_match_rate", 6).alias("final_match_rate"),
                      round_numeric("tgv_match_ratio", 6).alias("tgv_match_ratio"))


def talent_match(c): return matching.talent_match(c.long, c.stg_emp, c.ids, materialize=False, rates=c.rates)


def talent_match_candidates(c: Context) -> DataFrame:
    return matching.talent_match_candidates(c.long, c.stg_emp, c.ids, materialize=False, rates=c.rates)


def talent_match_stored(c: Context) -> DataFrame:
    """The match result from tables stored by employee."""
    return c.stored.result.rows()


def ranked_stored(c: Context) -> DataFrame:
    """D31 on the stored result: per-employee aggregate and join where the rows lie, then the rank."""
    return dashboard.ranked_candidates(c.stored.result.rows(), c.directory)


# --- dashboard -------------------------------------------------------------------------------------------

def employee_directory(c): return c.directory


def first_target(c: Context) -> DataFrame:
    """the first item of each trait's categorical target list."""
    return c.profile.where(F.col("categorical_target").isNotNull()).select(
        "tv_name", first_item(json_to_array("categorical_target")).alias("first_value"))


def ingest_days(c: Context) -> DataFrame:
    """the run-date text of every order day, with its number of ratings."""
    return (read_driver_tables(c.spark, c.sf_dir)["orders"].select(run_date_text("o_orderdate").alias("run_date"))
            .groupBy("run_date").agg(F.count(F.lit(1)).alias("n_orders")))


def filter_directory(c: Context) -> DataFrame:
    return dashboard.filter_directory(c.directory, **DIRECTORY_FILTER)


def filter_options(c: Context) -> DataFrame:
    return dashboard.filter_options(c.directory, role=DIRECTORY_FILTER["role"], grade=DIRECTORY_FILTER["grade"])


def display_roundtrip(c: Context) -> DataFrame:
    """the ``name (id)`` label of every directory row and the id parsed back."""
    from traitmatch.functions import label_to_id

    return c.directory.select("employee_id", "display", label_to_id("display").alias("parsed_id"))


def default_benchmarks(c: Context) -> DataFrame:
    """The rule's benchmark ids as defaults, over the unfiltered directory."""
    return dashboard.default_benchmarks(c.directory, c.ids)


def ranked_candidates(c): return c.ranked
def rate_histogram(c): return dashboard.rate_histogram(dashboard.candidates(c.result, c.directory))
def rate_round_histogram(c): return dashboard.rate_histogram(dashboard.candidates(c.result, c.directory), data_range=True)
def candidate_count(c): return dashboard.candidate_count(c.result, c.directory)
def group_averages(c: Context) -> DataFrame:
    out = dashboard.group_averages(c.result)
    return out.select("tgv_name", F.round("avg_match_rate", 4).alias("avg_match_rate"))


def group_averages_all(c: Context) -> DataFrame:
    """The averages over all candidates, equal rates counted each."""
    out = dashboard.group_averages(c.result, distinct=False)
    return out.select("tgv_name", F.round("avg_match_rate", 4).alias("avg_match_rate"))


def compare_to_benchmark(c: Context) -> DataFrame:
    return c.comparison.select("tgv_name", "ordinal", *[F.round(x, 4).alias(x) for x in
                                                        ("benchmark_avg", "candidate_rate", "diff")])


def strongest_and_gap(c: Context) -> DataFrame:
    out = dashboard.strongest_and_gap(c.comparison)
    return out.select("strongest", F.round("strongest_diff", 4).alias("strongest_diff"),
                      "weakest", F.round("weakest_diff", 4).alias("weakest_diff"))


def baseline_profile(c): return dashboard.baseline_profile(c.result)
def key_competencies(c): return dashboard.key_competencies(c.result, c.t.dims["dim_competency_pillars"])


_ALL = [
    csv_roundtrip, csv_discover, landed_days, load_all, csv_rejects, csv_loaded, land_raw, landed_partition, load_overwrite, stream_load, load_audit, inline_weights, model_chain,
    sql_parametrised, sql_ordinal_group,
    check_unique, check_not_null,
    filter_ratings, filter_in_list, benchmark_flag, case_disc_map,
    star_join, left_join_year_on, cross_join_mode, array_overlap, array_membership, lateral_strengths,
    median_by_key, median_window, median_sketch, mode_value, mode_sketch, count_distinct, distinct_sketch, mode_with_ties, conditional_sum, array_agg_themes,
    string_agg_themes, avg_distinct, histogram, round_histogram,
    top5_strengths, top1_group, global_rank,
    unpivot_traits, composites, pivot_baseline,
    stg_competencies, stg_competencies_yearly, stg_papi, stg_performance_yearly, stg_strengths,
    cognitive_medians, clean_mbti, clean_disc, stg_employees,
    categorical_targets, numeric_targets, strength_target, benchmark_profile, match_scores,
    weighted_scores, aggregate_scores, group_ratios, talent_match, talent_match_candidates, talent_match_stored, ranked_stored,
    employee_directory, filter_directory, filter_options, display_roundtrip, default_benchmarks, ranked_candidates,
    rate_histogram, rate_round_histogram, candidate_count, first_target, ingest_days, group_averages, group_averages_all,
    compare_to_benchmark, strongest_and_gap, baseline_profile,
    key_competencies,
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {fn.__name__: _q(fn) for fn in _ALL}
