"""Physical-plan shape checks: the properties the operators rely on at scale."""

import io
import contextlib

from pyspark.sql import functions as F

from traitmatch.operators import matching, relational as rel, staging
from traitmatch.operators.traits import COMPETENCY, SCORED_TRAITS
from traitmatch.plans.lineage import cut_lineage
from traitmatch.plans.ranking import global_rank
from traitmatch.sources.dims import dimension_frames


def physical(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def employees(spark):
    return spark.createDataFrame(
        [(f"e{i}", f"N{i}", f"n{i}", i, i % 6 + 1, i % 7 + 1, i % 3 + 1, i % 4 + 1, i % 7 + 1, i % 4 + 1, i % 5, i % 3 + 1)
         for i in range(50)],
        "employee_id string, fullname string, nip string, years_of_service_months int, department_id int, "
        "position_id int, grade_id int, education_id int, major_id int, company_id int, area_id int, "
        "directorate_id int")


def test_dimension_joins_are_broadcast(spark):
    d = dimension_frames(spark)
    out = rel.star_join(employees(spark), [("department_id", d["dim_departments"], "department_id", "department"),
                                           ("area_id", d["dim_areas"], "area_id", "area")])
    plan = physical(out)
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan


def test_global_rank_has_no_single_partition_exchange(spark):
    """The default plan: only the one-row-per-partition counts may meet in one task."""
    df = spark.range(0, 2000).select((F.col("id") % 13).alias("s"), "id")
    plan = physical(global_rank(df, [F.col("s").desc(), F.col("id")]))
    single = [block for block in plan.split("\n\n") if "SinglePartition" in block]
    assert len(single) == 1 and "[_pid" in single[0] and "_pos" not in single[0] and "id#" not in single[0].replace("_pid#", "")
    assert "Scan parquet" in plan  # the sorted rows were written once; the rank reads them back


def test_builders_start_no_job(spark):
    """Staging and matching operators only build plans."""
    comp = spark.createDataFrame([("e", "A", 2000, v) for v in (1, 2, 99)],
                                 "employee_id string, pillar_code string, year int, score int")
    long = spark.createDataFrame([("e1", COMPETENCY, "SEA", "3", "numeric")],
                                 "employee_id string, tgv_name string, tv_name string, user_score string, tv_type string")
    meta = spark.createDataFrame([("e1", "D", "P", "G")], "employee_id string, directorate string, position string, grade string")
    spark.sparkContext.setJobGroup("lazy-build", "x")
    staging.stg_competencies(comp, year=2000)
    matching.talent_match(long, meta, ["e1"], materialize=False)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("lazy-build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []


def test_hot_employee_is_split_in_the_join(spark):
    """One employee holds a third of the rows: the join with the stored per-employee table is split."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = (spark.range(0, 120_000, 1, 8)
                .select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id"))).alias("employee_id"),
                        F.lit(COMPETENCY).alias("tgv_name"), F.lit("SEA").alias("tv_name"),
                        (F.col("id") % 5).cast("string").alias("user_score"), F.col("id").cast("string").alias("target_val_display"),
                        (F.col("id") % 100).cast("double").alias("match_score"),
                        (F.col("id") % 100).cast("double").alias("weighted_score")))
        weighted = cut_lineage(rows, "hot_rows")
        stored = cut_lineage(matching.aggregate_scores(weighted), "hot_rates")
        out = matching.group_ratios(weighted, stored)
        assert len(out.collect()) == 120_000
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_top5_uses_window_group_limit(spark):
    s = spark.createDataFrame([("e1", r, f"t{r}") for r in range(10)], "employee_id string, rank int, theme string")
    plan = physical(staging.stg_strengths(s))
    assert "WindowGroupLimit" in plan


def test_median_counts_before_the_shuffle_and_holds_no_value_map(spark):
    comp = spark.createDataFrame([("e", "A", 2000, v) for v in (1, 2, 3)],
                                 "employee_id string, pillar_code string, year int, score int")
    plan = physical(rel.median_by(comp, "pillar_code", "score"))
    assert plan.count("HashAggregate") >= 2  # partial + final counts per (key, value)
    assert "percentile" not in plan and "median(" not in plan
    # what a row gathers are counts of buckets (a bounded number), never values
    assert plan.count("partial_collect_list(struct(bucket, ") == plan.count("partial_collect_list(") > 0


def test_long_table_scan_prunes_and_pushes(spark):
    rows = [(f"e{i}", COMPETENCY, "SEA", str(i % 5), "numeric") for i in range(20)]
    rows += [(f"e{i}", "Other", "NotScored", "1", "numeric") for i in range(20)]
    long = cut_lineage(spark.createDataFrame(rows, "employee_id string, tgv_name string, tv_name string, "
                                                   "user_score string, tv_type string"), "plan_test_long")
    prof = matching.benchmark_profile(long, matching.benchmark_frame(spark, ["e1", "e2"]))
    plan = physical(matching.match_scores(long, prof))
    assert "PushedFilters: [In(tv_name" in plan
    scores = physical(matching.aggregate_scores(matching.weighted_scores(matching.match_scores(long, prof))))
    assert scores.count("HashAggregate") >= 2  # map-side partial sums before the shuffle
    assert "CartesianProduct" not in scores and "BroadcastNestedLoopJoin" not in scores


def test_mbti_mode_is_a_scalar_subquery_not_a_cross_join(spark):
    psych = spark.createDataFrame([("e1", "entj"), ("e2", "intj"), ("e3", "entj")], "employee_id string, mbti string")
    out = staging.clean_mbti(psych).select("employee_id", F.coalesce("mbti_val", staging.mbti_mode(psych)).alias("m"))
    plan = physical(out)
    assert "Subquery" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_tasks_grow_with_the_input_and_given_settings_are_kept(spark, tmp_path, monkeypatch):
    """A larger folder gets more shuffle partitions, in proportion; what the session was given stays."""
    from traitmatch import session
    from traitmatch.plans import catalog

    monkeypatch.setattr(session, "INPUT_BYTES_PER_PARTITION", 1 << 10)

    def folder(name, kilobytes):
        (tmp_path / name / "lineitem.parquet").mkdir(parents=True)     # a table of part files
        (tmp_path / name / "lineitem.parquet" / "part-0").write_bytes(b"x" * (kilobytes << 10))
        return str(tmp_path / name)

    held = spark.__dict__.pop("_traitmatch_contexts", None)
    plain = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = lambda: spark.conf.get(session.INITIAL_PARTITIONS, None)
    try:
        catalog.context(spark, folder("tiny", 1))
        assert wanted() is None and session.shuffle_partitions(spark) == plain
        for kilobytes in (100, 600):
            catalog.context(spark, folder(f"k{kilobytes}", kilobytes))
            assert int(wanted()) == session.shuffle_partitions(spark) == kilobytes
        catalog.context(spark, folder("small_again", 2))
        assert int(wanted()) == 600
        session.unfit_partitions(spark)
        assert wanted() is None and session.shuffle_partitions(spark) == plain
        spark.conf.set(session.INITIAL_PARTITIONS, "5")
        catalog.context(spark, folder("given", 300))
        assert wanted() == "5"
    finally:
        session.unfit_partitions(spark)
        spark.conf.unset(session.INITIAL_PARTITIONS)
        spark.__dict__.pop("_traitmatch_contexts", None)
        if held is not None:
            spark.__dict__["_traitmatch_contexts"] = held


def test_global_rank_takes_its_partitions_from_the_fitted_number(spark, monkeypatch):
    from traitmatch import session

    monkeypatch.setattr(session, "INPUT_BYTES_PER_PARTITION", 1 << 10)
    plain = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        session.fit_partitions(spark, 40 << 10)
        df = spark.range(0, 2000).select((F.col("id") % 13).alias("s"), "id")
        ranked = global_rank(df, [F.col("s").desc(), F.col("id")])
        assert ranked.agg(F.count_distinct("rank"), F.max("rank")).first() == (2000, 2000)
        assert len(ranked.inputFiles()) > plain        # written by more tasks than the session's number
    finally:
        session.unfit_partitions(spark)


def test_tables_stored_by_employee_and_task_sizes_follow_the_fitted_number(spark, monkeypatch):
    from traitmatch import session

    monkeypatch.setattr(session, "INPUT_BYTES_PER_PARTITION", 1 << 10)
    long = spark.createDataFrame([(f"e{i}", COMPETENCY, "SEA", str(i % 5), "numeric") for i in range(200)],
                                 "employee_id string, tgv_name string, tv_name string, user_score string, tv_type string")
    meta = spark.createDataFrame([(f"e{i}", "D", "P", "G") for i in range(200)],
                                 "employee_id string, directorate string, position string, grade string")
    stored = None
    try:
        session.fit_partitions(spark, 24 << 10)
        assert {spark.conf.get(k) for k in (session.ADVISORY_BYTES, session.SPLIT_BYTES)} == {str(session.TASK_BYTES)}
        stored = matching.stored_match(long, meta, ["e1"])
        plan = spark.sql(f"DESCRIBE EXTENDED {stored.result.names[0]}").where("col_name = 'Num Buckets'").first()
        assert plan["data_type"] == "24" and stored.result.rows().count() == 200
    finally:
        session.unfit_partitions(spark)
        for name in stored.tables() if stored else ():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
