"""Tables stored by employee: no rows move again, and a hot employee is kept apart."""

from pyspark.sql import functions as F

from conftest import rows
from test_plans import physical
from traitmatch.operators import dashboard, matching
from traitmatch.operators.traits import COMPETENCY
from traitmatch.plans import copartition
from traitmatch.plans.lineage import cut_lineage

NO_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


def talent(spark, hot):
    """Long rows and metadata of 200 employees; ``hot`` rows more for one of them."""
    one = spark.range(0, 200).select(F.concat(F.lit("e"), F.col("id")).alias("employee_id"), F.col("id"))
    more = spark.range(0, hot).select(F.lit("e7").alias("employee_id"), F.col("id"))
    rows_ = one.unionByName(more)
    long = rows_.select("employee_id", F.lit(COMPETENCY).alias("tgv_name"),
                        F.element_at(F.array(F.lit("SEA"), F.lit("QDD")), (F.col("id") % 2 + 1).cast("int")).alias("tv_name"),
                        (F.col("id") % 5 + 1).cast("string").alias("user_score"), F.lit("numeric").alias("tv_type"))
    meta = one.select("employee_id", F.lit("D").alias("directorate"), F.lit("P").alias("position"), F.lit("G").alias("grade"),
                      F.concat(F.lit("N"), F.col("id")).alias("fullname"))
    return cut_lineage(long, "t_long"), cut_lineage(meta, "t_meta")


def drop(spark, stored):
    for name in stored.tables():
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def moved_by_employee(df) -> list[str]:
    """Exchanges of rows by employee (a broadcast of a few ids is none)."""
    return [b for b in physical(df).split("\n\n") if "hashpartitioning(employee_id" in b]


def test_nothing_moves_by_employee_once_the_rows_are_stored(spark):
    long, meta = talent(spark, 0)
    stored = matching.stored_match(long, meta, ["e1", "e2"], buckets=4)
    old = spark.conf.get(NO_BROADCAST)
    spark.conf.set(NO_BROADCAST, "-1")
    try:
        detailed = matching.group_ratios(stored.scored.light, stored.rates.light)
        ranked_input = stored.result.rows().groupBy("employee_id").agg(F.max("final_match_rate"))
        assert moved_by_employee(detailed) == [] and "SortMergeJoin" in physical(detailed)
        assert moved_by_employee(ranked_input) == []
        assert moved_by_employee(matching.aggregate_scores(stored.scored.light)) == []
    finally:
        spark.conf.set(NO_BROADCAST, old)
    assert stored.scored.heavy is None
    plain = matching.talent_match(long, meta, ["e1", "e2"], sort=False, materialize=False)
    assert rows(stored.result.rows()) == rows(plain)
    drop(spark, stored)


def test_a_hot_employee_is_kept_apart_with_the_same_result(spark):
    long, meta = talent(spark, 300)
    heavy = copartition.heavy_keys(long, "employee_id", 2)
    assert rows(heavy) == [("e7",)]
    stored = matching.stored_match(long, meta, ["e1", "e2"], buckets=2)
    assert stored.scored.heavy.count() == 301 and stored.scored.light.where("employee_id = 'e7'").count() == 0
    plain = matching.talent_match(long, meta, ["e1", "e2"], sort=False, materialize=False)
    assert rows(stored.result.rows()) == rows(plain)
    named = dashboard.employee_directory(meta, spark.createDataFrame([], "employee_id string, year int, rating int"))
    assert rows(dashboard.ranked_candidates(stored.result.rows(), named)) == rows(dashboard.ranked_candidates(plain, named))
    drop(spark, stored)


def test_no_rows_and_no_benchmark(spark):
    long, meta = talent(spark, 0)
    for case in (matching.stored_match(long.limit(0), meta, ["e1"], buckets=2), matching.stored_match(long, meta, [], buckets=2)):
        assert case.result.rows().count() == 0
        drop(spark, case)
