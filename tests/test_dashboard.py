from pyspark.sql import functions as F

from traitmatch.operators import dashboard as d
from traitmatch.operators.traits import COGNITIVE, COMPETENCY, CONTEXTUAL, PERSONALITY, STRENGTHS
from traitmatch.sources.dims import dimension_frames
from conftest import rows

RESULT = ("employee_id string, directorate string, tgv_name string, tv_name string, baseline_score string, "
          "tgv_match_rate double, final_match_rate double, is_benchmark boolean")


def result_frame(spark):
    data = [
        ("b1", "D", COMPETENCY, "SEA", "4.5", 90.0, 80.0, True),
        ("b1", "D", COGNITIVE, "IQ", "100", 70.0, 80.0, True),
        ("b2", "D", COMPETENCY, "SEA", "4.5", 90.0, 70.0, True),
        ("b2", "D", COGNITIVE, "IQ", "100", 50.0, 70.0, True),
        ("c1", "D", COMPETENCY, "SEA", "4.5", 60.0, 55.5, False),
        ("c1", "D", COGNITIVE, "IQ", "100", 80.0, 55.5, False),
        ("c2", "E", COMPETENCY, "SEA", "4.5", 60.0, 55.5, False),   # same rate as c1: distinct average
        ("c2", "E", COGNITIVE, "IQ", "100", 20.0, 55.5, False),
        ("c3", "E", COMPETENCY, "SEA", "4.5", 10.0, 99.0, False),   # ghost: not in the directory
        ("c4", "E", PERSONALITY, "MBTI", "INTJ", 40.0, 100.0, False),
    ]
    return spark.createDataFrame(data, RESULT)


def directory_frame(spark):
    return spark.createDataFrame([
        ("b1", "Bea", "HRBP", "IV", 5.0, "Bea (b1)"), ("b2", "Bo", "HRBP", "IV", 4.0, "Bo (b2)"),
        ("c1", "Cy", "HRBP", "V", 3.0, "Cy (c1)"), ("c2", "Ci", "Data Analyst", "IV", 3.0, "Ci (c2)"),
        ("c4", "Col", "Unknown", "Unknown", 0.0, "Col (c4)"),
    ], "employee_id string, fullname string, role string, grade string, rating double, display string")


def test_ranked_candidates_drop_ghosts_and_rank(spark):
    ranked = d.ranked_candidates(result_frame(spark), directory_frame(spark))
    assert rows(ranked, "rank", "employee_id", "top_tgv", "final_match_rate") == [
        (1, "c4", PERSONALITY, 100.0), (2, "c1", COGNITIVE, 55.5), (3, "c2", COMPETENCY, 55.5)]


def test_group_averages_use_distinct_rates(spark):
    avg = dict((r.tgv_name, r.avg_match_rate) for r in d.group_averages(result_frame(spark)).collect())
    assert avg[COMPETENCY] == (60.0 + 10.0) / 2
    assert avg[COGNITIVE] == (80.0 + 20.0) / 2


def test_compare_and_gap(spark):
    cmp = d.compare_to_benchmark(result_frame(spark), "c1")
    got = rows(cmp, "tgv_name", "benchmark_avg", "candidate_rate", "diff")
    assert got == sorted([(COMPETENCY, 90.0, 60.0, -30.0), (COGNITIVE, 60.0, 80.0, 20.0),
                          (PERSONALITY, 0.0, 0.0, 0.0), (STRENGTHS, 0.0, 0.0, 0.0),
                          (CONTEXTUAL, 0.0, 0.0, 0.0)], key=repr)
    gap = d.strongest_and_gap(cmp).collect()[0]
    assert (gap.strongest, gap.strongest_diff, gap.weakest, gap.weakest_diff) == (COGNITIVE, 20.0, COMPETENCY, -30.0)


def test_gap_ties_take_first_group(spark):
    cmp = d.compare_to_benchmark(result_frame(spark), "nobody")  # candidate rates all 0
    gap = d.strongest_and_gap(cmp).collect()[0]
    assert gap.strongest == PERSONALITY  # 0 diff: first zero-diff group in the fixed order
    assert gap.weakest == COMPETENCY


def test_histogram_bins(spark):
    ranked = spark.createDataFrame([(0.0,), (4.99,), (5.0,), (100.0,), (55.5,)], "final_match_rate double")
    h = {r.bin: r["count"] for r in d.rate_histogram(ranked).collect()}
    assert len(h) == 20 and h[0] == 2 and h[1] == 1 and h[19] == 1 and h[11] == 1 and sum(h.values()) == 5


def test_directory_filters_and_options(spark):
    emp = spark.createDataFrame([("e1", "Ann", "Data Analyst", "IV"), ("e2", "Ben", None, None),
                                 ("e3", "Cat", "Data Analyst", "V")],
                                "employee_id string, fullname string, position string, grade string")
    perf = spark.createDataFrame([("e1", 2000, 4), ("e3", 1999, 5)], "employee_id string, year int, rating int")
    dr = d.employee_directory(emp, perf, year=2000)
    assert rows(dr, "employee_id", "role", "grade", "rating", "display") == [
        ("e1", "Data Analyst", "IV", 4.0, "Ann (e1)"), ("e2", "Unknown", "Unknown", 0.0, "Ben (e2)"),
        ("e3", "Data Analyst", "V", 0.0, "Cat (e3)")]
    assert rows(d.filter_directory(dr, role="Data Analyst", rating="4.0"), "employee_id") == [("e1",)]
    opts = rows(d.filter_options(dr, role="Data Analyst"), "kind", "value", "ordinal")
    assert opts == sorted([("role", "Data Analyst", 1), ("role", "Unknown", 2), ("grade", "IV", 1),
                           ("grade", "V", 2), ("rating", "4.0", 1)], key=repr)
    defaults = spark.createDataFrame([("e3",), ("e1",), ("zz",)], "employee_id string")
    assert rows(d.default_benchmarks(dr, defaults), "employee_id") == [("e1",), ("e3",)]


def test_baseline_profile_and_key_competencies(spark):
    res = result_frame(spark)
    wide = d.baseline_profile(res).collect()[0]
    assert wide.baseline_sea == "4.5" and wide.baseline_iq == "100" and wide.baseline_mbti == "INTJ"
    assert wide.baseline_tenure == "N/A"  # the reported default where there is no baseline
    pillars = dimension_frames(spark)["dim_competency_pillars"]
    lines = rows(d.key_competencies(res, pillars), "ordinal", "line")
    assert lines == [(1, "Social Empathy & Awareness (4.5)")]
    low = res.withColumn("baseline_score", F.lit("3"))
    assert rows(d.key_competencies(low, pillars), "line") == [(d.DEFAULT_COMPETENCY_LINE,)]
    comp = spark.createDataFrame([("STO_LIE", "5")], "tv_name string, baseline_score string")
    assert rows(d.key_competencies(comp, pillars), "line") == [("Synergy & Team Orientation (5.0)",)]
