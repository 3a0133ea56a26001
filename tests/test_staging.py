from pyspark.sql import functions as F

from traitmatch.operators import staging
from traitmatch.sources.dims import dimension_frames
from conftest import rows


def test_impute_group_median_edge_cases(spark):
    comp = spark.createDataFrame([
        # key A: odd count of valid values 1,3,5 -> median 3
        ("e1", "A", 2000, 1), ("e2", "A", 2000, 3), ("e3", "A", 2000, 5),
        ("e4", "A", 2000, 99), ("e5", "A", 2000, None), ("e6", "A", 2000, 0),
        # key B: even count 2,4 -> 3.0 (interpolated); value from another year is ignored for the median
        ("e1", "B", 2000, 2), ("e2", "B", 2000, 4), ("e3", "B", 1999, 5), ("e4", "B", 2000, 6),
        # key C: only invalid values -> stays NULL
        ("e1", "C", 2000, 6), ("e2", "C", 2000, None),
    ], "employee_id string, pillar_code string, year int, score int")
    out = staging.stg_competencies(comp, year=2000)
    assert rows(out, "employee_id", "pillar_code", "score_imputed") == sorted([
        ("e1", "A", 1.0), ("e2", "A", 3.0), ("e3", "A", 5.0), ("e4", "A", 3.0), ("e5", "A", 3.0), ("e6", "A", 3.0),
        ("e1", "B", 2.0), ("e2", "B", 4.0), ("e4", "B", 3.0),
        ("e1", "C", None), ("e2", "C", None),
    ], key=repr)
    yearly = staging.stg_competencies_yearly(comp, median_year=2000)
    assert ("e3", "B", 1999, 5.0) in rows(yearly, "employee_id", "pillar_code", "year", "score_imputed")
    assert yearly.count() == comp.count()


def test_papi_zero_is_valid(spark):
    papi = spark.createDataFrame([("e1", "Papi_P", 0), ("e2", "Papi_P", 0), ("e3", "Papi_P", 9),
                                  ("e4", "Papi_P", None)], "employee_id string, scale_code string, score int")
    assert rows(staging.stg_papi(papi), "employee_id", "score_imputed") == [
        ("e1", 0.0), ("e2", 0.0), ("e3", 9.0), ("e4", 0.0)]


def test_performance_history_filter(spark):
    perf = spark.createDataFrame([("e1", 1999, 3), ("e1", 2000, 4), ("e2", 1998, 0), ("e2", 1999, 6),
                                  ("e3", 1999, None), ("e3", 1997, 5)], "employee_id string, year int, rating int")
    assert rows(staging.stg_performance_yearly(perf, before=2000)) == [("e1", 1999, 3), ("e3", 1997, 5)]


def test_strengths_top5_after_junk(spark):
    data = [("e1", r, t) for r, t in enumerate([" nan ", "A", "", "B", None, "C", "NONE", "D", "E", "F"], 1)]
    data += [("e2", 1, "X"), ("e2", 2, "Y"), ("e3", 1, "Q"), ("e3", 1, "P")]  # e2: fewer than 5; e3: tied rank
    s = spark.createDataFrame(data, "employee_id string, rank int, theme string")
    out = rows(staging.stg_strengths(s), "employee_id", "theme")
    assert out == sorted([("e1", t) for t in "ABCDE"] + [("e2", "X"), ("e2", "Y"), ("e3", "P"), ("e3", "Q")],
                         key=repr)


def test_mbti_and_disc(spark):
    psych = spark.createDataFrame([
        ("e1", " inftj ", None, "Dominant-Influencer"),
        ("e2", "INFTJ", "di", None),
        ("e3", " entj", None, " Conscientious-Steadiness "),
        ("e4", None, None, "Unmapped"),
        ("e5", "ENTJ", None, None),
        ("e6", "istp", None, "Steadiness"),
    ], "employee_id string, mbti string, disc string, disc_word string")
    assert rows(staging.clean_mbti(psych)) == [("e1", "UNKNOWN"), ("e2", "UNKNOWN"), ("e3", "ENTJ"),
                                               ("e4", None), ("e5", "ENTJ"), ("e6", "ISTP")]
    # ENTJ and UNKNOWN both occur twice: the tie resolves to the smallest value
    assert spark.range(1).select(staging.mbti_mode(psych).alias("m")).collect()[0]["m"] == "ENTJ"
    assert rows(staging.clean_disc(psych), "employee_id", "disc") == [
        ("e1", "DI"), ("e2", "DI"), ("e3", "CS"), ("e4", None), ("e5", None), ("e6", "S")]


def test_every_disc_word_maps(spark):
    expect = {
        "Dominant-Influencer": "DI", "Dominant-Steadiness": "DS", "Dominant-Conscientious": "DC",
        "Influencer-Dominant": "ID", "Influencer-Steadiness": "IS", "Influencer-Conscientious": "IC",
        "Steadiness-Dominant": "SD", "Steadiness-Influencer": "SI", "Steadiness-Conscientious": "SC",
        "Conscientious-Dominant": "CD", "Conscientious-Influencer": "CI", "Conscientious-Steadiness": "CS",
        "Dominance": "D", "Influence": "I", "Steadiness": "S", "Conscientiousness": "C",
    }
    df = spark.createDataFrame([(f"e{i}", None, w) for i, w in enumerate(expect)],
                               "employee_id string, disc string, disc_word string")
    assert {r.disc_word: r.disc for r in staging.clean_disc(df).collect()} == expect


def test_stg_employees_rules(spark):
    emp = spark.createDataFrame([
        ("e1", "Ann", "N1", 10, 1, 2, 1, 1, 1, 1, 1, 1),
        ("e2", "Bob", "N2", 20, 4, 2, 1, 1, 1, 1, 1, 1),    # department 4: iq/gtq NULL
        ("e3", "Cid", "N3", 30, 1, 9, 9, 9, 9, 9, 0, 9),    # dangling keys -> NULL names
        ("e4", "Dee", "N4", 40, 1, 1, 1, 1, 1, 1, 1, 1),    # no rating this year -> dropped
        ("e5", "Eve", "N5", 50, 1, 1, 1, 1, 1, 1, 1, 1),    # rating 6 -> dropped
        ("e6", "Fay", "N6", 60, 1, 1, 1, 1, 1, 1, 1, 1),    # duplicate performance rows -> two rows
    ], "employee_id string, fullname string, nip string, years_of_service_months int, department_id int, "
       "position_id int, grade_id int, education_id int, major_id int, company_id int, area_id int, "
       "directorate_id int")
    psych = spark.createDataFrame([
        ("e1", 100.0, None, "entj", None, "Influence", 50.0, 5.0, 70.0),
        ("e2", 90.0, 20.0, None, "SC", None, 51.0, 6.0, None),
        ("e3", None, 30.0, None, None, None, 52.0, 7.0, 71.0),
        ("e6", 120.0, 40.0, "ENTJ", None, None, 53.0, 8.0, 72.0),
    ], "employee_id string, iq double, gtq double, mbti string, disc string, disc_word string, "
       "pauli double, tiki double, faxtor double")
    perf = spark.createDataFrame([("e1", 2000, 3), ("e2", 2000, 5), ("e3", 2000, 1), ("e4", 1999, 4),
                                  ("e5", 2000, 6), ("e6", 2000, 2), ("e6", 2000, 4)],
                                 "employee_id string, year int, rating int")
    out = staging.stg_employees(emp, psych, perf, dimension_frames(spark), year=2000)
    got = rows(out, "employee_id", "department", "position", "area", "iq_imputed", "gtq_imputed",
               "mbti_final", "disc", "rating")
    # department 1 medians over rated rows with iq or gtq: iq (100, 120, 120) -> 120; gtq (30, 40, 40) -> 40
    assert got == sorted([
        ("e1", "Finance", "Data Analyst", "Distribution", 100.0, 40.0, "ENTJ", "I", 3),
        ("e2", "Marketing", "Data Analyst", "Distribution", None, None, "ENTJ", "SC", 5),
        ("e3", "Finance", None, None, 120.0, 30.0, "ENTJ", None, 1),
        ("e6", "Finance", "Brand Executive", "Distribution", 120.0, 40.0, "ENTJ", None, 2),
        ("e6", "Finance", "Brand Executive", "Distribution", 120.0, 40.0, "ENTJ", None, 4),
    ], key=repr)


def test_rating_zero_and_null_are_not_rated(spark):
    emp = spark.createDataFrame([("e1", "A", "N1", 1, 1, 1, 1, 1, 1, 1, 1, 1), ("e2", "B", "N2", 1, 1, 1, 1, 1, 1, 1, 1, 1),
                                 ("e3", "C", "N3", 1, 1, 1, 1, 1, 1, 1, 1, 1)],
                                "employee_id string, fullname string, nip string, years_of_service_months int, "
                                "department_id int, position_id int, grade_id int, education_id int, major_id int, "
                                "company_id int, area_id int, directorate_id int")
    psych = spark.createDataFrame([("e1", 90.0, 10.0, "ENTJ", "D", None, 1.0, 1.0, 1.0)],
                                  "employee_id string, iq double, gtq double, mbti string, disc string, "
                                  "disc_word string, pauli double, tiki double, faxtor double")
    perf = spark.createDataFrame([("e1", 2000, 0), ("e2", 2000, None), ("e3", 2000, 5)],
                                 "employee_id string, year int, rating int")
    out = staging.stg_employees(emp, psych, perf, dimension_frames(spark), year=2000)
    got = rows(out, "employee_id", "iq_imputed", "mbti_final", "rating")
    # e3 has no psych row: iq from the department median over rated employees with iq/gtq (none) -> NULL;
    # MBTI falls back to the global mode
    assert got == [("e3", None, "ENTJ", 5)]


def test_approximate_median_imputation(spark):
    comp = spark.createDataFrame([("e1", "A", 2000, 1), ("e2", "A", 2000, 3), ("e3", "A", 2000, None)],
                                 "employee_id string, pillar_code string, year int, score int")
    exact = rows(staging.impute_group_median(comp, "pillar_code", "score"), "employee_id", "score_imputed")
    approx = rows(staging.impute_group_median(comp, "pillar_code", "score", approx=True), "employee_id", "score_imputed")
    assert exact[-1] == ("e3", 2.0) and approx[-1] == ("e3", 1.0)  # approx returns an observed value
