import json

import pytest
from pyspark.sql import functions as F

from traitmatch.operators import matching as m
from traitmatch.operators.traits import COGNITIVE, COMPETENCY, CONTEXTUAL, PERSONALITY, STRENGTHS
from conftest import rows

SCHEMA = "employee_id string, tgv_name string, tv_name string, user_score string, tv_type string"


def long_frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_categorical_targets_winner_tie_and_null(spark):
    data = [
        # MBTI: one winner (INTJ twice)
        ("b1", PERSONALITY, "MBTI", "INTJ", "categorical"), ("b2", PERSONALITY, "MBTI", "INTJ", "categorical"),
        ("b3", PERSONALITY, "MBTI", "ENFP", "categorical"),
        # DISC: full tie
        ("b1", PERSONALITY, "DISC", "DI", "categorical"), ("b2", PERSONALITY, "DISC", "SC", "categorical"),
        ("b3", PERSONALITY, "DISC", "CS", "categorical"),
        # Major: NULL wins
        ("b1", CONTEXTUAL, "Major", None, "categorical"), ("b2", CONTEXTUAL, "Major", None, "categorical"),
        ("b3", CONTEXTUAL, "Major", "Design", "categorical"),
    ]
    prof = m.benchmark_profile(long_frame(spark, data), m.benchmark_frame(spark, ["b1", "b2", "b3"]))
    got = {r.tv_name: r.categorical_target for r in prof.collect()}
    assert json.loads(got["MBTI"]) == ["INTJ"]
    assert json.loads(got["DISC"]) == ["CS", "DI", "SC"]
    assert json.loads(got["Major"]) == [None]


def test_numeric_score_rules(spark):
    bench = [("b1", PERSONALITY, "Papi_S", "4", "numeric"), ("b1", COMPETENCY, "SEA", "4", "numeric"),
             ("b1", COGNITIVE, "IQ", "0", "numeric"), ("b1", COGNITIVE, "GTQ", None, "numeric"),
             ("b1", COGNITIVE, "Pauli", "50", "numeric")]
    users = [
        ("u1", COMPETENCY, "SEA", "2", "numeric"),        # 50
        ("u2", COMPETENCY, "SEA", "9", "numeric"),        # over 100 -> 100
        ("u3", COMPETENCY, "SEA", "-1", "numeric"),       # negative -> 0
        ("u4", COMPETENCY, "SEA", None, "numeric"),       # u NULL -> NULL
        ("u5", COMPETENCY, "SEA", "abc", "numeric"),      # non-numeric -> NULL
        ("u6", COGNITIVE, "IQ", "100", "numeric"),        # t = 0 -> NULL
        ("u7", COGNITIVE, "GTQ", "10", "numeric"),        # t NULL -> NULL
        ("u8", PERSONALITY, "Papi_S", "6", "numeric"),    # inverse: (8-6)/4 = 50
        ("u9", PERSONALITY, "Papi_S", "1", "numeric"),    # inverse: (8-1)/4 -> 100
        ("u10", COGNITIVE, "Pauli", "25", "numeric"),     # 50
    ]
    long = long_frame(spark, bench + users)
    prof = m.benchmark_profile(long, m.benchmark_frame(spark, ["b1"]))
    got = dict(((r.employee_id, r.tv_name), r.match_score) for r in m.match_scores(long, prof).collect())
    assert got[("u1", "SEA")] == 50.0
    assert got[("u2", "SEA")] == 100.0
    assert got[("u3", "SEA")] == 0.0
    assert got[("u4", "SEA")] is None
    assert got[("u5", "SEA")] is None
    assert got[("u6", "IQ")] is None
    assert got[("u7", "GTQ")] is None
    assert got[("u8", "Papi_S")] == 50.0
    assert got[("u9", "Papi_S")] == 100.0
    assert got[("u10", "Pauli")] == 50.0
    assert got[("b1", "Papi_S")] == 100.0 and got[("b1", "SEA")] == 100.0


def test_strength_and_categorical_scores(spark):
    data = [
        ("b1", STRENGTHS, "Strength", json.dumps(["Achiever", "Focus", "Learner"]), "array"),
        ("b2", STRENGTHS, "Strength", json.dumps(["Arranger", "Belief", "Command", "Deliberative"]), "array"),
        ("b1", CONTEXTUAL, "Area", "HQ", "categorical"),
        ("u1", STRENGTHS, "Strength", json.dumps([" achiever", "FOCUS ", "Focus", "Zeal"]), "array"),
        ("u2", STRENGTHS, "Strength", json.dumps([]), "array"),
        ("u3", STRENGTHS, "Strength", None, "array"),
        ("u1", CONTEXTUAL, "Area", " hq ", "categorical"),
        ("u2", CONTEXTUAL, "Area", None, "categorical"),
        ("u3", CONTEXTUAL, "Area", "Plant", "categorical"),
    ]
    long = long_frame(spark, data)
    prof = m.benchmark_profile(long, m.benchmark_frame(spark, ["b1", "b2"]))
    target = [r.strength_target for r in prof.collect() if r.tv_name == "Strength"][0]
    assert len(json.loads(target)) == 7  # the target may hold more than five themes
    got = dict(((r.employee_id, r.tv_name), r.match_score) for r in m.match_scores(long, prof).collect())
    # distinct raw items: " achiever", "FOCUS ", "Focus" all match -> 3 / 5
    assert got[("u1", "Strength")] == pytest.approx(60.0)
    assert got[("u2", "Strength")] == 0.0
    assert got[("u3", "Strength")] == 0.0
    assert got[("u1", "Area")] == 100.0
    assert got[("u2", "Area")] == 0.0
    assert got[("u3", "Area")] == 0.0


def test_null_winning_category_scores_zero_for_everyone(spark):
    data = [("b1", CONTEXTUAL, "Major", None, "categorical"), ("u1", CONTEXTUAL, "Major", "Design", "categorical"),
            ("u2", CONTEXTUAL, "Major", None, "categorical")]
    long = long_frame(spark, data)
    prof = m.benchmark_profile(long, m.benchmark_frame(spark, ["b1"]))
    assert {r.match_score for r in m.match_scores(long, prof).collect()} == {0.0}


def test_talent_match_invariants(spark):
    data = []
    for e, (sea, mbti, papi) in {"b1": ("4", "INTJ", "3"), "u1": ("2", "ENFP", "5"), "u2": (None, "INTJ", "1")}.items():
        data += [(e, COMPETENCY, "SEA", sea, "numeric"), (e, PERSONALITY, "MBTI", mbti, "categorical"),
                 (e, PERSONALITY, "Papi_T", papi, "numeric"), (e, "Other", "NotScored", "1", "numeric")]
    long = long_frame(spark, data)
    emp = spark.createDataFrame([("b1", "D1", "P1", "G1"), ("u1", "D2", "P2", "G2")],
                                "employee_id string, directorate string, position string, grade string")
    res = m.talent_match(long, emp, ["b1"])
    out = res.collect()
    assert len(out) == 9  # the unscored trait is dropped; u2 has no metadata but keeps its rows
    assert all(r.tv_match_rate is None or 0 <= r.tv_match_rate <= 100 for r in out)
    b1 = [r for r in out if r.employee_id == "b1"]
    assert all(r.is_benchmark and r.tv_match_rate == 100.0 for r in b1)
    # final = sum of weighted scores, rounded: 100*0.084375 + 100*0.00714 + 100*0.00714
    assert b1[0].final_match_rate == round(8.4375 + 0.714 + 0.714, 2)
    assert out[0].is_benchmark  # sorted: benchmarks first
    u2 = [r for r in out if r.employee_id == "u2"]
    assert {r.role for r in u2} == {None}
    sea_u2 = [r for r in u2 if r.tv_name == "SEA"][0]
    assert sea_u2.tv_match_rate is None  # missing value: NULL score, the total simply drops it
    cands = m.talent_match_candidates(long, emp, ["b1"]).collect()
    assert {r.employee_id for r in cands} == {"u1", "u2"}


def test_benchmark_ids_as_frame(spark):
    data = [("b1", COMPETENCY, "SEA", "4", "numeric"), ("u1", COMPETENCY, "SEA", "2", "numeric")]
    long = long_frame(spark, data)
    ids = spark.createDataFrame([("b1",)], "employee_id string")
    emp = spark.createDataFrame([], "employee_id string, directorate string, position string, grade string")
    res = m.talent_match(long, emp, ids)
    assert rows(res, "employee_id", "tv_match_rate", "is_benchmark") == [("b1", 100.0, True), ("u1", 50.0, False)]


def test_no_benchmark_gives_an_empty_result(spark):
    long = long_frame(spark, [("e1", COMPETENCY, "SEA", "3", "numeric")])
    meta = spark.createDataFrame([("e1", "D", "P", "G")],
                                 "employee_id string, directorate string, position string, grade string")
    assert m.talent_match(long, meta, [], materialize=False).count() == 0
    assert m.talent_match(long, meta, ["e1"], materialize=False).count() == 1


def test_weights_shares_and_lists_are_the_fixed_values():
    weights = dict(m.TRAIT_WEIGHTS)
    assert len(weights) == 26
    assert weights["SEA"] == weights["CEX_GDR"] == 0.084375 and weights["IQ"] == 0.01
    assert weights["MBTI"] == weights["Papi_W"] == 0.00714 and weights["Strength"] == 0.05 and weights["Tenure"] == 0.035
    assert {k: v for k, (_, v) in m.GROUP_TOTALS.items()} == {
        "competency_raw": 0.675, "cognitive_raw": 0.05, "personality_raw": 0.05, "strengths_raw": 0.05,
        "contextual_raw": 0.175}
    assert m.INVERSE_TRAITS == ("Papi_S", "Papi_G", "Papi_T")
