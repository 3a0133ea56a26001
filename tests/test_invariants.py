"""Property tests of the score invariants (random small long tables)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from traitmatch.operators import matching as m
from traitmatch.operators.traits import COGNITIVE, COMPETENCY, CONTEXTUAL, PERSONALITY

TRAITS = [(COMPETENCY, "SEA", "numeric"), (COMPETENCY, "QDD", "numeric"), (COGNITIVE, "IQ", "numeric"),
          (PERSONALITY, "Papi_S", "numeric"), (PERSONALITY, "MBTI", "categorical"),
          (CONTEXTUAL, "Area", "categorical")]
num = st.one_of(st.none(), st.integers(min_value=-5, max_value=200).map(str), st.just("n/a"))
cat = st.one_of(st.none(), st.sampled_from(["INTJ", "ENFP", " intj ", "HQ", "Plant"]))


@st.composite
def long_tables(draw):
    n = draw(st.integers(min_value=1, max_value=6))
    rows = []
    for e in range(n):
        for group, trait, kind in TRAITS:
            if draw(st.booleans()) or e == 0:
                rows.append((f"e{e}", group, trait, draw(num if kind == "numeric" else cat), kind))
    return rows


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=long_tables())
def test_score_invariants(spark, rows):
    long = spark.createDataFrame(rows, "employee_id string, tgv_name string, tv_name string, user_score string, "
                                       "tv_type string")
    ids = m.benchmark_frame(spark, ["e0"])
    prof = m.benchmark_profile(long, ids)
    scores = m.match_scores(long, prof).collect()
    assert all(r.match_score is None or 0.0 <= r.match_score <= 100.0 for r in scores)
    # the sole benchmark matches itself: 100 on every numeric trait with a positive value,
    # and on every categorical trait with a non-NULL value
    for r in scores:
        if r.employee_id != "e0":
            continue
        if r.tv_type == "numeric":
            try:
                v = float(r.user_score)
            except (TypeError, ValueError):
                v = None
            if v is not None and v > 0:
                assert r.match_score == 100.0
        elif r.user_score is not None:
            assert r.match_score == 100.0
    # final rate = sum of the five raw group sums
    weighted = m.weighted_scores(m.match_scores(long, prof))
    for a in m.aggregate_scores(weighted).collect():
        parts = [a[c] for c in m.GROUP_TOTALS]
        if a.final_match_rate is not None:
            assert abs(a.final_match_rate - sum(p or 0.0 for p in parts)) < 1e-9
