from pyspark.sql import functions as F

from traitmatch.operators import relational as rel
from traitmatch.plans.ranking import global_rank
from conftest import rows


def test_global_rank_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).cast("double").alias("score"), F.col("id").alias("k"))
    expect = [(i + 1, k) for i, (_, k) in enumerate(sorted(((-(k % 97), k) for k in range(5000))))]
    ranked = global_rank(df, [F.col("score").desc(), F.col("k")], num_partitions=7)
    assert sorted((r["rank"], r.k) for r in ranked.collect()) == expect


def test_modes_with_ties_and_null(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None), ("b", None), ("b", "z")], "k string, v string")
    got = {r.k: r.modes for r in rel.modes_with_ties(df, "k", "v").collect()}
    assert got == {"a": ["x", "y"], "b": [None]}


def test_median_forms_agree(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 10), ("a", 11), ("b", 5), ("b", None)], "k string, v int")
    grouped = rows(rel.median_by(df, "k", "v"))
    window = rows(rel.median_window(df, "k", "v").select("k", "median").distinct())
    assert grouped == window == [("a", 6.0), ("b", 5.0)]
    approx = rows(rel.median_by(df, "k", "v", approx=True))
    assert approx == [("a", 2.0), ("b", 5.0)]  # percentile_approx returns an actual value


def test_wide_to_long_keeps_nulls(spark):
    df = spark.createDataFrame([("e1", 1.0, None)], "id string, a double, b string")
    out = rel.wide_to_long(df, ["id"], [(F.col("a"), {"t": "A"}), (F.col("b"), {"t": "B"})])
    assert rows(out, "id", "t", "value") == [("e1", "A", "1.0"), ("e1", "B", None)]


def test_top1_and_arg_extreme(spark):
    df = spark.createDataFrame([("e", "g1", 5.0), ("e", "g2", 5.0), ("e", "g3", 1.0), ("f", "g1", None)],
                               "k string, g string, v double")
    assert rows(rel.top_1_by(df, "k", "v", "g", "top", fill="N/A")) == [("e", "g1")]
    ordered = spark.createDataFrame([("x", 2.0, 0), ("y", 2.0, 1), ("z", -1.0, 2), ("w", -1.0, 3)],
                                    "g string, d double, o int")
    ext = rel.arg_extreme(ordered, "g", "d", "o").collect()[0]
    assert (ext.max_g, ext.min_g) == ("x", "z")


def test_where_helpers(spark):
    df = spark.createDataFrame([(1, "a"), (5, None), (6, "b"), (None, "c")], "r int, s string")
    assert rel.where_between(df, "r", 1, 5).count() == 2
    assert rel.where_in(df, "s", ["a"], negate=True).count() == 2  # NULL passes neither
    assert rel.where_optional(df, {"s": "All"}).count() == 4
    assert rows(rel.where_optional(df, {"s": "b"}), "r") == [(6,)]


def test_group_value(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 5)], "k string, v int")
    per_k = df.groupBy("k").agg(F.sum("v").alias("k_sum"))
    assert rows(rel.with_group_value(df, per_k, "k"), "k", "v", "k_sum") == [("a", 1, 4), ("a", 3, 4), ("b", 5, 5)]


def test_approximate_variants(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    assert spark.range(1).select(rel.mode_value(df, "k", approx=True).alias("m")).collect()[0]["m"] == "b"
    assert spark.range(1).select(rel.mode_value(df, "k").alias("m")).collect()[0]["m"] == "b"


def test_scale_settings(spark):
    from traitmatch.session import apply_unset, scale_settings
    s = scale_settings(100 * 1024 ** 4, partition_bytes=1024 ** 3)
    assert s["spark.sql.shuffle.partitions"] == str(100 * 1024) and s["spark.sql.adaptive.enabled"] == "true"
    assert scale_settings(10, executors_cores=16)["spark.sql.shuffle.partitions"] == "16"
    applied = apply_unset(spark, {"spark.sql.shuffle.partitions": "3", "spark.traitmatch.test.flag": "on"})
    assert applied == {"spark.traitmatch.test.flag": "on"}  # shuffle partitions were already set


def test_id_frames_carry_no_broadcast_hint(spark):
    from traitmatch.operators import matching as m
    ids = spark.range(0, 50).selectExpr("concat('e', cast(id as string)) as employee_id")
    frame = m.benchmark_frame(spark, ids)
    assert frame.count() == 50 and "strategy=broadcast" not in frame._jdf.queryExecution().analyzed().toString()
    assert m.benchmark_frame(spark, ["a", "b", "a"]).count() == 2


def test_mode_rows_keep_ties_and_null(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None), ("b", None), ("b", "z")], "k string, v string")
    assert rows(rel.mode_rows(df, "k", "v")) == [("a", "x"), ("a", "y"), ("b", None)]


def test_median_even_odd_and_repeated_values(spark):
    data = [("odd", v) for v in (9, 1, 5)] + [("even", v) for v in (1, 2, 2, 8)] + [("half", v) for v in (3, 4)]
    df = spark.createDataFrame(data, "k string, v int")
    assert rows(rel.median_by(df, "k", "v")) == [("even", 2.0), ("half", 3.5), ("odd", 5.0)]


def test_small_building_blocks(spark):
    df = spark.createDataFrame([("e1", "G1", 2.0, True), ("e1", "G2", None, False), ("e2", "G1", 4.0, None)],
                               "k string, g string, v double, flag boolean")
    assert rows(rel.tag(df.select("k"), src="x"), "k", "src") == [("e1", "x"), ("e1", "x"), ("e2", "x")]
    c = rel.case([(F.col("v") > 3, "big"), (F.col("v").isNotNull(), "small")], otherwise="none")
    assert rows(df.select("k", "g", c.alias("c")), "k", "g", "c") == [("e1", "G1", "small"), ("e1", "G2", "none"),
                                                                     ("e2", "G1", "big")]
    assert rel.where_not_null(df, "v", "flag").count() == 1
    assert rows(rel.where_flag(df, "flag", False), "k", "g") == [("e1", "G2")]  # NULL flag passes neither
    sums = rel.conditional_sums(df, "k", "g", "v", {"g1": "G1", "g2": "G2"})
    assert rows(sums) == [("e1", 2.0, 0.0), ("e2", 4.0, 0.0)]  # NULL value in its group: SUM skips it
    assert rows(rel.collect_sorted(df, "g", "k", "ks")) == [("G1", ["e1", "e2"]), ("G2", ["e1"])]
    assert rel.row_count(df).collect()[0]["n"] == 3
    assert [r.k for r in rel.sort_result(df, [F.col("v").desc_nulls_last(), F.col("k")]).collect()] == ["e2", "e1", "e1"]
    assert rows(rel.count_by(df, "k")) == [("e1", 2), ("e2", 1)]
    assert rows(rel.row_number_by(df, ["k"], [F.col("g")]), "k", "g", "rn") == [("e1", "G1", 1), ("e1", "G2", 2),
                                                                                ("e2", "G1", 1)]
    assert rel.union_all(df, df).count() == 6


def test_reshaping_and_lateral(spark):
    long = spark.createDataFrame([("e1", "A", "1"), ("e1", "B", "2"), ("e2", "A", "3")], "id string, t string, v string")
    wide = rel.long_to_wide(long, "t", "v", ["A", "B", "C"], name_fn=str.lower, group_by=["id"])
    assert rows(wide) == [("e1", "1", "2", None), ("e2", "3", None, None)]
    g = spark.createDataFrame([("Y", 5.0)], "grp string, val double")
    assert rows(rel.reindex(g, "grp", ["X", "Y", "Z"], ["val"]), "grp", "ordinal", "val") == [
        ("X", 0, 0.0), ("Y", 1, 5.0), ("Z", 2, 0.0)]
    arr = spark.createDataFrame([("s", ["a", "b"]), ("s", []), ("n", ["z"])], "t string, items array<string>")
    out = rel.explode_when(arr, F.col("t") == "s", F.col("items"), "item")
    assert rows(out, "t", "item") == sorted([("n", None), ("s", None), ("s", "a"), ("s", "b")], key=repr)
    joined = rel.left_join(long, spark.createDataFrame([("e1", "Ann")], "id string, name string"), "id")
    assert rows(rel.drop_unmatched(joined, "name"), "id", "t") == [("e1", "A"), ("e1", "B")]
    assert rel.inner_join(long, spark.createDataFrame([("e2",)], "id string"), "id").count() == 1
