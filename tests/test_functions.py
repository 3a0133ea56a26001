from pyspark.sql import functions as F

from traitmatch.functions import (clamp, code_prefix, display_label, join_items, json_to_array,
                                  label_to_id, map_value, norm, num_to_text, round_numeric, to_double)


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).collect()[0]["x"]


def test_clamp_keeps_null(spark):
    assert one(spark, clamp(F.lit(None).cast("double"))) is None
    assert one(spark, clamp(F.lit(150.0))) == 100.0
    assert one(spark, clamp(F.lit(-3.0))) == 0.0
    assert one(spark, clamp(F.lit(42.5))) == 42.5


def test_num_to_text(spark):
    assert one(spark, num_to_text(F.lit(3.0))) == "3"
    assert one(spark, num_to_text(F.lit(3.5))) == "3.5"
    assert one(spark, num_to_text(F.lit(123456789.0))) == "123456789"
    assert one(spark, num_to_text(F.lit(7))) == "7"
    assert one(spark, num_to_text(F.lit(None).cast("double"))) is None
    assert one(spark, num_to_text(F.lit(0.0005))) == "0.0005"            # no exponent
    assert one(spark, num_to_text(F.lit(9007199254740993).cast("bigint"))) == "9007199254740993"  # no digit lost


def test_to_double_never_raises(spark):
    assert one(spark, to_double(F.lit("abc"))) is None
    assert one(spark, to_double(F.lit("4.5"))) == 4.5


def test_round_numeric_half_away_from_zero(spark):
    assert one(spark, round_numeric(F.lit(2.675), 2)) == 2.68  # binary 2.67499.. absorbed by decimal(38,9)
    assert one(spark, round_numeric(F.lit(-1.005), 2)) == -1.01


def test_json_and_join_items(spark):
    assert one(spark, json_to_array(F.lit('["a",null,"b"]'))) == ["a", None, "b"]
    assert one(spark, json_to_array(F.lit("not json"))) is None
    assert one(spark, join_items(json_to_array(F.lit('["a",null,"b"]')))) == "a, b"
    assert one(spark, join_items(json_to_array(F.lit("[null]")))) is None
    assert one(spark, join_items(json_to_array(F.lit("[]")))) is None


def test_labels_and_codes(spark):
    assert one(spark, display_label(F.lit("Ann"), F.lit("EMP1"))) == "Ann (EMP1)"
    assert one(spark, display_label(F.lit(None).cast("string"), F.lit("EMP1"))) is None
    assert one(spark, label_to_id(F.lit("Ann (B) (EMP1)"))) == "EMP1"
    assert one(spark, code_prefix(F.lit("STO_LIE"))) == "STO"
    assert one(spark, norm(F.lit("  abc "))) == "ABC"
    assert one(spark, map_value(F.lit("b"), {"a": "1", "b": "2"})) == "2"
    assert one(spark, map_value(F.lit("z"), {"a": "1"})) is None


def test_array_member_and_overlap(spark):
    from traitmatch.functions import array_member, array_overlap_count, first_item
    targets = F.array(F.lit("ACHIEVER"), F.lit("FOCUS"), F.lit(None).cast("string"))
    assert one(spark, array_member(F.lit(" focus "), targets)) is True
    assert one(spark, array_member(F.lit("zeal"), targets)) is False
    assert one(spark, array_member(F.lit(None).cast("string"), targets)) is False
    items = F.array(F.lit(" achiever"), F.lit("Focus"), F.lit("FOCUS "), F.lit("Focus"), F.lit(None).cast("string"))
    assert one(spark, array_overlap_count(items, targets)) == 3
    assert one(spark, array_overlap_count(F.lit(None).cast("array<string>"), targets)) == 0
    arr = F.array(F.struct(F.lit("x").alias("value"), F.lit(3).alias("count")))
    assert one(spark, first_item(arr, "value")) == "x"
    assert one(spark, first_item(F.array().cast("array<string>"))) is None
