"""Atomic replace, dated partitions, audited loads and reject rows."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_plans import physical
from traitmatch.sources import files, typed, versions


def folder(name):
    return os.path.join(tempfile.mkdtemp(prefix="tm-load-"), name)


def test_a_load_that_dies_before_it_publishes_leaves_the_old_table(spark):
    target = folder("t")
    files.load_table(spark.range(10).toDF("id"), target, day="2000-01-01")
    versions.stage(spark.range(99).toDF("id"), target)                       # written, never published
    assert files.read_table(spark, target).count() == 10
    broken = spark.range(5).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        files.load_table(broken, target, day="2000-01-02")
    assert files.read_table(spark, target).count() == 10
    assert versions.current(spark, target)["day"] == "2000-01-01"
    assert files.load_table(spark.range(3).toDF("id"), target).count() == 3


def test_a_table_replaced_from_itself_and_a_reader_of_the_old_version(spark):
    target = folder("t")
    old = files.load_table(spark.range(10).toDF("id"), target)
    files.load_table(files.read_table(spark, target).where("id < 4"), target)
    assert files.read_table(spark, target).count() == 4
    assert old.count() == 10                                                  # its files are still there
    for n in range(3):
        files.load_table(spark.range(n).toDF("id"), target)
    kept = os.listdir(os.path.join(target, "_versions"))
    assert len(kept) == versions.KEPT_VERSIONS and files.read_table(spark, target).count() == 2
    with pytest.raises(FileNotFoundError):
        files.read_table(spark, folder("none"))


def test_two_loads_publish_one_after_the_other(spark):
    target, rows_ = folder("t"), spark.range(2).toDF("id")
    a, b = versions.stage(rows_, target), versions.stage(rows_.where("id = 0"), target)
    first = versions.publish(spark, target, b, rows_.schema)
    second = versions.publish(spark, target, a, rows_.schema)
    assert (first["number"], second["number"]) == (1, 2) and files.read_table(spark, target).count() == 2


def test_a_version_without_rows_keeps_its_columns(spark):
    target = folder("t")
    files.load_table(spark.range(0).selectExpr("id", "cast(null as string) as s"), target)
    out = files.read_table(spark, target)
    assert out.columns == ["id", "s"] and out.count() == 0


def test_catalog_tables_switch_to_the_new_version(spark):
    name = "tm_switch_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    files.load_table(spark.range(10).toDF("id"), name)
    assert files.load_table(spark.range(3).toDF("id"), name).count() == 3
    assert spark.table(name).count() == 3
    assert files.load_table(spark.range(2).selectExpr("id", "'x' as s"), name).columns == ["id", "s"]
    spark.sql(f"DROP TABLE {name}")


def test_days_are_partitions_that_are_pruned_and_replaced_alone(spark):
    root = folder("land")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    files.land_day(df, root, "2000-01-01", "t")
    path = files.land_day(df, root, "2000-01-02", "t")
    files.land_day(df.where("id = 1"), root, "2000-01-01", "t")               # one of two days again
    day = files.landed_between(spark, path, "2000-01-01", "2000-01-01")
    assert rows(day, "id", "v") == [(1, "a")]
    scan = physical(day)
    assert "PartitionFilters: [isnotnull(ingest_date" in scan and "2000-01-01" in scan
    assert rows(files.landed_between(spark, path, first="2000-01-02"), "id") == [(1,), (2,)]
    files.land_day(df.limit(0), root, "2000-01-01", "t")                      # the day has no rows any more
    assert rows(files.landed_between(spark, path), "id") == [(1,), (2,)]


def write(lines):
    path = folder("t.csv")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.csv"), "w") as out:
        out.write("\n".join(lines) + "\n")
    return path


LINES = ["id,n,x,day,s"] + [f"{i},{i},{i}.5,2000-01-0{i % 9 + 1},t{i}" for i in range(1, 60)]


def test_types_are_detected_and_bad_lines_kept_apart(spark):
    path = write([*LINES, "60,many,1.0,2000-01-01,t", "61,5", "62,6,7.5,2000-13-01,t", ",7,1.0,2000-01-01,t",
                  '63,8,1.0,2000-01-01,"a, ""b"""', "64,99999999999,1.0,2000-01-01,t", "65,,,,"])
    split = typed.read_typed(spark, path, required=["id"])
    assert dict(split.dtypes) == {"id": "int", "n": "int", "x": "double", "day": "date", "s": "string",
                                  "reasons": "array<string>", "line": "string"}
    bad = rows(typed.rejected(split), "line", "reason")
    assert bad == sorted([("60,many,1.0,2000-01-01,t", "n: not int"), ("61,5", "fields"),
                          ("62,6,7.5,2000-13-01,t", "day: not date"), (",7,1.0,2000-01-01,t", "id: missing"),
                          ("64,99999999999,1.0,2000-01-01,t", "n: not int")], key=repr)
    good = typed.fitting(split)
    assert good.count() == 59 + 2
    assert rows(good.where("id >= 63"), "id", "n", "s") == [(63, 8, 'a, "b"'), (65, None, None)]
    wide = typed.read_typed(spark, path, max_bad_share=0.0)                    # no value may miss its type
    assert dict(wide.dtypes)["n"] == "string" and dict(wide.dtypes)["x"] == "double"
    with pytest.raises(ValueError, match="nope"):
        typed.read_typed(spark, path, {"nope": "int"})


def test_audit_is_observed_while_the_rows_are_written(spark):
    target = folder("t")
    split = typed.read_typed(spark, write([*LINES, "60,many,1.0,2000-01-01,t", "61,5", ",7,1.0,2000-01-01,t"]))
    audit = files.load_checked(split, target, "t", "id")
    assert audit == {"table_name": "t", "num_rows": 60, "null_keys": 1, "rejected_rows": 2}
    loaded = files.loaded_rows(spark, target)
    assert loaded.count() == 60 and loaded.where("id is null").count() == 1
    assert rows(files.loaded_rejects(spark, target), "reason") == [("fields",), ("n: not int",)]
    assert versions.current(spark, target)["audit"] == audit
    empty = typed.read_typed(spark, write(LINES[:1]))
    assert files.load_checked(empty, target, "t", "id") == {"table_name": "t", "num_rows": 0, "null_keys": 0, "rejected_rows": 0}
    assert files.loaded_rows(spark, target).count() == 0 and files.loaded_rejects(spark, target).count() == 0


def test_load_all_reports_what_it_wrote(spark):
    root, target = folder("land"), folder("tables")
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, n int")
    files.land_raw(df, root, "2000-01-01", "t")
    out = files.load_all(spark, root, target, {"t": "k string, n int"}, keys={"t": "k"})
    assert rows(out) == [("t", 3, 1, 0)]
    strict = files.load_all(spark, root, target, {"t": "k int, n int"})
    assert rows(strict, "num_rows", "null_keys", "rejected_rows") == [(1, 1, 2)]
    assert rows(files.loaded_rejects(spark, f"{target}/t"), "line") == [("a,1",), ("c,3",)]
