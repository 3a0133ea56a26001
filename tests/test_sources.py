import os
import tempfile

import pytest
from pyspark.sql import functions as F

from traitmatch.operators import checks
from traitmatch.sources import files
from traitmatch.sources.dims import DIMENSIONS, dimension_frames
from conftest import rows


def test_dimension_constants_are_local_relations(spark):
    dims = dimension_frames(spark)
    assert set(dims) == set(DIMENSIONS)
    pillars = dims["dim_competency_pillars"]
    assert ("LIE", "Lead, Inspire & Empower") in rows(pillars)
    plan = pillars._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan


def test_land_discover_load_audit(spark):
    root = tempfile.mkdtemp(prefix="tm-land-")
    dims = dimension_frames(spark)
    for name in ("dim_areas", "dim_competency_pillars"):
        files.land_raw(dims[name], root, "2000-01-02", name)
    found = files.discover_tables(spark, root)
    assert rows(found, "table_name") == [("dim_areas",), ("dim_competency_pillars",)]
    back = files.read_csv(spark, [r.uri for r in found.collect() if r.table_name == "dim_competency_pillars"])
    assert rows(back) == rows(dims["dim_competency_pillars"])  # quoted comma survives
    assert dict(zip(back.columns, [t for _, t in back.dtypes])) == {"pillar_code": "string", "pillar_label": "string"}
    audit = files.load_audit({"dim_areas": dims["dim_areas"], "dim_grades": dims["dim_grades"]})
    assert rows(audit) == [("dim_areas", 4), ("dim_grades", 3)]


def test_discover_missing_and_empty(spark):
    with pytest.raises(FileNotFoundError):
        files.discover_tables(spark, "/nonexistent/folder/for/tests")
    empty = tempfile.mkdtemp(prefix="tm-empty-")
    open(os.path.join(empty, "notes.txt"), "w").write("x")
    assert files.discover_tables(spark, empty).count() == 0


def test_load_overwrite_replaces(spark):
    target = os.path.join(tempfile.mkdtemp(prefix="tm-tbl-"), "t")
    files.load_table(spark.range(10).toDF("id"), target)
    out = files.load_table(spark.range(3).toDF("id"), target)
    assert out.count() == 3


def test_example_models_and_checks(spark):
    src = spark.createDataFrame([(1,), (1,), (2,), (None,)], "rating int")
    first = checks.example_model(src, "rating", name="tm_example_test")
    assert rows(checks.filtered_model(spark, "tm_example_test")) == [(1,), (1,)]
    assert rows(checks.check_unique(first, "id")) == [(1, 2)]
    assert checks.check_not_null(first, "id").count() == 2


def test_constants_escape(spark):
    df = files.constants(spark, [("it's", 1.5, None), ("a\\b", 2.0, True)], "s string, x double, b boolean")
    assert set(rows(df)) == {("a\\b", 2.0, True), ("it's", 1.5, None)}


def test_register_sources_from_landing_folder(spark):
    root = tempfile.mkdtemp(prefix="tm-reg-")
    dims = dimension_frames(spark)
    files.land_raw(dims["dim_grades"], root, "2000-01-03", "dim_grades")
    names = files.register_sources(spark, root, {"dim_grades": "grade_id int, name string"})
    assert names == ["dim_grades"]
    assert rows(spark.sql("SELECT grade_id, name FROM dim_grades WHERE grade_id >= 2")) == [(2, "IV"), (3, "V")]


def test_newest_landed_day_wins(spark):
    root = tempfile.mkdtemp(prefix="tm-days-")
    grades = dimension_frames(spark)["dim_grades"]
    files.land_raw(grades, root, "2000-01-03", "dim_grades")
    files.land_raw(grades.where("grade_id = 1"), root, "2000-01-04", "dim_grades")
    files.land_raw(grades.where("grade_id < 3"), root, "2000-01-02", "other")
    schemas = {"dim_grades": "grade_id int, name string", "other": "grade_id int, name string"}
    files.register_sources(spark, root, schemas)
    assert rows(spark.sql("SELECT grade_id FROM dim_grades")) == [(1,)]      # not the union of both days
    files.register_sources(spark, root, schemas, run_date="2000-01-03")
    assert rows(spark.sql("SELECT grade_id FROM dim_grades")) == [(1,), (2,), (3,)]
    target = tempfile.mkdtemp(prefix="tm-all-")
    assert rows(files.load_all(spark, root, target, schemas), "table_name", "num_rows") == [("dim_grades", 1), ("other", 2)]
    assert files.loaded_rows(spark, f"{target}/other").count() == 2
    assert files.load_all(spark, tempfile.mkdtemp(prefix="tm-none-"), target).count() == 0


def test_checkpoint_folder_and_scratch(spark):
    from traitmatch import session

    assert session._is_local("local[4]") and not session._is_local("local-cluster[3,2,1000]")
    assert not session._is_local("spark://host:7077")
    path = session.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    listed = session.input_listing(spark, path)
    assert any(name.endswith(".parquet") for name, _, _ in listed)
