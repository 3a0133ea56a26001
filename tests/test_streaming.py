import os
import tempfile

from traitmatch.sources import files
from traitmatch.sources.dims import dimension_frames
from traitmatch.streaming import load_landed
from conftest import rows


def test_available_now_loads_new_days_and_replaces(spark):
    root = tempfile.mkdtemp(prefix="tm-stream-")
    target = os.path.join(root, "tables", "dim_grades")
    ckpt = os.path.join(root, "ckpt")
    grades = dimension_frames(spark)["dim_grades"]
    files.land_raw(grades, root, "2000-01-01", "dim_grades")
    first = load_landed(spark, root, "dim_grades", "grade_id int, name string", target, ckpt)
    assert first["num_input_rows"] == 3
    assert rows(files.read_table(spark, target)) == [(1, "III"), (2, "IV"), (3, "V")]

    # next day: a changed file lands; the rerun loads only it and replaces the table
    files.land_raw(grades.where("grade_id < 3"), root, "2000-01-02", "dim_grades")
    second = load_landed(spark, root, "dim_grades", "grade_id int, name string", target, ckpt)
    assert second["num_input_rows"] == 2
    assert rows(files.read_table(spark, target)) == [(1, "III"), (2, "IV")]

    # nothing new: the table stays as it is
    load_landed(spark, root, "dim_grades", "grade_id int, name string", target, ckpt)
    assert rows(files.read_table(spark, target)) == [(1, "III"), (2, "IV")]

    # a day that lands late is older than the loaded one: the table does not go back
    files.land_raw(grades, root, "1999-12-31", "dim_grades")
    load_landed(spark, root, "dim_grades", "grade_id int, name string", target, ckpt)
    assert rows(files.read_table(spark, target)) == [(1, "III"), (2, "IV")]
