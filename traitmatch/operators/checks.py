"""Data tests and the two chained example models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitmatch.sources.files import constants, materialize


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Failing rows of a uniqueness test -- values occurring more than
    once (NULLs excluded) with their count.  Empty frame = test passes."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Failing rows of a not-null test."""
    return df.where(F.col(col).isNull())


def example_model(source: DataFrame, col: str, name: str = "example_model", as_: str = "table") -> DataFrame:
    """D39 (first model): an ``id`` column from ``source`` plus one NULL row,
    materialised so the next model reads it by name."""
    ids = source.select(F.col(col).cast("int").alias("id"))
    null_row = constants(source.sparkSession, [(None,)], "id int")
    return materialize(ids.unionByName(null_row), name, as_=as_)


def filtered_model(spark_df_or_name, name: str = "example_model") -> DataFrame:
    """D39 (second model): ``SELECT * FROM <first model> WHERE id = 1``."""
    if isinstance(spark_df_or_name, DataFrame):
        first = spark_df_or_name
    else:
        first = spark_df_or_name.table(name)
    return first.where(F.col("id") == 1)
