"""CSV landing and loading.

Only file listings and table names touch the driver; rows stay on executors.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from traitmatch.session import delete_path, scratch_path
from traitmatch.sources import typed, versions

DAY = "ingest_date"
REJECTED = "_rejected"

_TABLE_FROM_PATH = r"/([^/]+)\.csv(/[^/]*)?$"
_URI_FROM_PATH = r"^(.*?/[^/]+\.csv)(/[^/]+)?$"


def read_csv(spark: SparkSession, path: str | Sequence[str],
             schema: StructType | str | None = None) -> DataFrame:
    """Read CSV with a header row.

    With ``schema`` the read is a single pass; without it the types are
    inferred (an extra pass over the files, fine for dimension-sized inputs).
    Quoted fields may contain the separator.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def discover_tables(spark: SparkSession, folder: str) -> DataFrame:
    """List ``*.csv`` below ``folder`` -> ``(table_name, uri)``.

    The table name is the file name without ``.csv``; a folder named
    ``<table>.csv`` holding part files (how Spark writes CSV) counts as one
    table.  A missing folder raises ``FileNotFoundError``; a folder without CSV
    files gives an empty frame.  File contents are never read.
    """
    try:
        files = (spark.read.format("binaryFile")
                 .option("pathGlobFilter", "*.csv")
                 .option("recursiveFileLookup", "true")
                 .load(folder)
                 .select("path"))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(folder) from exc
        raise
    return (files
            .select(F.regexp_extract("path", _TABLE_FROM_PATH, 1).alias("table_name"),
                    F.regexp_extract("path", _URI_FROM_PATH, 1).alias("uri"))
            .where(F.col("table_name") != "")
            .distinct())


def landing_uri(root: str, run_date: _dt.date | str, name: str) -> str:
    day = run_date if isinstance(run_date, str) else run_date.strftime("%Y-%m-%d")
    return f"{root.rstrip('/')}/landing_zone/manual/{day}/{name}.csv"


def land_raw(df: DataFrame, root: str, run_date: _dt.date | str, name: str) -> str:
    """S3: write a raw table under ``landing_zone/manual/<yyyy-mm-dd>/<name>.csv``.

    Re-running the same day replaces that day's folder only, so a retried
    task is idempotent.
    """
    uri = landing_uri(root, run_date, name)
    df.write.mode("overwrite").option("header", True).csv(uri)
    return uri


def land_day(df: DataFrame, root: str, run_date: _dt.date | str, name: str) -> str:
    """S3: land a day as one partition of the table ``landing_zone/by_day/<name>``.

    Dynamic partition overwrite replaces the day's rows and leaves all other days alone, so a
    retried day is harmless; a day without rows ends up without a partition.  The rows are
    counted while they are written.
    """
    day = run_date if isinstance(run_date, str) else run_date.strftime("%Y-%m-%d")
    path = f"{root.rstrip('/')}/landing_zone/by_day/{name}"
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("n")).withColumn(DAY, F.to_date(F.lit(day)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path))
    if not seen.get["n"]:
        delete_path(df.sparkSession, f"{path}/{DAY}={day}")
    return path


def landed_between(spark: SparkSession, path: str, first: _dt.date | str | None = None,
                   last: _dt.date | str | None = None) -> DataFrame:
    """S3: the rows of the days ``first`` to ``last`` (inclusive; open without one), with ``ingest_date``.

    The days are partitions: folders outside the range are not listed, let alone read.
    """
    rows = spark.read.parquet(path)
    for bound, keep in ((first, F.col(DAY).__ge__), (last, F.col(DAY).__le__)):
        if bound is not None:
            rows = rows.where(keep(F.to_date(F.lit(str(bound)))))
    return rows


def load_table(df: DataFrame, target: str, **stated) -> DataFrame:
    """Replace a table completely (``WRITE_TRUNCATE``) in one step, and return it.

    ``target`` is a path (``/``, ``file:``, ``s3a:`` ...), read with :func:`read_table`, or a catalog
    name.  The new rows are written as a version of their own and published at the end: a load
    that dies leaves the old table, and readers never meet a half-written one
    (:mod:`traitmatch.sources.versions`).  ``stated`` is stored with the version.
    """
    spark = df.sparkSession
    if "/" in target or ":" in target:
        return versions.replace(df, target, **stated)
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{target}.versions"
    at = versions.publish(spark, path, versions.stage(df, path), schema=df.schema, **stated)
    place = versions.version_path(path, at["version"])
    new = spark.read.parquet(place)
    if spark.catalog.tableExists(target):
        if spark.table(target).schema == new.schema:
            spark.sql(f"ALTER TABLE {target} SET LOCATION '{place}'")
            spark.catalog.refreshTable(target)
            return spark.table(target)
        spark.sql(f"DROP TABLE {target}")              # an external table: only its name goes
    spark.catalog.createTable(target, path=place, source="parquet")
    return spark.table(target)


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """The published rows of a table that :func:`load_table` wrote to a path."""
    return versions.read_version(spark, target)


def load_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, num_rows)`` for each loaded table.

    Each count is a partial aggregate; the union runs as one job.
    """
    parts = [df.groupBy().agg(F.count(F.lit(1)).alias("num_rows"))
             .select(F.lit(name).alias("table_name"), "num_rows")
             for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_DAY_FROM_URI = r"/manual/([0-9]{4}-[0-9]{2}-[0-9]{2})/"


def landed_tables(spark: SparkSession, folder: str, run_date: _dt.date | str | None = None) -> DataFrame:
    """``(table_name, day, uri)`` of one landed day per table.

    The day is ``run_date``, or each table's newest one.  Files outside a dated
    folder have a NULL day and count as older than any dated file.
    """
    found = discover_tables(spark, folder).withColumn(
        "day", F.nullif(F.regexp_extract("uri", _DAY_FROM_URI, 1), F.lit("")))
    if run_date is not None:
        day = run_date if isinstance(run_date, str) else run_date.strftime("%Y-%m-%d")
        return found.where(F.col("day") == day).select("table_name", "day", "uri")
    newest = found.groupBy("table_name").agg(F.max("day").alias("_newest"))
    return (found.join(newest, "table_name").where(F.col("day").eqNullSafe(F.col("_newest")))
            .select("table_name", "day", "uri"))


def _landed_uris(spark: SparkSession, folder: str, run_date: _dt.date | str | None) -> dict[str, list[str]]:
    # one row per table: only names and paths pass through the driver
    listing = (landed_tables(spark, folder, run_date).groupBy("table_name")
               .agg(F.sort_array(F.collect_set("uri")).alias("uris")).collect())
    return {r.table_name: list(r.uris) for r in listing}


def load_checked(rows: DataFrame, target: str, name: str, key: str) -> dict:
    """Load a split of typed rows and rejects (:mod:`traitmatch.sources.typed`) and audit it.

    One scan and one write: accepted and rejected lines go to two partitions of the same
    version, published together, and the counts (loaded rows, loaded rows without ``key``, rejected
    lines) are observed on the way.  They are stored with the version and returned.
    """
    seen, fits = Observation(), F.size("reasons") == 0
    counted = rows.observe(seen, F.count_if(fits).alias("num_rows"),
                           F.count_if(fits & F.col(key).isNull()).alias("null_keys"), F.count_if(~fits).alias("rejected_rows"))
    flagged = counted.withColumn("line", F.when(~fits, F.col("line"))).withColumn(REJECTED, F.when(fits, 0).otherwise(1))
    version = versions.stage(flagged, target, partition_by=REJECTED)
    audit = {"table_name": name, **{k: int(v) for k, v in seen.get.items()}}
    versions.publish(rows.sparkSession, target, version, schema=flagged.schema, audit=audit)
    return audit


def loaded_rows(spark: SparkSession, target: str) -> DataFrame:
    """The accepted rows of a table loaded by :func:`load_checked`."""
    return read_table(spark, target).where(F.col(REJECTED) == 0).drop("reasons", "line", REJECTED)


def loaded_rejects(spark: SparkSession, target: str) -> DataFrame:
    """``line, reason`` of the lines that its last load rejected."""
    return typed.rejected(read_table(spark, target).where(F.col(REJECTED) == 1))


def load_all(spark: SparkSession, folder: str, target_root: str,
             schemas: Mapping[str, StructType | str] | None = None, run_date: _dt.date | str | None = None,
             keys: Mapping[str, str] | None = None) -> DataFrame:
    """S1-S5 in one call: load one landed day of every table found, replacing the
    table under ``target_root``, and audit each load.

    Returns ``(table_name, num_rows, null_keys, rejected_rows)`` as observed while the rows were written.
    ``keys`` names a table's key column (default: its first).  Types come from ``schemas`` or are detected;
    lines that do not fit are kept apart with their reasons (:func:`loaded_rejects`).  A folder
    without tables loads nothing and gives an empty audit.
    """
    audits = []
    for name, uris in sorted(_landed_uris(spark, folder, run_date).items()):
        schema = (schemas or {}).get(name)
        kinds = None if schema is None else {
            f.name: f.dataType.simpleString() for f in (StructType.fromDDL(schema) if isinstance(schema, str) else schema)}
        rows = typed.read_typed(spark, uris, kinds)
        audits.append(load_checked(rows, f"{target_root.rstrip('/')}/{name}", name, (keys or {}).get(name, rows.columns[0])))
    fields = "table_name string, num_rows bigint, null_keys bigint, rejected_rows bigint"
    return constants(spark, [tuple(a[f.split()[0]] for f in fields.split(", ")) for a in audits], fields)


def register_sources(spark: SparkSession, tables: Mapping[str, DataFrame] | str,
                     schemas: Mapping[str, StructType | str] | None = None,
                     run_date: _dt.date | str | None = None) -> list[str]:
    """Name each source table so SQL models can refer to it.

    ``tables`` is a mapping of frames, or a landing folder: then every table
    found in it is read as CSV from one landed day (``run_date``, or the table's
    newest day), with its declared schema from ``schemas`` when given.
    """
    if isinstance(tables, str):
        tables = {name: read_csv(spark, uris, (schemas or {}).get(name))
                  for name, uris in _landed_uris(spark, tables, run_date).items()}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def materialize(df: DataFrame, name: str, as_: str = "view", path: str | None = None,
                bucket_by: str | None = None, buckets: int | None = None) -> DataFrame:
    """Persist a model as a view or a written table; later models read it by name.

    ``as_="table"`` writes Parquet to ``path`` (default: a fresh folder under
    the shared checkpoint folder) and cuts the lineage.  With ``bucket_by``
    the table is bucketed so later joins and aggregations on that key need no
    shuffle.
    """
    spark = df.sparkSession
    if as_ == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if as_ != "table":
        raise ValueError(f"as_ must be 'view' or 'table', not {as_!r}")
    location = path or scratch_path(spark, name)
    if bucket_by:
        (df.write.mode("overwrite").format("parquet").option("path", location)
         .bucketBy(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), bucket_by)
         .sortBy(bucket_by).saveAsTable(name))
        return spark.table(name)
    df.write.mode("overwrite").parquet(location)
    out = spark.read.parquet(location)
    out.createOrReplaceTempView(name)
    return out


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def constants(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal table (``SELECT ... UNION ALL ...`` / ``UNNEST([STRUCT ...])``).

    Built as an inline ``VALUES`` table, so the plan holds a ``LocalRelation``
    whose exact size the optimizer knows (it is broadcast, never shuffled).
    ``schema`` is a DDL string such as ``"tv_name string, weight double"``.
    """
    fields = [f.strip().split(None, 1) for f in schema.split(",")]
    names = [f[0] for f in fields]
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in fields)
    if not rows:
        return spark.sql(f"SELECT {casts} FROM (SELECT {', '.join('NULL AS ' + n for n in names)}) WHERE FALSE")
    body = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({', '.join(names)})")
