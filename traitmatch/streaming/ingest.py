"""Daily landing-zone load as an ``availableNow`` file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from traitmatch.session import ensure_checkpoint_dir
from traitmatch.sources import versions

_DAY = r"/manual/([0-9]{4}-[0-9]{2}-[0-9]{2})/"


def landed_stream(spark: SparkSession, landing_root: str, table: str, schema: StructType | str) -> DataFrame:
    """Streaming read of every landed CSV file of ``table``
    (``landing_zone/manual/<yyyy-mm-dd>/<table>.csv``), with its run date."""
    path = f"{landing_root.rstrip('/')}/landing_zone/manual/*/{table}.csv"
    src = (spark.readStream.schema(schema).option("header", True)
           .option("quote", '"').option("escape", '"').csv(path))
    day = F.regexp_extract(F.col("_metadata.file_path"), _DAY, 1)
    return src.select("*", day.alias("ingest_date"))


def _replace_with_latest(target: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # WRITE_TRUNCATE: the table becomes the newest day's rows in this batch,
        # unless it already holds a newer day.  The batch is read twice (newest
        # date, then the rows), so cache it.  Rows and day become true in one published pointer.
        spark = batch.sparkSession
        held = versions.current(spark, target) or {}
        cached = batch.persist()
        try:
            latest = cached.select(F.max("ingest_date")).first()[0]
            if latest is None or latest < held.get("day", ""):
                return
            rows = cached.where(F.col("ingest_date") == F.lit(latest)).drop("ingest_date")
            versions.replace(rows, target, day=latest)
        finally:
            cached.unpersist()
    return write


def load_landed(spark: SparkSession, landing_root: str, table: str, schema: StructType | str,
                target: str, checkpoint: str | None = None) -> dict:
    """Load the files landed since the last run into ``target`` and stop.

    Each micro-batch replaces ``target`` with the rows of the newest run date
    it contains (a full reload, as in the daily job), unless the table already
    holds a newer day: a day that arrives late never takes the table back.  The table is read with
    :func:`traitmatch.sources.files.read_table`.  A
    batch that is retried rewrites the same rows, so a retry is harmless.  The stream
    checkpoint defaults to a folder under the shared ``spark.checkpoint.dir``.
    Returns the last progress report (``numInputRows`` etc.).
    """
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/traitmatch-streams/{table}"
    query = (landed_stream(spark, landing_root, table, schema).writeStream
             .foreachBatch(_replace_with_latest(target))
             .option("checkpointLocation", ckpt)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    progress = query.lastProgress or {}
    return {"batch_id": progress.get("batchId"), "num_input_rows": progress.get("numInputRows", 0)}
