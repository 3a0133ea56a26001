"""Session defaults and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for local runs and tests; a cluster's own settings win because we
# only fill in values that are not already configured.
_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "traitmatch", driver_memory: str | None = None) -> SparkSession:
    """Return the active session or build one with conservative defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    if driver_memory:
        # only effective when this call launches the JVM (local mode)
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_settings(input_bytes: int, executors_cores: int = 8,
                   partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a given input volume.

    Scans split files into ``partition_bytes`` pieces; the first shuffle gets
    about one partition per ``partition_bytes`` of input (never fewer than
    the available cores), which AQE then coalesces toward the same advisory
    size and splits further where a key is skewed.  For 100 TB and 256 MiB
    that is ~400k partitions -- use a larger ``partition_bytes`` (e.g. 1 GiB)
    when executors have the memory, to keep task counts manageable.
    """
    shuffle = max(executors_cores, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes * 4),
    }


def apply_unset(spark: SparkSession, settings: dict[str, str]) -> dict[str, str]:
    """Apply only the SQL settings the session does not already have."""
    applied = {}
    for key, value in settings.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
            applied[key] = value
    return applied


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
# Input bytes behind one shuffle partition.  An order line becomes up to three wide rows of a shuffle, so a
# partition of ``TASK_BYTES`` (compressed) is reached first.
INPUT_BYTES_PER_PARTITION = 4 << 20
TASK_BYTES = 16 << 20


def folder_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of files or folders (0 where there is none), by Spark's file system."""
    total = 0
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        total += fs.getContentSummary(at).getLength() if fs.exists(at) else 0
    return int(total)


def fit_partitions(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Let the number of tasks of scans and shuffles grow with the input, so that what one task holds does not.

    A fixed number of shuffle partitions makes each task's sort or hash table grow
    with the tables until it spills.  Adaptive execution starts from a number in proportion to the
    input and joins small partitions again.  Values the session was given are kept; an input that
    ``spark.sql.shuffle.partitions`` suffices for changes nothing.  :func:`unfit_partitions` takes the settings back.
    """
    wanted = -(-int(input_bytes) // INPUT_BYTES_PER_PARTITION)
    own = spark.__dict__.setdefault("_traitmatch_fitted", {})
    if wanted <= max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(own.get(INITIAL_PARTITIONS, 0))):
        return dict(own)
    if INITIAL_PARTITIONS in own:
        spark.conf.unset(INITIAL_PARTITIONS)
    own.update(apply_unset(spark, {INITIAL_PARTITIONS: str(wanted), ADVISORY_BYTES: str(TASK_BYTES),
                                   SPLIT_BYTES: str(TASK_BYTES)}))
    return dict(own)


def unfit_partitions(spark: SparkSession) -> None:
    for key in spark.__dict__.pop("_traitmatch_fitted", {}):
        spark.conf.unset(key)


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions for a shuffle that is given a number: the session's, or more where the input asks for it."""
    plain = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(plain, int(spark.__dict__.get("_traitmatch_fitted", {}).get(INITIAL_PARTITIONS, 0)))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is left as
    is.  Only a local session without one (tests, a laptop) gets a private folder;
    a session with executors elsewhere must name a folder they all share.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="traitmatch-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    # getCheckpointDir() appends a per-application uuid folder; keep using it
    # so concurrent applications never collide.
    return f"{root}/traitmatch/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder by Spark's file system; a missing one is no error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what :func:`scratch_path` named for this application (its frames can no longer be read)."""
    delete_path(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/traitmatch")


def _is_local(master: str) -> bool:
    """Whether all tasks run in the driver's process (``local``, ``local[4]``), not ``local-cluster``."""
    return master == "local" or master.startswith("local[")


def input_listing(spark: SparkSession, folder: str) -> tuple[tuple[str, int, int], ...]:
    """Name, length and modification time of the files directly in a folder, by Spark's file system."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))
