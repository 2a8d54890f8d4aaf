"""Session helpers: one place for the settings every job here relies on."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: adaptive execution re-plans joins and
# shuffle partition counts from runtime sizes, splits skewed join partitions,
# and keeps Arrow on for the few pandas-backed operators.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


LOCAL_DRIVER_MEMORY = "16g"


def get_session(master: str | None = None, app_name: str = "statflow",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster, leave ``master`` unset so spark-submit decides, and size
    ``shuffle_partitions`` to the data (about 128-256 MB per partition).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Local mode runs every task in the driver JVM; 1g (Spark's
            # default) is too small for the model fits. Only applies when this
            # call starts the JVM.
            builder = builder.config("spark.driver.memory", LOCAL_DRIVER_MEMORY)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def partition_settings(input_bytes: int, target_bytes: int = 256 << 20,
                       cores: int = 8) -> dict[str, str]:
    """Shuffle and scan sizing for a job reading ``input_bytes``.

    Aims at ``target_bytes`` per task (128-256 MB fits executor memory with
    room for sort and aggregation buffers). Shuffle partitions are the initial
    upper bound; adaptive execution coalesces small ones and splits skewed
    join partitions at runtime. For 100 TB: about 400k shuffle partitions.
    """
    parts = max(cores, -(-input_bytes // target_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(target_bytes, 128 << 20)),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed.

    The folder must be shared storage on a cluster, so it is read from the
    session (``spark.checkpoint.dir``). Only a local-mode session (tests) gets
    a private temporary folder when nothing is configured.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's own setting applies
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "(HDFS/S3/GCS) so checkpoints survive executor loss")
        configured = tempfile.mkdtemp(prefix="statflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


# Fixed value: Spark's setting by which a query's shuffle files go when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# The size in bytes above which the JVM never compiles a method, and Spark's
# setting of the size above which a stage is generated operator by operator, in small methods.
METHOD_LIMIT, METHOD_SETTING = "8000", "spark.sql.codegen.hugeMethodLimit"


@contextlib.contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_released(spark: SparkSession):
    """Within it, a query's shuffle files go when the query ends; else they stay until the
    driver happens to collect its garbage. For queries whose rows are written, checkpointed or
    collected, and not shuffled again from the same plan."""
    return _set(spark, SHUFFLE_CLEANUP, "true")


def small_methods(spark: SparkSession):
    """Within it, queries of many expressions run as compiled code: one generated method for
    all of a stage would be too long for the JVM to compile."""
    return _set(spark, METHOD_SETTING, METHOD_LIMIT)


def stored(df: DataFrame) -> DataFrame:
    """``df`` from a new table in the checkpoint folder: the plan is cut and the rows are fixed,
    as by a checkpoint. A checkpoint runs its last stage twice (once to count, once to write)
    and writes plain serialized rows; this runs once and writes compressed columns. The
    shuffles that made the rows are gone when it returns."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(folder: str):
    """``(file system, path)`` of a folder under the checkpoint folder."""
    from pyarrow import fs
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[len("file:"):].lstrip("/")
    return (fs.LocalFileSystem(), folder) if folder.startswith("/") else fs.FileSystem.from_uri(folder)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing will read again."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            if folder.rsplit("/", 1)[1].startswith("table-"):
                system, root = file_system(folder)
                system.delete_dir(root)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
