"""Session building, table loading and the shared scratch folder."""

from __future__ import annotations

import os
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "fascicle", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here assumes.

    On a cluster the submit command sets the master, memory and shuffle sizing; only
    settings that are safe anywhere are put here. Adaptive execution does the rest:
    it merges small shuffle partitions, splits skewed ones and switches a join to
    broadcast only after the measured size of a side is known.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Give this package to the Python workers, once per application.

    Functions that run in tasks are sent by name, so the executors must be able to import the
    package wherever the driver was started from. A job submitted with the package in
    ``--py-files`` has it already; sending it again does no harm.
    """
    context = spark.sparkContext
    if not getattr(context, "_fascicle_shipped", False):
        package = pathlib.Path(__file__).parent
        archive = pathlib.Path(tempfile.mkdtemp(prefix="fascicle-code-"), "fascicle.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._fascicle_shipped = True
    return spark


# Rows and bytes that Spark hands to Python at once.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small enough for tables of long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def load(spark: SparkSession, folder: str, *names: str) -> DataFrame | tuple[DataFrame, ...]:
    """Read ``<folder>/<name>.parquet`` for every name; one frame for one name."""
    ship_package(spark)
    frames = tuple(spark.read.parquet(f"{folder}/{name}.parquet") for name in names)
    return frames[0] if len(frames) == 1 else frames


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder is lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    current = context.getCheckpointDir()
    if current is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="fascicle-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a full URI: a path without scheme is on the cluster's default file system."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(location).toString()


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: fixes the rows on shared storage and cuts the lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def small_side(df: DataFrame) -> DataFrame:
    """A join side that is expected to be small, stored and read back.

    The stored table's size is known before the join is planned, so Spark itself decides whether
    the side is sent to every executor (``spark.sql.autoBroadcastJoinThreshold``). Adaptive
    execution would find out too, but not before the large side has been shuffled.
    """
    path = scratch_path(df.sparkSession, "side")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_in_folders(df: DataFrame, path: str, *columns: str) -> None:
    """Write ``df`` with a folder for each value of ``columns``; its schema beside it, as a table without rows has no file."""
    df.write.partitionBy(*columns).parquet(f"{path}/data")
    df.sparkSession.createDataFrame([], df.schema).write.parquet(f"{path}/schema")


def read_folders(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_in_folders`` wrote; a filter on the folders' columns leaves other folders unread."""
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/data")
