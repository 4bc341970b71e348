"""Where intermediate results are kept: the shared folder named by the cluster."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset in a local session (tests), a
    temporary one is set; on a cluster that raises, since its machines would not share it."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} names no folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="playpulse-"))
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
    return current.get()


@contextmanager
def once(spark: SparkSession) -> Iterator[None]:
    """DataFrames that are made within are run once: Spark deletes their shuffle files then.

    Elsewhere these files stay until the driver happens to collect its garbage, which many
    short jobs do not make it do. Where the session has the setting, it is left as it is.
    """
    held = spark.conf.get(FILE_CLEANUP, None)
    if held is None:
        spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        if held is None:
            spark.conf.unset(FILE_CLEANUP)


def cut(df: DataFrame) -> DataFrame:
    """The rows of df, kept in the shared folder: computed once, safe from lost executors.

    Mostly ids, hashes and counts pass through here, and texts only of candidates (near
    duplicates that share a bucket, suspects of contamination). Spark deletes the files with
    the DataFrame when spark.cleaner.referenceTracking.cleanCheckpoints is on, and those of
    shuffles as soon as the rows are kept.
    """
    shared_folder(df.sparkSession)
    with once(df.sparkSession):
        return df.select("*").checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for an operator's output files."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove an operator's own intermediate folder, in whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Make a session ready for the operators that run Python.

    Sends this package to the Python workers, once per application (as --py-files would),
    and bounds the bytes of an Arrow batch where the session does not.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, "8m")  # long texts: a batch is bounded by bytes, not rows
    context = spark.sparkContext
    if getattr(context, "_playpulse_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="playpulse-")) / "playpulse_package.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for source in sorted((root / "playpulse").rglob("*.py")):
            target.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    context._playpulse_shipped = True
