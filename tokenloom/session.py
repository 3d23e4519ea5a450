"""Session helpers: the shared folder and a local session for tests and the benchmark."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application (as ``--py-files`` would)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    if package.is_dir() and (package / "__init__.py").is_file():
        # built on the driver and handed out by Spark itself
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='tokenloom-')}/tokenloom", "zip", package.parent, package.name)
        context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    own = tempfile.mkdtemp(prefix="tokenloom-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def local_session(cores: int | str = 8, memory: str = "8g", partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tokenloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .getOrCreate()
    )
