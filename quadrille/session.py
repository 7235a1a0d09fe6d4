"""Session settings the jobs are written for."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", *, memory: str = "8g", partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and local work; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("quadrille")
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for name, value in (settings | extra).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession, *packages: str) -> None:
    """Sends this package (and further source folders) to the Python workers, once per application.

    Not needed when the job was submitted with ``--py-files``.
    """
    context = spark.sparkContext
    root = Path(__file__).resolve().parent
    for folder in (root, *(Path(p).resolve() for p in packages)):
        mark = f"{context.applicationId}:{folder}"
        if mark in _shipped:
            continue
        base = Path(tempfile.mkdtemp(prefix="quadrille-")) / folder.name
        archive = shutil.make_archive(str(base), "zip", root_dir=folder.parent, base_dir=folder.name)
        context.addPyFile(archive)
        _shipped.add(mark)
