"""Where intermediate results are kept, and how lineage is cut.

Everything that must outlive an executor goes to the folder the cluster names in ``spark.checkpoint.dir``.
A machine-local folder is used only by local sessions in which that setting is missing.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def durable_root(spark: SparkSession) -> str:
    """The checkpoint folder of the session, set up on first use."""
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if root:
        return root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="quadrille-")
    context.setCheckpointDir(root)
    return context.getCheckpointDir()


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage; partitions and the order of rows inside them stay as written."""
    durable_root(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the durable root."""
    return f"{durable_root(spark)}/{label}-{uuid.uuid4().hex}"
