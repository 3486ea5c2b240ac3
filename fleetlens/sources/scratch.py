"""The shared folder for tables that must outlive a task or an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local session that names none.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="fleetlens-")
    return f"{root.rstrip('/')}/fleetlens-{uuid.uuid4().hex}"
