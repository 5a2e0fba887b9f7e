"""Where tables that a job needs for itself are put."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_dir(spark: SparkSession) -> str:
    """A new folder in the shared one of the session. A local one only where the master is local: executors of a cluster do not share it."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="tapeloom-") + "/files"


def written(rows: DataFrame, path: str | None = None) -> DataFrame:
    """Rows computed once, as a table that outlives executors."""
    where = path or new_dir(rows.sparkSession)
    rows.write.parquet(where)
    return rows.sparkSession.read.schema(rows.schema).parquet(where)
