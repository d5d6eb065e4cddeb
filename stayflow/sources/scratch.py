"""Where intermediate results that must outlive an executor are written."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder path under the session's ``spark.checkpoint.dir``.

    Only a session in one process without the setting gets a temporary folder of its own; on a
    cluster, also one that starts with "local-cluster", other executors would not see it.
    """
    base = spark.conf.get(CHECKPOINT_SETTING, None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="stayflow-")
    return f"{base.rstrip('/')}/stayflow-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage, fixes the rows against
    recomputation, and gives the optimizer real sizes to choose join strategies by."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
