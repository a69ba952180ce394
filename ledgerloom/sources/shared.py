"""The shared folder of a cluster: where lineage is cut and streams keep their state."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir.

    Where it names none, the context's own; on a single machine (as in tests) a temporary one; on a cluster that is an error.
    """
    own = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="shared-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(own)
    return own


def cut(df: DataFrame) -> DataFrame:
    """df written once to the shared folder, so that what follows starts there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
