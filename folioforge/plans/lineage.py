"""Cutting lineage in a folder that all executors share."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written to the session's ``spark.checkpoint.dir``; one process (tests) may do without, a cluster not."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(shared or os.path.join(tempfile.gettempdir(), "folioforge-checkpoints"))
    return df.checkpoint(eager=True)
