"""Tables that a plan comes back to."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def keep(df: DataFrame) -> DataFrame:
    """``df`` written to the folder of ``spark.checkpoint.dir``, its lineage cut; on one machine a temporary folder may stand in."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        configured = context.getConf().get("spark.checkpoint.dir", None)
        if not configured and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="lumivox-checkpoint-"))
    return df.checkpoint(eager=True)
