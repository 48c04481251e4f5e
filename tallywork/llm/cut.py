"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallywork.session import shared_folder


def cut(df: DataFrame) -> DataFrame:
    """``df`` checkpointed: computed once, read again from files that outlive executors.

    The folder is the session's ``spark.checkpoint.dir``; where that is unset, as in some
    tests, a local session gets one of its own. Spark removes the files with the frame
    where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
