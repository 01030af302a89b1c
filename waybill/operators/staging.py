"""Intermediate results that several parts of one query read."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def staged(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the session's checkpoint folder.

    Used where facts have been reduced to a table that is then read several
    times: without it Spark may scan the facts once per reader. The data are in
    reliable storage, so a lost executor costs nothing but a re-read. The folder
    is ``spark.checkpoint.dir``; only a local session without one gets its own.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="waybill-checkpoints-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def one_row(df: DataFrame) -> Column:
    """The single row of ``df`` as a struct; one subquery however many fields are used."""
    return df.select(F.struct(*df.columns)).scalar()
