"""Rows kept as files between two halves of a plan, written slice by slice.

The shuffles of a plan stay on disk until all of it is done. Where a long plan ends in narrow rows, writing these first, in
slices of a key, leaves on disk the files and what one slice shuffles.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from demandlens.sources.parts import bucket
from demandlens.sources.tables import append, read_table

#: Has Spark delete what a query shuffled as soon as the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no folder, and a folder of one machine is none that executors share")
    return folder or tempfile.mkdtemp()


def staged(df: DataFrame, key: str | None = None, slices: int = 1) -> DataFrame:
    """The rows of ``df`` out of files in the folder of spark.checkpoint.dir; written at once, and left there.

    With ``slices`` there is one job per bucket of ``key``. Each reads the inputs of ``df`` whole, so their number
    should not grow with the data. The choice of a bucket reaches every input that ``df`` joins or groups by ``key``,
    before anything is shuffled; a null key has a bucket too. Inputs with other keys are best staged themselves.
    """
    spark = df.sparkSession
    path = f"{_shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    with _shuffles_deleted(spark):
        for i in range(slices):
            append(df if slices == 1 else df.where(bucket(key, slices) == i), path)
    return read_table(spark, path, df.schema)
