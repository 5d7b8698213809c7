"""Table sinks and the sources that read them back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def overwrite(df: DataFrame, path: str, partition_by: str | None = None, touched_only: bool = False) -> None:
    """Replace the table at ``path``, schema included.

    With ``partition_by`` the rows are rebalanced on that column first: a
    partition value gets few, well-sized files, and one that holds a large share
    of the rows is split over several tasks. ``touched_only`` replaces just the
    partition values that occur in ``df``.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
        return
    mode = "dynamic" if touched_only else "static"
    (
        df.hint("rebalance", partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(partition_by)
        .parquet(path)
    )


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Replace a catalog table, bucketed so that joins on ``key`` need no exchange."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Scan a table; a declared ``schema`` gives NULL for columns older files lack."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def _glob(spark: SparkSession, pattern: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath() for status in found or []]


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has committed."""
    return bool(_glob(spark, f"{path}/_SUCCESS"))


@dataclass(frozen=True)
class Snapshots:
    """A table kept as complete states ``<base>/v=<n>``; readers take the newest.

    A new state is computed from the old one, so it must not overwrite the files
    being read. A state counts once its job has committed (``_SUCCESS``), which
    makes a failed or repeated run harmless.
    """

    spark: SparkSession
    base: str

    def _versions(self) -> list[int]:
        marks = _glob(self.spark, f"{self.base}/v=*/_SUCCESS")
        return sorted(int(m.getParent().getName()[2:]) for m in marks)

    def current(self) -> DataFrame | None:
        versions = self._versions()
        return self.spark.read.parquet(f"{self.base}/v={versions[-1]}") if versions else None

    def publish(self, df: DataFrame) -> DataFrame:
        version = max(self._versions(), default=0) + 1
        df.write.mode("overwrite").parquet(f"{self.base}/v={version}")
        return self.spark.read.parquet(f"{self.base}/v={version}")
