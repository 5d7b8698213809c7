"""Incremental ingest of landing files into the bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, DataType, StringType, StructField, StructType

from demandlens.operators.paths import LOST
from demandlens.rules import SOURCE_SYSTEM
from demandlens.schema import BRONZE, RECORD, Spec
from demandlens.sources.landing import BAD_RECORD, EVERY_FILE, UNCONVERTED, flatten, readable_schema, with_key, without_key

REJECTED = "rejected"


def stream_ingest(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    record: StructType = RECORD,
    spec: Spec | None = None,
    source: str = SOURCE_SYSTEM,
    max_bytes_per_batch: int = 1 << 40,
) -> StreamingQuery:
    """Append everything new under ``landing`` to ``bronze``, then stop.

    Good rows and rejects go through one pass and one file sink, told apart by a
    partition column, so both are written exactly once per input file. A large
    backlog is drained in micro-batches of at most ``max_bytes_per_batch``. Files are read
    whatever their age and also in sub-folders.
    Returns the finished query.
    """
    raw = (
        spark.readStream.schema(readable_schema(record))
        .options(**EVERY_FILE)
        .option("columnNameOfCorruptRecord", BAD_RECORD)
        .option("maxBytesPerTrigger", max_bytes_per_batch)
        .json(landing)
    )
    rows = flatten(raw, spec, source).withColumn(REJECTED, F.col("job_id").isNull())
    query = (
        rows.writeStream.format("parquet")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .partitionBy(REJECTED)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _stored(spark: SparkSession, bronze: str, schema: StructType) -> DataFrame:
    lost = StructField(UNCONVERTED, DataType.fromDDL(LOST))
    extra = [StructField(BAD_RECORD, StringType()), lost, StructField(REJECTED, BooleanType())]
    return spark.read.schema(StructType([*schema.fields, *extra])).parquet(bronze)


def read_bronze(spark: SparkSession, bronze: str, schema: StructType = BRONZE) -> DataFrame:
    """Accepted rows. Columns that older files lack are NULL: the declared schema
    stands in for a merge of all file footers."""
    accepted = with_key(_stored(spark, bronze, schema).where(~F.col(REJECTED)))
    return accepted.select(*schema.fieldNames())


def read_lost(spark: SparkSession, bronze: str, schema: StructType = BRONZE) -> DataFrame:
    """``job_id``, ``_unconverted`` and ``_bad_record`` of accepted rows that lost a value."""
    accepted = _stored(spark, bronze, schema).where(~F.col(REJECTED))
    lost = accepted.where((F.size(UNCONVERTED) > 0) | F.col(BAD_RECORD).isNotNull())
    return lost.select("job_id", UNCONVERTED, BAD_RECORD)


def read_rejects(spark: SparkSession, bronze: str, schema: StructType = BRONZE) -> DataFrame:
    """Rejected rows with what did not convert, and the raw line where Spark could not read it."""
    return without_key(_stored(spark, bronze, schema).where(F.col(REJECTED))).drop(REJECTED)
