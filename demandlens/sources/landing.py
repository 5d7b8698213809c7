"""JSON-lines landing files: schema inference, flattening, incremental scans."""

from __future__ import annotations

import json
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from demandlens.operators.paths import lost_values, project
from demandlens.rules import SOURCE_SYSTEM
from demandlens.schema import RECORD, Spec, as_text, flatten_spec

BAD_RECORD = "_bad_record"
#: Values of an accepted row that did not convert, with their column.
UNCONVERTED = "_unconverted"
#: Files are read whatever their age and however deep their folder.
EVERY_FILE = {"recursiveFileLookup": "true", "maxFileAge": "36500d"}


def infer_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> StructType:
    return spark.read.option("samplingRatio", sampling_ratio).json(path).schema


def save_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    spark.range(1).select(F.lit(schema.json()).alias("value")).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> StructType:
    return StructType.fromJson(json.loads(spark.read.text(path, wholetext=True).first()["value"]))


def readable_schema(record: StructType = RECORD) -> StructType:
    """``record`` with text leaves, plus the column that receives unreadable input.

    A value of another JSON type than declared (``"77"``, ``12.0``, ``"true"``) is kept as
    its text and converted by ``flatten``.
    """
    return StructType([*as_text(record).fields, StructField(BAD_RECORD, StringType())])


def read_json(spark: SparkSession, path: str, record: StructType = RECORD) -> DataFrame:
    """Landing files as one batch; unreadable lines land in ``_bad_record``."""
    reader = spark.read.schema(readable_schema(record)).option("recursiveFileLookup", "true")
    return reader.option("columnNameOfCorruptRecord", BAD_RECORD).json(path)


def flatten(raw: DataFrame, spec: Spec | None = None, source: str = SOURCE_SYSTEM) -> DataFrame:
    """Nested records to bronze rows: the spec's columns, audit columns, fingerprint.

    Works on batch and streaming frames alike. ``_bad_record`` is kept if present, and
    with it what did not convert.
    """
    spec = flatten_spec() if spec is None else spec
    now = F.current_timestamp()
    keep_bad = BAD_RECORD in raw.columns
    full = [*spec, (BAD_RECORD, BAD_RECORD, StringType())] if keep_bad else spec
    names = [name for name, _, _ in spec]
    lost = [lost_values(raw.schema, spec).alias(UNCONVERTED)] if keep_bad else []
    return project(raw, full, *lost).withColumns({
        "_raw_ingested_at": now,
        "_bronze_processed_at": now,
        "_source": F.lit(source),
        "_row_hash": F.xxhash64(*names),
    })


def with_key(bronze: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows that can be stored: the key is known."""
    return bronze.where(F.col(key).isNotNull())


def without_key(bronze: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows for quarantine."""
    return bronze.where(F.col(key).isNull())


def discovered_after(df: DataFrame, since: date | None, column: str = "discovered_at") -> DataFrame:
    """Rows whose day is strictly after ``since``.

    Written as a bound on the raw column, so that the scan can skip files and
    row groups; a bound on ``to_date(column)`` would be evaluated per row.
    """
    if since is None:
        return df
    first = F.lit(since + timedelta(days=1))
    return df.where(F.col(column) >= first.cast(df.schema[column].dataType))
