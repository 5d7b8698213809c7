"""Helpers shared by the operators: exact column choice and Arrow batches of whole texts.

Every operator reads its columns by exact name through ``pick``, so further columns
of the table, whatever their names, neither clash nor travel.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one call of a task's function gets, beyond a single longer text.
SLICE_BYTES = 8 << 20


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only; of columns with one name the first, whatever the case of the others."""
    places = [next((i for i, c in enumerate(df.columns) if c == n), None) for n in names]
    if None in places:
        raise ValueError(f"no column {names[places.index(None)]!r} in {df.columns}")
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))).select(
        *(F.col(f"c{i}").alias(n) for i, n in zip(places, names, strict=True))
    )


def slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with at most ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield batch.slice(start)


def map_texts(
    df: DataFrame, keep: list[str], text: str, result: str,
    make: Callable[[], Callable[..., list]], limit: int = SLICE_BYTES, with_kept: bool = False,
) -> DataFrame:
    """``keep`` and the columns of ``result`` (DDL), one row for each row of ``df``.

    ``make()`` runs once in each task and returns the function from the UTF-8 texts
    of a slice to the lists or arrays of the result's columns; ``with_kept`` gives it the
    kept columns too.
    """
    rows = pick(df, *keep, text)
    extra = T.StructType.fromDDL(result)
    clash = {n.lower() for n in keep} & {n.lower() for n in extra.names}
    if clash:
        raise ValueError(f"kept columns clash with results: {sorted(clash)}")
    names = [f"k{i}" for i in range(len(keep))]
    rows = rows.toDF(*names, "text").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*(T.StructField(n, f.dataType) for n, f in zip(keep, rows.schema.fields, strict=False)), *extra])
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for part in slices(batch, at, limit):
                texts = part.column(at).cast(pa.large_binary()).to_pylist()
                made = function(texts, part.columns[:at]) if with_kept else function(texts)
                arrays = [*(part.column(i) for i in range(at)), *(
                    x if isinstance(x, pa.Array) else pa.array(x, type=to_arrow(f.dataType))
                    for x, f in zip(made, extra.fields, strict=True)
                )]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(run, schema)


def map_slices(
    df: DataFrame, columns: list[str], result: str,
    make: Callable[[], Callable[..., Iterator[list]]], limit: int = SLICE_BYTES,
) -> DataFrame:
    """Rows of the columns in ``result`` (DDL), any number for each slice of ``df``.

    ``make()`` runs once in each task and returns the function from the UTF-8 texts of the last
    of ``columns`` and the Arrow arrays of the others to lists of arrays or lists, one each column.
    """
    schema = T.StructType.fromDDL(result)
    kinds = [to_arrow(f.dataType) for f in schema]
    rows = pick(df, *columns).toDF(*(f"c{i}" for i in range(len(columns))))
    last = f"c{len(columns) - 1}"
    rows = rows.withColumn(last, F.col(last).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for part in slices(batch, len(columns) - 1, limit):
                texts = part.column(len(columns) - 1).cast(pa.large_binary()).to_pylist()
                for made in function(texts, *part.columns[:-1]):
                    arrays = [x.cast(k) if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(made, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(run, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share; unset, a temporary one on a single machine only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no folder, and a folder of one machine is none that executors share")
    return tempfile.mkdtemp()


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as files in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def to_arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
