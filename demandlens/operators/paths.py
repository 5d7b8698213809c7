"""Projection of nested records by dotted paths.

Paths are checked against the schema while the plan is built, because a column
expression over a missing field only fails at analysis. A numeric segment is an
array position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, IntegralType, StringType, StructType

from demandlens.schema import Spec

LOST = "array<struct<name:string,value:string>>"


def path_type(schema: DataType, path: str) -> DataType | None:
    """Type at the end of ``path``, or None where the schema has no such path."""
    for step in path.split("."):
        if isinstance(schema, ArrayType) and step.isdigit():
            schema = schema.elementType
        elif isinstance(schema, StructType) and step in schema.fieldNames():
            schema = schema[step].dataType
        else:
            return None
    return schema


def path_value(path: str) -> Column:
    """Value at ``path`` as it is; the schema must have the path."""
    head, *steps = path.split(".")
    value = F.col(head)
    for step in steps:
        value = F.get(value, int(step)) if step.isdigit() else value.getField(step)
    return value


def converted(value: Column, kind: DataType, to: DataType) -> Column:
    """``value`` as type ``to``, NULL where it does not convert.

    Text like ``12.0`` is a whole number too: it goes by way of a decimal.
    """
    plain = value.try_cast(to)
    if isinstance(to, IntegralType) and isinstance(kind, StringType):
        return F.coalesce(plain, value.try_cast(DecimalType(38, 9)).try_cast(to))
    return plain


def path_column(schema: StructType, path: str, to: DataType) -> Column:
    """Value at ``path`` as type ``to``.

    NULL for a path the schema lacks, a position past the end of an array, and a
    value that does not convert.
    """
    kind = path_type(schema, path)
    return F.lit(None).cast(to) if kind is None else converted(path_value(path), kind, to)


def lost_values(schema: StructType, spec: Spec) -> Column:
    """``(name, value)`` of every entry of ``spec`` whose text does not convert."""
    found = [
        F.when(path_value(path).isNotNull() & path_column(schema, path, to).isNull(),
               F.struct(F.lit(name).alias("name"), path_value(path).alias("value")))
        for name, path, to in spec
        if isinstance(path_type(schema, path), StringType) and not isinstance(to, StringType)
    ]
    return F.array_compact(F.array(*found)) if found else F.array().cast(LOST)


def project(df: DataFrame, spec: Spec, *more: Column) -> DataFrame:
    """One flat select: every entry of ``spec``, renamed and typed, and further columns."""
    schema = df.schema
    return df.select(*[path_column(schema, path, to).alias(name) for name, path, to in spec], *more)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``; those ``df`` lacks are typed NULLs.

    Written as SQL text: one call to the JVM instead of several per column.
    """
    present = set(df.columns)
    return df.selectExpr(*[
        f"try_cast({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in schema.fields
    ])
