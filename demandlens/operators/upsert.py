"""Keyed upsert without history (SCD type 1)."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.sources.parts import Parts, bucket, values


def scd1_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    attributes: list[str],
    at: datetime | None = None,
) -> DataFrame:
    """The full next state of ``target`` after taking over ``source``.

    Both sides hold one row per key. A new key is inserted, a key with a
    differing attribute gets all attributes of ``source`` and a new
    ``updated_date``, every other row stays as it is. ``created_date`` never
    moves. One full outer join on the key; nothing is written in place.
    """
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    old, new = target.alias("old"), source.alias("new")
    in_old, in_new = F.col(f"old.{key}").isNotNull(), F.col(f"new.{key}").isNotNull()
    same = reduce(and_, [F.col(f"old.{a}").eqNullSafe(F.col(f"new.{a}")) for a in attributes])
    return old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer").select(
        F.coalesce(f"old.{key}", f"new.{key}").alias(key),
        *[F.when(in_new, F.col(f"new.{a}")).otherwise(F.col(f"old.{a}")).alias(a) for a in attributes],
        F.when(in_old, F.col("old.created_date")).otherwise(stamp).alias("created_date"),
        F.when(in_old & (~in_new | same), F.col("old.updated_date")).otherwise(stamp).alias("updated_date"),
    )


def first_load(source: DataFrame, key: str, attributes: list[str], at: datetime | None = None) -> DataFrame:
    """State of the table when there is no earlier one."""
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return source.select(
        key, *attributes, stamp.alias("created_date"), stamp.alias("updated_date")
    )


def upsert_parts(
    table: Parts, source: DataFrame, key: str, attributes: list[str], buckets: int, at: datetime | None = None, batch: int = 0,
) -> DataFrame:
    """Take over ``source`` into a table kept by buckets of ``key``; only buckets with incoming keys are read and replaced.

    A key's bucket is a function of the key, so no key of another bucket can match.
    """
    incoming = source.withColumn(table.by, bucket(key, buckets))
    if not table.exists():
        first = first_load(incoming, key, [*attributes, table.by], at)
        return table.replace(first, batch=batch)
    touched = values(incoming, table.by)
    merged = scd1_upsert(table.read(touched).drop(table.by), source, key, attributes, at)
    return table.replace(merged.withColumn(table.by, bucket(key, buckets)), touched, batch)
