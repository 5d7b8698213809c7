"""Counting over tag arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_tags(*arrays: Column) -> Column:
    """Sorted distinct non-NULL elements of all arrays; empty rather than NULL."""
    filled = [F.coalesce(a, F.array().cast("array<string>")) for a in arrays]
    return F.sort_array(F.array_distinct(F.array_compact(F.concat(*filled))))


def tag_counts(rows: DataFrame, keys: list[str], tags: str, name: str, *aggregates: Column) -> DataFrame:
    """Aggregate per ``(keys, tag)`` and, in the same pass, per ``keys`` alone.

    Each row is unfolded into its tags plus one marker with a NULL tag, so the
    line with ``is_total`` covers every row once, tagged or not. ``is_total`` is
    an aggregate on purpose: a filter on it stays above the shuffle, and totals
    and tag lines are then read from the same exchange instead of two scans.

    A tag counts once per row, so with one row per record plain counts are
    distinct counts and no DISTINCT aggregate is needed.
    """
    marker = F.array(F.lit(None).cast("string"))
    present = F.coalesce(F.array_distinct(F.array_compact(tags)), F.array().cast("array<string>"))
    unfolded = rows.withColumn(name, F.explode(F.concat(marker, present))).drop(tags)
    return unfolded.groupBy(*keys, name).agg(
        F.max(F.col(name).isNull()).alias("is_total"), *aggregates
    )
