"""Rows that joins and windows would otherwise lose without a word."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a dimension row and the number of facts behind each.

    Facts are counted per key before the anti join, so a key that very many
    facts share crosses the shuffle as one row per task.
    """
    used = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("facts"))
    return used.join(dim.select(key), key, "left_anti")


def undated(lines: DataFrame) -> DataFrame:
    """Number of postings that no window and no daily mart can show."""
    return lines.agg(F.count_if(F.col("posting_date").isNull()).alias("undated_postings"))


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that stand in more than one row, and in how many."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
