"""Exact distinct counts that add up: bitmaps over numbered keys.

A distinct count of a day says nothing about that of a week. Bitmaps do: the state holds, per combination of dimensions
and block of numbers, which keys occur; states of any rows are merged by OR, then counted. Keys get whole numbers once
and keep them, consecutive ones where they belong together (``near``, such as the day), so that a block's bitmap is dense.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Groups that the keys of one ``near`` value are dealt to, or all keys without ``near``; each is numbered by one task.
DEAL, DEAL_ALL = 64, 4096


def number_keys(keys: DataFrame, key: str, known: DataFrame | None = None, near: Column | None = None) -> DataFrame:
    """(key, number) of every distinct key that is not NULL, those of ``known`` first.

    Keys of ``known`` keep their numbers, new ones follow from the largest on, by ``near`` (the smallest, if a key has
    several). Only the sizes of the groups, one row per value of ``near`` and deal, go through one task.
    """
    new = keys.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.lit(0) if near is None else near).alias("_near"))
    start = F.lit(0).cast("long")
    if known is not None:
        new = new.join(known.select(key), key, "left_anti")
        start = F.coalesce(known.agg((F.max("number") + 1).alias("next")).scalar(), start)
    new = new.withColumn("_deal", F.pmod(F.xxhash64(key), F.lit(DEAL_ALL if near is None else DEAL)).cast("int"))
    sizes = new.groupBy("_near", "_deal").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_near", "_deal")) - F.col("_n")
    offsets = sizes.select(F.col("_near").alias("_near_of"), F.col("_deal").alias("_deal_of"), before.alias("_before"))
    same = F.col("_near").eqNullSafe(F.col("_near_of")) & (F.col("_deal") == F.col("_deal_of"))
    place = F.row_number().over(Window.partitionBy("_near", "_deal").orderBy(key)) - 1
    numbered = new.withColumn("_place", place).join(offsets, same).select(
        key, (start + F.col("_before") + F.col("_place")).cast("long").alias("number"))
    return numbered if known is None else known.select(key, "number").unionByName(numbered)


def distinct_state(rows: DataFrame, dimensions: list[str], number: str = "number") -> DataFrame:
    """(dimensions, block, bits): which numbers occur; NULL numbers leave their combination with no bit."""
    block = F.bitmap_bucket_number(number).alias("block")
    return rows.groupBy(*dimensions, block).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def merged_state(state: DataFrame, dimensions: list[str]) -> DataFrame:
    """The state by fewer dimensions, or of several states that were put together."""
    return state.groupBy(*dimensions, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_of_state(state: DataFrame, dimensions: list[str], name: str) -> DataFrame:
    """Exact number of distinct keys per combination of ``dimensions``, any of those that the state has."""
    return merged_state(state, dimensions).groupBy(*dimensions).agg(F.sum(F.bitmap_count("bits")).alias(name))
