"""Grouped summaries with an exact median, for few and possibly huge groups.

A median by sorted window or by a value map puts a whole group into one task,
and sketches from every task of a large job all meet in one task per group. Here
a first pass counts the rows per narrow value bucket, which hash aggregation
reduces to a bounded number of rows in every task; a second pass looks only at
the bucket that holds the middle row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_DOUBLING = 1024
#: Beyond the logarithm of the smallest positive double, so that every bucket number is positive.
LOWEST_DOUBLING = 1075


def value_bucket(value: str) -> Column:
    """A coarse number that never decreases when ``value`` grows.

    Steps are about 0.07 percent of the value at every magnitude, so doubles of any
    size fall into a bounded number of buckets. Zero has a bucket of its own.
    """
    step = F.floor(F.log2(F.abs(value)) * BUCKETS_PER_DOUBLING) + BUCKETS_PER_DOUBLING * LOWEST_DOUBLING
    return F.when(F.col(value) == 0, F.lit(0.0)).otherwise(F.signum(value) * step)


def median_state(
    rows: DataFrame,
    keys: list[str],
    value: str,
    counts: dict[str, Column] | None = None,
    lowest: dict[str, str] | None = None,
    highest: dict[str, str] | None = None,
) -> DataFrame:
    """Rows per ``keys`` and value bucket, with counts, minima and maxima: a histogram that adds up.

    Kept by day, the states of any days give the summary of all of them (``summary_of_state``);
    a day that changes is counted anew by itself.
    """
    return rows.withColumn("_bucket", value_bucket(value)).groupBy(*keys, "_bucket").agg(
        F.count(value).alias("_n"),
        *[c.alias(n) for n, c in (counts or {}).items()],
        *[F.min(c).alias(n) for n, c in (lowest or {}).items()],
        *[F.max(c).alias(n) for n, c in (highest or {}).items()],
    )


def summary_of_state(
    state: DataFrame,
    rows: DataFrame,
    keys: list[str],
    value: str,
    median: str,
    counts: list[str] = (),
    lowest: list[str] = (),
    highest: list[str] = (),
) -> DataFrame:
    """Per ``keys``: counts, minima, maxima and the exact lower median, from states that may be finer than ``keys``.

    ``rows`` are the rows that the state counts. Only those in the bucket of the middle one are looked at.
    """
    buckets = state.groupBy(*keys, "_bucket").agg(
        *[F.sum(n).alias(n) for n in ("_n", *counts)], *[F.min(n).alias(n) for n in lowest], *[F.max(n).alias(n) for n in highest],
    )
    summary = buckets.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in ("_n", *counts)], *[F.min(n).alias(n) for n in lowest], *[F.max(n).alias(n) for n in highest],
    ).drop("_n")
    running = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bucket"))
    whole = F.sum("_n").over(Window.partitionBy(*keys))
    middle = (
        buckets.select(*keys, "_bucket", "_n", running.alias("_upto"), whole.alias("_values"))
        .where((2 * F.col("_upto") >= F.col("_values")) & (2 * (F.col("_upto") - F.col("_n")) < F.col("_values")))
        .select(*keys, "_bucket", (F.col("_upto") - F.col("_n")).alias("_before"), "_values")
    )
    inside = (
        rows.where(F.col(value).isNotNull()).select(*keys, value).withColumn("_bucket", value_bucket(value))
        .join(middle, [*keys, "_bucket"])
        .groupBy(*keys, value, "_before", "_values").agg(F.count("*").alias("_n"))
    )
    position = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys).orderBy(value))
    medians = (
        inside.withColumn("_upto", position)
        .where(2 * F.col("_upto") >= F.col("_values"))
        .groupBy(*keys).agg(F.min(value).alias(median))
    )
    return summary.join(medians, keys, "left")


def summarize_with_median(
    rows: DataFrame,
    keys: list[str],
    value: str,
    median: str,
    counts: dict[str, Column] | None = None,
    lowest: dict[str, str] | None = None,
    highest: dict[str, str] | None = None,
) -> DataFrame:
    """Per ``keys``: the lower median of ``value``, counts, minima and maxima.

    The lower median is the smallest value with at least half of the non-NULL
    values at or below it; NULL for a group without values.
    """
    counts, lowest, highest = counts or {}, lowest or {}, highest or {}
    state = median_state(rows, keys, value, counts, lowest, highest)
    return summary_of_state(state, rows, keys, value, median, list(counts), list(lowest), list(highest))
