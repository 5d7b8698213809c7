"""Daily and snapshot marts, built from posting lines."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.functions.keys import mart_key, with_business_date
from demandlens.operators.medians import median_state, summary_of_state
from demandlens.operators.tags import tag_counts

DAY_KEYS = ["posting_date", "industry"]


def _daily(lines: DataFrame, tags: str, name: str) -> DataFrame:
    """Postings per (day, industry, tag) next to all postings per (day, industry).

    One scan and one shuffle of pre-aggregated groups; postings without a date
    have no day to count for and drop out.
    """
    dated = lines.where(F.col("posting_date").isNotNull()).select(*DAY_KEYS, tags)
    counts = tag_counts(dated, DAY_KEYS, tags, name, F.count("*").alias("postings"))
    totals = counts.where("is_total").select(*DAY_KEYS, F.col("postings").alias("total_posting_count"))
    appear = counts.where("NOT is_total").select(
        *DAY_KEYS, name, F.col("postings").alias("posting_appear_count")
    )
    return appear.join(totals, DAY_KEYS)


def daily_totals(lines: DataFrame) -> DataFrame:
    """All postings per (day, industry), days without any tag included."""
    dated = lines.where(F.col("posting_date").isNotNull())
    return dated.groupBy(*DAY_KEYS).agg(F.count("*").alias("total_posting_count"))


def _mart(daily: DataFrame, key: str, name: str, extra: Column, as_of: date | None) -> DataFrame:
    keyed = daily.withColumn(key, mart_key(*DAY_KEYS, name))
    return with_business_date(keyed, as_of).select(
        key, "business_date", name, extra, "industry", "posting_date",
        "posting_appear_count", "total_posting_count", "source_system",
    )


def skill_daily(lines: DataFrame, skills: DataFrame, as_of: date | None = None) -> DataFrame:
    """Grain: (posting_date, industry, skill_name).

    Two slugs can share a display name, so the category is taken per name
    (technology wins) and joined after the aggregation, on far fewer rows.
    """
    category = skills.groupBy(F.col("name").alias("skill_name")).agg(F.max("category").alias("skill_category"))
    daily = _daily(lines, "skill_names", "skill_name").join(category, "skill_name")
    return _mart(daily, "skills_daily_id", "skill_name", F.col("skill_category"), as_of)


def cert_daily(lines: DataFrame, certs: DataFrame, as_of: date | None = None) -> DataFrame:
    """Grain: (posting_date, industry, cert_name)."""
    providers = certs.select(F.col("name").alias("cert_name"), F.col("provider").alias("cert_provider"))
    daily = _daily(lines, "cert_names", "cert_name").join(providers, "cert_name")
    return _mart(daily, "cert_daily_id", "cert_name", F.col("cert_provider"), as_of)


ROLE_COUNTS = ("job_postings_count", "open_roles_count")


def role_state(lines: DataFrame, keys: tuple[str, ...] = ("posting_date", "role_name")) -> DataFrame:
    """What role snapshots are made of, by day of posting; states of days add up."""
    return median_state(
        lines, list(keys), "avg_salary_usd",
        counts={"job_postings_count": F.count("*"), "open_roles_count": F.count_if("is_open")},
        lowest={"min_salary": "min_salary_usd"}, highest={"max_salary": "max_salary_usd"},
    )


def role_daily(lines: DataFrame, as_of: date | None = None, state: DataFrame | None = None) -> DataFrame:
    """Snapshot per role over all lines given; lines are one row per posting,
    so plain counts are distinct counts. With the stored ``state`` of the lines' days the lines are read for the
    middle value buckets only."""
    snapshot = summary_of_state(
        role_state(lines, ("role_name",)) if state is None else state, lines, ["role_name"], "avg_salary_usd", "median_salary",
        ROLE_COUNTS, ["min_salary"], ["max_salary"],
    )
    stamped = with_business_date(snapshot, as_of)
    return stamped.select(
        mart_key("business_date", "role_name").alias("role_daily_id"), "business_date", "role_name",
        "job_postings_count", "open_roles_count", "min_salary", "max_salary", "median_salary",
        "source_system",
    )
