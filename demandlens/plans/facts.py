"""Latest postings, the fact tables and the many-to-many bridges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens import rules
from demandlens.functions.keys import company_id, location_id, surrogate_key, with_audit
from demandlens.functions.text import role_name
from demandlens.operators.latest import latest_by_key
from demandlens.operators.tags import distinct_tags
from demandlens.plans.dims import version_order
from demandlens.schema import TEXT_ID


def latest_postings(bronze: DataFrame) -> DataFrame:
    """One row per posting: a re-posted id keeps its newest version."""
    return latest_by_key(bronze, ["job_id"], version_order())


def fact_postings(
    latest: DataFrame, taxonomy: rules.Roles = rules.Roles(), at: datetime | None = None,
) -> DataFrame:
    """Grain: one row per posting. A projection of ``latest``, no shuffle of its own; a reference to the text stays."""
    fact = latest.select(
        "job_id",
        surrogate_key(role_name(taxonomy)).alias("role_id"),
        company_id().alias("company_id"),
        location_id().alias("location_id"),
        "job_title", "normalized_title",
        F.col("description").alias("job_description"),
        "url", "seniority", "date_posted", "date_reposted", "closed_at",
        F.col("closed_at").isNull().alias("is_open"),
        "remote", "hybrid",
        F.col("min_annual_salary_usd").alias("min_salary_usd"),
        F.col("max_annual_salary_usd").alias("max_salary_usd"),
        F.col("avg_annual_salary_usd").alias("avg_salary_usd"),
        "salary_currency",
        F.lit(rules.CREATED_BY).alias("created_by"),
        F.to_date("discovered_at").alias("_batch_date"),
        *[c for c in (TEXT_ID,) if c in latest.columns],
    )
    return with_audit(fact, at)


def fact_postings_slim(latest: DataFrame, taxonomy: rules.Roles = rules.Roles()) -> DataFrame:
    """The narrow variant of the fact, a table of its own."""
    return latest.select(
        "job_id",
        F.col("job_title").alias("title"),
        "url",
        company_id().alias("company_id"),
        location_id().alias("location_id"),
        surrogate_key(role_name(taxonomy)).alias("role_id"),
        F.col("date_posted").alias("posted_at"),
        F.col("remote").alias("is_remote"),
        F.to_date("_bronze_processed_at").alias("_batch_date"),
        F.col("_raw_ingested_at").alias("_ingested_at"),
    )


def bridge_job_skills(latest: DataFrame, at: datetime | None = None) -> DataFrame:
    """Distinct (posting, skill) pairs.

    ``latest`` has one row per posting, so duplicates can only sit inside a row
    and are removed there instead of by a shuffle over all pairs.
    """
    slugs = F.concat(*[
        F.coalesce(c, F.array().cast("array<string>")) for c in ("technology_slugs", "keyword_slugs")
    ])
    pairs = latest.select("job_id", F.explode(distinct_tags(F.transform(slugs, F.lower))).alias("slug"))
    return with_audit(pairs.select("job_id", surrogate_key("slug").alias("skill_id")), at)


def bridge_job_certifications(staging: DataFrame, at: datetime | None = None) -> DataFrame:
    """Distinct (posting, certification) pairs; spellings of one name merge here."""
    pairs = staging.select("job_id", surrogate_key(F.lower("cert_name")).alias("cert_id"))
    return with_audit(pairs.dropDuplicates(), at)


def bridge_job_locations(latest: DataFrame, at: datetime | None = None) -> DataFrame:
    pairs = latest.where(F.col("location").isNotNull()).select("job_id", location_id().alias("location_id"))
    return with_audit(pairs, at)
