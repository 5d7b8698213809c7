"""Dimension tables, one row per key, newest attributes win."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens import rules
from demandlens.functions.keys import (
    company_domain, company_id, company_name, location_id, surrogate_key, with_audit,
)
from demandlens.functions.text import slug_to_name
from demandlens.operators.latest import latest_by_key

COMPANY_ATTRIBUTES = ["name", "domain", "industry", "employee_count", "country", "source_system"]
VERSION_ORDER = ("discovered_at", "_raw_ingested_at", "_row_hash")


def version_order():
    """Newest version first; the fingerprint makes the choice repeatable."""
    return [F.col(c).desc() for c in VERSION_ORDER]


def _newest(rows: DataFrame, key: str) -> DataFrame:
    return latest_by_key(rows, [key], version_order()).drop(*VERSION_ORDER)


def companies(latest: DataFrame) -> DataFrame:
    """Current attributes per company: the source side of the upsert."""
    rows = latest.where(F.col("co_name").isNotNull() | F.col("company").isNotNull()).select(
        company_id().alias("company_id"),
        company_name().alias("name"),
        company_domain().alias("domain"),
        F.col("co_industry").alias("industry"),
        F.col("co_employee_count").cast("long").alias("employee_count"),
        F.coalesce("co_country", "country").alias("country"),
        F.lit(rules.SOURCE_SYSTEM).alias("source_system"),
        *VERSION_ORDER,
    )
    return _newest(rows, "company_id")


def locations(latest: DataFrame, codes: dict[str, str] = rules.CONTINENT_CODES) -> DataFrame:
    rows = latest.where(F.col("location").isNotNull()).select(
        location_id().alias("location_id"),
        F.coalesce("loc_display_name", "location").alias("name"),
        F.col("loc_admin1_name").alias("state"),
        F.coalesce("loc_admin1_code", "state_code").alias("state_code"),
        F.coalesce("loc_country_name", "country").alias("country_name"),
        "country_code",
        rules.continent_code(F.col("loc_continent"), codes).alias("continent_code"),
        F.col("loc_continent").alias("continent_name"),
        "latitude", "longitude",
        F.lit(rules.SOURCE_SYSTEM).alias("source_system"),
        *VERSION_ORDER,
    )
    return _newest(rows, "location_id")


def roles(spark: SparkSession, taxonomy: rules.Roles = rules.Roles(), at: datetime | None = None) -> DataFrame:
    """Seeded dimension: a handful of constant rows."""
    seed = spark.range(1).select(F.explode(F.array(*map(F.lit, taxonomy.names))).alias("name"))
    return with_audit(seed.select(surrogate_key("name").alias("role_id"), "name"), at)


def skill_uses(latest: DataFrame) -> DataFrame:
    """(slug, category): the tags of the postings as they stand, slugs lowercased."""
    def tagged(column: str, category: str) -> Column:
        named = F.transform(column, lambda slug: F.struct(slug.alias("slug"), F.lit(category).alias("category")))
        return F.coalesce(named, F.array().cast("array<struct<slug:string,category:string>>"))

    both = F.concat(tagged("technology_slugs", rules.TECHNOLOGY), tagged("keyword_slugs", rules.METHODOLOGY))
    tags = latest.select(*[c for c in ("sign",) if c in latest.columns], F.inline(both)).where(F.col("slug").isNotNull())
    return tags.withColumn("slug", F.lower("slug"))


def skills(latest: DataFrame, at: datetime | None = None) -> DataFrame:
    """One row per lowercased slug; a slug in both lists is a technology."""
    return skills_of_uses(skill_uses(latest), at)


def skills_of_uses(uses: DataFrame, at: datetime | None = None) -> DataFrame:
    """The dimension of the (slug, category) rows; ``max`` prefers a technology, as the two category names sort that way."""
    slugs = uses.groupBy("slug").agg(F.max("category").alias("category"))
    dim = slugs.select(
        surrogate_key("slug").alias("skill_id"),
        slug_to_name("slug").alias("name"),
        F.lit(None).cast("string").alias("description"),
        "category",
    )
    audited = with_audit(dim, at)
    return audited.select(
        *dim.columns, "created_date", F.col("created_date").alias("updated_date"), "source_system"
    )


def certifications(staging: DataFrame, at: datetime | None = None) -> DataFrame:
    """One row per case-insensitive name: its most frequent spelling and provider.

    Counted per spelling first, so the second step only sees distinct spellings.
    """
    return certifications_of_uses(staging.groupBy("cert_name", "cert_provider").agg(F.count("*").alias("n")), at)


def certifications_of_uses(spellings: DataFrame, at: datetime | None = None) -> DataFrame:
    """The dimension of the (cert_name, cert_provider, n) rows."""
    dim = (
        spellings.groupBy(surrogate_key(F.lower("cert_name")).alias("cert_id"))
        .agg(F.min(F.struct(-F.col("n"), "cert_name", "cert_provider")).alias("best"))
        .select("cert_id", F.col("best.cert_name").alias("name"), F.col("best.cert_provider").alias("provider"))
    )
    return with_audit(dim, at)
