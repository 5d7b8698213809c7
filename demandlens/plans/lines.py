"""Posting lines: one denormalised row per posting, the input of marts and insight."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens import rules
from demandlens.functions.keys import company_id, location_id, with_business_date
from demandlens.functions.text import role_name, slug_to_name
from demandlens.operators.tags import distinct_tags
from demandlens.schema import TEXT_ID

COMPANY_COLUMNS = ("company", "company_domain", "industry")
LOCATION_COLUMNS = ("country",)
COLUMNS = (
    "job_id", "title", "description", "url", *COMPANY_COLUMNS, "role_name", "seniority",
    "remote", "hybrid", "is_open", "min_salary_usd", "max_salary_usd", "avg_salary_usd",
    "date_posted", "posting_date", *LOCATION_COLUMNS, "skill_names", "cert_names",
)
TEXT_COLUMNS = ("description", "cert_names")

#: Turns the ``TEXT_ID`` of rows into their ``description``.
Texts = Callable[[DataFrame], DataFrame]


def _industry() -> Column:
    return F.coalesce("c.industry", F.lit(rules.UNKNOWN_INDUSTRY))


def _company_side(companies: DataFrame) -> DataFrame:
    return companies.select("company_id", "name", "domain", "industry").alias("c")


def _location_side(locations: DataFrame) -> DataFrame:
    return locations.select("location_id", "country_name").alias("l")


def posting_lines(
    latest: DataFrame,
    companies: DataFrame | None = None,
    locations: DataFrame | None = None,
    taxonomy: rules.Roles = rules.Roles(),
    entities: Column | None = None,
    columns: tuple[str, ...] = COLUMNS,
    texts: Texts | None = None,
) -> DataFrame:
    """Lines straight from the latest postings.

    Role and tag arrays are expressions over the row: a posting already carries
    its slugs, so exploding them into a bridge, joining names and collecting them
    again (``posting_lines_from_star``) would only add shuffles. ``entities`` is
    an entity array over ``latest``, by default none.

    Only joins that ``columns`` needs are planned. Both dimensions are left to
    Spark's size-based choice between broadcast and shuffle, as they grow with
    the data; a company with very many postings is split by AQE. ``texts`` is for
    rows with a reference to their text: it is called after the joins, which carry
    the reference only, and ``entities`` are then found in what it returns.
    """
    no_tags = F.array().cast("array<string>")
    slugs = F.concat(F.coalesce("technology_slugs", no_tags), F.coalesce("keyword_slugs", no_tags))
    certs = no_tags if entities is None else F.transform(entities, lambda e: e["name"])
    expressions = {
        "title": F.col("job_title"),
        "role_name": role_name(taxonomy),
        "is_open": F.col("closed_at").isNull(),
        "min_salary_usd": F.col("min_annual_salary_usd"),
        "max_salary_usd": F.col("max_annual_salary_usd"),
        "avg_salary_usd": F.col("avg_annual_salary_usd"),
        "posting_date": F.to_date("date_posted"),
        "skill_names": distinct_tags(F.transform(slugs, slug_to_name)),
        "cert_names": distinct_tags(certs),
    }
    joined = {
        "company": F.col("c.name"), "company_domain": F.col("c.domain"), "industry": _industry(),
        "country": F.col("l.country_name"),
    }
    late = [c for c in columns if texts is not None and c in TEXT_COLUMNS]
    own = [expressions.get(c, F.col(c)).alias(c) for c in columns if c not in joined and c not in late]
    if late:
        own.append(F.col(TEXT_ID))
    needs_company = any(c in COMPANY_COLUMNS for c in columns)
    needs_location = any(c in LOCATION_COLUMNS for c in columns)
    if needs_company:
        # Without id and names a posting has no row in the dimension; NULL keeps such rows from meeting in one key.
        # The row of a posting with an id only may come from another posting, or from an earlier load.
        known = F.coalesce("co_id", "co_name", "company").isNotNull()
        own.append(F.when(known, company_id()).alias("company_id"))
    if needs_location:
        known = F.col("loc_id").isNotNull() | F.col("location").isNotNull()
        own.append(F.when(known, location_id()).alias("location_id"))
    lines = latest.select(*own)
    if needs_company:
        lines = lines.alias("p").join(_company_side(companies), "company_id", "left")
    if needs_location:
        lines = lines.join(_location_side(locations), "location_id", "left")
    early = [c for c in columns if c not in late] + [TEXT_ID] * bool(late)
    lines = lines.select(*[joined[c].alias(c) if c in joined else F.col(c) for c in early])
    if not late:
        return lines
    return texts(lines).select(*[expressions.get(c, F.col(c)).alias(c) if c in late else F.col(c) for c in columns])


def posting_lines_from_star(
    fact: DataFrame,
    roles: DataFrame,
    companies: DataFrame,
    locations: DataFrame,
    bridge_skills: DataFrame,
    skills: DataFrame,
    bridge_certs: DataFrame,
    certs: DataFrame,
    texts: Texts | None = None,
) -> DataFrame:
    """Lines from the stored star schema, for dimensions edited after the load.

    Tag names are collected per posting; that array is as long as the posting's
    own tag list. With the fact and the bridges bucketed on ``job_id`` the three
    large inputs meet without an exchange. With ``texts`` the fact has a reference
    in place of the text, which is looked up after all joins.
    """
    def names(bridge: DataFrame, dim: DataFrame, key: str, column: str) -> DataFrame:
        named = bridge.select("job_id", key).join(dim.select(key, "name"), key)
        return named.groupBy("job_id").agg(F.sort_array(F.collect_set("name")).alias(column))

    no_tags = F.array().cast("array<string>")
    role_side = F.broadcast(roles.select("role_id", F.col("name").alias("role_name")))  # a few constant rows
    lines = (
        fact.join(names(bridge_skills, skills, "skill_id", "skill_names"), "job_id", "left")
        .join(names(bridge_certs, certs, "cert_id", "cert_names"), "job_id", "left")
        .join(role_side, "role_id")
        .join(_company_side(companies), "company_id", "left")
        .join(_location_side(locations), "location_id", "left")
    )
    renamed = {
        "title": F.col("job_title"), "description": F.col("job_description"),
        "company": F.col("c.name"), "company_domain": F.col("c.domain"), "industry": _industry(),
        "posting_date": F.to_date("date_posted"), "country": F.col("l.country_name"),
        "skill_names": F.coalesce("skill_names", no_tags),
        "cert_names": F.coalesce("cert_names", no_tags),
    }
    if texts is None:
        return lines.select(*[renamed.get(c, F.col(c)).alias(c) for c in COLUMNS])
    early = [c for c in COLUMNS if c != "description"] + [TEXT_ID]
    return texts(lines.select(*[renamed.get(c, F.col(c)).alias(c) for c in early])).select(*COLUMNS)


def job_posting_lines(lines: DataFrame, as_of: date | None = None) -> DataFrame:
    """The stored form of the lines, stamped with the day of the run."""
    return with_business_date(lines, as_of)
