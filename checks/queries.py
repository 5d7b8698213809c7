"""One query per operator, over the given tables. See ``oracle.py`` for the SQL."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.functions.dates import resolve_window, window_coverage
from demandlens.functions.keys import mart_key, surrogate_key
from demandlens.functions.text import role_name, slug_to_name
from demandlens.operators import entities
from demandlens.operators.distinct import number_keys
from demandlens.operators.latest import latest_by_key
from demandlens.operators.paths import conform
from demandlens.operators.upsert import scd1_upsert, upsert_parts
from demandlens.plans import demand_index, dims, facts, insight, marts, quality, semantic
from demandlens.plans import lines as lines_plan
from demandlens.schema import BRONZE, TEXT_ID
from demandlens.sources import landing
from demandlens.sources import order_feed as feed
from demandlens.sources.parts import Parts
from demandlens.sources.staged import staged

AS_OF = date(2001, 8, 1)
EARLIER = date(2000, 8, 1)
ROLE = "role_a"
INDUSTRY = "MACHINERY"
RANGE = "2y"
#: Lines of so many postings are made in one plan; of more, in up to so many slices that are kept without their texts.
POSTINGS_A_SLICE, MOST_SLICES = 500_000, 4

Query = Callable[[SparkSession, str], DataFrame]
OWNER, TAGS, TEXT = feed.OWNER, feed.TAGS, feed.TEXT


# --- shared inputs --------------------------------------------------------------

def latest(spark: SparkSession, sf_dir: str, *groups: str) -> DataFrame:
    """Versions are chosen with references to texts; the texts of the chosen ones come last, so that they cross no shuffle."""
    referring = tuple(TEXT_ID if g == TEXT else g for g in groups)
    rows = facts.latest_postings(feed.postings(spark, sf_dir, referring))
    return feed.with_texts(rows, sf_dir) if TEXT in groups else rows


def slices(spark: SparkSession, sf_dir: str) -> int:
    """In how many slices lines of all postings with all columns are made."""
    return max(1, min(MOST_SLICES, feed.table(spark, sf_dir, "orders").count() // POSTINGS_A_SLICE))


def lines(spark: SparkSession, sf_dir: str, *columns: str, parts: int = 1) -> DataFrame:
    """Posting lines with just the column groups and joins that ``columns`` need; in ``parts`` slices up to the texts."""
    keep = staged if parts > 1 else lambda made, *_: made
    groups = [TAGS]
    by_company = any(c in lines_plan.COMPANY_COLUMNS for c in columns)
    by_location = any(c in lines_plan.LOCATION_COLUMNS for c in columns)
    if by_company or by_location:
        groups.append(OWNER)
    if any(c in lines_plan.TEXT_COLUMNS for c in columns):
        groups.append(TEXT_ID)
    rows = latest(spark, sf_dir, *groups)
    owners = latest(spark, sf_dir, OWNER)
    return lines_plan.posting_lines(
        rows,
        keep(dims.companies(owners)) if by_company else None,
        keep(dims.locations(owners, feed.CONTINENT_CODES)) if by_location else None,
        feed.ROLES,
        entities.dictionary_entities("description", feed.TERMS),
        columns,
        lambda chosen: feed.with_texts(keep(chosen, "job_id", parts), sf_dir),
    )


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest(spark, sf_dir, TEXT).select(
        "job_id", entities.dictionary_entities("description", feed.TERMS).alias("entities")
    )
    return entities.inline_entities(rows, "job_id", "entities")


def certs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.certifications(staging(spark, sf_dir))


# --- ingest and row-level operators ------------------------------------------------

def bronze_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records with an absent path, empty arrays and unreadable values."""
    company = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("industry"),
        F.col("c_nationkey").alias("employee_count"),
    )
    place = F.struct(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    no_places = F.array().cast("array<struct<id:bigint,name:string>>")
    status = F.col("o_orderstatus")
    raw = (
        feed.table(spark, sf_dir, "orders")
        .join(feed.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(feed.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.when(status == "P", "n/a").otherwise(F.col("o_orderkey").cast("string")).alias("id"),
            F.col("o_orderpriority").alias("job_title"),
            F.when(F.col("o_custkey") % 5 == 0, "soon")
            .otherwise(F.to_date("o_orderdate").cast("string")).alias("date_posted"),
            F.when(F.col("o_custkey") % 13 == 0, no_places).otherwise(F.array(place)).alias("locations"),
            company.alias("company_object"),
        )
    )
    return landing.with_key(landing.flatten(raw)).select(
        "job_id", "job_title", "date_posted", "loc_id", "loc_name", "loc_type", "co_id", "co_name",
        "co_industry", "co_employee_count", "company_domain", "technology_slugs",
    ).withColumn("technology_slugs", F.col("technology_slugs").isNull()).withColumnRenamed(
        "technology_slugs", "no_slugs"
    )


def bronze_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bronze column from JSON text, with numbers, flags and keys written as other JSON types."""
    key, text = F.col("o_orderkey"), "string"
    place = F.struct(F.col("n_nationkey").cast(text).alias("id"), F.col("n_name").alias("name"), F.col("n_name").alias("country_name"))
    company = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("industry"),
        F.col("c_nationkey").cast("double").alias("employee_count"), F.col("c_nationkey").cast(text).alias("industry_id"),
        F.when(key % 3 == 0, "old").otherwise(F.year("o_orderdate").cast(text)).alias("founded_year"),
        (key % 2 == 0).cast(text).alias("is_recruiting_agency"), F.array("c_mktsegment").alias("company_tags"),
    )
    record = F.struct(
        F.when(key % 11 == 0, "n/a").otherwise(key.cast(text)).alias("id"), F.col("o_orderpriority").alias("job_title"),
        F.to_date("o_orderdate").cast(text).alias("date_posted"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("discovered_at"),
        (key % 2 == 0).cast(text).alias("remote"), (key % 5 == 0).alias("hybrid"),
        F.col("o_totalprice").cast(text).alias("min_annual_salary_usd"), F.col("o_totalprice").alias("max_annual_salary_usd"),
        F.array("o_orderstatus", "o_orderpriority").alias("technology_slugs"),
        F.array(place).alias("locations"), company.alias("company_object"), F.lit("ignored").alias("surprise"),
    )
    lines = (
        feed.table(spark, sf_dir, "orders")
        .join(feed.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(feed.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.to_json(record).alias("line"))
    )
    raw = lines.select(F.from_json("line", landing.readable_schema()).alias("r")).select("r.*")
    rows = landing.with_key(landing.flatten(raw))
    plain = {
        f.name: F.array_join(f.name, "|") if f.dataType.typeName() == "array"
        else F.to_date(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in BRONZE.fields if not f.name.startswith("_")
    }
    return rows.select(*[c.alias(n) for n, c in plain.items()], F.size(landing.UNCONVERTED).alias("unconverted"))


def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = feed.table(spark, sf_dir, "events")
    return landing.discovered_after(events, date(2024, 1, 15), "ts").select(
        "event_id", "user_id", "event_type", "value"
    )


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ("normalized_title", "co_industry")
    return feed.postings(spark, sf_dir, (OWNER, TAGS)).select(
        "job_id", surrogate_key(*parts).alias("guarded_key"), mart_key(*parts).alias("plain_key")
    )


def slug_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    slug = F.concat_ws("_", F.regexp_replace(F.lower("p_name"), " ", "-"), F.lower("p_type"))
    slugs = feed.table(spark, sf_dir, "part").select(slug.alias("slug")).distinct()
    return slugs.select("slug", slug_to_name("slug").alias("name"))


def classify_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.postings(spark, sf_dir, (TAGS,)).select("job_id", role_name(feed.ROLES).alias("role_name"))


def latest_posting(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = feed.table(spark, sf_dir, "events")
    newest = latest_by_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return newest.select("user_id", "event_id", "event_type", "value")


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as versions of one posting, with ties in every column of the order but the last."""
    line = feed.table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("timestamp")
    month = F.date_trunc("month", day)
    bronze = conform(line.select(
        F.col("l_orderkey").alias("job_id"), month.alias("discovered_at"), month.alias("_raw_ingested_at"),
        month.alias("_bronze_processed_at"), F.col("l_returnflag").alias("job_title"),
        (F.col("l_partkey") * 1000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")).cast("long").alias("_row_hash"),
    ), BRONZE)
    newest = facts.latest_postings(bronze)
    return newest.select("job_id", F.to_date("discovered_at").alias("discovered"), F.col("_row_hash").alias("version"))


def upsert_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes that are NULL in the stored state, in the update, or in both."""
    key = F.col("c_custkey")
    then = F.lit(datetime(2001, 1, 1)).cast("timestamp")
    customer = feed.table(spark, sf_dir, "customer")
    stored = customer.where(key % 5 != 0).select(
        key.alias("company_id"), F.when(key % 2 == 0, F.col("c_mktsegment")).alias("industry"),
        then.alias("created_date"), then.alias("updated_date"),
    )
    updates = customer.where(key % 7 != 0).select(
        key.alias("company_id"), F.when(key % 3 != 0, F.col("c_mktsegment")).alias("industry"))
    merged = scd1_upsert(stored, updates, "company_id", ["industry"], datetime(2001, 8, 1))
    return merged.withColumns({c: F.to_date(c) for c in ("created_date", "updated_date")})


def _segments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers outside one segment, as stored; updates for those with a balance, of which the richer ones changed segment."""
    customer = feed.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("company_id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("industry"), "c_acctbal",
    )
    stored = customer.where(F.col("industry") != INDUSTRY).select("company_id", "name", "industry")
    moved = F.when(F.col("c_acctbal") > 5000, "MOVED").otherwise(F.col("industry"))
    return stored, customer.where("c_acctbal >= 0").select("company_id", "name", moved.alias("industry"))


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One join over the whole table."""
    stored, updates = _segments(spark, sf_dir)
    then = F.lit(datetime(2001, 1, 1)).cast("timestamp")
    stored = stored.withColumns({"created_date": then, "updated_date": then})
    merged = scd1_upsert(stored, updates, "company_id", ["name", "industry"], datetime(2001, 8, 1))
    return merged.withColumns({c: F.to_date(c) for c in ("created_date", "updated_date")})


def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by way of a table of buckets, of which only those with incoming keys are replaced."""
    stored, updates = _segments(spark, sf_dir)
    folder = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp()  # the latter on one machine only, as in tests
    table = Parts(spark, f"{folder}/companies-{uuid.uuid4().hex}", "bucket")
    upsert_parts(table, stored, "company_id", ["name", "industry"], 16, datetime(2001, 1, 1))
    merged = upsert_parts(table, updates, "company_id", ["name", "industry"], 16, datetime(2001, 8, 1), 1)
    return merged.drop("bucket").withColumns({c: F.to_date(c) for c in ("created_date", "updated_date")})


# --- text ---------------------------------------------------------------------------

def _names(column: str):
    return F.array_join(F.array_sort(F.transform(column, lambda e: e["name"])), "; ")


def entity_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = entities.dictionary_entities("text", feed.TERMS)
    documents = feed.table(spark, sf_dir, "documents").select("doc_id", found.alias("found"))
    return documents.select("doc_id", F.size("found").alias("entity_count"), _names("found").alias("names"))


def _staged(texts: DataFrame) -> DataFrame:
    return texts.select(
        "text_hash", entities.dictionary_entities("text", feed.TERMS).alias("entities"),
        F.lit(None).cast("string").alias("error"),
    )


def entity_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct text once, then back to the postings that share it."""
    rows = latest(spark, sf_dir, TEXT).select("job_id", "description")
    staged = _staged(entities.pending_texts(rows, "description"))
    return entities.staged_entities(rows, "job_id", "description", staged)


def extract_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label have been through extraction; the others are pending
    unless they copy one of those."""
    documents = feed.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = feed.table(spark, sf_dir, "labels").select("doc_id")
    known = documents.join(labels, "doc_id", "left_semi").select(
        entities.text_hash("text").alias("text_hash"), F.lit(None).cast("string").alias("error")
    )
    staged = _staged(entities.pending_texts(documents, "text", known))
    return staged.select("text_hash", F.size("entities").alias("entity_count"), _names("entities").alias("names"))


def term_finder(terms: tuple) -> entities.Extractor:
    """A stand-in for an external extractor; it answers in JSON."""
    known = [(t.pattern, t.name, t.provider) for t in terms]

    def find(text: str) -> str:
        found = [{"name": name, "provider": provider} for pattern, name, provider in known if pattern in text]
        return json.dumps({"certifications": found})

    return find


def extract_callable(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = feed.table(spark, sf_dir, "documents")
    staged = entities.extract_texts(entities.pending_texts(documents, "text"), term_finder(feed.TERMS))
    return staged.select(
        "text_hash", F.size("entities").alias("entity_count"), _names("entities").alias("names"), "error"
    )


def json_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of an extractor, some cut off, some of another shape, some absent."""
    events, key = feed.table(spark, sf_dir, "events"), F.col("event_id")
    first = F.concat(F.lit('{"name":"'), "event_type", F.lit('","provider":"'), F.get_json_object("props", "$.k"), F.lit('"}'))
    answer = (
        F.when(key % 7 == 0, F.lit(None).cast("string"))
        .when(key % 5 == 0, F.concat(F.lit('{"certifications":['), first))
        .when(key % 3 == 0, F.lit('{"certifications":[]}'))
        .otherwise(F.concat(F.lit('{"certifications":['), first, F.lit(',{"name":"other"}]}')))
    )
    found = events.select("event_id", entities.json_entities(answer).alias("found"))
    providers = F.array_join(F.transform("found", lambda e: F.coalesce(e["provider"], F.lit("-"))), "; ")
    return found.select(
        "event_id", F.size("found").alias("entity_count"), _names("found").alias("names"), providers.alias("providers"),
    )


# --- star schema ---------------------------------------------------------------------

def dim_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.companies(latest(spark, sf_dir, OWNER)).drop("source_system")


def dim_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.locations(latest(spark, sf_dir, OWNER), feed.CONTINENT_CODES).drop("source_system")


def dim_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seeded roles with the number of postings that refer to each."""
    fact = facts.fact_postings(latest(spark, sf_dir, TAGS), feed.ROLES)
    used = fact.groupBy("role_id").agg(F.count("*").alias("n"))
    roles = dims.roles(spark, feed.ROLES).select("role_id", "name")
    return roles.join(used, "role_id", "left").select(
        "role_id", "name", F.coalesce("n", F.lit(0)).alias("postings")
    )


def dim_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.skills(latest(spark, sf_dir, TAGS)).select("skill_id", "name", "description", "category")


def dim_certs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return certs(spark, sf_dir).select("cert_id", "name", "provider")


def bridge_job_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.bridge_job_skills(latest(spark, sf_dir, TAGS)).select("job_id", "skill_id")


def bridge_job_certs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.bridge_job_certifications(staging(spark, sf_dir)).select("job_id", "cert_id")


def bridge_job_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.bridge_job_locations(latest(spark, sf_dir, OWNER)).select("job_id", "location_id")


def fact_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = facts.fact_postings(latest(spark, sf_dir, OWNER, TAGS, TEXT), feed.ROLES)
    return fact.withColumn("closed_at", F.to_date("closed_at")).drop("created_date", "source_system")


def fact_postings_slim(spark: SparkSession, sf_dir: str) -> DataFrame:
    slim = facts.fact_postings_slim(latest(spark, sf_dir, OWNER, TAGS), feed.ROLES)
    return slim.drop("_ingested_at")


# --- lines and marts -------------------------------------------------------------------

def posting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = lines(spark, sf_dir, *lines_plan.COLUMNS, parts=slices(spark, sf_dir))
    return lines_plan.job_posting_lines(made, AS_OF).drop("source_system")


def posting_lines_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by way of the star schema."""
    parts = slices(spark, sf_dir)
    keep = staged if parts > 1 else lambda made, *_: made
    tagged = keep(latest(spark, sf_dir, TAGS).select("job_id", "technology_slugs", "keyword_slugs"), "job_id", parts)
    owned, found = latest(spark, sf_dir, OWNER), keep(staging(spark, sf_dir))
    star = lines_plan.posting_lines_from_star(
        facts.fact_postings(latest(spark, sf_dir, OWNER, TAGS, TEXT_ID), feed.ROLES),
        dims.roles(spark, feed.ROLES),
        keep(dims.companies(owned)), keep(dims.locations(owned, feed.CONTINENT_CODES)),
        facts.bridge_job_skills(tagged), keep(dims.skills(tagged)),
        facts.bridge_job_certifications(found), keep(dims.certifications(found)),
        lambda joined: feed.with_texts(keep(joined, "job_id", parts), sf_dir),
    )
    joined = {c: F.array_join(c, "|") for c in ("skill_names", "cert_names")}
    return star.withColumns(joined)


def skill_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir, "posting_date", "industry", "skill_names")
    skills = dims.skills(latest(spark, sf_dir, TAGS))
    return marts.skill_daily(rows, skills, AS_OF).drop("source_system")


def cert_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir, "posting_date", "industry", "cert_names")
    return marts.cert_daily(rows, certs(spark, sf_dir), AS_OF).drop("source_system")


ROLE_DAILY_COLUMNS = ("role_name", "is_open", "min_salary_usd", "max_salary_usd", "avg_salary_usd")


def role_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.role_daily(lines(spark, sf_dir, *ROLE_DAILY_COLUMNS), AS_OF).drop("source_system")


def role_daily_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same snapshot out of the states of the days, as the incremental refresh keeps them."""
    rows = lines(spark, sf_dir, *ROLE_DAILY_COLUMNS, "posting_date")
    return marts.role_daily(rows, AS_OF, marts.role_state(rows)).drop("source_system")


# --- insight -----------------------------------------------------------------------------

def resolve_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feed.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("posting_date"))
    return window_coverage(orders, "posting_date", AS_OF)


def insight_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir, "role_name", "industry")
    return insight.filters_for(rows, [(None, None), (ROLE, None), (None, INDUSTRY)], feed.ROLES)


def filter_tag_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    skills = insight.tag_values(lines(spark, sf_dir, "skill_names"), "skill_names")
    named = insight.tag_values(lines(spark, sf_dir, "cert_names"), "cert_names")
    return skills.withColumn("kind", F.lit("skill")).unionByName(
        named.withColumn("kind", F.lit("certification"))
    )


def _skill_lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return lines(spark, sf_dir, "role_name", "posting_date", "skill_names", *more)


def insight_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insight.skills(_skill_lines(spark, sf_dir), ROLE, RANGE, as_of=AS_OF, taxonomy=feed.ROLES)


def insight_skills_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _skill_lines(spark, sf_dir, "industry")
    return insight.skills(rows, ROLE, RANGE, INDUSTRY, "trending", as_of=AS_OF, taxonomy=feed.ROLES)


def insight_skills_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insight.skills_for_all(_skill_lines(spark, sf_dir, "industry"), RANGE, as_of=AS_OF)


def insight_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir, "role_name", "posting_date", "is_open", "avg_salary_usd")
    return insight.metrics(rows, ROLE, (RANGE, "all"), as_of=AS_OF, taxonomy=feed.ROLES)


def insight_certs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir, "role_name", "posting_date", "cert_names")
    return insight.certifications(rows, certs(spark, sf_dir), ROLE, RANGE, as_of=AS_OF, taxonomy=feed.ROLES)


def insight_cert_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir, "role_name", "posting_date", "cert_names")
    return insight.skills(rows, ROLE, RANGE, as_of=AS_OF, taxonomy=feed.ROLES, tags="cert_names")


JOB_LINES = ("role_name", "posting_date", "skill_names", *insight.JOB_COLUMNS)
SKILL = "Brand#17"


def insight_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir, *JOB_LINES)
    return insight.jobs(rows, ROLE, RANGE, skill=SKILL, page=2, as_of=AS_OF, taxonomy=feed.ROLES)


def insight_jobs_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postings after a given one, the deep-page form."""
    rows = lines(spark, sf_dir, *JOB_LINES)
    return insight.jobs(rows, ROLE, RANGE, skill=SKILL, after=(date(2000, 8, 1), 0), as_of=AS_OF,
                        taxonomy=feed.ROLES)


def insight_jobs_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insight.jobs_count(_skill_lines(spark, sf_dir), ROLE, RANGE, skill=SKILL, as_of=AS_OF,
                              taxonomy=feed.ROLES)


INDEXED = ("role_name", "posting_date", "industry", "skill_names", "cert_names")


def index_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = demand_index.demand_index(lines(spark, sf_dir, *INDEXED))
    return demand_index.skills(index, ROLE, RANGE, as_of=AS_OF, taxonomy=feed.ROLES)


def index_cert_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = demand_index.demand_index(lines(spark, sf_dir, *INDEXED))
    return demand_index.skills(index, ROLE, RANGE, as_of=AS_OF, taxonomy=feed.ROLES, tags="cert_names")


def index_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = demand_index.demand_index(lines(spark, sf_dir, *INDEXED))
    rows = lines(spark, sf_dir, *JOB_LINES)
    return demand_index.jobs(rows, index, ROLE, RANGE, skill=SKILL, page=2, as_of=AS_OF, taxonomy=feed.ROLES)


def index_jobs_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = demand_index.demand_index(lines(spark, sf_dir, *INDEXED))
    return demand_index.jobs_count(index, ROLE, RANGE, skill=SKILL, as_of=AS_OF, taxonomy=feed.ROLES)


# --- declared measures and checks ------------------------------------------------------------

def measure_skill_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = resolve_window(RANGE, AS_OF)
    rows = lines(spark, sf_dir, "posting_date", "industry", "skill_names")
    rows = rows.where(window.current(F.col("posting_date")))
    daily = marts.skill_daily(rows, dims.skills(latest(spark, sf_dir, TAGS)), AS_OF)
    shares = semantic.windowed_occurrence(daily, marts.daily_totals(rows), "skill_name")
    return shares.withColumns({c: F.bround(c, 1) for c in ("occurrence_pct", "declared_pct")})


def measure_role_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored snapshots of the role mart; ``latest`` reads the newer."""
    rows = lines(spark, sf_dir, "posting_date", *ROLE_DAILY_COLUMNS)
    snapshots = [
        marts.role_daily(rows.where(F.col("posting_date") < F.lit(day)), day) for day in (EARLIER, AS_OF)
    ]
    return semantic.measure(snapshots[0].unionByName(snapshots[1]), "role_daily", ["role_name"])


def measure_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir, "job_id", "role_name", "seniority", "industry")
    return semantic.measure(rows, "job_posting", ["role_name", "seniority", "industry"])


def measure_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: the declared measure counts orders all the same."""
    line = feed.table(spark, sf_dir, "lineitem")
    rows = line.select(F.col("l_orderkey").alias("job_id"), F.col("l_returnflag").alias("role_name"))
    return semantic.measure(rows, "job_posting", ["role_name"])


def measure_repeated_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same count out of bitmaps by month, status and flag, in which an order occurs many times."""
    line = feed.table(spark, sf_dir, "lineitem")
    rows = line.select(F.col("l_orderkey").alias("job_id"), F.col("l_returnflag").alias("role_name"),
                       F.col("l_linestatus").alias("seniority"), F.trunc("l_shipdate", "month").alias("posting_date"))
    numbers = number_keys(rows, "job_id", near=F.col("posting_date"))
    state = semantic.measure_state(rows, numbers, "job_posting", ["role_name", "seniority", "posting_date"])
    return semantic.measure_of_state(state, "job_posting", ["role_name"])


def orphan_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location keys of all postings that the locations seen in one region lack."""
    rows = latest(spark, sf_dir, OWNER)
    dim = dims.locations(rows.where(F.col("loc_continent") == "ASIA"), feed.CONTINENT_CODES)
    return quality.orphan_keys(facts.bridge_job_locations(rows), dim, "location_id")


QUERIES: dict[str, Query] = {
    "bronze_flatten": bronze_flatten,
    "bronze_wide": bronze_wide,
    "incremental_scan": incremental_scan,
    "surrogate_key": surrogate_keys,
    "slug_name": slug_name,
    "classify_role": classify_role,
    "latest_posting": latest_posting,
    "latest_version": latest_version,
    "scd1_upsert_nulls": upsert_nulls,
    "scd1_upsert": upsert,
    "scd1_upsert_buckets": upsert_buckets,
    "entity_extract": entity_extract,
    "entity_staging": entity_staging,
    "extract_incremental": extract_incremental,
    "extract_callable": extract_callable,
    "json_entities": json_entities,
    "dim_companies": dim_companies,
    "dim_locations": dim_locations,
    "dim_roles": dim_roles,
    "dim_skills": dim_skills,
    "dim_certs": dim_certs,
    "bridge_job_skills": bridge_job_skills,
    "bridge_job_certs": bridge_job_certs,
    "bridge_job_locations": bridge_job_locations,
    "fact_postings": fact_postings,
    "fact_postings_slim": fact_postings_slim,
    "posting_lines": posting_lines,
    "posting_lines_star": posting_lines_star,
    "skill_daily": skill_daily,
    "cert_daily": cert_daily,
    "role_daily": role_daily,
    "role_daily_from_days": role_daily_from_days,
    "resolve_windows": resolve_windows,
    "insight_filters": insight_filters,
    "filter_tag_values": filter_tag_values,
    "insight_skills": insight_skills,
    "insight_skills_trending": insight_skills_trending,
    "insight_skills_cube": insight_skills_cube,
    "insight_metrics": insight_metrics,
    "insight_certs": insight_certs,
    "insight_cert_trend": insight_cert_trend,
    "insight_jobs": insight_jobs,
    "insight_jobs_after": insight_jobs_after,
    "insight_jobs_count": insight_jobs_count,
    "index_skills": index_skills,
    "index_cert_trend": index_cert_trend,
    "index_jobs": index_jobs,
    "index_jobs_count": index_jobs_count,
    "measure_skill_window": measure_skill_window,
    "measure_role_latest": measure_role_latest,
    "measure_postings": measure_postings,
    "measure_repeated": measure_repeated,
    "measure_repeated_state": measure_repeated_state,
    "orphan_locations": orphan_locations,
}
