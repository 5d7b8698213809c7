"""All tables from bronze, in dependency order, each written once and read back.

A written table is where lineage ends: later steps start from files, so the loss
of an executor never replays more than one step.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens import rules
from demandlens.operators import entities
from demandlens.operators.upsert import first_load, scd1_upsert
from demandlens.plans import dims, facts, marts, quality
from demandlens.plans.demand_index import MONTH, demand_index
from demandlens.plans.lines import job_posting_lines, posting_lines
from demandlens.sources.tables import Snapshots, append, is_written, overwrite, read_table

#: Entities of a posting, kept with it between the steps.
FOUND = "_entities"


@dataclass(frozen=True)
class Settings:
    """What a refresh needs to know besides its input."""

    base: str
    as_of: date
    at: datetime
    taxonomy: rules.Roles = rules.Roles()
    terms: tuple[rules.Term, ...] = ()
    extractor: entities.Extractor | None = None
    #: Commits of a callable's results in one run.
    extract_commits: int = 4
    continent_codes: tuple[tuple[str, str], ...] = tuple(rules.CONTINENT_CODES.items())

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"


def _store(spark: SparkSession, df: DataFrame, s: Settings, table: str, by: str | None = None) -> DataFrame:
    overwrite(df, s.path(table), by)
    return read_table(spark, s.path(table), df.schema)  # an empty table has no file that tells its columns


def _companies(spark: SparkSession, latest: DataFrame, s: Settings) -> DataFrame:
    snapshots = Snapshots(spark, s.path("companies"))
    stored, new = snapshots.current(), dims.companies(latest)
    if stored is None:
        return snapshots.publish(first_load(new, "company_id", dims.COMPANY_ATTRIBUTES, s.at))
    return snapshots.publish(scd1_upsert(stored, new, "company_id", dims.COMPANY_ATTRIBUTES, s.at))


def _staging(spark: SparkSession, latest: DataFrame, s: Settings) -> DataFrame:
    """Entities per posting. Results of a callable are appended before use, so a
    re-evaluated plan never calls it again."""
    if s.extractor is None:
        return entities.inline_entities(latest, "job_id", FOUND)
    results = s.path("entity_results")
    known = read_table(spark, results) if is_written(spark, results) else None
    pending = entities.pending_texts(latest, "description", known)
    for part in range(s.extract_commits):  # a failure later on keeps what is committed
        own = pending.where(F.pmod(F.crc32("text_hash"), F.lit(s.extract_commits)) == part)
        append(entities.extract_texts(own, s.extractor), results)
    return entities.staged_entities(latest, "job_id", "description", read_table(spark, results))


def refresh(spark: SparkSession, bronze: DataFrame, s: Settings) -> dict[str, DataFrame]:
    """Rebuild every table under ``s.base``; companies are upserted, role snapshots kept.

    Texts are searched once: a dictionary's entities are stored with the latest
    postings, a callable's come from its staged results. Raises, before lines are written, where a
    posting would have more than one.
    """
    latest = facts.latest_postings(bronze)
    if s.extractor is None:
        latest = latest.withColumn(FOUND, entities.dictionary_entities("description", s.terms))
    latest = _store(spark, latest, s, "latest")
    staging = _store(spark, _staging(spark, latest, s), s, "staging")
    t = {
        "companies": _companies(spark, latest, s),
        "locations": _store(spark, dims.locations(latest, dict(s.continent_codes)), s, "locations"),
        "roles": _store(spark, dims.roles(spark, s.taxonomy, s.at), s, "roles"),
        "skills": _store(spark, dims.skills(latest, s.at), s, "skills"),
        "certifications": _store(spark, dims.certifications(staging, s.at), s, "certifications"),
        "bridge_job_skills": _store(spark, facts.bridge_job_skills(latest, s.at), s, "bridge_job_skills"),
        "bridge_job_certifications": _store(
            spark, facts.bridge_job_certifications(staging, s.at), s, "bridge_job_certifications"),
        "bridge_job_locations": _store(
            spark, facts.bridge_job_locations(latest, s.at), s, "bridge_job_locations"),
        "job_postings": _store(
            spark, facts.fact_postings(latest, s.taxonomy, s.at), s, "job_postings", "_batch_date"),
        "job_postings_slim": _store(
            spark, facts.fact_postings_slim(latest, s.taxonomy), s, "job_postings_slim", "_batch_date"),
    }
    rows = latest
    if s.extractor is not None:
        named = F.struct(F.col("cert_name").alias("name"), F.col("cert_provider").alias("provider"))
        rows = latest.join(staging.groupBy("job_id").agg(F.collect_list(named).alias(FOUND)), "job_id", "left")
    found = F.coalesce(FOUND, F.array().cast(entities.ENTITIES))
    # Dimensions with a repeated key are what could repeat a posting: they are checked before any line is written.
    for name, key in (("companies", "company_id"), ("locations", "location_id")):
        repeated = quality.repeated_keys(t[name], key).limit(5).collect()
        if repeated:
            raise ValueError(f"{name} has repeated ids, such as {[r[key] for r in repeated]}: lines would repeat postings")
    lines = posting_lines(rows, t["companies"], t["locations"], s.taxonomy, found)
    lines = _store(spark, job_posting_lines(lines, s.as_of), s, "job_posting_lines", "posting_date")
    t["job_posting_lines"] = lines
    t["demand_index"] = _store(spark, demand_index(lines), s, "demand_index", MONTH)
    t["skill_daily"] = _store(
        spark, marts.skill_daily(lines, t["skills"], s.as_of), s, "skill_daily", "posting_date")
    t["cert_daily"] = _store(
        spark, marts.cert_daily(lines, t["certifications"], s.as_of), s, "cert_daily", "posting_date")
    overwrite(marts.role_daily(lines, s.as_of), s.path("role_daily"), "business_date", touched_only=True)
    t["role_daily"] = read_table(spark, s.path("role_daily"))
    return t
