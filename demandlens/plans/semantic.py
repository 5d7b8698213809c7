"""Declared entities and measures, and the aggregations they stand for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.functions.rates import share_pct
from demandlens.operators.distinct import distinct_of_state, distinct_state

COUNT_DISTINCT, SUM, LATEST = "count_distinct", "sum", "latest"


@dataclass(frozen=True)
class Entity:
    table: str
    key: str
    dimensions: tuple[str, ...]
    measures: dict[str, tuple[str, str]]  # name -> (kind, column)


# --- Fixed values -----------------------------------------------------------
_DAILY_SUMS = {
    "posting_appear_count": (SUM, "posting_appear_count"),
    "total_posting_count": (SUM, "total_posting_count"),
}
ENTITIES = {
    "job_posting": Entity(
        "job_posting_lines", "job_id",
        ("title", "description", "url", "company", "company_domain", "industry", "role_name",
         "seniority", "remote", "hybrid", "is_open", "min_salary_usd", "max_salary_usd",
         "avg_salary_usd", "date_posted", "posting_date", "country", "skill_names", "cert_names"),
        {"total_postings": (COUNT_DISTINCT, "job_id")},
    ),
    "skill_daily": Entity(
        "skill_daily", "skills_daily_id",
        ("skill_name", "skill_category", "industry", "posting_date"), _DAILY_SUMS,
    ),
    "cert_daily": Entity(
        "cert_daily", "cert_daily_id",
        ("cert_name", "cert_provider", "industry", "posting_date"), _DAILY_SUMS,
    ),
    "role_daily": Entity(
        "role_daily", "role_daily_id", ("role_name",),
        {name: (LATEST, name) for name in (
            "job_postings_count", "open_roles_count", "min_salary", "max_salary", "median_salary")},
    ),
}
RELATIONSHIPS = (("job_posting", "role_name", "role_daily", "role_name", "many_to_one"),)
# --- End of fixed values ----------------------------------------------------


def _aggregate(kind: str, column: str) -> Column:
    if kind == COUNT_DISTINCT:
        return F.count_distinct(column)
    return F.sum(column) if kind == SUM else F.max_by(column, "business_date")


def measure(
    rows: DataFrame, entity_name: str, dimensions: list[str], names: list[str] | None = None,
) -> DataFrame:
    """Declared measures of an entity per combination of ``dimensions``."""
    entity = ENTITIES[entity_name]
    unknown = [d for d in dimensions if d not in entity.dimensions]
    names = list(entity.measures) if names is None else names
    unknown += [n for n in names if n not in entity.measures]
    if unknown:
        raise ValueError(f"{entity_name} does not declare {unknown}")
    return rows.groupBy(*dimensions).agg(
        *[_aggregate(*entity.measures[n]).alias(n) for n in names]
    )


def _distinct_measure(entity_name: str, dimensions: list[str]) -> tuple[str, str]:
    """Name and column of the entity's distinct count."""
    entity = ENTITIES[entity_name]
    unknown = [d for d in dimensions if d not in entity.dimensions]
    found = [(name, column) for name, (kind, column) in entity.measures.items() if kind == COUNT_DISTINCT]
    if unknown or not found:
        raise ValueError(f"{entity_name} does not declare {unknown or 'a distinct count'}")
    return found[0]


def measure_state(rows: DataFrame, numbers: DataFrame, entity_name: str, dimensions: list[str]) -> DataFrame:
    """What to store of rows, such as those of a day, so that the entity's distinct count of any of them needs no rows.

    ``numbers`` is the result of ``number_keys`` over the counted column.
    """
    _, column = _distinct_measure(entity_name, dimensions)
    numbered = rows.select(*dimensions, column).join(numbers.select(column, "number"), column, "left")
    return distinct_state(numbered, dimensions)


def measure_of_state(state: DataFrame, entity_name: str, dimensions: list[str]) -> DataFrame:
    """``measure`` of the entity's distinct count per combination of ``dimensions``, any of those that the state is kept by."""
    name, _ = _distinct_measure(entity_name, dimensions)
    return distinct_of_state(state, dimensions, name)


def relate(rows: DataFrame, other: DataFrame, entity: str, other_entity: str) -> DataFrame:
    """Left join along a declared relationship; ``other`` has one row per target column."""
    for left, left_column, right, right_column, _ in RELATIONSHIPS:
        if (left, right) == (entity, other_entity):
            return rows.join(other.withColumnRenamed(right_column, left_column), left_column, "left")
    raise ValueError(f"no relationship from {entity} to {other_entity}")


def windowed_occurrence(daily: DataFrame, totals: DataFrame, name: str) -> DataFrame:
    """Share of postings per tag over the days given.

    ``occurrence_pct`` divides by all postings of those days. The sum of
    ``total_posting_count`` over the mart, kept as ``declared_pct``, misses days
    on which a tag did not appear and overstates it.
    """
    sums = measure(daily, daily_entity(name), [name])
    everything = totals.agg(F.sum("total_posting_count").alias("n")).scalar()
    part = F.col("posting_appear_count")
    return sums.select(
        name, "posting_appear_count", "total_posting_count",
        everything.alias("window_posting_count"),
        share_pct(part, everything).alias("occurrence_pct"),
        share_pct(part, F.col("total_posting_count")).alias("declared_pct"),
    )


def daily_entity(name: str) -> str:
    return {"skill_name": "skill_daily", "cert_name": "cert_daily"}[name]
