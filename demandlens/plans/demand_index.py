"""Counts per day, role, industry and tag, from which questions are answered without unfolding postings.

The index has one row per (day, role, industry) for all postings and one per tag that occurs there. Rows of days add up,
so the counts of any window, its halves, any industry or all of them are sums over it, and the day on which a page of
postings begins follows from running sums. A page then reads the days that it lies in and no other.

Stored by month (``MONTH``): a touched day costs its month's rows, which are some thousand times fewer than postings.
Postings without a day are in no window and not in the index.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandlens import rules
from demandlens.functions.dates import resolve_window
from demandlens.plans import insight

MONTH = "month"
KEYS = ["posting_date", "role_name", "industry", "kind", "tag"]
#: Kinds of tags by their column in the lines; ``ALL`` marks the rows that count every posting once.
ALL, KINDS = "all", ("skill_names", "cert_names")
#: Rows up to the end of a page, from its first day on, that go through a sort with all their columns.
DIRECT = 1000


def demand_index(lines: DataFrame) -> DataFrame:
    """(month, posting_date, role_name, industry, kind, tag, n) of posting lines; one pass, added up before the shuffle."""
    def marks(kind: str) -> Column:
        named = F.array_distinct(F.array_compact(F.coalesce(kind, F.array().cast("array<string>"))))
        return F.transform(named, lambda tag: F.struct(F.lit(kind).alias("kind"), tag.alias("tag")))

    every = F.array(F.struct(F.lit(ALL).alias("kind"), F.lit(None).cast("string").alias("tag")))
    found = lines.where(F.col("posting_date").isNotNull()).select(
        *KEYS[:3], F.inline(F.concat(every, *(marks(k) for k in KINDS))),
    )
    counted = found.groupBy(*KEYS).agg(F.count("*").alias("n"))
    return counted.select(month_of("posting_date").alias(MONTH), *KEYS, "n")


def month_of(day: str | Column) -> Column:
    return F.trunc(day, "month")


def _rows(index: DataFrame, role: str, industry: str | None, date_range: str, as_of: date | None) -> DataFrame:
    """Index rows of a selection; the bounds on the month choose the files."""
    window = resolve_window(date_range, as_of)
    months = (F.col(MONTH) >= F.lit(window.start.replace(day=1))) & (F.col(MONTH) < F.lit(window.end))
    return insight._select(index.where(months), role, industry, window.start, window.end)


def skills(
    index: DataFrame, role: str, date_range: str = "90d", industry: str = rules.ALL_INDUSTRIES, sort: str = "occurrence",
    limit: int = 20, as_of: date | None = None, taxonomy: rules.Roles = rules.Roles(), tags: str = "skill_names",
) -> DataFrame:
    """The result of ``insight.skills`` as sums over the index."""
    insight._check_role(role, taxonomy)
    insight._check(tags in KINDS, f"tags must be one of {KINDS}, not {tags!r}")
    middle = F.lit(resolve_window(date_range, as_of).midpoint)
    chosen = _rows(index, role, industry, date_range, as_of).where(F.col("kind").isin(ALL, tags))
    recent, zero = F.col("posting_date") >= middle, F.lit(0)
    counts = chosen.groupBy(F.col("tag").alias("name")).agg(
        F.max(F.col("kind") == ALL).alias("is_total"),
        F.sum("n").alias("n"),
        F.sum(F.when(recent, zero).otherwise(F.col("n"))).alias("n_prior"),
        F.sum(F.when(recent, F.col("n")).otherwise(zero)).alias("n_recent"),
    )
    return insight.ranked_tags(counts, sort, limit)


def _matching(
    index: DataFrame, role: str, skill: str | None, certificate: str | None, industry: str | None,
    date_range: str, as_of: date | None, taxonomy: rules.Roles,
) -> DataFrame:
    """(posting_date, n) of the postings behind a figure, several rows a day."""
    insight._check_role(role, taxonomy)
    insight._check(not (skill and certificate), "give either skill or certificate, not both")
    rows = _rows(index, role, industry, date_range, as_of)
    if skill or certificate:
        kind = KINDS[0] if skill else KINDS[1]
        rows = rows.where((F.col("kind") == kind) & (F.col("tag") == (skill or certificate)))
    else:
        rows = rows.where(F.col("kind") == ALL)
    return rows.select("posting_date", "n")


def jobs_count(
    index: DataFrame, role: str, date_range: str = "90d", industry: str = rules.ALL_INDUSTRIES, skill: str | None = None,
    certificate: str | None = None, page_size: int = 20, as_of: date | None = None, taxonomy: rules.Roles = rules.Roles(),
) -> DataFrame:
    """The result of ``insight.jobs_count``; reads no posting."""
    insight._check_limit(page_size, "page_size")
    rows = _matching(index, role, skill, certificate, industry, date_range, as_of, taxonomy)
    return insight.pages_of(rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")), page_size)


def page_days(rows: DataFrame, offset: int, size: int) -> tuple[list[date], int]:
    """The days, newest first, that the rows from ``offset`` on lie in, and how many rows of the first one come before.

    One row per day goes through the running sum; every day of a page has a row of it, so at most ``size`` days return.
    """
    days = rows.groupBy("posting_date").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.desc("posting_date")))
    days = days.select("posting_date", "n", upto.alias("upto"))
    found = days.where((F.col("upto") - F.col("n") < offset + size) & (F.col("upto") > offset)).collect()
    found.sort(key=lambda r: r["upto"])
    return [r["posting_date"] for r in found], offset - (found[0]["upto"] - found[0]["n"]) if found else 0


def jobs(
    lines: DataFrame, index: DataFrame, role: str, date_range: str = "90d", industry: str = rules.ALL_INDUSTRIES,
    skill: str | None = None, certificate: str | None = None, page: int = 1, page_size: int = 20,
    as_of: date | None = None, taxonomy: rules.Roles = rules.Roles(),
) -> DataFrame:
    """The result of ``insight.jobs``. The index names the days of the page, at most ``page_size``; of the lines only those are read."""
    insight._check(page >= 1, "page must be at least 1")
    insight._check_limit(page_size, "page_size")
    asked = (role, skill, certificate, industry, date_range, as_of, taxonomy)
    days, skip = page_days(_matching(index, *asked), (page - 1) * page_size, page_size)
    inside = F.col("posting_date").isin(days) if days else F.lit(False)
    chosen = insight._drill_down(lines, *asked).where(inside)
    order = [F.desc("posting_date"), F.asc("job_id")]
    if skip + page_size > DIRECT:  # far into a large day: wide columns are read for the page's rows only
        keys = chosen.select("posting_date", "job_id").orderBy(*order).offset(skip).limit(page_size)
        chosen, skip = lines.where(inside).join(F.broadcast(keys), ["posting_date", "job_id"], "left_semi"), 0
    return chosen.select("posting_date", *insight.JOB_COLUMNS).orderBy(*order).offset(skip).limit(page_size).select(*insight.JOB_COLUMNS)
