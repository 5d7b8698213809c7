"""Demand questions over posting lines; every answer is a DataFrame.

Lines are one row per posting. A selection is a role, an industry (or ``all``)
and a date window; arguments are checked here and raise ``ValueError``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlens import rules
from demandlens.functions.dates import DateWindow, resolve_window
from demandlens.functions.rates import change_pct, demand_badge, round1, share_pct, trend_label
from demandlens.operators.medians import summarize_with_median
from demandlens.operators.tags import tag_counts

JOB_COLUMNS = (
    "job_id", "title", "company", "company_domain", "seniority", "remote", "description",
    "hybrid", "min_salary_usd", "max_salary_usd", "date_posted", "url",
)


# --- argument checks ----------------------------------------------------------

def _check(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


def _check_role(role: str | None, taxonomy: rules.Roles) -> None:
    _check(bool(role), "role is required")
    _check(role in taxonomy.selectable, f"role must be one of {taxonomy.selectable}, not {role!r}")


def _check_limit(limit: int, name: str = "limit") -> None:
    _check(1 <= limit <= rules.MAX_ROWS, f"{name} must be between 1 and {rules.MAX_ROWS}")


# --- selections ---------------------------------------------------------------

def _in_industry(lines: DataFrame, industry: str | None) -> DataFrame:
    if not industry or industry == rules.ALL_INDUSTRIES:
        return lines
    return lines.where(F.col("industry") == industry)


def _select(lines: DataFrame, role: str, industry: str | None, start: date, end: date) -> DataFrame:
    """Plain comparisons on stored columns: they reach the scan, and the bounds on
    ``posting_date`` prune partitions."""
    day = F.col("posting_date")
    chosen = lines.where((F.col("role_name") == role) & (day >= F.lit(start)) & (day < F.lit(end)))
    return _in_industry(chosen, industry)


# --- skills and certifications --------------------------------------------------

def _half_counts(window: DateWindow) -> list[Column]:
    day, middle = F.col("posting_date"), F.lit(window.midpoint)
    return [
        F.count("*").alias("n"),
        F.count_if(day < middle).alias("n_prior"),
        F.count_if(day >= middle).alias("n_recent"),
    ]


def _occurrence(total: Column) -> Column:
    return round1(share_pct(F.col("n"), total["n"]))


def _trend_delta(total: Column) -> Column:
    recent = share_pct(F.col("n_recent"), total["n_recent"])
    return round1(recent - share_pct(F.col("n_prior"), total["n_prior"]))


def _total() -> Column:
    return F.struct("n", "n_prior", "n_recent")


def _ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """Number rows that a limit has already cut to at most ``MAX_ROWS``."""
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def skills(
    lines: DataFrame,
    role: str,
    date_range: str = "90d",
    industry: str = rules.ALL_INDUSTRIES,
    sort: str = "occurrence",
    limit: int = 20,
    as_of: date | None = None,
    taxonomy: rules.Roles = rules.Roles(),
    tags: str = "skill_names",
) -> DataFrame:
    """Tags of a role by share of postings or by split-half trend, ranked.

    The totals come from the same aggregation as the tag counts and reach the
    tag lines as a scalar subquery. ``tags="cert_names"`` gives the trend of
    certifications.
    """
    _check_role(role, taxonomy)
    window = resolve_window(date_range, as_of)
    chosen = _select(lines, role, industry, window.start, window.end).select("posting_date", tags)
    return ranked_tags(tag_counts(chosen, [], tags, "name", *_half_counts(window)), sort, limit)


def ranked_tags(counts: DataFrame, sort: str, limit: int) -> DataFrame:
    """Shares, trends and ranks of (name, is_total, n, n_prior, n_recent)."""
    _check(sort in rules.SORTS, f"sort must be one of {rules.SORTS}, not {sort!r}")
    _check_limit(limit)
    total = counts.where("is_total").select(_total()).scalar()
    measured = (
        counts.where("NOT is_total")
        .withColumn("total", total)
        .select(
            "name",
            _occurrence(F.col("total")).alias("occurrence_pct"),
            _trend_delta(F.col("total")).alias("trend_delta_pp"),
        )
    )
    order = [F.desc("trend_delta_pp" if sort == "trending" else "occurrence_pct"), F.asc("name")]
    top = _ranked(measured.orderBy(*order).limit(limit), *order)
    return top.select(
        "rank", "name", "occurrence_pct", trend_label(F.col("trend_delta_pp")).alias("trend"), "trend_delta_pp"
    )


def certifications(
    lines: DataFrame,
    certs: DataFrame,
    role: str,
    date_range: str = "90d",
    industry: str = rules.ALL_INDUSTRIES,
    limit: int = 5,
    as_of: date | None = None,
    taxonomy: rules.Roles = rules.Roles(),
) -> DataFrame:
    """Most named certifications of a role with a demand badge."""
    _check_role(role, taxonomy)
    _check_limit(limit)
    window = resolve_window(date_range, as_of)
    chosen = _select(lines, role, industry, window.start, window.end).select("cert_names")
    counts = tag_counts(chosen, [], "cert_names", "name", F.count("*").alias("n"))
    total = counts.where("is_total").select(F.struct("n")).scalar()
    order = [F.desc("n"), F.asc("name")]
    top = _ranked(counts.where("NOT is_total").select("name", "n").orderBy(*order).limit(limit), *order)
    measured = top.withColumn("total", total).withColumn("occurrence_pct", _occurrence(F.col("total")))
    # The badge follows the rounded share, as shown.
    return measured.join(certs.select("name", "provider"), "name", "left").select(
        "rank", "name", "provider", "occurrence_pct", demand_badge(F.col("occurrence_pct")).alias("demand_badge")
    )


def skills_for_all(
    lines: DataFrame,
    date_range: str = "90d",
    limit: int = 20,
    as_of: date | None = None,
    sort: str = "occurrence",
) -> DataFrame:
    """``skills`` of every role, for each industry and for all of them, in one job.

    Counts are additive, so the grouping sets run over the counted groups, not
    over the unfolded postings. The rank is cut per group before its shuffle.
    """
    _check(sort in rules.SORTS, f"sort must be one of {rules.SORTS}, not {sort!r}")
    _check_limit(limit)
    window = resolve_window(date_range, as_of)
    day = F.col("posting_date")
    chosen = lines.where((day >= F.lit(window.start)) & (day < F.lit(window.end)))
    keys = ["role_name", "industry"]
    counts = tag_counts(
        chosen.select(*keys, "posting_date", "skill_names"), keys, "skill_names", "name", *_half_counts(window)
    )
    every_industry = F.grouping("industry") == 1
    cube = counts.groupingSets(
        [["role_name", "industry", "name"], ["role_name", "name"]], "role_name", "industry", "name"
    ).agg(
        F.max("is_total").alias("is_total"),
        F.max(F.when(every_industry, rules.ALL_INDUSTRIES).otherwise(F.col("industry"))).alias("shown"),
        *[F.sum(c).alias(c) for c in ("n", "n_prior", "n_recent")],
    )
    cube = cube.drop("industry").withColumnRenamed("shown", "industry")
    totals = cube.where("is_total").select(*keys, _total().alias("total"))
    measured = (
        cube.where("NOT is_total").join(totals, keys)
        .select(
            *keys, "name",
            _occurrence(F.col("total")).alias("occurrence_pct"),
            _trend_delta(F.col("total")).alias("trend_delta_pp"),
        )
    )
    best = F.desc("trend_delta_pp" if sort == "trending" else "occurrence_pct")
    order = Window.partitionBy(*keys).orderBy(best, F.asc("name"))
    ranked = measured.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    return ranked.select(
        *keys, "rank", "name", "occurrence_pct",
        trend_label(F.col("trend_delta_pp")).alias("trend"), "trend_delta_pp",
    )


# --- headline figures -----------------------------------------------------------

def metrics(
    lines: DataFrame,
    role: str,
    date_ranges: tuple[str, ...] = ("90d",),
    industry: str = rules.ALL_INDUSTRIES,
    as_of: date | None = None,
    taxonomy: rules.Roles = rules.Roles(),
) -> DataFrame:
    """Postings, open roles and median salary with the change to the period before.

    One line per range. A posting is unfolded into the periods it falls into, so
    all windows and their predecessors are counted together; without postings
    the counts are 0 and the median is NULL.
    """
    _check_role(role, taxonomy)
    windows = {name: resolve_window(name, as_of) for name in date_ranges}
    day = F.col("posting_date")
    first = min(w.first_day for w in windows.values())
    last = max(w.end for w in windows.values())
    periods = [
        F.when(inside, F.struct(F.lit(name).alias("date_range"), F.lit(current).alias("current")))
        for name, w in windows.items()
        for current, inside in ((True, w.current(day)), (False, w.prior(day)))
    ]
    unfolded = _select(lines, role, industry, first, last).select(
        F.inline(F.array_compact(F.array(*periods))), "is_open", "avg_salary_usd"
    )
    stats = summarize_with_median(
        unfolded, ["date_range", "current"], "avg_salary_usd", "median",
        counts={"postings": F.count("*"), "open": F.count_if("is_open")},
    )
    fields = ("postings", "open", "median")
    paired = stats.groupBy("date_range").agg(*[
        F.max(F.when(F.col("current") == current, F.col(f))).alias(f"{period}_{f}")
        for f in fields for period, current in (("now", True), ("before", False))
    ])
    ranges = F.array(*[
        F.struct(
            F.lit(name).alias("date_range"), F.lit(w.start).alias("window_start"),
            F.lit(w.end).alias("window_end"), F.lit(w.midpoint).alias("window_midpoint"),
        )
        for name, w in windows.items()
    ])
    asked = lines.sparkSession.range(1).select(F.inline(ranges))
    none = F.lit(0).cast("long")

    return asked.join(F.broadcast(paired), "date_range", "left").select(
        "date_range",
        F.coalesce("now_postings", none).alias("job_postings"),
        change_pct(F.coalesce("now_postings", none), F.col("before_postings")).alias("job_postings_delta_pct"),
        F.coalesce("now_open", none).alias("open_roles"),
        change_pct(F.coalesce("now_open", none), F.col("before_open")).alias("open_roles_delta_pct"),
        F.col("now_median").alias("median_salary_usd"),
        change_pct(F.col("now_median"), F.col("before_median")).alias("median_salary_delta_pct"),
        "window_start", "window_end", "window_midpoint",
    )


# --- filter values ----------------------------------------------------------------

def filters(
    lines: DataFrame,
    role: str | None = None,
    industry: str | None = None,
    taxonomy: rules.Roles = rules.Roles(),
) -> DataFrame:
    """Selectable roles and industries, each narrowed by the other's selection."""
    return filters_for(lines, [(role, industry)], taxonomy)


def filters_for(
    lines: DataFrame,
    selections: list[tuple[str | None, str | None]],
    taxonomy: rules.Roles = rules.Roles(),
) -> DataFrame:
    """``filters`` for several selections from one scan.

    The distinct (role, industry) pairs are the only thing read from the lines. Each
    pair unfolds into the selections and the two kinds of values, and one small
    aggregate says which values are offered, whatever the number of selections.
    """
    pairs = lines.select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("role_name", "industry")]
    ).distinct()
    asked = F.array(*[
        F.struct(F.lit(i).alias("at"), F.lit(role or None).cast("string").alias("role"),
                 F.lit(None if industry == rules.ALL_INDUSTRIES else industry or None).cast("string").alias("industry"))
        for i, (role, industry) in enumerate(selections)
    ])
    name, industry = F.col("role_name"), F.col("industry")
    wanted = pairs.select(name, industry, F.explode(asked).alias("s"))
    kinds = F.array(
        F.struct(F.lit("role").alias("kind"), name.alias("value"), (industry == F.col("s.industry")).alias("ok")),
        F.struct(F.lit("industry").alias("kind"), industry.alias("value"),
                 ((industry != "") & (F.col("s.role").isNull() | (name == F.col("s.role")))).alias("ok")),
    )
    offered = (
        wanted.select(F.col("s.at").alias("at"), F.inline(kinds))
        .where("ok").select("at", "kind", "value").distinct()
    )
    # Constant rows: every role, and the entry for all industries, of every selection.
    constant = lines.sparkSession.range(1).select(F.inline(asked))
    roles = constant.select("at", F.col("industry").isNull().alias("free"), F.inline(_options(taxonomy)))
    kept = roles.join(offered.where("kind = 'role'").select("at", "value", F.lit(True).alias("used")), ["at", "value"], "left")
    kept = kept.where(F.col("free") | F.col("used")).select("at", F.lit("role").alias("kind"), "position", "value", "label")
    order = Window.partitionBy("at").orderBy("value")
    listed = offered.where("kind = 'industry'").select(
        "at", "kind", F.row_number().over(order).alias("position"), "value", F.col("value").alias("label"),
    )
    first = constant.select(
        "at", F.lit("industry").alias("kind"), F.lit(0).alias("position"),
        F.lit(rules.ALL_INDUSTRIES).alias("value"), F.lit(rules.ALL_INDUSTRIES_LABEL).alias("label"),
    )
    given = F.array(*[
        F.struct(F.lit(role).cast("string").alias("for_role"), F.lit(industry).cast("string").alias("for_industry"))
        for role, industry in selections
    ])
    return kept.unionByName(listed).unionByName(first).select(
        F.get(given, F.col("at")).getField("for_role").alias("for_role"),
        F.get(given, F.col("at")).getField("for_industry").alias("for_industry"),
        "kind", "position", "value", "label",
    )


def _options(taxonomy: rules.Roles) -> Column:
    return F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(value).alias("value"), F.lit(label).alias("label"))
        for i, (value, label) in enumerate(taxonomy.labels)
    ])


def tag_values(lines: DataFrame, tags: str) -> DataFrame:
    """Distinct values of a tag column: the skill or certification filter."""
    return lines.select(F.explode(tags).alias("value")).where(F.col("value").isNotNull()).distinct()


# --- postings behind a figure -------------------------------------------------------

def _drill_down(
    lines: DataFrame, role: str, skill: str | None, certificate: str | None, industry: str | None,
    date_range: str, as_of: date | None, taxonomy: rules.Roles,
) -> DataFrame:
    _check_role(role, taxonomy)
    _check(not (skill and certificate), "give either skill or certificate, not both")
    window = resolve_window(date_range, as_of)
    chosen = _select(lines, role, industry, window.start, window.end)
    if skill:
        chosen = chosen.where(F.array_contains("skill_names", skill))
    if certificate:
        chosen = chosen.where(F.array_contains("cert_names", certificate))
    return chosen


def jobs(
    lines: DataFrame,
    role: str,
    date_range: str = "90d",
    industry: str = rules.ALL_INDUSTRIES,
    skill: str | None = None,
    certificate: str | None = None,
    page: int = 1,
    page_size: int = 20,
    after: tuple[date, int] | None = None,
    as_of: date | None = None,
    taxonomy: rules.Roles = rules.Roles(),
) -> DataFrame:
    """One page of postings, newest first, ties by id.

    The page is decided on (date, id) alone; the wide columns are then read for
    those at most ``MAX_ROWS`` rows, whose dates also prune the partitions of
    that second read. ``page`` counts the postings of each day first and ranks
    only the days that the page lies in; ``after``, the date and id of the last
    row seen, needs no count.
    """
    _check(page >= 1, "page must be at least 1")
    _check_limit(page_size, "page_size")
    chosen = _drill_down(lines, role, skill, certificate, industry, date_range, as_of, taxonomy)
    if after is not None:
        day, last_id = F.lit(after[0]), after[1]
        chosen = chosen.where(
            (F.col("posting_date") < day) | ((F.col("posting_date") == day) & (F.col("job_id") > last_id))
        )
    order = [F.desc("posting_date"), F.asc("job_id")]
    if after is not None or page == 1:
        keys = chosen.select("posting_date", "job_id").orderBy(*order).limit(page_size)
    else:
        keys = _page_keys(chosen, (page - 1) * page_size, page_size)
    page_rows = lines.join(F.broadcast(keys), ["posting_date", "job_id"], "left_semi")
    return page_rows.orderBy(*order).select(*JOB_COLUMNS)


def _page_keys(chosen: DataFrame, offset: int, size: int) -> DataFrame:
    """Date and id of the rows from ``offset`` on, newest first, ties by id.

    One row per day goes through the running sum. The days of a page are at most as
    many as its rows, so what is broadcast has a bound.
    """
    days = chosen.groupBy("posting_date").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.desc("posting_date")))
    days = days.select("posting_date", (upto - F.col("n")).alias("before"), upto.alias("upto"))
    days = days.where((F.col("before") < offset + size) & (F.col("upto") > offset)).withColumnRenamed("posting_date", "day")
    inside = chosen.select("posting_date", "job_id").join(F.broadcast(days), F.col("posting_date").eqNullSafe(F.col("day")))
    place = F.col("before") + F.row_number().over(Window.partitionBy("posting_date").orderBy("job_id"))
    return inside.withColumn("place", place).where(
        (F.col("place") > offset) & (F.col("place") <= offset + size)
    ).select("posting_date", "job_id")


def jobs_count(
    lines: DataFrame,
    role: str,
    date_range: str = "90d",
    industry: str = rules.ALL_INDUSTRIES,
    skill: str | None = None,
    certificate: str | None = None,
    page_size: int = 20,
    as_of: date | None = None,
    taxonomy: rules.Roles = rules.Roles(),
) -> DataFrame:
    """Number of postings and pages behind ``jobs``; at least one page."""
    _check_limit(page_size, "page_size")
    chosen = _drill_down(lines, role, skill, certificate, industry, date_range, as_of, taxonomy)
    return pages_of(chosen.agg(F.count("*").alias("total")), page_size)


def pages_of(total: DataFrame, page_size: int) -> DataFrame:
    pages = F.greatest(F.lit(1), F.ceil(F.col("total") / page_size)).cast("long")
    return total.select("total", F.lit(page_size).alias("page_size"), pages.alias("total_pages"))
