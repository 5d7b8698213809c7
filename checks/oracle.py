"""The queries of ``queries.py`` as SQL over the same tables.

``BASE`` maps the order book to postings and builds the star schema; each query
is appended to it. Unused parts cost nothing.
"""

from __future__ import annotations

from demandlens.schema import BRONZE


def _title_case(text: str) -> str:
    words = f"string_split({text}, ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def _skill_name(slug: str) -> str:
    return _title_case(f"regexp_replace({slug}, '[-_]', ' ', 'g')")


def _role(title: str) -> str:
    return f"""CASE
        WHEN contains({title}, 'widget') OR contains({title}, 'bolt') THEN 'role_a'
        WHEN contains({title}, 'gear') OR contains({title}, 'red ') THEN 'role_b'
        WHEN contains({title}, 'ring') THEN 'role_c'
        ELSE 'other' END"""


TERMS = """terms(name, provider) AS (VALUES
    ('Apache License, Version 2.0', 'Apache Software Foundation'),
    ('MIT License', 'MIT'),
    ('GNU General Public License, version 3', 'Free Software Foundation'),
    ('CC BY-NC 4.0', 'Creative Commons'))"""

BASE = f"""WITH {TERMS},
order_tags AS (
    SELECT l_orderkey,
           min_by(p_name, (l_linenumber, l_partkey)) AS job_title,
           list_sort(list_distinct(list(lower(p_brand)))) AS technology_slugs,
           list_sort(list_distinct(list(lower(p_type)))) AS keyword_slugs
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY l_orderkey),
postings AS (
    SELECT o_orderkey AS job_id, job_title,
           CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN '  '
                ELSE job_title END AS normalized_title,
           o_orderdate::DATE AS date_posted, o_orderdate AS discovered_at,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS closed_at,
           o_orderpriority AS seniority,
           o_totalprice * 0.8 AS min_salary_usd, o_totalprice * 1.2 AS max_salary_usd,
           o_totalprice AS avg_salary_usd,
           CASE WHEN o_custkey % 11 <> 0 THEN c_custkey::VARCHAR END AS co_id,
           c_name AS co_name, lower(c_name) || '.example' AS co_domain,
           CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS co_industry,
           n_name AS location, n_name AS country,
           CASE WHEN o_custkey % 13 <> 0 THEN n_nationkey END AS loc_id,
           r_name AS loc_continent,
           technology_slugs, keyword_slugs, text AS description,
           o_orderkey % 2 = 0 AS remote, o_orderkey % 5 = 0 AS hybrid,
           'https://jobs.example/' || o_orderkey AS url
    FROM orders
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN order_tags ON o_orderkey = l_orderkey
    LEFT JOIN documents ON doc_id = o_orderkey % (SELECT count(*) FROM documents)),
keyed AS (
    SELECT *,
           coalesce(co_id, md5(coalesce(co_domain, '') || '||' || coalesce(co_name, ''))) AS company_id,
           coalesce(loc_id::VARCHAR, md5(coalesce(location, ''))) AS location_id,
           {_role("lower(coalesce(nullif(trim(normalized_title), ''), job_title, ''))")} AS role_name
    FROM postings),
companies AS (
    SELECT company_id, co_name AS name, co_domain AS domain, co_industry AS industry,
           NULL::BIGINT AS employee_count, country
    FROM keyed WHERE co_name IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY discovered_at DESC, job_id DESC) = 1),
locations AS (
    SELECT location_id, location AS name, NULL::VARCHAR AS state, NULL::VARCHAR AS state_code,
           country AS country_name, NULL::VARCHAR AS country_code,
           CASE loc_continent WHEN 'AFRICA' THEN 'AF' WHEN 'ASIA' THEN 'AS' WHEN 'EUROPE' THEN 'EU' END
               AS continent_code,
           loc_continent AS continent_name, NULL::DOUBLE AS latitude, NULL::DOUBLE AS longitude
    FROM keyed WHERE location IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY discovered_at DESC, job_id DESC) = 1),
tagged AS (
    SELECT job_id, unnest(technology_slugs) AS slug, 'technology' AS category FROM keyed
    UNION ALL SELECT job_id, unnest(keyword_slugs), 'methodology' FROM keyed),
skills AS (
    SELECT md5(slug) AS skill_id, {_skill_name("slug")} AS name, category
    FROM (SELECT lower(slug) AS slug, max(category) AS category FROM tagged GROUP BY 1)),
staging AS (
    SELECT job_id, name AS cert_name, provider AS cert_provider
    FROM keyed JOIN terms ON contains(description, name)),
certs AS (
    SELECT md5(lower(cert_name)) AS cert_id, cert_name AS name, cert_provider AS provider
    FROM staging GROUP BY ALL),
skill_lists AS (
    SELECT job_id, list_sort(list(DISTINCT name)) AS skill_names
    FROM tagged JOIN skills ON md5(lower(slug)) = skill_id GROUP BY job_id),
cert_lists AS (
    SELECT job_id, list_sort(list(DISTINCT cert_name)) AS cert_names FROM staging GROUP BY job_id),
lines AS (
    SELECT k.job_id, job_title AS title, description, url, c.name AS company,
           c.domain AS company_domain, coalesce(c.industry, 'Unknown') AS industry, role_name, seniority,
           remote, hybrid, closed_at IS NULL AS is_open, min_salary_usd, max_salary_usd, avg_salary_usd,
           date_posted, date_posted AS posting_date, l.country_name AS country,
           coalesce(skill_names, []) AS skill_names, coalesce(cert_names, []) AS cert_names
    FROM keyed k
    LEFT JOIN companies c USING (company_id)
    LEFT JOIN locations l USING (location_id)
    LEFT JOIN skill_lists s ON s.job_id = k.job_id
    LEFT JOIN cert_lists t ON t.job_id = k.job_id)
"""

AS_OF = "DATE '2001-08-01'"


def _daily(names: str, name: str, extra: str) -> str:
    """Mart rows per day, industry and tag; ``extra`` is the looked-up column."""
    return f"""unfolded AS (SELECT posting_date, industry, job_id, unnest({names}) AS {name} FROM lines),
totals AS (SELECT posting_date, industry, count(DISTINCT job_id) AS total_posting_count
           FROM lines GROUP BY ALL),
appear AS (SELECT posting_date, industry, {name}, count(DISTINCT job_id) AS posting_appear_count
           FROM unfolded GROUP BY ALL),
daily AS (SELECT md5(concat_ws('||', posting_date, industry, {name})) AS daily_id,
                 {AS_OF} AS business_date, {name}, {extra}, industry, posting_date,
                 posting_appear_count, total_posting_count
          FROM appear JOIN totals USING (posting_date, industry) JOIN looked_up USING ({name}))"""


SKILL_LOOKUP = "looked_up AS (SELECT name AS skill_name, max(category) AS skill_category FROM skills GROUP BY 1)"
CERT_LOOKUP = "looked_up AS (SELECT name AS cert_name, provider AS cert_provider FROM certs)"


def _role_daily(day: str, condition: str = "true") -> str:
    return f"""SELECT md5(concat_ws('||', {day}, role_name)) AS role_daily_id, {day} AS business_date, role_name,
       count(DISTINCT job_id) AS job_postings_count,
       count(DISTINCT CASE WHEN is_open THEN job_id END) AS open_roles_count,
       min(min_salary_usd) AS min_salary, max(max_salary_usd) AS max_salary,
       quantile_disc(avg_salary_usd, 0.5) AS median_salary
FROM lines WHERE {condition} GROUP BY role_name"""


START, MIDDLE, PRIOR = "DATE '1999-08-02'", "DATE '2000-08-01'", "DATE '1997-08-02'"
IN_WINDOW = f"posting_date >= {START} AND posting_date < {AS_OF}"


def _pct(part: str, total: str) -> str:
    return f"(CASE WHEN {total} > 0 THEN 100.0::DOUBLE * {part} / {total} ELSE 0.0::DOUBLE END)"


def _trend(delta: str) -> str:
    return f"CASE WHEN {delta} >= 2.0 THEN 'trending' WHEN {delta} <= -2.0 THEN 'declining' ELSE 'stable' END"


def _top_tags(names: str, condition: str, order: str) -> str:
    halves = f"""count(DISTINCT job_id) AS n,
        count(DISTINCT CASE WHEN posting_date < {MIDDLE} THEN job_id END) AS n_prior,
        count(DISTINCT CASE WHEN posting_date >= {MIDDLE} THEN job_id END) AS n_recent"""
    return f"""chosen AS (SELECT * FROM lines WHERE {condition} AND {IN_WINDOW}),
totals AS (SELECT {halves.replace('AS n', 'AS t')} FROM chosen),
counted AS (SELECT name, {halves} FROM (SELECT job_id, posting_date, unnest({names}) AS name FROM chosen)
            GROUP BY name),
measured AS (SELECT name, round_even({_pct('n', 't')}, 1) AS occurrence_pct,
                    round_even({_pct('n_recent', 't_recent')} - {_pct('n_prior', 't_prior')}, 1) AS trend_delta_pp
             FROM counted, totals)
SELECT row_number() OVER (ORDER BY {order} DESC, name)::INTEGER AS rank, name, occurrence_pct,
       {_trend('trend_delta_pp')} AS trend, trend_delta_pp
FROM measured QUALIFY rank <= 20"""


def _metrics(name: str, start: str, middle: str, prior: str | None) -> str:
    inside = f"posting_date >= {start} AND posting_date < {AS_OF}"
    before = f"posting_date >= {prior} AND posting_date < {start}" if prior else "false"

    def change(field: str) -> str:
        if prior is None:
            return "NULL::DOUBLE"
        now, then = f"c_{field}", f"p_{field}"
        return f"CASE WHEN {then} <> 0 THEN round_even(100.0::DOUBLE * ({now} - {then}) / {then}, 1) END"

    return f"""SELECT '{name}' AS date_range,
       c_jobs AS job_postings, {change('jobs')} AS job_postings_delta_pct,
       c_open AS open_roles, {change('open')} AS open_roles_delta_pct,
       c_pay AS median_salary_usd, {change('pay')} AS median_salary_delta_pct,
       {start} AS window_start, {AS_OF} AS window_end, {middle} AS window_midpoint
FROM (SELECT count(DISTINCT job_id) FILTER ({inside}) AS c_jobs,
             count(DISTINCT job_id) FILTER ({inside} AND is_open) AS c_open,
             quantile_disc(avg_salary_usd, 0.5) FILTER ({inside}) AS c_pay,
             count(DISTINCT job_id) FILTER ({before}) AS p_jobs,
             count(DISTINCT job_id) FILTER ({before} AND is_open) AS p_open,
             quantile_disc(avg_salary_usd, 0.5) FILTER ({before}) AS p_pay
      FROM lines WHERE role_name = 'role_a')"""


def _windows() -> str:
    days = {"30d": 30, "60d": 60, "90d": 90, "6m": 182, "1y": 365, "2y": 730, "all": 3650}
    rows = ", ".join(f"('{name}', {n})" for name, n in days.items())
    return f"""WITH ranges(date_range, n) AS (VALUES {rows}),
windows AS (SELECT date_range, {AS_OF} - n AS window_start, {AS_OF} AS window_end,
                   {AS_OF} - n + n // 2 AS window_midpoint,
                   CASE WHEN date_range <> 'all' THEN {AS_OF} - 2 * n END AS prior_window_start,
                   CASE WHEN date_range <> 'all' THEN {AS_OF} - n END AS prior_window_end FROM ranges),
days AS (SELECT o_orderdate::DATE AS d, count(*) AS k FROM orders GROUP BY 1)
SELECT w.*,
       coalesce(sum(k) FILTER (d >= window_start AND d < window_end), 0)::BIGINT AS rows_in_window,
       coalesce(sum(k) FILTER (d >= window_start AND d < window_midpoint), 0)::BIGINT AS rows_in_first_half,
       coalesce(sum(k) FILTER (d >= prior_window_start AND d < prior_window_end), 0)::BIGINT
           AS rows_in_prior_window
FROM windows w, days GROUP BY ALL"""


ROLE_OPTIONS = "roles(position, value, label) AS (VALUES (0, 'role_a', 'Role A'), (1, 'role_b', 'Role B'), (2, 'role_c', 'Role C'))"


def _filter_block(role: str, industry: str) -> str:
    scoped_roles = (f"WHERE value IN (SELECT role_name FROM lines WHERE industry = {industry})"
                    if industry != "NULL" else "")
    scoped_lines = f"WHERE role_name = {role}" if role != "NULL" else ""
    scope = f"{role}::VARCHAR AS for_role, {industry}::VARCHAR AS for_industry"
    return f"""SELECT {scope}, 'role' AS kind, position, value, label FROM roles {scoped_roles}
UNION ALL SELECT {scope}, 'industry', 0, 'all', 'All Industries'
UNION ALL SELECT {scope}, 'industry', row_number() OVER (ORDER BY industry)::INTEGER, industry, industry
          FROM (SELECT DISTINCT industry FROM lines {scoped_lines})"""


JOBS = f"""chosen AS (SELECT job_id, title, company, company_domain, seniority, remote, description, hybrid,
       min_salary_usd, max_salary_usd, date_posted, url, posting_date
FROM lines WHERE role_name = 'role_a' AND {IN_WINDOW} AND list_contains(skill_names, 'Brand#17'))"""

CUBE_HALVES = f"""count(*) AS n, count(*) FILTER (posting_date < {MIDDLE}) AS n_prior,
       count(*) FILTER (posting_date >= {MIDDLE}) AS n_recent"""

FOUND = """found AS (SELECT {key} AS key, count(name) AS entity_count,
              coalesce(string_agg(name, '; ' ORDER BY name), '') AS names
       FROM {source} LEFT JOIN terms ON contains(text, name) GROUP BY 1)"""

DISTINCT_TEXTS = "texts AS (SELECT DISTINCT sha256(text) AS text_hash, text FROM documents)"


def _bronze_wide() -> str:
    """Known columns by expression, all others NULL of their type."""
    known = {
        "job_id": "o_orderkey", "job_title": "o_orderpriority", "date_posted": "o_orderdate::DATE",
        "discovered_at": "o_orderdate::DATE", "remote": "o_orderkey % 2 = 0", "hybrid": "o_orderkey % 5 = 0",
        "min_annual_salary_usd": "o_totalprice", "max_annual_salary_usd": "o_totalprice",
        "technology_slugs": "o_orderstatus || '|' || o_orderpriority",
        "loc_id": "n_nationkey::BIGINT", "loc_name": "n_name", "loc_country_name": "n_name",
        "co_id": "c_custkey::VARCHAR", "co_name": "c_name", "co_industry": "c_mktsegment",
        "co_employee_count": "c_nationkey::INTEGER", "co_industry_id": "c_nationkey::INTEGER",
        "co_founded_year": "CASE WHEN o_orderkey % 3 <> 0 THEN year(o_orderdate)::INTEGER END",
        "co_is_recruiting_agency": "o_orderkey % 2 = 0", "co_company_tags": "c_mktsegment",
    }
    kinds = {"long": "BIGINT", "integer": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "DATE"}
    columns = [
        f"{known.get(f.name, 'NULL::' + kinds.get(f.dataType.typeName(), 'VARCHAR'))} AS {f.name}"
        for f in BRONZE.fields if not f.name.startswith("_")
    ]
    return (f"SELECT {', '.join(columns)}, (o_orderkey % 3 = 0)::INTEGER AS unconverted FROM orders "
            "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderkey % 11 <> 0")


ORACLE: dict[str, str] = {
    "bronze_flatten": """SELECT o_orderkey AS job_id, o_orderpriority AS job_title,
       TRY_CAST(CASE WHEN o_custkey % 5 = 0 THEN 'soon' ELSE o_orderdate::DATE::VARCHAR END AS DATE) AS date_posted,
       CASE WHEN o_custkey % 13 <> 0 THEN n_nationkey::BIGINT END AS loc_id,
       CASE WHEN o_custkey % 13 <> 0 THEN n_name END AS loc_name, NULL::VARCHAR AS loc_type,
       c_custkey::VARCHAR AS co_id, c_name AS co_name, c_mktsegment AS co_industry,
       c_nationkey AS co_employee_count, NULL::VARCHAR AS company_domain, true AS no_slugs
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus <> 'P'""",
    "bronze_wide": _bronze_wide(),
    "incremental_scan": "SELECT event_id, user_id, event_type, value FROM events WHERE ts::DATE > DATE '2024-01-15'",
    "surrogate_key": BASE + """SELECT job_id,
       md5(coalesce(normalized_title, '') || '||' || coalesce(co_industry, '')) AS guarded_key,
       md5(concat_ws('||', normalized_title, co_industry)) AS plain_key FROM postings""",
    "slug_name": f"""SELECT slug, {_skill_name('slug')} AS name FROM (
       SELECT DISTINCT replace(lower(p_name), ' ', '-') || '_' || lower(p_type) AS slug FROM part)""",
    "classify_role": BASE + "SELECT job_id, role_name FROM keyed",
    "latest_posting": """SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "latest_version": """WITH v AS (SELECT l_orderkey AS job_id, date_trunc('month', l_shipdate)::DATE AS discovered,
           (l_partkey * 1000 + l_suppkey * 10 + l_linenumber)::BIGINT AS version FROM lineitem)
SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY discovered DESC, version DESC) = 1""",
    "scd1_upsert_nulls": """WITH stored AS (
  SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment FROM customer WHERE c_custkey % 5 <> 0
), updates AS (
  SELECT c_custkey AS id, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS segment FROM customer WHERE c_custkey % 7 <> 0
)
SELECT coalesce(s.id, u.id) AS company_id, CASE WHEN u.id IS NOT NULL THEN u.segment ELSE s.segment END AS industry,
       CASE WHEN s.id IS NULL THEN DATE '2001-08-01' ELSE DATE '2001-01-01' END AS created_date,
       CASE WHEN s.id IS NULL OR (u.id IS NOT NULL AND u.segment IS DISTINCT FROM s.segment) THEN DATE '2001-08-01'
            ELSE DATE '2001-01-01' END AS updated_date
FROM stored s FULL JOIN updates u ON s.id = u.id""",
    "scd1_upsert": """WITH stored AS (SELECT c_custkey AS id, c_name, c_mktsegment AS segment FROM customer
                WHERE c_mktsegment <> 'MACHINERY'),
updates AS (SELECT c_custkey AS id, c_name, CASE WHEN c_acctbal > 5000 THEN 'MOVED' ELSE c_mktsegment END AS segment
            FROM customer WHERE c_acctbal >= 0)
SELECT coalesce(s.id, u.id) AS company_id, coalesce(u.c_name, s.c_name) AS name,
       coalesce(u.segment, s.segment) AS industry,
       CASE WHEN s.id IS NULL THEN DATE '2001-08-01' ELSE DATE '2001-01-01' END AS created_date,
       CASE WHEN s.id IS NULL OR u.segment <> s.segment THEN DATE '2001-08-01'
            ELSE DATE '2001-01-01' END AS updated_date
FROM stored s FULL JOIN updates u ON s.id = u.id""",
    "entity_extract": f"WITH {TERMS}, " + FOUND.format(key="doc_id", source="documents")
    + " SELECT key AS doc_id, entity_count::INTEGER AS entity_count, names FROM found",
    "entity_staging": BASE + "SELECT job_id, cert_name, cert_provider FROM staging",
    "extract_incremental": f"WITH {TERMS}, {DISTINCT_TEXTS}, "
    + """pending AS (SELECT * FROM texts WHERE text_hash NOT IN (
             SELECT sha256(text) FROM documents JOIN labels USING (doc_id))), """
    + FOUND.format(key="text_hash", source="pending")
    + " SELECT key AS text_hash, entity_count::INTEGER AS entity_count, names FROM found",
    "extract_callable": f"WITH {TERMS}, {DISTINCT_TEXTS}, " + FOUND.format(key="text_hash", source="texts")
    + " SELECT key AS text_hash, entity_count::INTEGER AS entity_count, names, NULL::VARCHAR AS error FROM found",
    "json_entities": """SELECT event_id, whole * 2::INTEGER AS entity_count,
       CASE whole WHEN 1 THEN array_to_string(list_sort([event_type, 'other']), '; ') ELSE '' END AS names,
       CASE whole WHEN 1 THEN regexp_extract(props, '"k": *(-?[0-9]+)', 1) || '; -' ELSE '' END AS providers
FROM (SELECT *, (event_id % 7 <> 0 AND event_id % 5 <> 0 AND event_id % 3 <> 0)::INTEGER AS whole FROM events)""",
    "dim_companies": BASE + "SELECT * FROM companies",
    "dim_locations": BASE + "SELECT * FROM locations",
    "dim_roles": BASE + """SELECT md5(r.name) AS role_id, r.name, count(job_id) AS postings
FROM (VALUES ('role_a'), ('role_b'), ('role_c'), ('other')) r(name)
LEFT JOIN keyed ON role_name = r.name GROUP BY r.name""",
    "dim_skills": BASE + "SELECT skill_id, name, NULL::VARCHAR AS description, category FROM skills",
    "dim_certs": BASE + "SELECT cert_id, name, provider FROM certs",
    "bridge_job_skills": BASE + "SELECT DISTINCT job_id, md5(lower(slug)) AS skill_id FROM tagged",
    "bridge_job_certs": BASE + "SELECT DISTINCT job_id, md5(lower(cert_name)) AS cert_id FROM staging",
    "bridge_job_locations": BASE + "SELECT job_id, location_id FROM keyed WHERE location IS NOT NULL",
    "fact_postings": BASE + """SELECT job_id, md5(role_name) AS role_id, company_id, location_id, job_title,
       normalized_title, description AS job_description, url, seniority, date_posted,
       NULL::DATE AS date_reposted, closed_at::DATE AS closed_at, closed_at IS NULL AS is_open,
       remote, hybrid, min_salary_usd, max_salary_usd, avg_salary_usd, NULL::VARCHAR AS salary_currency,
       'batch_refresh' AS created_by, discovered_at::DATE AS _batch_date FROM keyed""",
    "fact_postings_slim": BASE + """SELECT job_id, job_title AS title, url, company_id, location_id,
       md5(role_name) AS role_id, date_posted AS posted_at, remote AS is_remote,
       discovered_at::DATE AS _batch_date FROM keyed""",
    "posting_lines": BASE + f"SELECT *, {AS_OF} AS business_date FROM lines",
    "posting_lines_star": BASE + """SELECT * REPLACE (
       array_to_string(skill_names, '|') AS skill_names, array_to_string(cert_names, '|') AS cert_names)
FROM lines""",
    "skill_daily": BASE + f", {SKILL_LOOKUP}, {_daily('skill_names', 'skill_name', 'skill_category')} "
    + "SELECT * RENAME (daily_id AS skills_daily_id) FROM daily",
    "cert_daily": BASE + f", {CERT_LOOKUP}, {_daily('cert_names', 'cert_name', 'cert_provider')} "
    + "SELECT * RENAME (daily_id AS cert_daily_id) FROM daily",
    "role_daily": BASE + _role_daily(AS_OF),
    "resolve_windows": _windows(),
    "insight_filters": BASE + f", {ROLE_OPTIONS} " + "\nUNION ALL ".join(
        _filter_block(*scope) for scope in (("NULL", "NULL"), ("'role_a'", "NULL"), ("NULL", "'MACHINERY'"))
    ),
    "filter_tag_values": BASE + """SELECT DISTINCT value, kind FROM (
    SELECT unnest(skill_names) AS value, 'skill' AS kind FROM lines
    UNION ALL SELECT unnest(cert_names), 'certification' FROM lines)""",
    "insight_skills": BASE + ", " + _top_tags("skill_names", "role_name = 'role_a'", "occurrence_pct"),
    "insight_skills_trending": BASE + ", " + _top_tags(
        "skill_names", "role_name = 'role_a' AND industry = 'MACHINERY'", "trend_delta_pp"),
    "insight_skills_cube": BASE + f""",
chosen AS (SELECT * FROM lines WHERE {IN_WINDOW}),
totals AS (SELECT role_name, coalesce(industry, 'all') AS industry,
                  {CUBE_HALVES.replace('AS n', 'AS t')} FROM chosen
           GROUP BY GROUPING SETS ((role_name, industry), (role_name))),
counted AS (SELECT role_name, coalesce(industry, 'all') AS industry, name, {CUBE_HALVES}
            FROM (SELECT role_name, industry, posting_date, unnest(skill_names) AS name FROM chosen)
            GROUP BY GROUPING SETS ((role_name, industry, name), (role_name, name))),
measured AS (SELECT role_name, industry, name, round_even({_pct('n', 't')}, 1) AS occurrence_pct,
       round_even({_pct('n_recent', 't_recent')} - {_pct('n_prior', 't_prior')}, 1) AS trend_delta_pp
       FROM counted JOIN totals USING (role_name, industry))
SELECT role_name, industry, row_number() OVER (PARTITION BY role_name, industry
       ORDER BY occurrence_pct DESC, name)::INTEGER AS rank, name, occurrence_pct,
       {_trend('trend_delta_pp')} AS trend, trend_delta_pp
FROM measured QUALIFY rank <= 20""",
    "insight_metrics": BASE + _metrics("2y", START, MIDDLE, PRIOR) + "\nUNION ALL "
    + _metrics("all", "DATE '1991-08-04'", "DATE '1996-08-02'", None),
    "insight_certs": BASE + f""",
chosen AS (SELECT job_id, cert_names FROM lines WHERE role_name = 'role_a' AND {IN_WINDOW}),
counted AS (SELECT cert, count(DISTINCT job_id) AS n FROM (SELECT job_id, unnest(cert_names) AS cert FROM chosen)
            GROUP BY cert),
measured AS (SELECT row_number() OVER (ORDER BY n DESC, cert)::INTEGER AS rank, cert,
       round_even({_pct('n', '(SELECT count(DISTINCT job_id) FROM chosen)')}, 1) AS occurrence_pct FROM counted)
SELECT rank, cert AS name, provider, occurrence_pct,
       CASE WHEN occurrence_pct >= 15 THEN 'High' WHEN occurrence_pct >= 5 THEN 'Medium' ELSE 'Low' END AS demand_badge
FROM measured LEFT JOIN certs ON certs.name = cert WHERE rank <= 5""",
    "insight_cert_trend": BASE + ", " + _top_tags("cert_names", "role_name = 'role_a'", "occurrence_pct"),
    "insight_jobs": BASE + f", {JOBS} " + """SELECT * EXCLUDE (posting_date) FROM chosen
ORDER BY posting_date DESC, job_id LIMIT 20 OFFSET 20""",
    "insight_jobs_after": BASE + f", {JOBS} " + """SELECT * EXCLUDE (posting_date) FROM chosen
WHERE posting_date < DATE '2000-08-01' OR (posting_date = DATE '2000-08-01' AND job_id > 0)
ORDER BY posting_date DESC, job_id LIMIT 20""",
    "insight_jobs_count": BASE + f", {JOBS} " + """SELECT count(*) AS total, 20 AS page_size,
       greatest(1, ceil(count(*) / 20))::BIGINT AS total_pages FROM chosen""",
    "measure_skill_window": BASE + f""",
chosen AS (SELECT * FROM lines WHERE {IN_WINDOW}),
days AS (SELECT posting_date, industry, count(*) AS t FROM chosen GROUP BY ALL),
counted AS (SELECT posting_date, industry, skill_name, count(*) AS n
            FROM (SELECT posting_date, industry, unnest(skill_names) AS skill_name FROM chosen) GROUP BY ALL),
summed AS (SELECT skill_name, sum(n)::BIGINT AS n, sum(t)::BIGINT AS t,
                  (SELECT count(*) FROM chosen) AS w
           FROM counted JOIN days USING (posting_date, industry) GROUP BY skill_name)
SELECT skill_name, n AS posting_appear_count, t AS total_posting_count, w AS window_posting_count,
       round_even({_pct('n', 'w')}, 1) AS occurrence_pct, round_even({_pct('n', 't')}, 1) AS declared_pct
FROM summed""",
    "measure_role_latest": BASE + f""", snapshots AS (
{_role_daily("DATE '2000-08-01'", "posting_date < DATE '2000-08-01'")}
UNION ALL {_role_daily(AS_OF, f"posting_date < {AS_OF}")})
SELECT role_name, """ + ", ".join(
        f"arg_max({m}, business_date) AS {m}" for m in (
            "job_postings_count", "open_roles_count", "min_salary", "max_salary", "median_salary")
    ) + " FROM snapshots GROUP BY role_name",
    "measure_postings": BASE + """SELECT role_name, seniority, industry, count(DISTINCT job_id) AS total_postings
FROM lines GROUP BY ALL""",
    "measure_repeated": """SELECT l_returnflag AS role_name, count(DISTINCT l_orderkey) AS total_postings
FROM lineitem GROUP BY l_returnflag""",
    "orphan_locations": BASE + """SELECT location_id, count(*) AS facts FROM keyed
WHERE location IS NOT NULL AND location_id NOT IN (SELECT location_id FROM keyed WHERE loc_continent = 'ASIA')
GROUP BY location_id""",
}
# Other ways to the same results.
ORACLE["scd1_upsert_buckets"] = ORACLE["scd1_upsert"]
ORACLE["measure_repeated_state"] = ORACLE["measure_repeated"]
for _name in ("skills", "cert_trend", "jobs", "jobs_count"):
    ORACLE[f"index_{_name}"] = ORACLE[f"insight_{_name}"]
ORACLE["role_daily_from_days"] = ORACLE["role_daily"]
