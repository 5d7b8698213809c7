"""Headline queries, timed; prints one JSON line.

``queries`` holds seconds per query: the registered queries from the given
tables, and ``stored_*`` for the same questions over posting lines that were
written once, as a service would read them. ``compare`` holds other ways to the
central figures of a query, without its order, labels and keys, and the dictionary
search with 4, 400 and 4,000 terms. Each figure is the median of the runs after one warm-up; every
run plans anew, so nothing is reused between runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks.queries import AS_OF, QUERIES, RANGE, ROLE, SKILL, certs, latest, lines  # noqa: E402
from demandlens.functions.dates import resolve_window  # noqa: E402
from demandlens.operators.entities import dictionary_entities  # noqa: E402
from demandlens.plans import demand_index, dims, insight, marts  # noqa: E402
from demandlens.plans.lines import COLUMNS  # noqa: E402
from demandlens.rules import Term  # noqa: E402
from demandlens.session import spark_session  # noqa: E402
from demandlens.sources import order_feed as feed  # noqa: E402
from demandlens.sources.tables import overwrite, read_table  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

FROM_TABLES = [
    "bronze_flatten", "classify_role", "latest_posting", "scd1_upsert", "entity_extract",
    "extract_callable", "dim_companies", "dim_skills", "bridge_job_skills", "fact_postings",
    "posting_lines", "posting_lines_star", "skill_daily", "cert_daily", "role_daily",
    "insight_filters", "insight_skills", "insight_skills_cube", "insight_metrics", "insight_certs",
    "insight_jobs", "measure_role_latest",
]


def run_all(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(action: Callable[[], None], runs: int = RUNS) -> float:
    action()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def naive_skills(stored: DataFrame) -> DataFrame:
    """Distinct counts with conditions, and the selection read twice."""
    window = resolve_window(RANGE, AS_OF)
    day = F.col("posting_date")
    chosen = stored.where((F.col("role_name") == ROLE) & window.current(day))

    def counts(prefix: str):
        job, middle = F.col("job_id"), F.lit(window.midpoint)
        return [F.count_distinct(job).alias(prefix),
                F.count_distinct(F.when(day < middle, job)).alias(f"{prefix}_prior"),
                F.count_distinct(F.when(day >= middle, job)).alias(f"{prefix}_recent")]

    tags = chosen.withColumn("name", F.explode("skill_names")).groupBy("name").agg(*counts("n"))
    return tags.join(F.broadcast(chosen.agg(*counts("t")))).select(
        "name", F.bround(100 * F.col("n") / F.col("t"), 1),
        F.bround(100 * F.col("n_recent") / F.col("t_recent") - 100 * F.col("n_prior") / F.col("t_prior"), 1),
    )


def naive_skill_daily(stored: DataFrame) -> DataFrame:
    keys = ["posting_date", "industry"]
    tags = stored.withColumn("skill_name", F.explode("skill_names"))
    appear = tags.groupBy(*keys, "skill_name").agg(F.count_distinct("job_id").alias("a"))
    return appear.join(stored.groupBy(*keys).agg(F.count_distinct("job_id").alias("t")), keys)


def terms_of(count: int) -> tuple[Term, ...]:
    """The feed's terms and further ones that occur nowhere."""
    return feed.TERMS + tuple(Term(f"Certificate No. {i}", f"c{i}", None) for i in range(count - len(feed.TERMS)))


def _names_per_row(text):
    return [t.name for t in feed.TERMS if text and t.pattern in text]


def main() -> None:
    spark = spark_session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    started = time.perf_counter()
    timed = {key: seconds(lambda key=key: run_all(QUERIES[key](spark, SF_DIR))) for key in FROM_TABLES}

    # BENCH_DIR: a folder that all executors share; by default one of this machine.
    base = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("BENCH_DIR"))
    start = time.perf_counter()
    overwrite(lines(spark, SF_DIR, *COLUMNS), f"{base}/lines", "posting_date")
    timed["build_lines"] = round(time.perf_counter() - start, 3)
    overwrite(dims.skills(latest(spark, SF_DIR, feed.TAGS)), f"{base}/skills")
    overwrite(certs(spark, SF_DIR), f"{base}/certs")
    stored = read_table(spark, f"{base}/lines")
    overwrite(demand_index.demand_index(stored), f"{base}/index", demand_index.MONTH)
    index = read_table(spark, f"{base}/index")
    skills, named = read_table(spark, f"{base}/skills"), read_table(spark, f"{base}/certs")
    asked = {"as_of": AS_OF, "taxonomy": feed.ROLES}
    questions = {
        "skills": lambda: insight.skills(stored, ROLE, RANGE, **asked),
        "skills_cube": lambda: insight.skills_for_all(stored, RANGE, as_of=AS_OF),
        "metrics": lambda: insight.metrics(stored, ROLE, (RANGE,), **asked),
        "certs": lambda: insight.certifications(stored, named, ROLE, RANGE, **asked),
        "filters": lambda: insight.filters(stored, ROLE, taxonomy=feed.ROLES),
        "jobs": lambda: insight.jobs(stored, ROLE, RANGE, skill=SKILL, page=2, **asked),
        "jobs_count": lambda: insight.jobs_count(stored, ROLE, RANGE, skill=SKILL, **asked),
        "skills_by_index": lambda: demand_index.skills(index, ROLE, RANGE, **asked),
        "jobs_by_index": lambda: demand_index.jobs(stored, index, ROLE, RANGE, skill=SKILL, page=2, **asked),
        "jobs_count_by_index": lambda: demand_index.jobs_count(index, ROLE, RANGE, skill=SKILL, **asked),
        "skill_daily": lambda: marts.skill_daily(stored, skills, AS_OF),
        "role_daily": lambda: marts.role_daily(stored, AS_OF),
    }
    for name, ask in questions.items():
        timed[f"stored_{name}"] = seconds(lambda ask=ask: run_all(ask()))

    roles_industries = [(r["role_name"], r["industry"]) for r in stored.select("role_name", "industry").distinct()
                        .where(F.col("role_name") != "other").collect()]

    def one_request_each() -> None:
        for role, industry in roles_industries:
            run_all(insight.skills(stored, role, RANGE, industry, **asked))

    documents = feed.table(spark, SF_DIR, "documents")
    per_row = F.udf(_names_per_row, "array<string>", useArrow=False)
    compare = {
        "stored_skills_multi_distinct": seconds(lambda: run_all(naive_skills(stored))),
        "stored_skill_daily_count_distinct": seconds(lambda: run_all(naive_skill_daily(stored))),
        "stored_skills_cube_one_request_each": seconds(one_request_each, 1),
        **{f"dictionary_{n}_terms": seconds(lambda n=n: run_all(documents.select(
            "doc_id", dictionary_entities("text", terms_of(n))))) for n in (4, 400, 4000)},
        "entity_extract_row_udf": seconds(lambda: run_all(documents.select("doc_id", per_row("text")))),
    }
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": timed, "compare": compare, "sf": Path(SF_DIR).name, "cpus": int(CPUS), "runs": RUNS,
        "wall": round(time.perf_counter() - started, 1),
    }))


if __name__ == "__main__":
    main()
