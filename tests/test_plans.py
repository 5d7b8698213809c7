"""Shape of the physical plans, and results when one key holds a third of all rows."""

import random
import re
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import queries as q
from checks.queries import QUERIES
from demandlens.operators import entities
from demandlens.operators.latest import latest_by_key
from demandlens.operators.medians import summarize_with_median
from demandlens.plans import insight, marts, quality
from demandlens.sources import order_feed as feed
from demandlens.sources.landing import discovered_after


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    execution = df._jdf.queryExecution()
    df.collect()
    return execution.executedPlan().toString()


#: Queries that search texts by a callable; dictionaries are built-in functions.
SEARCHING = {"extract_callable"}


@pytest.mark.parametrize("key", QUERIES)
def test_plan_shape(spark, sf_dir, key):
    """No cross join, no DISTINCT expansion, Python only where a callable searches texts."""
    text = plan(QUERIES[key](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Expand" not in text or key == "insight_skills_cube"
    assert ("InPandas" in text or "EvalPython" in text) is (key in SEARCHING)


def test_versions_are_cut_before_the_shuffle(spark, sf_dir):
    text = plan(q.latest_posting(spark, sf_dir))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_incremental_bound_reaches_the_scan(spark, sf_dir):
    assert "GreaterThanOrEqual(ts,2024-01-16" in plan(q.incremental_scan(spark, sf_dir))


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines") / "lines")
    from demandlens.plans.lines import COLUMNS
    from demandlens.sources.tables import overwrite
    overwrite(q.lines(spark, sf_dir, *COLUMNS), path, "posting_date")
    return spark.read.parquet(path)


ASKED = {"as_of": q.AS_OF, "taxonomy": q.feed.ROLES}


def test_skills_read_the_lines_once(stored):
    df = insight.skills(stored, q.ROLE, q.RANGE, **ASKED)
    assert "ReusedExchange" in executed(df)
    initial = plan(insight.skills(stored, q.ROLE, q.RANGE, **ASKED))
    assert "PartitionFilters: [isnotnull(posting_date" in initial
    assert "description" not in initial


def test_page_reads_wide_columns_for_the_page_only(stored):
    text = plan(insight.jobs(stored, q.ROLE, q.RANGE, page=2, **ASKED))
    assert "dynamicpruning" in text
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert sum("description" in s for s in scans) == 1


def test_filters_read_the_lines_once(stored):
    scopes = [(None, None), (q.ROLE, None), (None, q.INDUSTRY)]
    text = executed(insight.filters_for(stored, scopes, q.feed.ROLES))
    assert text.split("== Initial Plan ==")[0].count("FileScan") == 1


# --- one key with a third of the rows ------------------------------------------------

N = 3000


@pytest.fixture(scope="module")
def skewed():
    """(id, key, day, value, tags): key 0 holds a third of the rows."""
    pick = random.Random(7)
    return [
        (i, 0 if i % 3 == 0 else pick.randrange(1, 400), date(2024, 6, 1 + pick.randrange(28)),
         pick.choice([None, 50_000.0, round(pick.uniform(1, 3e5), 2)]),
         ["hot"] * (i % 3 == 0) + pick.sample(["a", "b", "c", "d"], pick.randrange(4)))
        for i in range(N)
    ]


@pytest.fixture(scope="module")
def skewed_df(spark, skewed):
    return spark.createDataFrame(
        skewed, "id long, key long, day date, value double, tags array<string>").repartition(7)


def test_hot_key_latest(skewed, skewed_df):
    got = latest_by_key(skewed_df, ["key"], [F.desc("day"), F.desc("id")]).collect()
    expected = {}
    for i, key, day, *_ in skewed:
        expected[key] = max(expected.get(key, (day, i)), (day, i))
    assert {r["key"]: (r["day"], r["id"]) for r in got} == expected


def test_hot_group_median(skewed, skewed_df):
    rows = skewed_df.withColumn("hot", F.col("key") == 0)
    got = {r["hot"]: r["m"] for r in summarize_with_median(rows, ["hot"], "value", "m").collect()}
    for hot in (True, False):
        known = sorted(v for _, k, _, v, _ in skewed if (k == 0) is hot and v is not None)
        assert got[hot] == known[(len(known) - 1) // 2]


def test_hot_day_and_tag(skewed, skewed_df):
    lines = skewed_df.select(
        F.when(F.col("key") == 0, F.lit(date(2024, 6, 1))).otherwise(F.col("day")).alias("posting_date"),
        F.lit("X").alias("industry"), F.col("tags").alias("skill_names"))
    skills = skewed_df.select(F.explode("tags").alias("name"), F.lit("technology").alias("category")).distinct()
    got = {(r["posting_date"], r["skill_name"]): (r["posting_appear_count"], r["total_posting_count"])
           for r in marts.skill_daily(lines, skills).collect()}
    days = [(date(2024, 6, 1) if k == 0 else d, t) for _, k, d, _, t in skewed]
    totals = Counter(d for d, _ in days)
    appear = Counter((d, tag) for d, tags in days for tag in set(tags))
    assert got == {(d, tag): (n, totals[d]) for (d, tag), n in appear.items()}


def test_text_shared_by_a_third(spark, skewed):
    docs = spark.createDataFrame([(i, "MIT License" if k == 0 else f"text {i}") for i, k, *_ in skewed], "id long, t string")
    texts = entities.pending_texts(docs, "t")
    assert texts.count() == len({t for t in ("MIT License" if k == 0 else f"text {i}" for i, k, *_ in skewed)})
    staged = texts.select("text_hash", entities.dictionary_entities("text", q.feed.TERMS).alias("entities"),
                          F.lit(None).cast("string").alias("error"))
    hits = entities.staged_entities(docs, "id", "t", staged)
    assert hits.count() == sum(k == 0 for _, k, *_ in skewed)


def test_orphans_of_a_hot_key(skewed, skewed_df):
    dim = skewed_df.select("key").distinct().where("key > 10")
    got = {r["key"]: r["facts"] for r in quality.orphan_keys(skewed_df, dim, "key").collect()}
    assert got == Counter(k for _, k, *_ in skewed if k <= 10)


def test_undated(spark):
    rows = spark.createDataFrame([(None,), (date(2024, 1, 1),)], "posting_date date")
    assert quality.undated(rows).first()["undated_postings"] == 1


def test_pages_cover_every_row_once(spark, skewed_df):
    lines = skewed_df.select(
        F.col("id").alias("job_id"), F.col("day").alias("posting_date"), F.col("day").alias("date_posted"),
        F.lit("data_engineer").alias("role_name"), F.lit("X").alias("industry"),
        F.col("tags").alias("skill_names"),
        *[F.lit(None).cast("string").alias(c) for c in insight.JOB_COLUMNS
          if c not in ("job_id", "date_posted")],
    ).where("id < 120")
    common = {"as_of": date(2024, 6, 30), "page_size": 50}
    paged = [r["job_id"] for page in (1, 2, 3, 4)
             for r in insight.jobs(lines, "data_engineer", page=page, **common).collect()]
    walked, after = [], None
    while rows := insight.jobs(lines, "data_engineer", after=after, **common).collect():
        walked += [r["job_id"] for r in rows]
        after = (rows[-1]["date_posted"], rows[-1]["job_id"])
    assert paged == walked and sorted(paged) == list(range(120))


def test_day_bound_equals_day_comparison(spark):
    rows = spark.sql("SELECT explode(sequence(timestamp'2024-01-14', timestamp'2024-01-18', interval 6 hours)) AS discovered_at")
    since = date(2024, 1, 15)
    got = discovered_after(rows, since).collect()
    assert sorted(got) == sorted(rows.where(F.to_date("discovered_at") > F.lit(since)).collect())
    assert discovered_after(rows, None).count() == rows.count()


def test_skills_read_their_input_once(spark, sf_dir):
    assert plan(q.dim_skills(spark, sf_dir)).count("lineitem.parquet") == 1


def test_deep_pages_keep_one_page(spark, sf_dir):
    rows = q.lines(spark, sf_dir, *q.JOB_LINES)
    text = plan(insight.jobs(rows, q.ROLE, q.RANGE, page=100_000, as_of=q.AS_OF, taxonomy=feed.ROLES))
    assert "TakeOrderedAndProject" not in text and "offset" not in text.lower()


def test_pages_are_the_whole_list(spark, sf_dir):
    rows = q.lines(spark, sf_dir, *q.JOB_LINES)
    asked = {"as_of": q.AS_OF, "taxonomy": feed.ROLES, "page_size": 50}
    pages = [insight.jobs(rows, q.ROLE, q.RANGE, page=p, **asked).collect() for p in (1, 2, 3, 4)]
    ids = [r["job_id"] for page in pages for r in page]
    whole = rows.where((F.col("role_name") == q.ROLE) & q.resolve_window(q.RANGE, q.AS_OF).current(F.col("posting_date")))
    want = [r["job_id"] for r in whole.orderBy(F.desc("posting_date"), "job_id").limit(200).collect()]
    assert ids == want


#: Queries whose rows carry, or are made from, whole texts of postings.
TEXTED = (
    "cert_daily", "entity_staging", "fact_postings", "index_jobs", "insight_certs", "posting_lines", "posting_lines_star",
    "bridge_job_certs", "dim_certs", "filter_tag_values", "insight_jobs", "insight_jobs_after", "index_jobs_count",
    "index_cert_trend", "index_skills", "insight_cert_trend",
)
#: Only documents go to their ids and distinct texts to their hashes.
CARRIED = ({"doc_id", "text"}, {"text_id", "_text"}, {"text_hash", "text"})


def moved(df):
    """Column names that each shuffle, sort and window of a plan takes in; a page's last sort, over all of its few rows, apart."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    for node in text.split("\n\n"):
        head = re.match(r"\(\d+\) (\w+)", node)
        given = re.search(r"^Input \[\d+\]: \[(.*)\]", node, re.M)
        ordered = re.search(r"^Arguments: (rangepartitioning|.*\], true, )", node, re.M)
        if head and given and not ordered and head[1] in ("Exchange", "Sort", "SortAggregate", "Window", "WindowGroupLimit"):
            yield head[1], {re.sub(r"#\d+L?$", "", c) for c in given[1].split(", ")}


@pytest.mark.parametrize("key", TEXTED)
def test_texts_cross_no_shuffle_of_postings(spark, sf_dir, key):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nodes = list(moved(QUERIES[key](spark, sf_dir)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert any("doc_id" in names or "text_id" in names for _, names in nodes)
    for kind, names in nodes:
        texts = names & {"text", "_text", "description", "job_description"}
        assert not texts or any(names <= allowed for allowed in CARRIED), (kind, names)


def test_texts_by_reference(spark, tmp_path):
    """A reference without a text, a null text, and an id of two documents."""
    spark.createDataFrame([(1, "one"), (2, None), (3, "b"), (3, "a"), (None, "x")], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    rows = spark.createDataFrame([(10, 1), (11, 1), (12, 2), (13, 3), (14, 9), (15, None)], "job_id long, text_id long")
    got = feed.with_texts(rows, str(tmp_path))
    assert got.columns == ["job_id", "description"]
    assert dict(map(tuple, got.collect())) == {10: "one", 11: "one", 12: None, 13: "a", 14: None, 15: None}
