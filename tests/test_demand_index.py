"""Answers from the demand index against answers from posting lines."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from checks.queries import AS_OF, RANGE, lines
from demandlens.plans import demand_index, insight
from demandlens.plans.lines import COLUMNS
from demandlens.sources import order_feed as feed
from demandlens.sources.tables import overwrite, read_table

ASK = {"date_range": RANGE, "as_of": AS_OF, "taxonomy": feed.ROLES}


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Lines by day, some without a day, some tags repeated or null; and their index by month."""
    base = str(tmp_path_factory.mktemp("index"))
    rows = lines(spark, sf_dir, *COLUMNS).where(F.col("posting_date") >= F.lit(AS_OF - timedelta(days=70)))
    odd = F.concat("skill_names", F.array(F.lit(None).cast("string")), F.slice("skill_names", 1, 1))
    rows = rows.withColumn("skill_names", F.when(F.col("job_id") % 5 == 0, odd).otherwise(F.col("skill_names")))
    rows = rows.withColumn("posting_date", F.when(F.col("job_id") % 13 != 0, F.col("posting_date")))
    overwrite(rows, f"{base}/lines", "posting_date")
    found = read_table(spark, f"{base}/lines")
    overwrite(demand_index.demand_index(found), f"{base}/index", demand_index.MONTH)
    return found, read_table(spark, f"{base}/index")


@pytest.fixture(scope="module")
def role(stored):
    """The role with most postings."""
    known = stored[0].where(F.col("role_name").isin(list(feed.ROLES.selectable)) & F.col("posting_date").isNotNull())
    return known.groupBy("role_name").count().orderBy(F.desc("count")).first()["role_name"]


def same(a, b):
    assert a.columns == b.columns
    found = a.collect()
    assert found == b.collect()
    return found


@pytest.mark.parametrize("industry", [None, "MACHINERY"])
@pytest.mark.parametrize("sort", ["occurrence", "trending"])
def test_skills(stored, industry, sort):
    rows, index = stored
    for role in feed.ROLES.selectable[:2]:
        for tags in ("skill_names", "cert_names"):
            asked = dict(role=role, industry=industry, sort=sort, tags=tags, **ASK)
            same(insight.skills(rows, **asked), demand_index.skills(index, **asked))


@pytest.mark.parametrize("direct", [0, 1000])
def test_pages(stored, role, direct, monkeypatch):
    monkeypatch.setattr(demand_index, "DIRECT", direct)
    rows, index = stored
    skill = rows.where(F.col("role_name") == role).select(F.explode("skill_names").alias("s")).groupBy("s").count().orderBy(F.desc("count"), "s").first()["s"]
    for more in ({}, {"skill": skill}, {"industry": "MACHINERY"}, {"certificate": "MIT License"}, {"skill": "none"}):
        total = same(insight.jobs_count(rows, role, page_size=3, **more, **ASK), demand_index.jobs_count(index, role, page_size=3, **more, **ASK))
        for page in {1, 2, total[0]["total_pages"], total[0]["total_pages"] + 1}:
            asked = dict(role=role, page=page, page_size=3, **more, **ASK)
            same(insight.jobs(rows, **asked), demand_index.jobs(rows, index, **asked))


def test_page_reads_its_days_only(spark, stored, role):
    rows, index = stored
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    df = demand_index.jobs(rows, index, role, page=2, page_size=3, **ASK)
    wanted = {r["date_posted"] for r in df.collect()}
    assert wanted
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    days = {d for i in range(80) if str(d := AS_OF - timedelta(days=i)) in plan.split("PartitionFilters")[1].split("PushedFilters")[0]}
    assert 1 <= len(days) <= 3 + 1  # the page's, and the start of the window
    assert {d.date() if hasattr(d, "date") else d for d in wanted} <= days


def test_page_days(spark):
    rows = spark.createDataFrame([(date(2024, 1, d), n) for d, n in ((1, 5), (2, 1), (2, 1), (4, 3), (9, 1))], "posting_date date, n long")
    d = {i: date(2024, 1, i) for i in range(1, 10)}
    assert demand_index.page_days(rows, 0, 1) == ([d[9]], 0)
    assert demand_index.page_days(rows, 2, 3) == ([d[4], d[2]], 1)
    assert demand_index.page_days(rows, 8, 9) == ([d[1]], 2)
    assert demand_index.page_days(rows, 11, 5) == ([], 0)


def test_arguments(stored):
    rows, index = stored
    role = feed.ROLES.selectable[0]
    for wrong in (lambda: demand_index.skills(index, "nobody", **ASK), lambda: demand_index.skills(index, role, tags="other", **ASK),
                  lambda: demand_index.skills(index, role, sort="up", **ASK), lambda: demand_index.jobs(rows, index, role, page=0, **ASK),
                  lambda: demand_index.jobs_count(index, role, skill="a", certificate="b", **ASK)):
        with pytest.raises(ValueError):
            wrong()
