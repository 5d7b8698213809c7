"""Streams, sinks, snapshots and the refresh of all tables, on temporary folders."""

import json
import os
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from demandlens.operators import entities
from demandlens.plans import insight
from demandlens.plans import refresh as refresh_plan
from demandlens.plans.refresh import Settings, refresh
from demandlens.schema import BRONZE, RECORD
from demandlens.sources import landing, order_feed as feed, tables
from demandlens.streaming.ingest import read_bronze, read_lost, read_rejects, stream_ingest


def write_lines(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines)
    (folder / name).write_text(text + "\n")


@pytest.fixture
def ingest(spark, tmp_path):
    def run():
        stream_ingest(spark, str(tmp_path / "landing"), str(tmp_path / "bronze"), str(tmp_path / "check"))
        return read_bronze(spark, str(tmp_path / "bronze")), read_rejects(spark, str(tmp_path / "bronze"))

    return tmp_path / "landing", run


def test_stream_reads_each_file_once(ingest):
    landing_dir, run = ingest
    write_lines(landing_dir, "a.json",
                {"id": 1, "job_title": "A", "locations": [{"id": 9, "name": "here"}],
                 "company_object": {"name": "C", "founded_year": 1999}},
                {"id": 2, "locations": []})
    first, _ = run()
    assert {r["job_id"]: (r["loc_id"], r["co_founded_year"]) for r in first.collect()} == {
        1: (9, 1999), 2: (None, None)}
    assert first.schema.names == BRONZE.names
    write_lines(landing_dir, "b.json", {"id": 1, "closed_at": "2024-05-01T00:00:00"})
    second, _ = run()
    assert sorted(r["job_id"] for r in second.collect()) == [1, 1, 2]
    again, _ = run()
    assert again.count() == 3


def test_stream_quarantines_and_goes_on(ingest):
    landing_dir, run = ingest
    write_lines(landing_dir, "a.json", "{broken", {"job_title": "no id"}, {"id": "n/a", "job_title": "x"},
                {"id": 5, "date_posted": "soon", "surprise": {"deep": 1}})
    good, bad = run()
    row, = good.collect()
    assert (row["job_id"], row["date_posted"]) == (5, None)
    raw = [r["_bad_record"] for r in bad.collect()]
    assert len(raw) == 3 and "{broken" in raw


def test_stream_reads_late_and_nested_files(ingest):
    landing_dir, run = ingest
    write_lines(landing_dir, "a.json", {"id": 1})
    run()
    write_lines(landing_dir / "2024" / "05", "b.json", {"id": 2})
    write_lines(landing_dir, "late.json", {"id": 3})
    month_ago = time.time() - 30 * 86400
    os.utime(landing_dir / "late.json", (month_ago, month_ago))
    good, _ = run()
    assert sorted(r["job_id"] for r in good.collect()) == [1, 2, 3]


def test_stream_keeps_values_of_another_type(ingest, spark):
    landing_dir, run = ingest
    write_lines(landing_dir, "a.json", {
        "id": "77", "min_annual_salary_usd": "90000", "remote": "true", "job_title": 5, "employment_statuses": ["x"],
        "date_posted": "soon", "company_object": {"employee_count": 12.0, "industry_id": "7", "founded_year": "old"},
        "discovered_at": "2024-05-01T10:00:00Z", "locations": [{"id": "9"}],
    })
    good, bad = run()
    row, = good.collect()
    assert bad.count() == 0
    assert (row["job_id"], row["min_annual_salary_usd"], row["remote"], row["job_title"]) == (77, 90000.0, True, "5")
    assert (row["co_employee_count"], row["co_industry_id"], row["loc_id"]) == (12, 7, 9)
    assert row["discovered_at"] is not None and row["employment_statuses"] == ["x"]
    lost, = read_lost(spark, str(landing_dir.parent / "bronze")).collect()
    assert {(v["name"], v["value"]) for v in lost["_unconverted"]} == {("date_posted", "soon"), ("co_founded_year", "old")}


def test_inferred_schema_round_trip(spark, tmp_path):
    write_lines(tmp_path / "in", "a.json", {"id": 1, "tags": ["x"], "nested": {"a": 1.5}})
    schema = landing.infer_schema(spark, str(tmp_path / "in"))
    landing.save_schema(spark, schema, str(tmp_path / "schema"))
    assert landing.load_schema(spark, str(tmp_path / "schema")) == schema
    flat = landing.flatten(spark.read.schema(schema).json(str(tmp_path / "in")))
    assert [r["job_id"] for r in flat.collect()] == [1]


def test_batch_json(spark, tmp_path):
    write_lines(tmp_path / "in", "a.json", {"id": 1}, "{broken")
    flat = landing.flatten(landing.read_json(spark, str(tmp_path / "in")))
    assert landing.with_key(flat).count() == landing.without_key(flat).count() == 1


def test_overwrite_replaces_schema_and_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string")
    tables.overwrite(days, path, "day")
    tables.overwrite(spark.createDataFrame([(3, "b")], "v int, day string"), path, "day", touched_only=True)
    assert {(r["v"], r["day"]) for r in tables.read_table(spark, path).collect()} == {(1, "a"), (3, "b")}
    tables.overwrite(spark.createDataFrame([(7,)], "other int"), path)
    assert tables.read_table(spark, path).columns == ["other"]


def test_declared_schema_fills_missing_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.createDataFrame([(1,)], "a int"), path)
    tables.append(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    from pyspark.sql.types import IntegerType, StringType, StructType
    schema = StructType().add("a", IntegerType()).add("b", StringType())
    assert {tuple(r) for r in tables.read_table(spark, path, schema).collect()} == {(1, None), (2, "x")}


def test_snapshots(spark, tmp_path):
    snapshots = tables.Snapshots(spark, str(tmp_path / "dim"))
    assert snapshots.current() is None
    snapshots.publish(spark.range(1))
    snapshots.publish(snapshots.current().unionByName(spark.range(5, 6)))
    (tmp_path / "dim" / "v=3").mkdir()  # a run that never committed
    assert sorted(r["id"] for r in snapshots.current().collect()) == [0, 5]


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS buckets LOCATION '{tmp_path}/db'")
    try:
        for name in ("fact", "bridge"):
            tables.overwrite_bucketed(spark.range(100).withColumnRenamed("id", "job_id"), f"buckets.{name}", "job_id", 4)
        joined = spark.table("buckets.fact").hint("merge").join(spark.table("buckets.bridge"), "job_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.sql("DROP DATABASE buckets CASCADE")


AS_OF, AT = date(2001, 8, 1), datetime(2001, 8, 1)
BASICS = ["job_id", "role_name", "industry", "company", "country", "skill_names", "cert_names"]


def test_refresh(spark, sf_dir, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    terms = [(t.pattern, t.name, t.provider) for t in feed.TERMS]

    def extractor(text):
        import uuid
        (calls / uuid.uuid4().hex).touch()
        return [{"name": n, "provider": p} for pattern, n, p in terms if pattern in text]

    # A few weeks: every day is a folder in five tables, written three times.
    bronze = feed.postings(spark, sf_dir).where(F.col("date_posted") >= F.lit(date(2001, 6, 15)))
    common = {"as_of": AS_OF, "at": AT, "taxonomy": feed.ROLES,
              "continent_codes": tuple(feed.CONTINENT_CODES.items())}
    plain = refresh(spark, bronze, Settings(str(tmp_path / "a"), terms=feed.TERMS, **common))
    called = refresh(spark, bronze, Settings(str(tmp_path / "b"), extractor=extractor, **common))
    rows = sorted(map(str, plain["job_posting_lines"].select(BASICS).collect()))
    assert rows == sorted(map(str, called["job_posting_lines"].select(BASICS).collect()))
    assert plain["skill_daily"].select("skills_daily_id").distinct().count() == plain["skill_daily"].count()

    made = len(list(calls.iterdir()))
    later = {**common, "as_of": date(2001, 9, 1), "at": datetime(2001, 9, 1)}
    again = refresh(spark, bronze, Settings(str(tmp_path / "b"), extractor=extractor, **later))
    assert len(list(calls.iterdir())) == made > 0
    assert again["companies"].where(F.col("updated_date") > F.lit(AT)).count() == 0
    assert again["role_daily"].select("business_date").distinct().count() == 2
    assert insight.skills(again["job_posting_lines"], "role_a", "2y", as_of=AS_OF, taxonomy=feed.ROLES).count() > 0


def test_extraction_keeps_what_is_committed(spark, tmp_path, monkeypatch):
    latest = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "job_id long, description string")
    settings = Settings(str(tmp_path), date(2024, 1, 1), datetime(2024, 1, 1), extractor=lambda text: [{"name": text}])
    whole, calls = entities.extract_texts, []

    def failing(texts, extractor):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return whole(texts, extractor)

    monkeypatch.setattr(entities, "extract_texts", failing)
    with pytest.raises(RuntimeError):
        refresh_plan._staging(spark, latest, settings)
    kept = tables.read_table(spark, settings.path("entity_results")).count()
    assert 0 < kept < 40
    found = refresh_plan._staging(spark, latest, settings)
    assert sorted(r["cert_name"] for r in found.collect()) == sorted(f"text {i}" for i in range(40))
    assert tables.read_table(spark, settings.path("entity_results")).count() == 40


def test_record_fields_are_nullable():
    assert all(f.nullable for f in RECORD.fields)
