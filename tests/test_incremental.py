"""Tables of parts, upserts by buckets, and batches against full rebuilds."""

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from demandlens.operators.medians import median_state, summarize_with_median, summary_of_state
from demandlens.operators.upsert import first_load, scd1_upsert, upsert_parts
from demandlens.plans import incremental, marts
from demandlens.plans.incremental import TABLES, apply_batch
from demandlens.plans.refresh import Settings, refresh
from demandlens.sources import order_feed as feed
from demandlens.sources.parts import Parts, bucket

AS_OF, AT = date(2001, 8, 1), datetime(2001, 8, 1)
COMMON = {"as_of": AS_OF, "at": AT, "taxonomy": feed.ROLES, "continent_codes": tuple(feed.CONTINENT_CODES.items()), "terms": feed.TERMS}
STAMPS = {"created_date", "updated_date", "business_date", "bucket", "_given", "_entities"}


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def rows(df):
    return sorted(str(tuple(r)) for r in df.select(sorted(c for c in df.columns if c not in STAMPS)).collect())


def test_parts(spark, tmp_path):
    table = Parts(spark, str(tmp_path / "t"), "day")
    assert not table.exists() and table.batch() == -1
    d = [date(2024, 1, i) for i in range(1, 5)]
    make = lambda *rows: spark.createDataFrame(rows, "v int, day date")
    table.replace(make((1, d[0]), (2, d[1]), (3, None)), batch=4)
    kept, before = files(tmp_path / "t/data"), table.read()
    table.replace(make((20, d[1]), (4, d[2])), [d[1], d[2], d[3]], 5)
    assert sorted((r["v"], r["day"]) for r in table.read().where("day is not null").collect()) == [(1, d[0]), (4, d[2]), (20, d[1])]
    assert [tuple(r) for r in table.read([None]).collect()] == [(3, None)]
    assert {k: v for k, v in files(tmp_path / "t/data").items() if k in kept} == kept
    assert sorted(r["v"] for r in before.collect()) == [1, 2, 3]  # a reader from before the write
    assert table.read([d[3]]).collect() == [] and table.read([d[3]]).schema == table.read().schema
    table.replace(make(), [None, d[0]], 6)
    assert table.batch() == 6 and len(table.parts()) == 2
    # A write that never committed its manifest does not count.
    make((9, d[0])).write.partitionBy("day").parquet(str(tmp_path / "t/data/version=9"))
    assert sorted(r["v"] for r in table.read().collect()) == [4, 20]
    assert table.drop_unused(1) == 3
    assert sorted(r["v"] for r in table.read().collect()) == [4, 20]
    empty = Parts(spark, str(tmp_path / "e"), "day")
    assert empty.replace(make()).collect() == [] and empty.exists()


def test_upsert_touches_buckets_of_incoming_keys_only(spark, tmp_path):
    then, now = datetime(2024, 1, 1), datetime(2024, 2, 1)
    stored = spark.range(200).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("a"), F.lit(None).cast("string").alias("b"))
    updates = spark.createDataFrame([("3", 0, None), ("4", 7, "x"), ("new", 1, None)], "k string, a long, b string")
    table = Parts(spark, str(tmp_path / "t"), "bucket")
    upsert_parts(table, stored, "k", ["a", "b"], 16, then)
    before = files(tmp_path / "t/data")
    found = upsert_parts(table, updates, "k", ["a", "b"], 16, now)
    expect = scd1_upsert(first_load(stored, "k", ["a", "b"], then), updates, "k", ["a", "b"], now)
    assert sorted(map(tuple, found.drop("bucket").select(expect.columns).collect())) == sorted(map(tuple, expect.collect()))
    touched = {r[0] for r in updates.select(bucket("k", 16)).collect()}
    written = [f for f in files(tmp_path / "t/data") if f not in before]
    assert {int(Path(f).parent.name[7:]) for f in written} == touched and len(touched) < 4
    assert all(files(tmp_path / "t/data")[f] == m for f, m in before.items())


def test_states_of_days_add_up(spark):
    lines = spark.createDataFrame(
        [(i % 7, f"r{i % 3}", None if i % 11 == 0 else float((i * 7919) % 1000) / 7, i % 2 == 0) for i in range(900)] + [(1, "none", None, True)],
        "day int, role string, v double, open boolean")
    counts = {"n": F.count("*"), "n_open": F.count_if("open")}
    whole = summarize_with_median(lines, ["role"], "v", "median", counts, {"low": "v"}, {"high": "v"})
    state = median_state(lines, ["day", "role"], "v", counts, {"low": "v"}, {"high": "v"})
    added = summary_of_state(state, lines, ["role"], "v", "median", ["n", "n_open"], ["low"], ["high"])
    assert rows(whole) == rows(added)
    some = lines.where("day in (2, 3)")
    assert rows(summary_of_state(state.where("day in (2, 3)"), some, ["role"], "v", "median", ["n"])) == rows(
        summarize_with_median(some, ["role"], "v", "median", {"n": F.count("*")}))


@pytest.fixture(scope="module")
def halves(spark, sf_dir, tmp_path_factory):
    """Some weeks of postings, and a later batch: new postings, sent-again rows and newer versions with everything moved."""
    base = str(tmp_path_factory.mktemp("halves"))
    bronze = feed.postings(spark, sf_dir).where(F.col("date_posted") >= F.lit(date(2001, 5, 15)))
    bronze.write.parquet(f"{base}/bronze")
    bronze = spark.read.parquet(f"{base}/bronze")
    key = F.col("job_id")
    part = F.pmod(F.xxhash64("job_id"), F.lit(8))
    first = bronze.where((part != 0) & ~((part == 2) & (F.col("date_posted") > F.lit(date(2001, 7, 20)))))
    newer = bronze.where(part == 1).withColumns({
        "discovered_at": F.col("discovered_at") + F.expr("interval 1 day"),
        "date_posted": F.when(key % 5 != 0, F.date_sub("date_posted", 2)),
        "technology_slugs": F.when(key % 2 == 0, F.col("keyword_slugs")), "keyword_slugs": F.lit(None).cast("array<string>"),
        "co_industry": F.lit("CHANGED"), "location": F.when(key % 3 == 0, F.lit("ELSEWHERE")), "country": F.lit("ELSEWHERE"),
        "loc_id": F.when(key % 3 != 0, F.col("loc_id")), "description": F.when(key % 2 == 0, F.lit("CC BY-NC 4.0 only")),
        "_row_hash": F.col("_row_hash") + 1,
    })
    second = bronze.where((part == 0) | ((part == 2) & (F.col("date_posted") > F.lit(date(2001, 7, 25))))).unionByName(newer).unionByName(bronze.where(part == 3))
    return first, second


def test_two_batches_equal_a_rebuild(spark, halves, tmp_path, monkeypatch):
    first, second = halves
    full, parts = (Settings(str(tmp_path / n), **COMMON) for n in ("full", "parts"))
    refresh(spark, first, full)
    expect = refresh(spark, first.unionByName(second), full)
    once = apply_batch(spark, first, parts, 0, 4)
    assert once["job_posting_lines"].count() == first.select("job_id").distinct().count()
    before = {name: files(tmp_path / "parts" / name / "data") for name in TABLES}
    old_days = {r["job_id"]: r["posting_date"] for r in once["job_posting_lines"].collect()}
    # The second batch fails on its way and comes again.
    with monkeypatch.context() as m:
        m.setattr(marts, "cert_daily", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            apply_batch(spark, second, parts, 1, 4)
    found = apply_batch(spark, second, parts, 1, 4)
    for name in sorted(set(expect) & set(found)):
        assert rows(expect[name]) == rows(found[name]), name
    kept = files(tmp_path / "parts" / "job_posting_lines" / "data")
    assert all(kept[f] == m for f, m in before["job_posting_lines"].items())
    written = {Path(f).parent.name[13:] for f in kept if f not in before["job_posting_lines"]}
    new_days = {r["job_id"]: r["posting_date"] for r in found["job_posting_lines"].collect()}
    changed = {j for j in new_days if new_days[j] != old_days.get(j)}
    assert {str(new_days[j]) for j in changed if new_days[j]} <= written
    # A batch that has been applied, or that brings nothing new, leaves every table as it is.
    state = {name: files(tmp_path / "parts" / name / "data") for name in TABLES}
    apply_batch(spark, second, parts, 1, 4)
    assert state == {name: files(tmp_path / "parts" / name / "data") for name in TABLES}


def test_untouched_days_stay_as_they_are(spark, halves, tmp_path):
    first, _ = halves
    s = Settings(str(tmp_path), **COMMON)
    lines = apply_batch(spark, first, s, 0, 4)["job_posting_lines"]
    row = first.orderBy(F.desc("date_posted"), "job_id").first()
    one = first.where(F.col("job_id") == row["job_id"])
    later = one.withColumns({"discovered_at": F.col("discovered_at") + F.expr("interval 1 day"), "job_title": F.lit("gear")})
    before = {n: files(tmp_path / n / "data") for n in ("job_posting_lines", "skill_daily", "role_state", "latest", "bridge_job_skills")}
    found = apply_batch(spark, later.select(first.columns), s, 1, 4)
    assert found["job_posting_lines"].count() == lines.count()
    assert found["job_posting_lines"].where(F.col("job_id") == row["job_id"]).first()["title"] == "gear"
    for name, old in before.items():
        written = {Path(f).parent.name for f in files(tmp_path / name / "data") if f not in old}
        assert len(written) <= 1, name  # one day, one bucket
    assert before["job_posting_lines"].keys() < files(tmp_path / "job_posting_lines" / "data").keys()


def test_stream_drives_batches(spark, halves, tmp_path):
    first, second = halves
    land = str(tmp_path / "land")
    first.limit(40).coalesce(1).write.parquet(land)
    s = Settings(str(tmp_path / "tables"), **COMMON)
    stream = lambda: spark.readStream.schema(first.schema).parquet(land)
    incremental.follow(stream(), s, str(tmp_path / "check"), 2)
    lines = Parts(spark, s.path("job_posting_lines"), "posting_date")
    assert lines.read().count() == 40
    second.limit(10).coalesce(1).write.mode("append").parquet(land)
    incremental.follow(stream(), s, str(tmp_path / "check"), 2)
    want = {r["job_id"] for r in spark.read.parquet(land).collect()}
    assert {r["job_id"] for r in lines.read().collect()} == want and lines.batch() == 1
    assert timedelta(0) <= AS_OF - max(r["posting_date"] for r in lines.read().collect() if r["posting_date"])
