"""Distinct counts out of stored bitmaps against count_distinct."""

import pytest
from pyspark.sql import functions as F

from demandlens.operators.distinct import distinct_of_state, distinct_state, merged_state, number_keys
from demandlens.plans import semantic


@pytest.fixture(scope="module")
def facts(spark):
    """Keys that repeat over days and kinds, NULL keys, a day and a kind that have nothing else."""
    rows = spark.range(90_000).select(
        F.when(F.col("id") % 17 != 0, F.concat(F.lit("k"), (F.col("id") * 7919) % 70_000)).alias("job_id"),
        (F.col("id") % 9).cast("int").alias("day"), F.when(F.col("id") % 5 != 0, F.concat(F.lit("r"), F.col("id") % 3)).alias("role_name"),
    )
    return rows.union(spark.createDataFrame([(None, 77, "only null"), ("k1", None, "r0")], rows.schema))


def counts(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_numbers_are_dense_and_stay(spark, facts):
    early = facts.where("day < 4")
    known = number_keys(early, "job_id", near=F.col("day"))
    known = spark.createDataFrame(known.collect(), known.schema)
    found = {r["job_id"]: r["number"] for r in known.collect()}
    assert sorted(found.values()) == list(range(len(found)))
    every = {r["job_id"]: r["number"] for r in number_keys(facts, "job_id", known, F.col("day")).collect()}
    assert all(every[k] == n for k, n in found.items())
    assert sorted(every.values()) == list(range(facts.where("job_id is not null").select("job_id").distinct().count()))
    first = {r["job_id"]: r["d"] for r in early.where("job_id is not null").groupBy("job_id").agg(F.min("day").alias("d")).collect()}
    days = [first[k] for k in sorted(found, key=found.get)]
    assert days == sorted(days)  # keys of a day stand together
    assert number_keys(facts.limit(0), "job_id").collect() == []
    assert len(number_keys(facts.limit(0), "job_id", known).collect()) == len(found)


def test_state_equals_count_distinct_over_any_dimensions(spark, facts):
    numbers = number_keys(facts, "job_id", near=F.col("day"))
    state = distinct_state(facts.join(numbers, "job_id", "left"), ["day", "role_name"])
    state = spark.createDataFrame(state.collect(), state.schema)
    for dims in (["day", "role_name"], ["role_name"], ["day"], []):
        expect = facts.groupBy(*dims).agg(F.count_distinct("job_id").alias("n"))
        assert counts(distinct_of_state(state, dims, "n")) == counts(expect)
    window = "day between 2 and 5"
    expect = facts.where(window).groupBy("role_name").agg(F.count_distinct("job_id").alias("n"))
    assert counts(distinct_of_state(state.where(window), ["role_name"], "n")) == counts(expect)
    halves = distinct_state(facts.where("day < 3").join(numbers, "job_id", "left"), ["role_name"]).unionByName(
        distinct_state(facts.where("not day < 3 or day is null").join(numbers, "job_id", "left"), ["role_name"]))
    whole = facts.groupBy("role_name").agg(F.count_distinct("job_id").alias("n"))
    assert counts(distinct_of_state(merged_state(halves, ["role_name"]), ["role_name"], "n")) == counts(whole)


def test_measure_of_state(spark, facts):
    state = semantic.measure_state(facts, number_keys(facts, "job_id"), "job_posting", ["role_name"])
    assert counts(semantic.measure_of_state(state, "job_posting", ["role_name"])) == counts(semantic.measure(facts, "job_posting", ["role_name"]))
    with pytest.raises(ValueError):
        semantic.measure_of_state(state, "job_posting", ["no such"])
    with pytest.raises(ValueError):
        semantic.measure_state(facts, facts, "skill_daily", ["skill_name"])
