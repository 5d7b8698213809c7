"""Generated inputs against plain Python answers."""

import random
import statistics
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandlens import rules
from demandlens.functions.dates import DATE_RANGES, resolve_window
from demandlens.functions.rates import share_pct
from demandlens.functions.text import classify
from demandlens.operators.entities import dictionary_entities
from demandlens.operators.medians import summarize_with_median
from demandlens.operators.tags import tag_counts
from demandlens.operators.upsert import scd1_upsert
from demandlens.rules import Term

few = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@given(st.sampled_from(DATE_RANGES), st.dates(date(1990, 1, 1), date(2100, 1, 1)))
def test_windows(name, as_of):
    w = resolve_window(name, as_of)
    assert w.start < w.midpoint < w.end == as_of
    assert w.midpoint - w.start == timedelta(days=(w.end - w.start).days // 2)
    if name == "all":
        assert (w.prior_start, w.prior_end, w.first_day) == (None, None, w.start)
    else:
        assert w.prior_end == w.start
        assert w.prior_end - w.prior_start == w.end - w.start


def test_unknown_range():
    with pytest.raises(ValueError):
        resolve_window("7d")


@few
@given(st.lists(st.text(alphabet="dateng ir", max_size=24), min_size=1, max_size=20))
def test_first_rule_wins(spark, texts):
    own = (("x", ("ate", "en")), ("y", ("g i", "d")), ("z", ("t",)))

    def expected(text):
        return next((label for label, words in own if any(w in text for w in words)), "none")

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", classify(F.col("t"), own, "none").alias("r")).collect()
    assert all(r["r"] == expected(r["t"]) for r in got)


values = st.one_of(
    st.none(), st.floats(-1e12, 1e12, allow_nan=False), st.integers(0, 3).map(float),
    st.floats(99_990, 100_010, allow_nan=False),
)


@few
@given(st.lists(st.tuples(st.sampled_from("abc"), values), max_size=60))
def test_median(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: (r["m"], r["n"]) for r in
           summarize_with_median(df, ["k"], "v", "m", counts={"n": F.count("*")}).collect()}
    expected = {}
    for key in {k for k, _ in rows}:
        known = [v for k, v in rows if k == key and v is not None]
        expected[key] = (statistics.median_low(known) if known else None, sum(k == key for k, _ in rows))
    assert got == expected


tag_lists = st.one_of(st.none(), st.lists(st.one_of(st.none(), st.sampled_from("pqr")), max_size=5))


@few
@given(st.lists(st.tuples(st.sampled_from("ab"), tag_lists), max_size=30))
def test_tag_counts(spark, rows):
    df = spark.createDataFrame(rows, "k string, tags array<string>")
    got = tag_counts(df, ["k"], "tags", "tag", F.count("*").alias("n")).collect()
    counts = {(r["k"], r["tag"]): r["n"] for r in got if not r["is_total"]}
    totals = {r["k"]: r["n"] for r in got if r["is_total"]}
    assert totals == {k: sum(x == k for x, _ in rows) for k in {x for x, _ in rows}}
    expected = {}
    for key, tags in rows:
        for tag in {t for t in tags or [] if t is not None}:
            expected[key, tag] = expected.get((key, tag), 0) + 1
    assert counts == expected


@few
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=20))
def test_shares_stay_in_range(spark, pairs):
    df = spark.createDataFrame([(min(p), max(p)) for p in pairs], "part int, total int")
    shares = [r["s"] for r in df.select(share_pct(F.col("part"), F.col("total")).alias("s")).collect()]
    assert all(0 <= s <= 100 for s in shares)


@few
@given(st.dictionaries(st.integers(0, 6), st.sampled_from(["x", "y", None]), max_size=6),
       st.dictionaries(st.integers(0, 6), st.sampled_from(["x", "y", None]), max_size=6))
def test_upsert_twice_is_upsert_once(spark, old, new):
    then, now, later = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
    target = spark.createDataFrame(
        [(k, a, then, then) for k, a in old.items()], "k int, a string, created_date timestamp, updated_date timestamp")
    source = spark.createDataFrame(list(new.items()), "k int, a string")
    once = scd1_upsert(target, source, "k", ["a"], now)
    twice = scd1_upsert(once, source, "k", ["a"], later)
    rows = once.collect()
    assert {r["k"]: r["a"] for r in rows} == old | new
    assert sorted(rows) == sorted(twice.collect())


def test_role_dimension_covers_the_taxonomy(spark):
    from demandlens.plans import dims
    roles = [r["name"] for r in dims.roles(spark).collect()]
    assert sorted(roles) == sorted({label for label, _ in rules.JOB_ROLE_RULES} | {rules.OTHER_ROLE})


def test_dictionary_equals_substring_search_on_any_characters(spark):
    draw = random.Random(4)
    signs = ["a", "b", "c", "\\", ".", "(", "é", "日", "😀", " ", "-", "^", "]", "\n", "$", "A"]
    for trial in range(8):
        patterns = dict.fromkeys("".join(draw.choices(signs, k=draw.choice([trial % 4 > 0, 1, 2, 3, 4]))) for _ in range(draw.choice([1, 5, 40])))
        terms = tuple(Term(p, f"n{i % 17}x", "p" if i % 17 % 2 else None) for i, p in enumerate(patterns))
        texts = [None, "", *("".join(draw.choices(signs, k=draw.choice([1, 5, 30, 200]))) for _ in range(60))]
        docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
        for row in docs.select("id", dictionary_entities("t", terms).alias("e")).collect():
            text = texts[row["id"]]
            want = dict.fromkeys((t.name, t.provider) for t in terms if text is not None and t.pattern in text)
            assert [tuple(e) for e in row["e"]] == sorted(want, key=[(t.name, t.provider) for t in terms].index)


def test_dictionary_runs_without_python_workers(spark):
    docs = spark.range(3).selectExpr("cast(id as string) as t")
    plan = docs.select(dictionary_entities("t", (Term("a", "a"), Term("ab", "b"))).alias("e"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "from_json" not in plan
