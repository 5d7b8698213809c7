"""Row-level operators on hand-made frames."""

from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from demandlens import rules
from demandlens.functions.keys import mart_key, surrogate_key, with_audit, with_business_date
from demandlens.functions.rates import change_pct, demand_badge, round1, share_pct, trend_label
from demandlens.functions.text import role_name, slug_to_name
from demandlens.operators import entities
from demandlens.operators.medians import value_bucket
from demandlens.operators.paths import conform, path_type, project
from demandlens.operators.upsert import first_load, scd1_upsert
from demandlens.plans import dims, facts, insight
from demandlens.plans.lines import posting_lines
from demandlens.rules import Term
from demandlens.schema import BRONZE, RECORD, flatten_spec
from demandlens.sources import landing


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def bronze(spark, rows):
    """Bronze-shaped frame from dicts that name only the columns of interest."""
    names = list(dict.fromkeys(k for r in rows for k in r))
    schema = StructType([BRONZE[n] for n in names])
    return conform(spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema), BRONZE)


def test_spec_covers_the_record():
    spec = flatten_spec()
    assert len(spec) == 88
    assert len({name for name, _, _ in spec}) == 88
    assert all(path_type(RECORD, path) == kind for _, path, kind in spec)


@pytest.mark.parametrize("path, known", [
    ("a", True), ("b", False), ("list.0.x", True), ("list.x", False), ("list.0.y", False), ("a.0", False),
])
def test_path_type(path, known):
    inner = StructType([StructField("x", LongType())])
    schema = StructType([StructField("a", StringType()), StructField("list", ArrayType(inner))])
    assert (path_type(schema, path) is not None) is known


def test_arrays_and_absent_paths_give_null(spark):
    raw = spark.createDataFrame(
        [("1", [(7, "here")]), ("2", []), ("3", None), ("n/a", [(8, "x")])],
        "id string, locations array<struct<id: bigint, name: string>>",
    )
    flat = landing.flatten(raw)
    assert {r["job_id"]: r["loc_id"] for r in landing.with_key(flat).collect()} == {1: 7, 2: None, 3: None}
    assert landing.without_key(flat).count() == 1
    assert flat.select("co_name").distinct().collect()[0][0] is None
    assert [f.dataType for f in flat.schema if f.name in BRONZE.names] == [f.dataType for f in BRONZE]


def test_bad_value_becomes_null(spark):
    raw = spark.createDataFrame([("1", "soon"), ("2", "2024-05-01")], "id string, date_posted string")
    got = {r["job_id"]: r["date_posted"] for r in project(raw, flatten_spec()).collect()}
    assert got == {1: None, 2: date(2024, 5, 1)}


@pytest.mark.parametrize("normalized, title, role", [
    ("   ", "Data Engineer", "data_engineer"),
    ("", "ML Engineer II", "ai_engineer"),
    (None, None, "other"),
    ("Data Architect / Data Engineer", None, "data_architect"),
    ("Plumber", "Data Engineer", "other"),
])
def test_role(spark, normalized, title, role):
    df = spark.createDataFrame([(normalized, title)], "normalized_title string, job_title string")
    assert df.select(role_name().alias("r")).first()["r"] == role


def test_keys(spark):
    df = spark.createDataFrame([("a", None, "b")], "x string, y string, z string")
    got = df.select(
        (surrogate_key("x", "y", "z") == F.md5(F.lit("a||||b"))).alias("guarded"),
        (mart_key("x", "y", "z") == F.md5(F.lit("a||b"))).alias("plain"),
    ).first()
    assert got["guarded"] and got["plain"]


def test_audit_columns(spark):
    at = datetime(2024, 1, 2, 3, 4)
    row = with_business_date(with_audit(spark.range(1), at), date(2024, 1, 2)).first()
    assert (row["created_date"], row["business_date"]) == (at, date(2024, 1, 2))
    assert with_business_date(with_audit(spark.range(1))).first()["created_date"] is not None


def test_slug_names(spark):
    assert one(spark, slug_to_name(F.lit("ci-cd_c++"))) == "Ci Cd C++"


@pytest.mark.parametrize("delta, label", [
    (2.0, "trending"), (1.9, "stable"), (-1.9, "stable"), (-2.0, "declining"),
])
def test_trend(spark, delta, label):
    assert one(spark, trend_label(F.lit(delta))) == label


@pytest.mark.parametrize("pct, badge", [(15.0, "High"), (14.9, "Medium"), (5.0, "Medium"), (4.9, "Low")])
def test_badge(spark, pct, badge):
    assert one(spark, demand_badge(F.lit(pct))) == badge


def test_rates(spark):
    assert one(spark, round1(share_pct(F.lit(1), F.lit(16)))) == 6.2
    assert one(spark, share_pct(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, change_pct(F.lit(3), F.lit(0))) is None
    assert one(spark, change_pct(F.lit(3), F.lit(None).cast("int"))) is None
    assert one(spark, change_pct(F.lit(112), F.lit(100))) == 12.0


def test_newest_version_wins(spark):
    rows = bronze(spark, [
        {"job_id": 1, "discovered_at": datetime(2024, 1, 1), "technology_slugs": ["old"]},
        {"job_id": 1, "discovered_at": datetime(2024, 1, 2), "closed_at": datetime(2024, 1, 2),
         "technology_slugs": ["new"]},
        {"job_id": 2, "discovered_at": datetime(2024, 1, 1)},
    ])
    latest = facts.latest_postings(rows)
    fact = {r["job_id"]: r["is_open"] for r in facts.fact_postings(latest).collect()}
    assert fact == {1: False, 2: True}
    assert [r["name"] for r in dims.skills(latest).collect()] == ["New"]


def test_upsert_moves_only_what_changed(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 2, 1)
    first = spark.createDataFrame([(1, "same"), (2, "before"), (3, None), (5, "kept")], "k int, a string")
    target = first_load(first, "k", ["a"], old)
    source = spark.createDataFrame([(1, "same"), (2, "after"), (3, None), (4, "added")], "k int, a string")
    got = {r["k"]: (r["a"], r["created_date"], r["updated_date"])
           for r in scd1_upsert(target, source, "k", ["a"], new).collect()}
    assert got == {
        1: ("same", old, old), 2: ("after", old, new), 3: (None, old, old), 4: ("added", new, new),
        5: ("kept", old, old),
    }


def test_companies_without_id_do_not_share_a_key(spark):
    latest = bronze(spark, [
        {"job_id": 1, "company": "A", "company_domain": "a.example"},
        {"job_id": 2, "company": "B", "company_domain": "b.example"},
    ])
    ids = {r["company_id"] for r in facts.fact_postings(latest).collect()}
    assert ids == {r["company_id"] for r in dims.companies(latest).collect()}
    assert len(ids) == 2


def test_slug_case_and_category(spark):
    latest = bronze(spark, [
        {"job_id": 1, "technology_slugs": ["Python", None], "keyword_slugs": ["python", "agile"]},
        {"job_id": 2, "technology_slugs": [], "keyword_slugs": None},
    ])
    assert {(r["name"], r["category"]) for r in dims.skills(latest).collect()} == {
        ("Python", "technology"), ("Agile", "methodology")}
    pairs = facts.bridge_job_skills(latest).select("job_id", "skill_id").collect()
    assert len(pairs) == len(set(pairs)) == 2


def test_locations(spark):
    latest = bronze(spark, [
        {"job_id": 1, "location": "Oslo", "loc_id": 5, "loc_continent": "Europe"},
        {"job_id": 2, "location": "Moon", "loc_continent": "Space"},
        {"job_id": 3, "loc_continent": "Asia"},
    ])
    got = {r["name"]: (r["location_id"] == "5", r["continent_code"]) for r in dims.locations(latest).collect()}
    assert got == {"Oslo": (True, "EU"), "Moon": (False, None)}


def test_certification_spellings_merge(spark):
    staging = spark.createDataFrame(
        [(1, "PMP", "PMI"), (2, "PMP", "PMI"), (2, "pmp", "PMI"), (3, "pmp", None)],
        "job_id long, cert_name string, cert_provider string",
    )
    assert [(r["name"], r["provider"]) for r in dims.certifications(staging).collect()] == [("PMP", "PMI")]
    pairs = facts.bridge_job_certifications(staging).select("job_id", "cert_id").collect()
    assert len(pairs) == len(set(pairs)) == 3


def test_lines_keep_untagged_postings(spark):
    rows = bronze(spark, [{"job_id": 1, "technology_slugs": None, "keyword_slugs": []}])
    latest = facts.latest_postings(rows)
    row = posting_lines(latest, dims.companies(latest), dims.locations(latest)).first()
    assert (row["skill_names"], row["cert_names"], row["industry"]) == ([], [], "Unknown")


TERMS = (rules.Term("AWS Certified", "AWS Certified", "AWS"), rules.Term("PMP", "PMP", "PMI"))


def test_dictionary_reads_whole_texts(spark):
    texts = spark.createDataFrame(
        [(1, "x" * 50_000 + " PMP"), (2, None), (3, ""), (4, "AWS Certified and PMP")], "id int, t string")
    found = texts.select("id", entities.dictionary_entities("t", TERMS).alias("e"))
    got = {r["id"]: [e["name"] for e in r["e"]] for r in found.collect()}
    assert got == {1: ["PMP"], 2: [], 3: [], 4: ["AWS Certified", "PMP"]}


def test_dictionary_rejects_two_spellings():
    with pytest.raises(ValueError):
        entities.dictionary_entities("t", (*TERMS, rules.Term("pmp", "pmp", "PMI")))


@pytest.fixture
def extractor():
    def extract(text):
        if "boom" in text:
            raise RuntimeError("no answer")
        if "garbled" in text:
            return "{not json"
        return {"certifications": [{"name": " PMP ", "provider": "PMI"}]} if "PMP" in text else []

    return extract


def test_callable_extractor(spark, extractor):
    docs = spark.createDataFrame(
        [(1, "has PMP"), (2, "boom"), (3, "garbled"), (4, None), (5, "nothing"), (6, "has PMP"),
         (7, "y" * 3998 + "PMP" + "y" * 9000)], "id int, t string")
    staged = entities.extract_texts(entities.pending_texts(docs, "t"), extractor)
    assert staged.count() == 5
    errors = {r["error"] for r in staged.where("error IS NOT NULL").collect()}
    assert len(errors) == 2 and any("no answer" in e for e in errors)
    assert staged.where("error IS NOT NULL AND size(entities) > 0").count() == 0
    hits = entities.staged_entities(docs, "id", "t", staged).collect()
    assert {(r["id"], r["cert_name"], r["cert_provider"]) for r in hits} == {
        (1, "PMP", "PMI"), (6, "PMP", "PMI"), (7, "PMP", "PMI")}


def test_failures_are_retried_and_successes_are_not(spark, extractor):
    docs = spark.createDataFrame([(1, "has PMP"), (2, "boom")], "id int, t string")
    staged = entities.extract_texts(entities.pending_texts(docs, "t"), extractor)
    again = entities.pending_texts(docs, "t", staged)
    assert [r["text"] for r in again.collect()] == ["boom"]


def test_json_entities(spark):
    texts = spark.createDataFrame(
        [('{"certifications": [{"name": "PMP", "provider": "PMI"}]}',), ("{oops",), (None,)], "t string")
    got = [r["e"] for r in texts.select(entities.json_entities("t").alias("e")).collect()]
    assert [[tuple(e) for e in found] for found in got] == [[("PMP", "PMI")], [], []]


# --- questions ------------------------------------------------------------------

AS_OF = date(2024, 6, 30)
LINES = ("job_id long, posting_date date, role_name string, industry string, is_open boolean,"
         " avg_salary_usd double, skill_names array<string>, cert_names array<string>")


def lines(spark, rows):
    return spark.createDataFrame(rows, LINES)


def test_empty_window(spark):
    empty = lines(spark, [])
    row = insight.metrics(empty, "data_engineer", ("90d", "all"), as_of=AS_OF).collect()
    assert [(r["job_postings"], r["open_roles"], r["median_salary_usd"]) for r in row] == [(0, 0, None)] * 2
    assert all(r["job_postings_delta_pct"] is None for r in row)
    assert insight.skills(empty, "data_engineer", as_of=AS_OF).count() == 0
    count = insight.jobs_count(empty, "data_engineer", as_of=AS_OF).first()
    assert (count["total"], count["total_pages"]) == (0, 1)


def test_current_zero_with_prior(spark):
    rows = lines(spark, [(1, date(2024, 2, 1), "data_engineer", "X", True, 10.0, [], [])])
    row = insight.metrics(rows, "data_engineer", ("90d",), as_of=AS_OF).first()
    assert (row["job_postings"], row["job_postings_delta_pct"]) == (0, -100.0)
    assert (row["median_salary_usd"], row["median_salary_delta_pct"]) == (None, None)


def test_ties_break_by_name_and_untagged_count(spark):
    day = date(2024, 6, 1)
    rows = lines(spark, [
        (1, day, "data_engineer", "X", True, 1.0, ["B", "A"], []),
        (2, day, "data_engineer", "X", True, 1.0, [], []),
    ])
    got = insight.skills(rows, "data_engineer", limit=1, as_of=AS_OF).collect()
    assert [(r["rank"], r["name"], r["occurrence_pct"]) for r in got] == [(1, "A", 50.0)]
    everywhere = insight.skills_for_all(rows, as_of=AS_OF).collect()
    assert {(r["industry"], r["name"], r["occurrence_pct"]) for r in everywhere} == {
        (i, n, 50.0) for i in ("X", "all") for n in "AB"}


def test_window_end_is_exclusive(spark):
    rows = lines(spark, [(1, AS_OF, "data_engineer", "X", True, 1.0, ["A"], [])])
    assert insight.skills(rows, "data_engineer", "all", as_of=AS_OF).count() == 0


def test_filters_cascade(spark):
    day = date(2024, 6, 1)
    rows = lines(spark, [
        (1, day, "data_engineer", "X", True, 1.0, [], []),
        (2, day, "ai_engineer", "Y", True, 1.0, [], []),
        (3, day, "other", "Z", True, 1.0, [], []),
    ])

    def values(kind, **scope):
        got = insight.filters(rows, **scope).where(F.col("kind") == kind).orderBy("position")
        return [r["value"] for r in got.collect()]

    assert values("role") == ["data_engineer", "ai_engineer", "data_architect"]
    assert values("role", industry="Y") == ["ai_engineer"]
    assert values("role", industry="all") == ["data_engineer", "ai_engineer", "data_architect"]
    assert values("industry") == ["all", "X", "Y", "Z"]
    assert values("industry", role="data_engineer") == ["all", "X"]
    assert values("industry", role="data_architect") == ["all"]


@pytest.mark.parametrize("call", [
    lambda df: insight.skills(df, None),
    lambda df: insight.skills(df, "other"),
    lambda df: insight.skills(df, "data_engineer", "7d"),
    lambda df: insight.skills(df, "data_engineer", sort="name"),
    lambda df: insight.skills(df, "data_engineer", limit=51),
    lambda df: insight.certifications(df, df, "data_engineer", limit=0),
    lambda df: insight.jobs(df, "data_engineer", page_size=51),
    lambda df: insight.jobs(df, "data_engineer", page=0),
    lambda df: insight.jobs(df, "data_engineer", skill="a", certificate="b"),
    lambda df: insight.metrics(df, "unknown"),
])
def test_bad_arguments(spark, call):
    with pytest.raises(ValueError):
        call(lines(spark, []))


def test_extractor_gets_whole_texts(spark):
    mention = "m" * 300
    docs = spark.createDataFrame([(1, "x" * 3750 + mention + "y" * 4000)], "id int, t string")
    term = Term(mention, "long", None)

    def find(text):
        return [{"name": "long"}] if mention in text else []

    staged = entities.extract_texts(entities.pending_texts(docs, "t"), find)
    assert [e["name"] for e in staged.first()["entities"]] == ["long"]
    found = docs.select(entities.dictionary_entities("t", (term,)).alias("e")).first()["e"]
    assert [e["name"] for e in found] == ["long"]


def test_dictionary_of_thousands_equals_substring_search(spark):
    terms = tuple(Term(f"w{i % 997}x{i}", f" name{i // 2} ", None if i // 2 % 3 else "p") for i in range(4000))
    texts = ["", None, "w1x1 and w1x998w2x2", "w3x3999", "nothing", " ".join(t.pattern for t in terms[100:140])]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = docs.select("id", entities.dictionary_entities("t", terms).alias("e")).collect()
    for row in got:
        text = texts[row["id"]]
        want = dict.fromkeys((t.name.strip(), t.provider) for t in terms if text is not None and t.pattern in text)
        assert [(e["name"], e["provider"]) for e in row["e"]] == list(want)


def test_repeated_staged_results_count_once(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a")], "id int, t string")
    one = docs.limit(1).select(entities.text_hash("t").alias("text_hash"),
                               F.array(F.struct(F.lit("n").alias("name"), F.lit(None).cast("string").alias("provider"))).alias("entities"),
                               F.lit(None).cast("string").alias("error"))
    hits = entities.staged_entities(docs, "id", "t", one.union(one)).collect()
    assert sorted((h["id"], h["cert_name"]) for h in hits) == [(1, "n"), (2, "n")]


def test_median_buckets_are_narrow_at_every_magnitude(spark):
    values = [i * 1e-9 for i in range(1, 20000)] + [-(2.0 ** e) for e in range(-300, 300, 7)] + [0.0, 5e-324, 1.7e308, -1.7e308]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = df.select("v", value_bucket("v").alias("b")).orderBy("v").collect()
    assert all(x["b"] <= y["b"] for x, y in zip(rows, rows[1:]))
    widest = max(Counter(r["b"] for r in rows).values())
    assert widest < 40


def test_lines_find_dimension_rows_by_id_alone(spark):
    """Names may come from another posting of the company or place."""
    latest = bronze(spark, [
        {"job_id": 1, "co_id": "c1", "co_name": "A", "co_industry": "Tools", "loc_id": 5, "location": "Oslo", "country": "Norway"},
        {"job_id": 2, "co_id": "c1", "loc_id": 5},
        {"job_id": 3},
    ])
    lines = posting_lines(latest, dims.companies(latest), dims.locations(latest)).collect()
    got = {r["job_id"]: (r["company"], r["industry"], r["country"]) for r in lines}
    assert got == {1: ("A", "Tools", "Norway"), 2: ("A", "Tools", "Norway"), 3: (None, "Unknown", None)}
