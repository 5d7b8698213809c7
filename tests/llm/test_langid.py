import os

import pytest
from pyspark.sql import functions as F

from demandlens.llm import langid, queries


def test_held_out_accuracy(spark, sf_dir):
    found = queries.op9_language(spark, sf_dir)
    rows = found.join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out").collect()
    assert len(held) > 20
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in held)
    assert not any(r.rejected for r in held)


def test_defined_results(spark):
    rows = [(i, f"the thing and that is {i}", "en") for i in range(9)] + [(i, f"der das und ist nicht {i}", "de") for i in range(9, 18)]
    rows += [(20, None, "en"), (21, "", None), (22, "12 34 !?", "en"), (23, "the that", None), (None, "und das ist", "de"), (24, "x" * 50, "und")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "0 as score", "'' as LANG")
    model = langid.fit(df, per_language=5)
    assert model["names"] == ["de", "en"]
    found = {r.doc_id: r for r in langid.identify(df, model).collect()}
    assert len(found) == len(rows)
    for i in (20, 21, 22):
        assert (found[i].lang_pred, found[i].score, found[i].rejected) == ("und", 0.0, True)
    assert [found[i].lang_pred for i in (0, 9, 23, None)] == ["en", "de", "en", "de"]


def test_empty_and_nothing_to_learn(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.fit(none)
    assert langid.identify(none, model).collect() == []
    one = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    found = langid.identify(one, langid.fit(one, learn=F.lit(True))).first()
    assert (found.lang_pred, found.rejected) == ("und", True)


def test_what_was_not_learned_is_rejected(spark):
    """Unlearned scripts, an unlearned language and gibberish go; held-out documents stay."""
    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("needs the documents of sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs, learn=queries.remainder(4) != 2)
    foreign = [
        "Все люди рождаются свободными и равными в своём достоинстве и правах и наделены разумом и совестью",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα",
        "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待",
        "يولد جميع الناس أحراراً متساوين في الكرامة والحقوق وقد وهبوا عقلاً وضميراً",
        "xqzv kjwq pfgh zxcvb qwrtp lkjhg mnbvc zzxq wvkj qpfx hjkl vbnm qwxz",
    ]
    given = spark.createDataFrame([(i, t * n) for i, t in enumerate(foreign) for n in (1, 5, 40)], "doc_id long, text string")
    found = langid.identify(given, model).collect()
    assert all(r.rejected for r in found), found
    held = docs.where(queries.remainder(4) == 2)
    short = held.selectExpr("doc_id", "substring(text, 1, 60) as text")
    for rows in (held, short):
        stay = langid.identify(rows.where(F.col("text").rlike(r"\p{L}")), model).collect()
        assert sum(r.rejected for r in stay) <= 0.01 * len(stay)
