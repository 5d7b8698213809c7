import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandlens.llm import queries, toxicity


def test_learns_pairs_that_weights_miss():
    """Toxic only where an insult and a group stand together; each of them alone is as common elsewhere."""
    random.seed(1)
    rows = []
    for i in range(900):
        insult, group = (i % 3 == 0, i % 3 == 0) if i % 2 else (i % 3 == 1, i % 3 == 2)
        noise = random.sample(range(100, 160), 8)
        rows.append((int(insult and group), sorted({*noise, *([7] if insult else []), *([9] if group else [])})))
    made = toxicity.fit_machine(pd.DataFrame(rows, columns=["label", "buckets"]))
    place = {b: i for i, b in enumerate(made["names"].tolist())}
    assert {7, 9} <= set(place)
    pair = made["v"][place[7]] @ made["v"][place[9]]
    logit = {k: made["bias"] + sum(made["w"][place[b]] for b in k) + (pair if len(k) == 2 else 0) for k in ((), (7,), (9,), (7, 9))}
    assert logit[7, 9] > 1 and max(logit[()], logit[7,], logit[9,]) < -1
    assert pair > 1


@pytest.mark.parametrize("toxic", [lambda a, b: (a + b) % 2 == 0, lambda a, b: a * 7 + b * 5 + a * b * 3 & 4 > 0], ids=["even", "mixed"])
def test_learns_pairs_of_members_equally_common_in_both_classes(toxic):
    """Six insults and six groups in every text; only which ones stand together tells the label."""
    def rows(seed, n):
        draw = random.Random(seed)
        made = []
        for i in range(n):
            a, b = i % 6, i // 6 % 6
            made.append((int(toxic(a, b)), sorted({1000 + a, 2000 + b, *(5000 + draw.randrange(400) for _ in range(20))})))
        return pd.DataFrame(made, columns=["label", "buckets"])

    made = toxicity.fit_machine(rows(1, 4000))
    right = sum((plain_logit(made, r.buckets) > 0) == r.label for r in rows(2, 1000).itertuples())
    assert right >= 900


def plain_logit(made, held):
    """Weights and products of vectors, pair by pair."""
    place = {b: i for i, b in enumerate(made["names"].tolist())}
    at = [place[b] for b in held if b in place]
    pairs = sum(float(made["v"][a].astype(float) @ made["v"][b].astype(float)) for i, a in enumerate(at) for b in at[:i])
    return made["bias"] + sum(float(made["w"][a]) for a in at) + pairs


def test_scores_equal_plain_sums_over_pairs(spark):
    words = [f"w{i}" for i in range(40)]
    draw = random.Random(3)
    docs = [(i, " ".join(draw.choices(words, k=draw.choice([0, 1, 5, 30])))) for i in range(200)]
    docs += [(900, " ".join(f"{w}!" for w in words * 30_000)), (901, " ".join(words))]
    a = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(a, a.selectExpr("doc_id", "int(text like '%w7 %' and text like '%w9 %') as toxic"))
    terms = toxicity.Terms()
    scores = {r.doc_id: r.score for r in toxicity.score(a, model).collect()}
    for i, text in docs:
        assert abs(scores[i] - 1 / (1 + np.exp(-np.clip(plain_logit(model, toxicity.buckets(text.encode(), terms)), -30, 30)))) < 1e-5


def test_sample_is_bounded_and_repeats(spark):
    labels = spark.range(4000).selectExpr("id as doc_id", "int(id % 2) as toxic")
    docs = labels.selectExpr("doc_id", "concat('text ', doc_id) as text").union(spark.range(500).selectExpr("5L", "concat('copy ', id % 3)"))
    draw = lambda: [tuple(r) for r in toxicity.training_rows(docs.repartition(7), labels, None, "doc_id", "text", "toxic", 90).collect()]
    found = draw()
    assert sorted(map(repr, found)) == sorted(map(repr, draw()))
    assert [sum(r[0] == v for r in found) for v in (0, 1)] == [90, 90]


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    if not os.path.isdir(sf_dir):
        pytest.skip("needs the labelled documents of sf0.1")
    rows = queries.op5_toxicity(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = [r.score for r in rows if r.toxic == 0], [r.score for r in rows if r.toxic == 1]
    assert np.mean([b > g for b in bad for g in good]) > 0.93
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.05 * len(good)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_defined_results(spark):
    docs = [(i, f"plain words number {i} you {'scoundrel' if i % 2 else 'friend'}") for i in range(60)]
    docs += [(100, None), (101, ""), (None, "scoundrel"), (3, docs[3][1])]
    labels = [(i, i % 2) for i in range(60)] + [(3, 0), (7, None), (8, 5), (None, 1), (999, 1)]
    a = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "2 as label", "3 as TEXT")
    b = spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("*", "'' as text", "1 as label")
    model = toxicity.fit(a, b, learn=F.col("doc_id") < 40, per_class=15)
    found = {}
    for r in toxicity.score(a, model).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert len(found[3]) == 2
    assert all(found[i][0].predicted == i % 2 for i in range(60))
    assert found[None][0].score > found[100][0].score == found[101][0].score
    none = toxicity.fit(a.limit(0), b)
    assert {r.predicted for r in toxicity.score(a, none).collect()} == {0}
    assert toxicity.score(a.limit(0), model).collect() == []
