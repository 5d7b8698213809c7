"""The stages one after another against their plain versions."""

import hashlib
import random

import pytest
from test_bpe import library
from test_line_index import plain as plain_lines
from test_simhash import plain_components, plain_print
from test_wu_manber import plain as plain_windows

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents():
    random.seed(21)
    english = ["the", "and", "that", "with", "house", "river", "thing", "over", "under", "light", "winter", "summer"]
    german = ["der", "und", "nicht", "haus", "fluss", "über", "unter", "licht", "winter", "sommer", "ding", "mit"]
    draw = lambda words, n: " ".join(random.choice(words) + str(random.randrange(30)) for _ in range(n))
    shared = [draw(english, 14) for _ in range(4)]
    rows = []
    for i in range(60):
        words = english if i % 3 else german
        lines = [draw(words, random.randint(3, 20)) for _ in range(random.randint(1, 5))]
        if i % 4 == 0:
            lines.insert(1, random.choice(shared))
        rows.append((i, "\n".join(lines), "en" if i % 3 else "de", f"src{i % 3}", 0))
    rows += [(100 + i, rows[i][1], rows[i][2], "copy", 0) for i in range(8)]
    rows += [(200 + i, rows[i][1] + " tail" + str(i), rows[i][2], "near", 0) for i in range(10, 14)]
    rows += [(300, None, "en", "x", None), (301, "", None, "x", 0), (302, "123 ... 456", "en", "x", 0), (303, "x", "en", "x", 1)]
    rows += [(304, "lead " + shared[0] + "\n" + items()[1][1] + " end", "en", "bench", 0), rows[5]]
    return rows


def items():
    random.seed(22)
    return [(i, " ".join(f"item{random.randrange(400)}" for _ in range(n))) for i, n in enumerate([25, 12, 4])]


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items(), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def plain():
    rows = [r for r in documents() if r[1] and any(c.isalpha() for c in r[1])]
    kept = {}
    for row, (_, _, _, text) in zip(sorted(rows, key=lambda r: repr((r[0],))), plain_lines([r[:2] for r in rows]), strict=True):
        kept.setdefault(row[0], text)  # the one repeated row is equal to the other
    texts = sorted(kept.items())
    part = plain_components([plain_print(t) for _, t in texts])
    first = {}
    for (i, t), p in zip(texts, part, strict=True):
        first.setdefault(p, (i, t))
    clean = [r[0] for r in plain_windows(list(first.values()), items()) if not r[5]]
    return {i: t for i, t in first.values() if i in clean}


def test_stages_equal_plain_versions(spark, folder):
    found = corpus_pipeline.run(spark, folder).collect()
    want, known = plain(), library()
    assert sorted(r.doc_id for r in found) == sorted(want)
    for row in found:
        ids = known.encode_ordinary(want[row.doc_id])
        assert row.token_ids == ids and row.n_tokens == len(ids)
        assert row.decoded_sha256 == hashlib.sha256(want[row.doc_id].encode()).hexdigest()
    assert not {300, 301, 302, 304} & set(want)
    assert {303, 59} <= set(want)


def test_each_stage_keeps_columns_and_takes_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "1 as kept_text_", "2 as chunk")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
        assert stage(spark, docs.limit(0), folder).count() == 0, name
    lines = corpus_pipeline.lines(spark, docs.where("text is not null"), folder)
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    assert corpus_pipeline.tokens(spark, docs.limit(0), folder).count() == 0


def test_further_columns_may_be_named_like_results(spark, folder):
    names = ["score", "rejected", "spans", "kept_text", "n_lines", "items_0", "__mark", "LANG", "Text"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.toDF(*docs.columns).selectExpr("*", *(f"{i} + coalesce(doc_id, 0) as `{n}`" for i, n in enumerate(names)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert found.columns == docs.columns, name
        rows = found.collect()
        assert rows and all(tuple(r)[5:] == tuple(i + r[0] for i in range(len(names))) for r in rows), name
    assert corpus_pipeline.tokens(spark, docs, folder).count() == docs.count()
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        docs.write.parquet(f"{folder}/wide/documents.parquet")
        spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{folder}/wide/benchmark.parquet")
        assert sorted(r.doc_id for r in corpus_pipeline.run(spark, f"{folder}/wide").collect()) == sorted(plain())
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
