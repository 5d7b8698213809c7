import random
import re
from collections import Counter

import numpy as np
import pytest

from demandlens.llm import phrases


def plain(docs, support=10, longest=3, top=2000):
    f, total = Counter(), Counter()
    for _, lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    candidates = {(lang, p): a for (lang, p), a in f.items() if len(p) > 1 and a >= support}
    out = []
    for lang in total:
        rows = []
        for (own, p), a in candidates.items():
            if own != lang:
                continue
            if any(o == lang and len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for (o, q), b in candidates.items()):
                continue
            cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def documents():
    rng = random.Random(12)
    words = ["the", "The", "a", "über", "house", "w|x", "of", "x\x0by", "日本", "-", "river", "light", "\x00", "\x85"] + [f"r{i}" for i in range(40)]
    fixed = ["united states of", "new york", "by and large", "a priori", "of the house"]
    docs = []
    for i in range(120):
        text = ""
        for _ in range(rng.choice([1, 5, 60])):
            text += rng.choice(fixed if rng.random() < 0.3 else words) + rng.choice([" ", " ", " ", "  \t", ". ", ",", "\n"])
        docs.append((i, rng.choice(["en", "en", "de", None, "und"]), text))
    docs += [(None, "en", docs[0][2]), (None, None, None), (500, "xx", ""), (501, "xx", "only once here"), docs[7]]
    return docs + [(502, "fr", "le chat noir " * 30_000), (503, "fr", "z" * 200_000)]


def rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


# A sample of nearly nothing makes every phrase a failure of the border; one of everything proposes all.
@pytest.mark.parametrize("sampled, lowered", [(16, 2), (10**6, 2), (1, 1), (3, 5)])
def test_equals_plain_counts(spark, sampled, lowered):
    docs = documents()
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string").selectExpr("*", "1 as k", "2 as LANG", "'x' as phrase")
    assert rows(phrases.collocations(df, sampled=sampled, lowered=lowered)) == plain(docs)


def test_longer_phrases_and_ranks(spark):
    docs = documents()
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    for sampled in (2, 10**6):
        assert rows(phrases.collocations(df, support=6, longest=5, top=7, sampled=sampled)) == plain(docs, 6, 5, 7)


def test_counts_beyond_64_bits(spark, monkeypatch):
    big = 3_000_000_007
    found = [("en", 0, "", 10 * big), ("en", 1, "a", 2 * big), ("en", 1, "b", 3 * big), ("en", 2, "a b", big)]
    monkeypatch.setattr(phrases, "mined", lambda docs, *_: docs.sparkSession.createDataFrame(found, "lang string, k int, phrase string, n long"))
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert rows(phrases.collocations(df)) == [("en", 1, "a b", big, 2 * big, 3 * big, 10 * big, 10**6 // 6)]


def test_empty_tables_and_sets(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert phrases.collocations(df).count() == 0
    keys = np.random.default_rng(1).integers(0, 2**63, 5000)
    held = phrases.bits(spark.createDataFrame([(int(k) - 2**62,) for k in keys], "hash long"))
    assert held.test((keys - 2**62).view(np.uint64)).all()
    assert held.test(np.arange(10**5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).mean() < 0.1
