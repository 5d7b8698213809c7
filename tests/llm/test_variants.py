import random
import re
import zlib
from collections import Counter

import pytest

from demandlens.llm import variants


def plain_counts(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(docs):
    n = plain_counts(docs)
    near = {w: [v for v in n if v != w and one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def documents():
    rng = random.Random(31)
    letters = "aabcdé"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 12))) for _ in range(60)]
    words = []
    for i, stem in enumerate(stems):
        words += [stem] * (200 if i % 5 == 0 else 3)
        for _ in range(6):
            at = rng.randrange(len(stem) + 1)
            words += [stem[:at] + rng.choice(letters) + stem[at + rng.randint(0, 1):]] * rng.choice([1, 2, 4])
    words += ["aaaaaaa"] * 5 + ["aaaaaaaa"] * 60 + ["aaaaaaaaa"] * 700 + ["baaaaaaa", "aaaaaaab"] * 2
    words += ["ÀÉÎÕÜß÷"] * 3 + ["ÀÉÎÕÜß÷x"] * 40 + ["Straßen-Bahnen", "naïveté42naïveté", "日本語abcdefg日本"] * 3
    rng.shuffle(words)
    docs = [(i, " ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in words[i::40])) for i in range(40)]
    return docs + [(None, docs[3][1]), (None, None), (7, ""), (8, "x" * 70_000 + " " + "y" * 3000), (9, "x" * 70_000), docs[5]]


def rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("tile", [variants.TILE, 4])
def test_equals_all_pairs(spark, tile):
    docs = documents()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as word", "2 as TEXT", "3 as n")
    expect = plain(docs)
    assert rows(variants.variants(df, tile=tile)) == expect
    assert any(root not in (w, form) for w, form, root, *_ in expect)  # a chain of two forms


def test_groups_grow_shorter_segments(spark):
    """A beginning that all words share does not make a large group."""
    words = [(f"prefixes{a}{b}{c}", 2) for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    df = spark.createDataFrame(words, "word string, n long")
    chosen = variants.choose_segments(df, 16)
    assert chosen and all(q > 2 for q in chosen.values())
    found = variants.near_pairs(df, 16)
    assert found.count() == 8 ** 3 * 3 * 7 == found.select("word", "near").distinct().count()


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert variants.variants(df).count() == 0
    assert variants.variants(spark.createDataFrame([(1, "short words only")], "doc_id long, text string")).count() == 0
