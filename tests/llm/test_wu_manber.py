import hashlib
import random
import re

from demandlens.llm import wu_manber

WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(docs, items, size=10):
    """Every window of every item against every place of every document."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: WORD.findall((t or "").translate(lower))
    out = []
    for doc_id, text in docs:
        own, hit, found = split(text), set(), set()
        for item, passage in items:
            seek = split(passage)
            n = min(size, len(seek))
            for w in range(len(seek) - n + 1 if n else 0):
                for i in range(len(own) - n + 1):
                    if own[i:i + n] == seek[w:w + n]:
                        hit.update(range(i, i + n))
                        found |= {str(item)} if item is not None else set()
        ids = ",".join(sorted(found))
        out.append((doc_id, len(own), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def cases():
    random.seed(5)
    vocabulary = ["a", "b", "Ab", "über", "the", "thing", "x1", "日本", "ing"]
    draw = lambda n: " ".join(random.choice(vocabulary) for _ in range(n))
    items = [(i, draw(random.choice([0, 1, 3, 9, 10, 11, 30]))) for i in range(30)]
    items += [(None, "alpha beta gamma"), (1, "delta"), (100, None), (100, "A b A b A b A b A b A b A b"), (9, "...")]
    docs = [(i, draw(random.choice([0, 1, 5, 40, 200]))) for i in range(60)]
    docs += [(7, "alpha, BETA\n gamma delta"), (8, None), (8, ""), (None, "a b a b a b a b a b a b"), (9, "a-b " * 40)]
    docs += [(70 + (200 if i is None else i), draw(12) + ". " + (t or "").upper() + "!" + draw(7)) for i, (_, t) in enumerate(items)]
    return docs, items


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


def frames(spark, docs, items):
    a = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_words", "'' as Text", "'' as items")
    return a, spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "2 as doc_id")


def test_equals_plain_search(spark):
    docs, items = cases()
    a, b = frames(spark, docs, items)
    expect = sorted(plain(docs, items), key=repr)
    assert rows(wu_manber.digest(wu_manber.decontaminate(a, b))) == expect
    # A benchmark beyond the bound takes several passes; the result is the same.
    assert rows(wu_manber.digest(wu_manber.decontaminate(a, b, block_bytes=300))) == expect


def test_empty_tables(spark):
    docs, items = cases()
    a, b = frames(spark, docs, items)
    assert rows(wu_manber.digest(wu_manber.decontaminate(a.limit(0), b))) == []
    assert rows(wu_manber.digest(wu_manber.decontaminate(a, b.limit(0)))) == sorted(plain(docs, []), key=repr)


def test_long_text_and_stretches():
    passage = " ".join(f"word{i}" for i in range(14))
    text = ("lorem ipsum dolor " * 3000 + passage + " ") * 3
    counts, spans, items = wu_manber.Matcher([("p", passage.encode())], 10)([text.encode(), None])
    assert [b - a + 1 for a, b in spans[0]] == [14, 14, 14]
    assert (counts[1], spans[1], items) == (0, [], [["p"], []])
