import random

import numpy as np
import pytest

from demandlens.llm import ngram_join


def shingles(text, size=5):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def plain(docs):
    """All pairs of distinct sets, then the smallest id of each component."""
    sets = [shingles(t) for _, t in docs]
    distinct = list(dict.fromkeys(s for s in sets if s))
    root = {s: s for s in distinct}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * len(a & b) >= 80 * len(a | b):
                root[find(a)] = find(b)
    least = {}
    for (doc_id, _), s in zip(docs, sets, strict=True):
        if s and doc_id is not None:
            least[find(s)] = min(doc_id, least.get(find(s), doc_id))
    return sorted(((i, len(s), least.get(find(s)) if s else i) for (i, _), s in zip(docs, sets, strict=True)), key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at:at + rng.choice([0, 1, 1])] = [f"e{rng.randrange(10**6)}"]
    return words


def documents():
    rng = random.Random(13)
    passage = [f"p{i}" for i in range(60)]
    docs, at = [], 0
    for size in [4, 5, 6, 8, 9, 12, 20, 40, 90, 200, 400] * 3:
        base = [f"w{rng.randrange(3000)}" for _ in range(size)]
        for edits in [0, 0, 1, 1, 2, 3, 5]:
            docs.append((at, " ".join(edited(rng, base, edits if edits * 8 < size or size < 20 else 1))))
            at += 1
    # Frequent shingles: a passage in many documents, nearly alone in some.
    docs += [(at + i, " ".join([*edited(rng, [f"u{rng.randrange(10**5)}" for _ in range(n)], 1), *passage]).upper())
             for i, n in enumerate([3, 4, 6, 8, 9, 10, 11, 12, 13, 14, 15, 16, 18, 30, 100] * 6)]
    # Sets of four and five shingles at 4 / 5.
    docs += [(10**6, "a b c d e f g h"), (10**6 + 1, "a b c d e f g h i"), (10**6 + 2, "x a b c d e f g h i"), (10**6 + 3, "a b c"), (10**6 + 4, "A b  C")]
    docs += [(None, None), (2 * 10**6, ""), (2 * 10**6 + 1, " \n"), (None, docs[40][1]), (None, "nobody else"), (None, "nobody else"), docs[9], (docs[50][0], "another text")]
    return docs


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "2 as TEXT", "3 as node", "4 as root")


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


@pytest.mark.parametrize("rare, k, tile", [(16, 2, 512), (1, 2, 4), (3, 3, 7)])
def test_equals_all_pairs(spark, rare, k, tile):
    docs = documents()
    assert rows(ngram_join.similar_documents(frame(spark, docs), rare=rare, k=k, tile=tile)) == plain(docs)


@pytest.mark.parametrize("length", [40, 80, 500])
def test_chains_and_dense_groups(spark, length):
    """Each text is a near copy of the one before; the ends have little in common. And a dense group of near copies."""
    rng = random.Random(length)
    words, docs = [f"c{i}" for i in range(120)], []
    for i in range(length):
        words = [*words[2:], f"n{i}", f"m{i}"]
        docs.append((length - i, " ".join(words)))
    crowd = [f"d{i}" for i in range(150)]
    docs += [(10**4 + i, " ".join(edited(rng, crowd, 1 + i % 5))) for i in range(length)]
    expect = plain(docs) if length < 500 else None
    found = rows(ngram_join.similar_documents(frame(spark, docs), rare=4, tile=16))
    assert expect is None or found == expect
    assert {c for i, _, c in found if i < 10**4} == {1}


def test_prefixes_share_a_signature():
    """Any two similar sets have one in common, whatever the frequencies."""
    rng = random.Random(5)
    for _ in range(3000):
        n = rng.choice([4, 5, 7, 10, 30, 100, 300])
        universe = [(rng.choice([1, 2, 5, 40, 900]), t) for t in rng.sample(range(10**9), 2 * n)]
        x = universe[:n]
        need = -(-4 * n // 5)
        y = rng.sample(x, rng.randint(need, n)) + universe[n:n + rng.randint(0, n // 4)]
        common = len(set(x) & set(y))
        if 100 * common < 80 * (len(x) + len(y) - common) or set(x) == set(y):
            continue
        # A token in both stands in two sets at least.
        both = set(x) & set(y)
        df = lambda s: [(max(2, d) if (d, t) in both else d, t) for d, t in s]
        sides = [ngram_join.signatures_of(len(s), sorted(p for p in df(s) if p[0] > 1), rng.choice([16]), k) for s in (x, y) for k in (2,)]
        assert sides[0] & sides[1]


def test_a_pair_comes_from_one_signature(spark):
    """However many signatures two nodes share, and on whichever side they stand; none is lost where they share few."""
    rng = random.Random(31)
    members = {sig: set(rng.sample(range(60), 3)) for sig in range(-40, 0)}
    members |= {sig * 10**15: {n for n in range(40) if rng.random() < 0.9} for sig in range(1, 61)}
    root = {n: n if n % 3 else 0 for n in range(60)}
    given = [(sig, n, 100, 0, bytes(ngram_join.SKETCH // 8), root[n]) for sig, own in members.items() for n in own]
    df = spark.createDataFrame(given, "sig long, node long, n long, own long, sketch binary, root long")
    expect = {(a, b) for own in members.values() for a in own for b in own if a < b and root[a] != root[b]}
    for tile in (7, 512):
        found = [tuple(sorted(r)) for r in ngram_join.tile_pairs(df, tile).collect()]
        assert set(found) == expect
        assert len(found) < 1.01 * len(expect)


def test_long_text_and_empty_tables(spark):
    long = " ".join(f"w{i % 50_021}" for i in range(200_000))
    docs = [(1, long), (2, long + " end"), (3, "w1 " * 100_000)]
    assert rows(ngram_join.similar_documents(frame(spark, docs))) == [(1, 50021, 1), (2, 50022, 1), (3, 1, 3)]
    assert ngram_join.similar_documents(frame(spark, docs).limit(0)).count() == 0
    assert rows(ngram_join.similar_documents(frame(spark, [(5, None)]))) == [(5, 0, 5)]


def test_token_sets_follow_texts():
    texts = [b"a b c d e f", None, b"a b c d e", b"A B c d  e\nf a b c d e", b"", b"x", b"y x"]
    sets = ngram_join.token_sets(texts)
    assert list(map(len, sets)) == [2, 0, 1, 6, 0, 1, 1]
    assert np.isin(sets[2], sets[0]).all() and np.isin(sets[0], sets[3]).all()
    assert ngram_join.token_sets([b"x"])[0].tolist() == sets[5].tolist() and sets[5] != sets[6]
