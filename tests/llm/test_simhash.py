import random

import numpy as np
import xxhash

from demandlens.llm import simhash


def plain_print(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bound=3):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bound:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def expected(docs):
    prints = [plain_print(t) for _, t in docs]
    part = plain_components(prints)
    least = {p: min((i for (i, _), q in zip(docs, part, strict=True) if q == p and i is not None), default=None) for p in part}
    return sorted(((i, f"{f:016x}", least[p]) for (i, _), f, p in zip(docs, prints, part, strict=True)), key=repr)


def cases():
    random.seed(4)
    words = [f"w{i}" for i in range(300)]
    docs = []
    for i in range(40):
        text = [random.choice(words) for _ in range(random.choice([1, 2, 3, 60, 400]))]
        docs.append((10 * i, " ".join(text)))
        for j in range(random.choice([0, 0, 3])):
            text[random.randrange(len(text))] = random.choice(words)
            docs.append((10 * i + j + 1, "\t".join(text).upper() if j else " ".join(text)))
    return docs + [(500, None), (501, ""), (502, " \n "), (None, "alone in the world of words"), (None, docs[0][1]), (0, docs[0][1])]


def test_equals_all_pairs(spark):
    docs = cases()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as fingerprint", "2 as TEXT", "3 as node")
    assert sorted((tuple(r) for r in simhash.simhash(df).collect()), key=repr) == expected(docs)
    assert simhash.simhash(df.limit(0)).collect() == []


def test_links_connect_what_all_pairs_connect(spark):
    """Chains, dense groups beyond ``SMALL``, and every number of blocks."""
    rng = random.Random(6)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for base in list(prints)[:6]:
        for _ in range(60):
            base ^= 1 << rng.randrange(64) if rng.random() < 0.5 else 1 << rng.randrange(12)
            prints.add(base)
    prints = sorted(prints)
    part = plain_components(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    found = simhash.components(simhash.links(df), "a", "b").collect()
    root = {p: p for p in signed} | {r.node: r.root for r in found}
    groups = lambda labels: sorted(sorted(i for i, x in enumerate(labels) if x == y) for y in set(labels))
    assert groups([root[p] for p in signed]) == groups(part)
    for count in (10, 10**8, 10**10, 10**13):
        masks = simhash.key_masks(count, 3)
        for _ in range(300):
            other = 0
            for bit in rng.sample(range(64), 3):
                other |= 1 << bit
            assert any(other & m == 0 for m in masks)


def test_forest_and_pairs_agree():
    rng = np.random.default_rng(3)
    prints = np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 9, 14).astype(np.uint64))
    prints = np.unique(prints)
    pairs = simhash.by_offset(prints, np.zeros(len(prints), int), 3)
    assert pairs.shape[1] == len(prints) * (len(prints) - 1) // 2
    assert simhash.forest(prints, 3).shape[1] == len(prints) - 1


def test_one_of_each(spark):
    docs = cases()
    df = spark.createDataFrame([(i, t, "en", 5) for i, t in docs], "doc_id long, text string, lang string, __mark int")
    kept = simhash.one_of_each(df).collect()
    least = {c for _, _, c in expected(docs)}
    assert sorted((r.doc_id for r in kept), key=repr) == sorted(least, key=repr)
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "__mark"} and {r["__mark"] for r in kept} == {5}
    assert simhash.one_of_each(df.limit(0)).count() == 0
