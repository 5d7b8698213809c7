import math
import os
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from demandlens.llm import ppm

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def symbols(text):
    return [256] * 5 + list((text or "").translate(FOLD).encode()) + [256]


def plain(docs, learn, order=5):
    """A trie of dictionaries and explicit sets of excluded symbols."""
    trie = defaultdict(Counter)
    for i, text in docs:
        if learn(i):
            s = symbols(text)
            for at in range(5, len(s)):
                for k in range(order + 1):
                    trie[tuple(s[at - k:at])][s[at]] += 1

    def log_p(context, symbol):
        out, excluded = 0.0, set()
        for k in range(order, -1, -1):
            seen = trie.get(tuple(context[len(context) - k:]))
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in excluded}
            if symbol in left:
                return out + math.log10((left[symbol] - 0.5) / sum(left.values()))
            if left:
                out += math.log10(0.5 * len(left) / sum(left.values()))
            excluded |= set(left)
        return out - math.log10(257 - len(excluded))

    words = lambda t: [*(t or "").translate(FOLD).encode().split(), None]
    counts = Counter(w for i, t in docs if learn(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in docs:
        s = symbols(text)
        out.append((
            i, len(words(text)), sum(counts[w] > 0 for w in words(text)), n,
            sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(text)),
            sum(log_p(s[at - 5:at], s[at]) for at in range(5, len(s))),
        ))
    return out


def close(spark_rows, expect):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], round(r[5], 5))
    for a, b in zip(sorted(spark_rows, key=key), sorted(expect, key=key), strict=True):
        assert a[:4] == b[:4]
        assert math.isclose(a[4], b[4], rel_tol=1e-9) and math.isclose(a[5], b[5], rel_tol=1e-9)


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()]


def test_equals_plain_trie(spark):
    random.seed(12)
    words = ["the", "then", "The", "ten", "net", "über", "x", "a\tb", "\n", "日本"]
    docs = [(i, " ".join(random.choice(words) for _ in range(random.randint(0, 25)))) for i in range(40)]
    docs += [(3, None), (10, ""), (20, "never seen §§ zq\x00"), (None, "the net"), (7, "the " * 50), (7, "the " * 50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "2 as chunk", "'' as TEXT", "3 as learn")
    learn = F.coalesce(F.col("doc_id") % 10, F.lit(1)) != 0
    expect = plain(docs, lambda i: i is None or i % 10 != 0)
    close(rows(ppm.score(df, learn)), expect)
    close(rows(ppm.score(df, learn, chunk_bytes=200)), expect)
    held = ppm.score(df, learn).where("not learned").count()
    assert held == sum(i is not None and i % 10 == 0 for i, _ in docs)


def test_nothing_learned_and_empty(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in ppm.score(df, F.lit(False)).collect()}
    assert math.isclose(found[1].score, -3 * math.log10(257)) and found[1].n_known == 0
    assert (found[2].n_tokens, found[2].train_tokens) == (1, 0)
    assert ppm.score(df.limit(0), F.lit(True)).collect() == []


def test_better_than_words_alone_on_held_out_texts(spark):
    from demandlens.llm import queries

    if not os.path.isdir("/root/testdata/sf0.1"):
        pytest.skip("needs the documents of sf0.1")
    held = queries.op2_ppm(spark, "/root/testdata/sf0.1").where("held_out").collect()
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_runs_of_like_size_meet(monkeypatch):
    """Counts over many blocks are those of one, and no key is merged once per block."""
    texts = [bytes([i % 7, i % 11, i]) * 5 for i in range(200)]
    learn = [i % 3 != 0 for i in range(200)]
    whole = ppm.counted(texts, learn, 2)
    monkeypatch.setattr(ppm, "BLOCK_BYTES", 16)
    taken, merged = [], ppm.merged
    monkeypatch.setattr(ppm, "merged", lambda *runs: taken.append(sum(len(keys) for keys, _ in runs)) or merged(*runs))
    parts = ppm.counted(texts, learn, 2)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    assert sum(taken) < 20 * 200 * 16
    assert [len(x) for x in ppm.counted([], [], 2)] == [0, 0]


def test_places():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 54, 5000))
    np.random.default_rng(2).shuffle(keys)
    places = ppm.Places(keys)
    for asked in (keys, keys[::-1], keys[:0], np.repeat(keys[:7], 9)):
        assert (keys[places.find(asked)] == asked).all()
    for table in (places, ppm.Places(keys[:0])):
        with pytest.raises(KeyError):
            table.find(np.array([-1]))


def test_values_of_a_chunk_are_held_once():
    """Beside the columns that come with a chunk: no second copy of them, no object for each count."""
    n = 50_000
    words, keys = [b"word%06d" % i for i in range(n)], np.arange(n, dtype=np.int64) * 977
    pieces = [
        (pa.array(words[:7], pa.binary()), pa.nulls(7, pa.int64()), pa.array([1.0, 0.0, 2.0, 3.0, 1.0, 1.0, 1.0])),
        (pa.array([*words[7:], *[None] * n], pa.binary()), pa.concat_arrays([pa.nulls(n - 7, pa.int64()), pa.array(keys)]),
         pa.array(np.concatenate((np.full(n - 7, 2.0), -0.5 * np.arange(n))))),
    ]
    columns = [pa.chunked_array(c) for c in zip(*pieces, strict=True)]
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    values = ppm.Values(*columns)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert values.counts[words[3]] == 3 and values.counts[words[-1]] == 2 and len(values.counts) == n
    assert (values.value[values.known.find(keys[::-1])] == -0.5 * np.arange(n)[::-1]).all()
    assert held < 150 * n and pa.total_allocated_bytes() - before < 20 * n
    found = values.base_scores([b"word000003  word000001", b""], 4, 1000, 10)
    assert [c.to_pylist() for c in found[:2]] == [[3, 1], [2, 1]]
    assert math.isclose(found[2][1].as_py(), math.log10(4.1 / 1001.1))
