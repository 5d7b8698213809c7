import random
from collections import defaultdict

import numpy as np

from demandlens.llm import line_index

SPACE = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least=10):
    key = lambda line: line.strip(SPACE).translate(LOWER)
    order = lambda i: (i is None, i or 0)
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        gone = [len(key(x)) >= least and len(holders[key(x)]) > 1 and min(holders[key(x)], key=order) != i for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def cases():
    random.seed(2)
    pool = ["A common line of text", "a COMMON line of text\t", "  spaced  out line \r", "short", "ÄÖÜäöüßéèê", "äöüäöüßéèê",
            "x" * 10, "y" * 9, "", "   ", "ünïcödé is ten"] + [f"line number {i} of many" for i in range(40)]
    docs = [(i, "\n".join(random.choice(pool) for _ in range(random.randint(0, 12)))) for i in range(80)]
    return docs + [(3, "a common line of text"), (None, "A common line of text\nonly null here"), (None, "only null here"),
                   (90, None), (91, ""), (-5, "line number 1 of many\n\n\nline number 1 of many")]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_plain_version_both_ways(spark):
    docs = cases()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'' as kept_text", "1 as high", "2 as ID")
    expect = plain(docs)
    assert rows(line_index.dedup_lines(df)) == expect
    assert rows(line_index.dedup_lines(df, shard_keys=7)) == expect
    assert rows(line_index.dedup_lines(df, shard_keys=7, sent_bytes=0, group_lines=10)) == expect


def test_nothing_repeated_and_empty(spark):
    df = spark.createDataFrame([(1, "first line here"), (2, "other line here")], "doc_id long, text string")
    for sent in (0, 1 << 20):
        assert [r.n_dropped for r in line_index.dedup_lines(df, sent_bytes=sent).collect()] == [0, 0]
        assert line_index.dedup_lines(df.limit(0), sent_bytes=sent).collect() == []


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    high, low = rng.integers(0, 2**63, (2, 5000)).astype(np.uint64)
    low[:100] = low[100:200]  # half of the hash alone does not tell them apart
    shard = line_index.Shard.build(high, low)
    assert sorted(shard.find(high, low).tolist()) == list(range(5000))
    left = line_index.Shard([], b"", np.stack((high[:9], low[:9]), axis=1).tobytes())
    assert left.find(high[:10], low[:10]).tolist() == [*range(9), -1]
