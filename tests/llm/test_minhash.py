import hashlib
import random

from demandlens.llm import minhash


def order(docs):
    return sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))


def cases():
    random.seed(9)
    words = [f"w{i}" for i in range(500)] + ["é", "日本"]
    docs = [(i * 3, " ".join(random.choice(words) for _ in range(random.choice([0, 1, 4, 5, 30, 300])))) for i in range(70)]
    docs += [(1000 + i, docs[5][1]) for i in range(3)] + [(-7, None), (2000, ""), (None, "null id text here")]
    random.shuffle(docs)
    return docs


def test_edited_texts_in_order(spark):
    docs = cases()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_chars", "2 as stretch", "3 as near")
    ordered = [(i, t or "") for i, t in order(docs)]
    for stretch in (1 << 20, 2000, 100):
        found = {r.doc_id: r for r in minhash.edited_likeness(df, stretch_bytes=stretch).collect()}
        assert len(found) == len(docs)
        for (i, text), (j, other) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
            cut = len(text) // 3
            edited = text[:len(text) - cut] + other[:cut]
            row = found[i]
            assert row.n_chars == len(text)
            assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert (row.near_next == 1.0) if text == other else True
            if edited == text:
                assert row.near_edited == 1.0 and row.fingerprint == row.edited_fingerprint
            own, nxt = set(shingled(text)), set(shingled(other))
            if min(len(own), len(nxt)) > 100:
                assert abs(row.near_next - len(own & nxt) / len(own | nxt)) < 0.12
                ed = set(shingled(edited))
                assert abs(row.near_edited - len(own & ed) / len(own | ed)) < 0.12
            assert found[j].fingerprint == row.fingerprint or text != other
    assert minhash.edited_likeness(df.limit(0)).collect() == []
    one = df.where("doc_id = 15")
    assert [r.near_next for r in minhash.edited_likeness(one).collect()] == [1.0]


def shingled(text):
    words = text.encode().lower().split()
    return [tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))]


def test_likeness_is_unbiased_and_packing_exact():
    random.seed(1)
    for bits in (1, 4, 8):
        maker, errors = minhash.Fingerprinter(bits=bits), []
        for share in (0.0, 0.3, 0.8):
            for trial in range(12):
                both = [f"{trial}s{i}" for i in range(int(400 * share))]
                a, b = ([*both, *(f"{trial}{x}{i}" for i in range(400 - len(both)))] for x in "ab")
                same = len(set(a) & set(b)) / len(set(a) | set(b))
                one = minhash.Fingerprinter(size=1, bits=bits)
                bins = [one.bins_of(" ".join(x).encode()) for x in (a, b)]
                errors.append(one.likeness(*bins) - same)
                assert (one.unpack(one.pack(bins[0])) == bins[0]).all()
        assert abs(sum(errors) / len(errors)) < 0.03
        assert maker.likeness(maker.bins_of(b""), maker.bins_of(b"")) == 1.0


def test_fingerprints_of_equal_texts(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, "")], "doc_id long, text string")
    found = {r.doc_id: r.fingerprint for r in minhash.fingerprints(df).collect()}
    assert found[1] == found[2] != found[3] == found[4]
    assert len(found[1]) == minhash.BINS * minhash.BITS // 4
