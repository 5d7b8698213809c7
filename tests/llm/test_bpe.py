import base64
import hashlib
import random

import public_tokenizers
import tiktoken

from demandlens.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    random.seed(7)
    out = ["", "a", "a" * 3001, " " * 77, "\n\n  x \n y", "it's  1,234\t<|endoftext|>", "\x1c\x1d a\x85b 　c"]
    for top in (0x7F, 0x250, 0x3000, 0x10FFFF):
        for _ in range(60):
            points = (random.randint(0, top) for _ in range(random.randint(1, 50)))
            out.append("".join(chr(p) for p in points if not 0xD800 <= p < 0xE000))
    out += ["".join(random.choice(["the", " ", "re", "'s", "é", "\n", "1", "!?"]) for _ in range(90)) for _ in range(60)]
    return out


def test_ids_equal_the_library(spark):
    known, rows = library(), [(i, t) for i, t in enumerate(texts())] + [(-1, None), (0, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as n_tokens", "'' as TEXT")
    found = bpe.bpe(df, PATH, public_tokenizers.PATTERN).collect()
    assert len(found) == len(rows)
    expect = sorted((i, known.encode_ordinary(t or ""), t or "") for i, t in rows)
    for row, (i, ids, text) in zip(sorted(found, key=lambda r: (r.doc_id, r.token_ids)), sorted(expect), strict=True):
        assert (row.doc_id, row.token_ids, row.n_tokens) == (i, ids, len(ids))
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table_and_other_pattern(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.bpe(none, PATH, public_tokenizers.PATTERN).collect() == []
    one = spark.createDataFrame([(1, "ab cd")], "doc_id long, text string")
    whole = bpe.bpe(one, PATH, r"(?s).+", before_spaces=False).first()
    assert whole.token_ids == library()._core_bpe.encode_single_piece(b"ab cd")


def test_a_lower_rank_that_comes_up_late():
    """With these ranks ``abc`` ranks below ``ab``, so the order of single merges decides."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257, b"cab": 258}
    using = bpe.Codec(ranks, r"(?s).+")

    def plain(word):
        parts = [word[i:i + 1] for i in range(len(word))]
        while True:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks),
                       default=None)
            if best is None:
                return [ranks[p] for p in parts]
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    random.seed(3)
    words = ["".join(random.choice("abc") for _ in range(random.randint(1, 12))).encode() for _ in range(400)]
    ids, starts = using.encode_words(words)
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)] == [plain(w) for w in words]
