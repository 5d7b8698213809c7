"""LM scoring by prediction by partial matching, pretrained on part of the corpus.

The byte-context trie is held as counts of (context, symbol), from the longest context
down to none. A symbol is looked for in the longest context that was seen; each context
in which it is missing costs an escape, estimated from the number of distinct symbols
there (method D), and what that context holds is excluded from the shorter ones, down
to an even choice among symbols never seen. A text ends with a symbol of its own.

Everything is counted over all training texts, so the trie grows with them. Nothing of it
goes to the driver or to every task but the counts of single symbols after single symbols,
of which there are 257 x 257 at most. Texts are grouped into chunks of bounded size; a
chunk asks for the distinct words and contexts that it holds, gets their values by joins
on word and context, and scores its texts with them.

Null texts count as empty: they have the end only. ``base_score`` is a unigram model of words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandlens.llm.rows import checkpointed, pick, slices

ORDER = 5
CHUNK_BYTES = 24 << 20
#: Bits of a symbol: a byte, or ``EDGE``, which stands before and after a text.
WIDTH, EDGE = 9, 256
#: Text whose symbols are in memory at a time.
BLOCK_BYTES = 1 << 20


def low(order: int) -> int:
    """Bits of a symbol after ``order`` others."""
    return (1 << WIDTH * (order + 1)) - 1


def blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > BLOCK_BYTES:
            yield start, i
            start, total = i, 0
        total += len(text)
    if len(texts) > start:
        yield start, len(texts)


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Every symbol of every text with those before it, packed; and where each text's begin."""
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths + order + 1)
    starts = ends - lengths - order - 1
    symbols = np.full(int(ends[-1]) if len(texts) else 0, EDGE, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[(starts[:, None] + np.arange(order)).ravel()] = False  # what stands before a text
    predicted = inside.copy()
    inside[ends - 1] = False
    symbols[inside] = np.frombuffer(b"".join(texts), np.uint8)
    packed = symbols.copy()
    for back in range(1, order + 1):
        packed[back:] |= symbols[:-back] << (WIDTH * back)
    return packed[predicted], np.cumsum(lengths + 1) - lengths - 1


def counted(texts: list[bytes], learn: list[bool], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct packed symbols and how often they stand in the texts that are learned, 0 included."""
    runs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for own, part in ((1, [t for t, x in zip(texts, learn, strict=True) if x]), (0, [t for t, x in zip(texts, learn, strict=True) if not x])):
        for a, b in blocks(part):
            keys, n = np.unique(grams(part[a:b], order)[0], return_counts=True)
            runs.append((keys, own * n))
            # Only runs of like size meet, so a key is merged a logarithmic number of times.
            while len(runs) > 1 and 2 * len(runs[-1][0]) > len(runs[-2][0]):
                runs.append(merged(runs.pop(), runs.pop()))
    while len(runs) > 1:
        runs.append(merged(runs.pop(), runs.pop()))
    return runs[0]


def merged(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sums of two sorted runs of distinct keys."""
    keys, sums = (np.concatenate(x) for x in zip(one, other, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, sums = keys[order], sums[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(sums, first) if len(first) else sums


class Places:
    """Where each of some distinct keys stands: a hash table with open addresses, at most half full."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.bits = keys, max(1, (2 * len(keys)).bit_length())
        self.table = np.full(1 << self.bits, -1, np.int32)
        left, slots = np.arange(len(keys), dtype=np.int32), self.slots(keys)
        while len(left):
            free = self.table[slots] < 0
            self.table[slots[free]] = left[free]
            again = self.table[slots] != left
            left, slots = left[again], self.after(slots[again])

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).view(np.int64)

    def after(self, slots: np.ndarray) -> np.ndarray:
        return slots + 1 & len(self.table) - 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The places of keys that are all there."""
        if not len(keys):
            return np.zeros(0, np.int32)
        slots = self.slots(keys)
        found = self.table[slots]
        open_ = np.flatnonzero(self.keys[found] != keys) if len(self.keys) else np.arange(len(keys))
        slots = slots[open_]
        while len(open_):
            if (found[open_] < 0).any():
                raise KeyError("a key that is not there")
            slots = self.after(slots)
            found[open_] = self.table[slots]
            wrong = self.keys[found[open_]] != keys[open_]
            open_, slots = open_[wrong], slots[wrong]
        return found


def word_counts(texts: list[bytes], learn: list[bool]) -> Counter:
    found: Counter = Counter()
    for text, own in zip(texts, learn, strict=True):
        words = text.split()
        found.update(words if own else dict.fromkeys(words, 0))
    return found


class Values:
    """What the words and contexts of a chunk are worth, held in memory once besides the given columns."""

    def __init__(self, word: pa.ChunkedArray, key: pa.ChunkedArray, value: pa.ChunkedArray):
        self.counts = {}
        for words, n in zip(word.chunks, value.chunks, strict=True):
            spoken = words.is_valid()
            # As integers, the small of which are the same objects.
            self.counts.update(zip(words.filter(spoken).to_pylist(), n.filter(spoken).cast(pa.int64()).to_pylist(), strict=True))
        packed = key.is_valid()
        self.known, self.value = Places(key.filter(packed).to_numpy()), value.filter(packed).to_numpy()

    def base_scores(self, texts: list[bytes], learned: int, tokens: int, vocabulary: int) -> list[pa.Array]:
        """n_tokens, n_known and base_score of each text."""
        n_tokens, n_known, base = [], [], []
        for text in texts:
            split = text.split()
            c = np.fromiter(map(self.counts.__getitem__, split), float, len(split))
            c = np.append(c, learned)
            n_tokens.append(len(c))
            n_known.append(int((c > 0).sum()))
            base.append(float((np.log10(c + 0.1) - np.log10(tokens + 0.1 * (vocabulary + 1))).sum()))
        return [pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64())]

    def scores(self, texts: list[bytes], order: int) -> pa.Array:
        own, starts = grams(texts, order)
        return pa.array(np.add.reduceat(self.value[self.known.find(own)], starts))


class Trie:
    """Counts by order; the orders above ``shared`` hold the contexts of this group only."""

    def __init__(self, keys: np.ndarray, sums: np.ndarray, order: int, pair_keys: np.ndarray, pair_sums: np.ndarray):
        self.order, self.levels = order, {}
        keys, sums = keys[sums > 0], sums[sums > 0]
        for k in range(order, -1, -1):
            if k == 1:
                keys, sums = pair_keys, pair_sums
            own, at = np.unique(keys & low(k), return_inverse=True)
            n = np.bincount(at, sums, len(own)) if len(own) else np.zeros(0)
            contexts, of = np.unique(own >> WIDTH, return_inverse=True)
            self.levels[k] = {
                "keys": own, "n": n, "contexts": contexts, "of": of, "total": np.bincount(of, n, len(contexts)),
                "distinct": np.bincount(of, minlength=len(contexts)).astype(float),
            }
        for k in range(order, 0, -1):  # what a context's symbols count in the next shorter one
            here, below = self.levels[k], self.levels[k - 1]
            n = self.find(below["keys"], here["keys"] & low(k - 1))
            here["excluded"] = np.bincount(here["of"], below["n"][n] if len(n) else None, len(here["contexts"]))

    @staticmethod
    def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(table, keys), max(0, len(table) - 1))

    def log_probability(self, keys: np.ndarray) -> np.ndarray:
        """log10 of the probability of each packed symbol after its context."""
        score, open_ = np.zeros(len(keys)), np.arange(len(keys))
        above = np.full(len(keys), -1)  # the longer context that was tried last
        for k in range(self.order, -1, -1):
            level = self.levels[k]
            if len(level["contexts"]) == 0 or len(open_) == 0:
                continue
            wanted = keys[open_] & low(k)
            context = self.find(level["contexts"], wanted >> WIDTH)
            seen = level["contexts"][context] == wanted >> WIDTH
            at, context, wanted = open_[seen], context[seen], wanted[seen]
            total, distinct = level["total"][context], level["distinct"][context]
            tried = above[at] >= 0
            if k < self.order:
                longer = self.levels[k + 1]
                total[tried] -= longer["excluded"][above[at[tried]]]
                distinct[tried] -= longer["distinct"][above[at[tried]]]
            place = self.find(level["keys"], wanted)
            known = level["keys"][place] == wanted
            score[at[known]] += np.log10((level["n"][place[known]] - 0.5) / total[known])
            escaped = ~known & (distinct > 0)
            score[at[escaped]] += np.log10(0.5 * distinct[escaped] / total[escaped])
            above[at[~known]] = context[~known]
            done = np.zeros(len(keys), bool)
            done[at[known]] = True
            open_ = open_[~done[open_]]
        never = EDGE + 1 - (self.levels[0]["distinct"][0] if len(self.levels[0]["distinct"]) else 0)
        score[open_] -= np.log10(max(1.0, never))
        return score


def score(
    docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """id, learned, n_tokens, n_known, train_tokens, base_score and score (log10 probability) of every row.

    ``learn``, over the id, says which rows are learned from.
    """
    if not 2 <= order <= 6:
        raise ValueError("order: 2 to 6")
    rows = pick(docs, doc_id, text).withColumn("learn", F.coalesce(learn, F.lit(False))).toDF("id", "text", "learn")
    rows = rows.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    size, learned = rows.agg(F.sum(F.octet_length("text")), F.count_if("learn")).first()
    chunks = max(1, -(-(size or 0) // chunk_bytes))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)))

    def columns(table) -> tuple[list[bytes], list[bool]]:
        # One by one, so that the texts are in memory once.
        return [t.as_py().lower() for t in table["text"].cast(pa.large_binary())], table["learn"].to_pylist()

    def all_grams(batches):
        for batch in batches:
            keys, sums = counted(*columns(batch), order)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["key", "n"])

    def all_words(batches):
        for batch in batches:
            found = word_counts(*columns(batch))
            words = [w for w, n in found.items() if n]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array([found[w] for w in words], pa.int64())], names=["word", "n"])

    plain = rows.select("text", "learn")
    distinct, spoken = plain.mapInArrow(all_words, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")).agg(
        F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    tokens, vocabulary = spoken + learned, distinct + (learned > 0)
    totals = checkpointed(plain.mapInArrow(all_grams, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")))
    # Pairs of symbols: their number has a bound.
    pairs = totals.where("n > 0").groupBy(F.col("key").bitwiseAND(F.lit(low(1))).alias("key")).agg(F.sum("n").alias("n")).collect()
    sent = docs.sparkSession.sparkContext.broadcast((np.array([p.key for p in pairs], np.int64), np.array([p.n for p in pairs], np.int64)))
    # A group holds all that follows some pairs of symbols, so its trie is whole from order 2 on.
    groups = max(8, 2 * chunks)
    group = F.pmod(F.xxhash64(F.shiftright("key", WIDTH).bitwiseAND(F.lit(low(1)))), F.lit(groups))

    def probabilities(table: pa.Table) -> pa.Table:
        keys, sums = table["key"].to_numpy(), table["n"].to_numpy()
        return pa.table({"key": keys, "value": Trie(keys, sums, order, *sent.value).log_probability(keys)})

    values = totals.withColumn("group", group).groupBy("group").applyInArrow(probabilities, "key bigint, value double")

    def chunk_words(table: pa.Table) -> pa.Table:
        found = word_counts(*columns(table))
        return pa.table({
            "chunk": pa.array(np.full(len(found), table["chunk"][0].as_py())), "word": pa.array(list(found), pa.binary()),
            "n": pa.array(list(found.values()), pa.int64()),
        })

    def chunk_grams(table: pa.Table) -> pa.Table:
        keys, _ = counted(*columns(table), order)
        return pa.table({"chunk": pa.array(np.full(len(keys), table["chunk"][0].as_py())), "key": keys})

    words = rows.groupBy("chunk").applyInArrow(chunk_words, "chunk bigint, word binary, n bigint")
    words = words.select(
        "chunk", "word", F.lit(None).cast("bigint").alias("key"),
        F.sum("n").over(Window.partitionBy("word")).cast("double").alias("value"),
    )
    asked = rows.groupBy("chunk").applyInArrow(chunk_grams, "chunk bigint, key bigint").join(values, "key").select(
        "chunk", F.lit(None).cast("binary").alias("word"), "key", "value",
    )

    def chunk_scores(left: pa.Table, right: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # of the chunk before: the worker is kept
        values = Values(right["word"], right["key"], right["value"])
        parts = [[pa.array([], kind) for kind in (pa.int64(), pa.int64(), pa.float64(), pa.float64())]]
        at = left.schema.get_field_index("text")
        for batch in left.to_batches():
            for part in slices(batch, at, BLOCK_BYTES):
                texts, _ = columns(part)
                parts.append([*values.base_scores(texts, learned, tokens, vocabulary), values.scores(texts, order)])
        n_tokens, n_known, base, scores = map(pa.concat_arrays, zip(*parts, strict=True))
        return pa.table([
            left["id"], left["learn"], n_tokens, n_known, pa.array(np.full(len(left), tokens, np.int64)), base, scores,
        ], names=["id", "learn", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    id_type = rows.schema["id"].dataType.simpleString()
    result = f"id {id_type}, learn boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    scored = rows.groupBy("chunk").cogroup(words.union(asked).groupBy("chunk")).applyInArrow(chunk_scores, result)
    return scored.withColumnRenamed("id", doc_id).withColumnRenamed("learn", "learned")
