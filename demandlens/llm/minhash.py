"""Document fingerprints by one-permutation MinHash.

Every shingle is hashed once; the high bits of the hash choose a bin and the smallest
hash of a bin stays. A bin that got none borrows from another one, the first in an order
of probes that is fixed for the bin (optimal densification): which one does not depend
on the other documents, and every filled bin is equally likely. Of each smallest hash
the low-order bits are kept and packed. Two fingerprints agree in a bin by chance in one
of 2^bits cases, which the likeness corrects.

Null texts count as empty. A text of fewer words than a shingle is one shingle, also if
it has none, so every text has a fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.rows import map_texts, pick, slices

SHINGLE, BINS, BITS = 5, 512, 4
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Words whose hashes a task remembers; bounds its memory only.
REMEMBERED = 500_000
#: Text of one stretch of neighbouring ids, and the most stretches.
STRETCH_BYTES, MOST_STRETCHES = 16 << 20, 1 << 16


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = made = xxhash.xxh64_intdigest(word)
        return made


@lru_cache(maxsize=4)
def probes(bins: int) -> np.ndarray:
    """For each bin the order in which it asks the others."""
    rng = np.random.default_rng(bins)
    return np.argsort(rng.random((bins, bins)), axis=1).astype(np.int32)


class Fingerprinter:
    def __init__(self, size: int = SHINGLE, bins: int = BINS, bits: int = BITS):
        if bins & (bins - 1) or bits not in (1, 2, 4, 8):
            raise ValueError("bins: a power of two; bits: 1, 2, 4 or 8")
        self.size, self.bins, self.bits = size, bins, bits
        self.words = WordHashes()
        self.down = np.uint64(64 - bins.bit_length() + 1)
        self.order = probes(bins)

    def shingles(self, text: bytes) -> np.ndarray:
        found = text.lower().split()
        words = np.fromiter(map(self.words.__getitem__, found), np.uint64, len(found))
        if len(words) < self.size:
            total = np.zeros(1, np.uint64)
            for word in words:
                total = (total + word) * BASE
            total = total + np.uint64(len(words))
        else:
            total = np.zeros(len(words) - self.size + 1, np.uint64)
            for i in range(self.size):
                total = (total + words[i:len(words) - self.size + 1 + i]) * BASE
        total = (total ^ (total >> np.uint64(31))) * MIX
        return total ^ (total >> np.uint64(29))

    def bins_of(self, text: bytes) -> np.ndarray:
        """The kept bits of every bin."""
        hashes = np.sort(self.shingles(text))
        place = (hashes >> self.down).astype(np.int64)
        first = np.concatenate(([True], place[1:] != place[:-1]))
        filled = np.zeros(self.bins, bool)
        filled[place[first]] = True
        kept = np.zeros(self.bins, np.uint8)
        kept[place[first]] = (hashes[first] & np.uint64((1 << self.bits) - 1)).astype(np.uint8)
        empty, at, wide = np.flatnonzero(~filled), 0, 8
        while len(empty):
            ask = self.order[empty, at:at + wide]
            answers = filled[ask]
            some = answers.any(axis=1)
            kept[empty[some]] = kept[ask[some, answers[some].argmax(axis=1)]]
            empty, at, wide = empty[~some], at + wide, 8 * wide
        return kept

    def pack(self, bins: np.ndarray) -> bytes:
        each = np.unpackbits(bins[:, None], axis=1)[:, 8 - self.bits:]
        return np.packbits(each.ravel()).tobytes()

    def unpack(self, packed: bytes) -> np.ndarray:
        each = np.unpackbits(np.frombuffer(packed, np.uint8)).reshape(-1, self.bits)
        return np.packbits(each, axis=1)[:, 0] >> (8 - self.bits)

    def likeness(self, a: np.ndarray, b: np.ndarray) -> float:
        """Estimated Jaccard similarity of the shingles, from the bins' kept bits."""
        chance = 0.5 ** self.bits
        return min(1.0, max(0.0, (float(np.mean(a == b)) - chance) / (1 - chance)))


def fingerprints(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
    size: int = SHINGLE, bins: int = BINS, bits: int = BITS,
) -> DataFrame:
    """``keep`` and the packed fingerprint (hex) of every row."""
    def make():
        maker = Fingerprinter(size, bins, bits)
        return lambda texts: [[maker.pack(maker.bins_of(t or b"")).hex() for t in texts]]

    return map_texts(docs, list(keep), text, "fingerprint string", make)


def in_order(docs: DataFrame, doc_id: str, text: str, stretch_bytes: int) -> DataFrame:
    """Rows (stretch, copied, id, text) dealt by stretches of descending ids and sorted in each.

    Nulls come last, equal ids by hash of the text. The first row of each stretch stands,
    marked as copied, at the end of the one before too, and that of the first in the last. The
    driver learns one id and one hash for each stretch, of which there are at most ``MOST_STRETCHES``.
    """
    rows = pick(docs, doc_id, text).toDF("id", "text").withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = rows.withColumns({
        "down": F.bitwise_not(F.col("id").cast("bigint")), "hash": F.xxhash64("text"),
    }).withColumn("near", F.col("down").cast("double"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = min(MOST_STRETCHES, max(1, -(-size // stretch_bytes)))
    cuts = rows.agg(F.percentile_approx("near", [i / count for i in range(1, count)], 4 * count + 1000)).first()[0] if count > 1 else []
    splits = [-float("inf"), *sorted(set(cuts or [])), float("inf")]
    if len(splits) == 2:
        splits.insert(1, 0.0)
    rows = Bucketizer(splits=splits, inputCol="near", outputCol="stretch", handleInvalid="keep").transform(rows)
    rows = rows.withColumn("stretch", F.when(F.col("near").isNull(), len(splits)).otherwise(F.col("stretch").cast("int")))
    order = F.struct(F.col("down").isNull().alias("last"), "down", "hash")
    least = rows.groupBy("stretch").agg(F.min(order).alias("o")).select("stretch", "o.down", "o.hash").collect()
    firsts = sorted(tuple(r) for r in least)
    before = [(s, d, h, firsts[i - 1][0]) for i, (s, d, h) in enumerate(firsts)]
    # One row for each stretch, so its size has a bound.
    mark = rows.sparkSession.createDataFrame(before, "stretch_ int, down_ bigint, hash_ bigint, before int")
    same = (F.col("stretch") == F.col("stretch_")) & F.col("down").eqNullSafe(F.col("down_")) & (F.col("hash") == F.col("hash_"))
    rows = rows.join(F.broadcast(mark), same, "left")
    own = F.struct(F.col("stretch"), F.lit(0).alias("copied"))
    copy = F.struct(F.col("before").alias("stretch"), F.lit(1).alias("copied"))
    rows = rows.select(F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("at"), "id", "text", "down", "hash")
    rows = rows.select("at.stretch", "at.copied", "id", "text", "down", "hash")
    return rows.repartition("stretch").sortWithinPartitions(
        "stretch", "copied", F.col("down").asc_nulls_last(), "hash",
    ).select("stretch", "copied", "id", "text")


def edited_likeness(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, bins: int = BINS, bits: int = BITS,
    stretch_bytes: int = STRETCH_BYTES,
) -> DataFrame:
    """Each text against itself with its last third taken from the next document, and against that.

    Next is by descending id; after the last comes the first.
    """
    id_type = pick(docs, doc_id).schema[0].dataType.simpleString()
    schema = (f"`{doc_id}` {id_type}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Fingerprinter(size, bins, bits)
        waiting = None  # the last row, whose next one is still to come
        for whole in batches:
            for batch in slices(whole, 3, 4 << 20):
                out: list[tuple] = []
                for stretch, copied, i, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    row = (stretch, copied, i, own, maker.bins_of(own.encode()))
                    if waiting is not None and waiting[0] == stretch and not waiting[1]:
                        out.append(compared(maker, waiting[2:], row[2:]))
                    waiting = row
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[c] for o in out], t) for c, t in enumerate([
                        batch.schema.field(2).type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2])],
                    names=[doc_id, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return in_order(docs, doc_id, text, stretch_bytes).mapInArrow(run, schema)


def compared(maker: Fingerprinter, own: tuple, following: tuple) -> tuple:
    i, text, bins = own
    _, other, other_bins = following
    cut = len(text) // 3
    edited = (text[:len(text) - cut] + other[:cut]).encode()
    edited_bins = maker.bins_of(edited)
    return (
        i, len(text), hashlib.sha256(edited).hexdigest(), maker.pack(bins).hex(), maker.pack(edited_bins).hex(),
        maker.likeness(bins, edited_bins), maker.likeness(bins, other_bins),
    )
