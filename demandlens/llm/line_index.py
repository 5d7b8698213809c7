"""Line dedup by a sharded minimal perfect hash.

Keys of lines become 128-bit hashes. Those that stand in several documents are dealt to
shards; each shard is a minimal perfect hash (levels of bit arrays, in the manner of
BBHash) that numbers its keys, with one array each for the other half of the hash as
fingerprint, for the smallest document and for the number of documents. Documents look
up their lines in the arrays; no document's lines are joined.

Arrays up to ``sent_bytes`` go to all tasks. Beyond that, the lines' hashes go to the
shards: each shard meets its lines in groups of bounded size, so a line that stands in a
third of all documents is split, and only what is to be dropped comes back.

A null text is one empty line. Rows of one id are one document; a null id is a document
that comes after all others. Lines whose key is shorter than ``least`` always stay.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.rows import checkpointed, map_texts, pick

LEAST = 10
SHARD_KEYS = 250_000
SENT_BYTES = 64 << 20
#: Lines that meet one shard in one group, when lines go to the shards.
GROUP_LINES = 500_000
NO_ID = np.int64(2**63 - 1)
LEVELS, SPREAD = 40, 2
INDEX = "shard bigint, keys bigint, sizes array<bigint>, bits binary, rest binary, prints binary, firsts binary, counts binary"
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def line_key(line: bytes) -> bytes:
    return line.strip().lower()  # of bytes: ASCII white space and letters only


def hashes(lines: list[bytes], least: int) -> np.ndarray:
    """Rows (index of the line, high half, low half) of the lines with long enough keys."""
    out = []
    for i, line in enumerate(lines):
        key = line_key(line)
        if len(key) >= least and (len(key) >= 4 * least or len(key.decode(errors="replace")) >= least):
            h = xxhash.xxh3_128_intdigest(key)
            out.append((i, h >> 64, h & 0xFFFFFFFFFFFFFFFF))
    return np.array(out, np.uint64).reshape(-1, 3)


def mixed(low: np.ndarray, high: np.ndarray, level: int) -> np.ndarray:
    salt = np.uint64((level + 1) * int(M1) & 0xFFFFFFFFFFFFFFFF)
    x = (low ^ salt) * M2 + high
    x ^= x >> np.uint64(32)
    x *= M2
    return x ^ (x >> np.uint64(29))


class Shard:
    """A minimal perfect hash of distinct (high, low) keys; ``find`` gives each key's number, or -1."""

    def __init__(self, sizes: list[int], bits: bytes, rest: bytes):
        self.sizes = sizes
        words = np.frombuffer(bits, np.uint64)
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
        self.words, self.ones = words, ones
        self.rest = {k: i for i, k in enumerate(map(tuple, np.frombuffer(rest, np.uint64).reshape(-1, 2).tolist()))}

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> Shard:
        sizes, parts = [], []
        while len(low) and len(sizes) < LEVELS:
            level = len(sizes)
            size = 64 * -(-SPREAD * len(low) // 64)
            place = mixed(low, high, level) % np.uint64(size)
            taken = np.bincount(place.astype(np.int64), minlength=size)
            parts.append(np.packbits(taken == 1, bitorder="little").view(np.uint64))
            sizes.append(size)
            again = taken[place.astype(np.int64)] > 1
            high, low = high[again], low[again]
        bits = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        return cls(sizes, bits.tobytes(), np.stack((high, low), axis=1).tobytes())

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        number = np.full(len(low), -1, np.int64)
        open_, start = np.arange(len(low)), 0
        for level, size in enumerate(self.sizes):
            place = mixed(low[open_], high[open_], level) % np.uint64(size)
            word = start + (place >> np.uint64(6)).astype(np.int64)
            bit = place & np.uint64(63)
            own = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            number[open_[own]] = self.ones[word[own]] + np.bitwise_count(below[own])
            open_, start = open_[~own], start + size // 64
        if self.rest:
            base = int(self.ones[-1])
            for i in open_.tolist():
                at = self.rest.get((int(high[i]), int(low[i])))
                if at is not None:
                    number[i] = base + at
        return number


class Index:
    """A shard with its arrays, read from a row of the index table."""

    def __init__(self, row):
        self.shard = Shard(list(row["sizes"]), bytes(row["bits"]), bytes(row["rest"]))
        self.prints = np.frombuffer(bytes(row["prints"]), np.uint64)
        self.firsts = np.frombuffer(bytes(row["firsts"]), np.int64)
        self.counts = np.frombuffer(bytes(row["counts"]), np.uint32)

    def repeats(self, high: np.ndarray, low: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Whether each line stands in several documents, of which this is not the first."""
        at = self.shard.find(high, low)
        known = at >= 0
        at = np.where(known, at, 0)
        return known & (self.prints[at] == high) & (self.counts[at] > 1) & (self.firsts[at] != ids)


def index_row(shard: int, rows: pd.DataFrame) -> pd.DataFrame:
    high, low = (rows[c].to_numpy(np.int64).view(np.uint64) for c in ("high", "low"))
    built = Shard.build(high, low)
    at = built.find(high, low)
    prints, firsts, counts = np.zeros_like(high), np.zeros(len(high), np.int64), np.zeros(len(high), np.uint32)
    prints[at], firsts[at], counts[at] = high, rows["first"].to_numpy(), np.minimum(rows["n"].to_numpy(), 2**32 - 1)
    rest = np.array(list(built.rest), np.uint64).tobytes()
    return pd.DataFrame([(
        shard, len(high), built.sizes, built.words.tobytes(), rest, prints.tobytes(), firsts.tobytes(), counts.tobytes(),
    )], columns=[c.split()[0] for c in INDEX.split(", ")])


def line_hashes(docs: DataFrame, doc_id: str, text: str, least: int) -> DataFrame:
    """One row (id, high, low) for each distinct line key of each row."""
    kind = pa.list_(pa.struct([("high", pa.int64()), ("low", pa.int64())]))

    def function(texts):
        found = [np.unique(hashes((t or b"").split(b"\n"), least)[:, 1:], axis=0) for t in texts]
        offsets = np.cumsum([0, *(len(f) for f in found)]).astype(np.int32)
        flat = np.concatenate([np.zeros((0, 2), np.uint64), *found]).view(np.int64)
        halves = pa.StructArray.from_arrays([pa.array(flat[:, i].copy()) for i in (0, 1)], ["high", "low"])
        return [pa.ListArray.from_arrays(pa.array(offsets), halves).cast(kind)]

    rows = map_texts(docs, [doc_id], text, "keys array<struct<high:bigint,low:bigint>>", lambda: function)
    return rows.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(int(NO_ID))).alias("id"), F.explode("keys").alias("k")).select("id", "k.*")


def shards(lines: DataFrame, shard_keys: int) -> tuple[DataFrame, int]:
    """The index table over all keys that stand in at least two documents, and its number of shards."""
    repeated = checkpointed(
        lines.groupBy("high", "low").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
        .where("first < last").drop("last")
    )
    count = max(1, -(-repeated.count() // shard_keys))
    dealt = repeated.withColumn("shard", F.pmod("low", F.lit(count)))
    return dealt.groupBy("shard").applyInPandas(lambda key, rows: index_row(key[0], rows), INDEX), count


def kept_lines(text: bytes | None, drop: np.ndarray) -> tuple[int, bytes]:
    lines = (text or b"").split(b"\n")
    gone = set(drop.tolist())
    return len(lines), b"\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else text or b""


def dedup_lines(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), doc_id: str = "doc_id", text: str = "text", least: int = LEAST,
    shard_keys: int = SHARD_KEYS, sent_bytes: int = SENT_BYTES, group_lines: int = GROUP_LINES,
) -> DataFrame:
    """``keep``, n_lines, n_dropped and kept_text of every row. ``doc_id`` is a whole number, among ``keep``."""
    lines = line_hashes(docs, doc_id, text, least)
    table, count = shards(lines, shard_keys)
    index = checkpointed(table)
    binary = ("bits", "rest", "prints", "firsts", "counts")
    size = index.agg(F.sum(sum((F.octet_length(c) for c in binary), F.lit(0)))).first()[0] or 0
    result = "n_lines bigint, n_dropped bigint, kept_text string"
    at = keep.index(doc_id)

    def decided(texts, found) -> list:
        kept = [kept_lines(t, d) for t, d in zip(texts, found, strict=True)]
        return [[n for n, _ in kept], [len(d) for d in found], pa.array([t for _, t in kept], pa.binary()).view(pa.string())]

    if size <= sent_bytes:
        sent = docs.sparkSession.sparkContext.broadcast([r.asDict() for r in index.collect()])

        def make():
            indexes = {row["shard"]: Index(row) for row in sent.value}

            def function(texts, columns):
                ids = columns[at].cast(pa.int64()).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
                each = [hashes((t or b"").split(b"\n"), least) for t in texts]
                owner = np.repeat(np.arange(len(each)), [len(e) for e in each])
                flat = np.concatenate([np.zeros((0, 3), np.uint64), *each])
                drop = np.zeros(len(flat), bool)
                shard = flat[:, 2].view(np.int64) % count  # like pmod
                for number in np.unique(shard):
                    if number in indexes:
                        own = np.flatnonzero(shard == number)
                        drop[own] = indexes[number].repeats(flat[own, 1], flat[own, 2], ids[owner[own]])
                ends = np.searchsorted(owner[drop], np.arange(len(each) + 1))
                places = flat[drop, 0]
                return decided(texts, [places[a:b] for a, b in zip(ends, ends[1:], strict=False)])

            return function

        return map_texts(docs, list(keep), text, result, make, with_kept=True)

    asked = lines.withColumn("shard", F.pmod("low", F.lit(count)))
    groups = asked.groupBy("shard").agg(F.ceil(F.count("*") / group_lines).alias("groups"))
    asked = asked.join(groups, "shard").withColumn("part", F.pmod(F.xxhash64("id"), "groups")).drop("groups")
    spread = index.join(groups.toDF("shard", "groups"), "shard").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1))).drop("groups")

    def probe(own: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        if len(own) == 0 or len(table) == 0:
            return own[["id", "high", "low"]].iloc[:0]
        high, low = (own[c].to_numpy(np.int64).view(np.uint64) for c in ("high", "low"))
        return own.loc[Index(table.iloc[0]).repeats(high, low, own["id"].to_numpy()), ["id", "high", "low"]]

    dropped = asked.groupBy("shard", "part").cogroup(spread.groupBy("shard", "part")).applyInPandas(
        probe, "id bigint, high bigint, low bigint",
    ).groupBy("id").agg(F.collect_set("low").alias("low"))
    rows = pick(docs, *keep, *([] if text in keep else [text]))
    rows = rows.withColumn("__id", F.coalesce(F.col(doc_id).cast("bigint"), F.lit(int(NO_ID))))
    rows = rows.join(dropped.select(F.col("id").alias("__id"), F.col("low").alias("__low")), "__id", "left")

    def make_from_list():
        def function(texts, columns):
            found = []
            for t, low in zip(texts, columns[-1].to_pylist(), strict=True):
                own = hashes((t or b"").split(b"\n"), least)
                found.append(own[np.isin(own[:, 2].view(np.int64), np.array(low or [], np.int64)), 0])
            return decided(texts, found)

        return function

    return map_texts(rows, [*keep, "__low"], text, result, make_from_list, with_kept=True).drop("__low")
