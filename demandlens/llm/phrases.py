"""Phrase collocations by Toivonen's mining: a sample proposes, full passes count, until the border is closed.

The sample's phrases that reach a lowered count are the proposal. Its negative border are the phrases outside
it whose own parts (all but the last word, all but the first) are inside; single words are all proposed. One
full pass counts both over the whole corpus: what is proposed by its text, the border, which is far larger
and mostly rare, by 64-bit hash. A hash never counts less than any of its phrases, so border phrases that reach the
support are all among the hashes that do. These are the border's failures: an expansion pass counts them by text,
and with them all phrases that they newly complete. Passes go on until one adds nothing that a longer phrase could
be built on. Every count in the result is one of texts.

Sets of phrases travel as bit arrays of at most ``MOST_BITS``; a phrase that shares its bit with another one is
counted without need, never left out. Everything is kept apart by language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlens.llm.rows import checkpointed, map_slices, pick
from demandlens.llm.tokens import hashes, mixed, numbered

LONGEST, SUPPORT, INSIDE, TOP, UNKNOWN = 3, 10, 50, 2000, "und"
#: One document in so many is in the sample, by CRC-32 of its id; phrases found so often there are proposed.
SAMPLED, LOWERED = 16, 2
#: Bits of one set of phrases, at most (16 MB), and for each phrase of it.
MOST_BITS, BITS_EACH = 1 << 27, 16
#: Bytes of text that are counted together before the shuffle.
HELD = 8 << 20
#: Tasks that choose the first phrases of a language before one task does.
PARTS = 64
BREAK = b"\n"
ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
PIECES = re.compile(rb"[^ \n]+|\n")


@dataclass(frozen=True)
class Bits:
    """A set of hashes that may hold more than was put in."""

    array: np.ndarray

    def test(self, keys: np.ndarray) -> np.ndarray:
        at = keys & np.uint64(len(self.array) * 8 - 1)
        return (self.array[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bits(keys: DataFrame) -> Bits:
    """The hashes of the one column; its size goes by their number, up to the bound."""
    number = keys.count()
    size = 1 << 15
    while size < min(MOST_BITS, BITS_EACH * number):
        size *= 2
    place = F.col(keys.columns[0]).bitwiseAND(F.lit(size - 1)) + 1
    parts = keys.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))
    array = np.zeros(size // 8, np.uint8)
    for row in parts.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        block = np.frombuffer(row["bits"], np.uint8)
        at = (row["part"] - 1) * len(block)
        array[at:at + len(block)] = block
    return Bits(array)


@dataclass
class Pass:
    """What a full pass looks for, by phrase length: phrases whose parts are in ``parts``; by text, if in ``asked`` too, else by hash.

    ``asked`` None: all by text. A phrase that an earlier pass has counted by text is left out.
    """

    parts: dict[int, Bits] = field(default_factory=dict)
    asked: dict[int, Bits] | None = None

    def candidate(self, k: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        found = self.parts.get(k - 1)
        return np.ones(len(left), bool) if k == 2 else found.test(left) & found.test(right)

    def by_text(self, k: int, keys: np.ndarray) -> np.ndarray:
        return np.ones(len(keys), bool) if self.asked is None else self.asked[k].test(keys)


def status(passes: list[Pass], failed: dict[int, Bits], k: int, keys: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """0: not counted in the last of the passes, 1: counted by hash, 2: by text."""
    *earlier, now = passes
    done, border = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    for one in earlier:
        candidate = one.candidate(k, left, right)
        text = one.by_text(k, keys)
        done |= candidate & text
        border |= candidate & ~text
    candidate = now.candidate(k, left, right) & ~done
    if earlier:
        # What the border counted by hash is worth a text only where that hash reached the support.
        candidate &= ~border | failed[k].test(keys)
    return np.where(candidate, np.where(now.by_text(k, keys), 2, 1), 0)


def count_pass(docs: DataFrame, lang: Column, passes: list[Pass], failed: dict[int, Bits], words: bool, longest: int) -> DataFrame:
    """(lang, k, phrase, hash, n): counts by text, with hash null, and by hash, with lang and phrase null; k = 0 is the language's words."""
    shared = docs.sparkSession.sparkContext.broadcast((passes, failed))
    ordered = docs.select(lang.alias("lang"), "text")

    def make():
        def count(texts: list, langs: pa.Array) -> Iterator[list]:
            given, known = shared.value
            of: dict[str, list[bytes]] = {}
            for name, text in zip(langs.to_pylist(), texts, strict=True):
                of.setdefault(name, []).append(text or b"")
            for name, bodies in of.items():
                yield from phrase_counts(name, bodies, given, known, words, longest)

        return count

    rows = map_slices(ordered, ["lang", "text"], "lang string, k int, phrase string, hash bigint, n bigint", make, HELD)
    # Slices are summed up already, and most of what they count is rare: a second map-side sum would hold it all once more.
    return rows.repartition("lang", "k", "phrase", "hash").groupBy("lang", "k", "phrase", "hash").agg(F.sum("n").alias("n"))


def phrase_counts(lang: str, texts: list[bytes], passes: list[Pass], failed: dict[int, Bits], words: bool, longest: int) -> Iterator[list]:
    body = BREAK.join(texts).lower().translate(ENDS)
    ids, known = numbered(PIECES.findall(body), BREAK)
    keys = hashes(known, xxhash.xxh64_intdigest(lang) & 0xFFFFFFFF)
    if words:
        n = np.bincount(ids, minlength=len(known))[1:]
        yield [[lang, *[lang] * len(n)], [0, *[1] * len(n)], ["", *known[1:]], [None] * (len(n) + 1), [int(n.sum()), *n.tolist()]]
    # At each place the phrase of k words that starts there, by its number; -1: none, or one that cannot become longer.
    at, last, texts_of = np.where(ids > 0, ids, -1), ids, lambda chosen: [known[i] for i in chosen]
    for k in range(2, longest + 1):
        if len(at) < 2:
            return
        places = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0))
        pairs, number, n = np.unique(at[places] << 32 | at[places + 1], return_inverse=True, return_counts=True)
        left, right = pairs >> 32, pairs & 0xFFFFFFFF
        own = mixed(keys[left], keys[right])
        state = status(passes, failed, k, own, keys[left], keys[right])
        hashed = np.flatnonzero(state == 1)
        if len(hashed):
            none = pa.nulls(len(hashed), pa.string())
            yield [none, np.full(len(hashed), k, np.int32), none, own[hashed].view(np.int64), n[hashed]]
        end = np.zeros(len(pairs), np.int64)
        end[number] = last[places + 1]
        texts_of = phrase_texts(texts_of, left, end, known)
        named = np.flatnonzero(state == 2)
        if len(named):
            yield [[lang] * len(named), np.full(len(named), k, np.int32), texts_of(named), pa.nulls(len(named), pa.int64()), n[named]]
        if k == longest:
            return
        grows = passes[-1].parts[k].test(own)
        at = np.full(len(at) - 1, -1)
        at[places] = np.where(grows[number], number, -1)
        last, keys = last[1:], own


def phrase_texts(shorter, left: np.ndarray, end: np.ndarray, known: list[bytes]):
    def texts(chosen: np.ndarray) -> list[bytes]:
        return [a + b" " + known[b_] for a, b_ in zip(shorter(left[chosen].tolist()), end[chosen].tolist(), strict=True)]

    return texts


def mined(docs: DataFrame, lang: Column, support: int = SUPPORT, longest: int = LONGEST, sampled: int = SAMPLED, lowered: int = LOWERED) -> DataFrame:
    """(lang, k, phrase, n): all phrases of up to ``longest`` words that occur ``support`` times; k = 0: all words of the language.

    ``docs`` has doc_id and text. A null id is in the sample.
    """
    lengths = range(2, longest + 1)
    everything = Pass({k: Bits(np.full(1 << 12, 255, np.uint8)) for k in lengths}, {k: Bits(np.zeros(1 << 12, np.uint8)) for k in lengths})
    part = docs.where(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % sampled, F.lit(0)) == 0)
    proposed = checkpointed(count_pass(part, lang, [everything], {}, False, longest).where(F.col("n") >= lowered).select("k", "hash"))
    sets = {k: bits(proposed.where(F.col("k") == k).select("hash")) for k in lengths}
    passes, failed = [Pass(sets, sets)], {}
    counts = checkpointed(count_pass(docs, lang, passes, failed, True, longest).where((F.col("n") >= support) | (F.col("k") == 0)))
    found = counts.where("hash is null").drop("hash")
    border = counts.where("hash is not null")
    while True:
        failed = {k: bits(border.where(F.col("k") == k).select("hash")) for k in lengths}
        grown = found.where((F.col("k") > 1) & (F.col("k") < longest))
        named = checkpointed(with_hash(grown, longest))
        parts = {
            k: bits(named.where(F.col("k") == k).select("hash").union(border.where(F.col("k") == k).select("hash")))
            for k in lengths if k < longest
        }
        passes = [*passes, Pass(parts, None)]
        added = checkpointed(count_pass(docs, lang, passes, failed, False, longest).where(F.col("n") >= support).drop("hash"))
        found = found.unionByName(added)
        # New phrases of which longer ones were no candidates yet: those that this pass had not among its parts.
        new = with_hash(added.where(F.col("k") < longest), longest)
        if not any(outside(new.where(F.col("k") == k), parts[k]) for k in parts):
            return found.select("lang", "k", "phrase", "n")


def with_hash(rows: DataFrame, longest: int) -> DataFrame:
    """(k, hash) of phrases given by their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                phrase_hash(phrase.encode(), name)
                for name, phrase in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(np.array(made, np.uint64).view(np.int64))], names=["k", "hash"])

    return rows.select("lang", "k", "phrase").mapInArrow(run, "k int, hash bigint")


def phrase_hash(phrase: bytes, lang: str) -> int:
    keys = hashes(phrase.split(b" "), xxhash.xxh64_intdigest(lang) & 0xFFFFFFFF)
    while len(keys) > 1:
        keys = mixed(keys[:-1], keys[1:])
    return int(keys[0])


def outside(keys: DataFrame, known: Bits) -> bool:
    """Whether any of the hashes (k, hash) is not in the set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.asarray(batch.column(1)).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array([int((~known.test(own)).sum())])], names=["n"])

    return bool(keys.mapInArrow(run, "n bigint").agg(F.sum("n").alias("n")).first()["n"])


def collocations(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", support: int = SUPPORT, longest: int = LONGEST,
    top: int = TOP, sampled: int = SAMPLED, lowered: int = LOWERED,
) -> DataFrame:
    """Lang, rank, phrase, a, l, r, n and score of the ``top`` phrases of each language.

    A null language counts as ``und``, a null text as empty; repeated rows count as often as they stand. A language without
    phrases has no rows. Scores are exact: decimals of 38 digits hold 1,000,000 a a up to counts of 10 ** 15.
    """
    given = pick(docs, doc_id, lang, text).toDF("doc_id", "lang", "text").withColumn("lang", F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)))
    found = checkpointed(mined(given, F.col("lang"), support, longest, sampled, lowered))
    counts = found.where("k > 0").select("lang", "phrase", "n")
    words = F.split("phrase", " ")
    cuts = found.where("k > 1").select(
        "lang", "phrase", "k", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"), words.alias("w"),
    ).select("lang", "phrase", "k", "a", "cut", F.concat_ws(" ", F.slice("w", 1, F.col("cut"))).alias("first"),
             F.concat_ws(" ", F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut"))).alias("rest"))
    for side, total in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(total)), ["lang", side])
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    scored = cuts.withColumns({"over": F.lit(1000000).cast("decimal(7,0)") * exact("a") * exact("a"), "under": exact("l") * exact("r")})
    scored = scored.withColumn("score", F.expr("over div under"))
    lowest = scored.groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("at"))
    inner = found.where("k > 2").select("lang", F.col("n").alias("longer"), "k", words.alias("w")).select(
        "lang", "longer", "k", "w", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"),
    ).select("lang", "longer", "w", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("start")).select(
        "lang", "longer", F.concat_ws(" ", F.slice("w", F.col("start"), F.col("size"))).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < INSIDE * F.col("a")))
    total = found.where("k = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    flat = kept.select("lang", "phrase", "a", "at.l", "at.r", "at.score").withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    some = flat.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
