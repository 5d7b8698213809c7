"""SimHash near-duplicates by pivot distance tables.

Distances of every distinct fingerprint to fixed reference fingerprints are computed
once. Two fingerprints whose distances to any one pivot differ by more than the bound
cannot be closer than it, so the largest coordinate difference discards nearly all pairs
before the bits are compared. Which pairs meet at all is decided by blocks of bits:
fingerprints at ``bound`` differing bits agree on all but ``bound`` blocks. The number of
blocks follows the number of fingerprints, so groups stay small; the result is the same.

Copies collapse to one fingerprint first. A group gives a spanning forest of its links,
not its pairs. Null and wordless texts have fingerprint zero, linked like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.components import components
from demandlens.llm.rows import checkpointed, map_texts

SHINGLE, BOUND, SEED = 3, 3, 42
#: Reference fingerprints; the hashes of their numbers.
PIVOTS = np.array([xxhash.xxh64_intdigest(str(i), SEED) for i in range(16)], np.uint64)
#: Fingerprints that are expected to share a key at most before keys get longer.
SHARED = 64
#: Groups up to this size are compared by array operations over many groups at once.
SMALL = 16
COUNTED = 1 << 16


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    found = (text or b"").lower().split()
    if not found:
        return 0
    if len(found) < size:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(size)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNTED):
        part = hashes[at:at + COUNTED].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", size: int = SHINGLE) -> DataFrame:
    """``keep`` and the fingerprint as a signed 64-bit number."""
    def make():
        return lambda texts: [np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64)]

    return map_texts(docs, list(keep), text, "fingerprint bigint", make)


def key_masks(count: int, bound: int) -> list[int]:
    """Bit masks; fingerprints at most ``bound`` bits apart agree under one of them at least."""
    blocks = bound + 1
    while True:
        edges = [round(64 * i / blocks) for i in range(blocks + 1)]
        bits = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
        masks = [sum(chosen) for chosen in combinations(bits, blocks - bound)]
        if count <= SHARED << min(m.bit_count() for m in masks) or blocks == 2 * bound + 2:
            return masks
        blocks += 1


def links(fingerprints: DataFrame, bound: int = BOUND) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints at most ``bound`` bits apart that connect all such pairs."""
    masks = key_masks(fingerprints.count(), bound)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = fingerprints.select(
        F.explode(F.array(*(
            F.struct(F.lit(i).alias("kind"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key"))
            for i, m in enumerate(signed)
        ))).alias("at"), "fingerprint",
    ).select("at.kind", "at.key", "fingerprint")
    dealt = keyed.repartition("kind", "key").sortWithinPartitions("kind", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((3, 0), np.int64)
        for batch in (b for b in batches if b.num_rows):
            new = np.stack([np.asarray(batch.column(i).cast(pa.int64())) for i in range(3)])
            rows = np.concatenate((rest, new), axis=1)
            # The last group may go on in the next batch.
            whole = int(np.argmax((rows[:2] == rows[:2, -1:]).all(axis=0)))
            rest = rows[:, whole:]
            yield from linked(rows[:, :whole], bound)
        yield from linked(rest, bound)

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def linked(rows: np.ndarray, bound: int) -> Iterator[pa.RecordBatch]:
    """Links within the groups of rows (kind, key, fingerprint), sorted by group."""
    if rows.shape[1] < 2:
        return
    prints = rows[2].view(np.uint64)
    group = np.concatenate(([0], np.cumsum((rows[:2, 1:] != rows[:2, :-1]).any(axis=0))))
    sizes = np.bincount(group)
    small = sizes[group] <= SMALL
    pairs = [by_offset(prints[small], group[small], bound)]
    starts = np.cumsum(sizes) - sizes
    pairs += [forest(prints[starts[g]:starts[g] + sizes[g]], bound) for g in np.flatnonzero(sizes > SMALL)]
    a, b = np.concatenate(pairs, axis=1)
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def pivot_table(prints: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints[:, None] ^ PIVOTS).astype(np.int8)


def by_offset(prints: np.ndarray, group: np.ndarray, bound: int) -> np.ndarray:
    """All links inside small groups; rows of a group are neighbours."""
    table = pivot_table(prints)
    found = [np.zeros((2, 0), np.uint64)]
    left = np.arange(len(prints))
    for offset in range(1, SMALL):
        left = left[left + offset < len(prints)]
        left = left[group[left] == group[left + offset]]
        right = left + offset
        near = left[(np.abs(table[left] - table[right]).max(axis=1, initial=0) <= bound)]
        near = near[np.bitwise_count(prints[near] ^ prints[near + offset]) <= bound]
        found.append(np.stack((prints[near], prints[near + offset])))
    return np.concatenate(found, axis=1)


def forest(prints: np.ndarray, bound: int) -> np.ndarray:
    """A spanning forest of one group: what is reached leaves the table, so dense groups empty quickly."""
    table = pivot_table(prints)
    order = np.argsort(table[:, 0], kind="stable")
    prints, table = prints[order], table[order]
    pairs: list[tuple[int, np.ndarray]] = []
    reached: list[tuple[np.uint64, np.ndarray]] = []
    while len(prints):
        if not reached:
            reached.append((prints[0], table[0]))
            prints, table = prints[1:], table[1:]
        here, distances = reached.pop()
        low = np.searchsorted(table[:, 0], distances[0] - bound, side="left")
        high = np.searchsorted(table[:, 0], distances[0] + bound, side="right")
        near = low + np.flatnonzero(np.abs(table[low:high] - distances).max(axis=1, initial=0) <= bound)
        near = near[np.bitwise_count(prints[near] ^ here) <= bound]
        if len(near):
            pairs.append((here, prints[near]))
            reached += zip(prints[near], table[near], strict=True)
            prints, table = np.delete(prints, near), np.delete(table, near, axis=0)
    if not pairs:
        return np.zeros((2, 0), np.uint64)
    return np.stack((np.repeat(np.array([p for p, _ in pairs], np.uint64), [len(n) for _, n in pairs]),
                     np.concatenate([n for _, n in pairs])))


def near_duplicates(prints: DataFrame, doc_id: str = "doc_id", bound: int = BOUND) -> DataFrame:
    """Rows of ``prints`` (id, fingerprint) with component_id, the smallest id connected; null if it has none.

    Ids repeat and may be null; nulls never name a component. ``prints`` is read several
    times, so it should be stored.
    """
    distinct = prints.groupBy("fingerprint").agg(F.min(doc_id).alias("least"))
    roots = components(links(distinct.select("fingerprint"), bound), "a", "b")
    member = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"),
    )
    named = member.groupBy("root").agg(F.min("least").alias("component_id"))
    names = member.join(named, "root").select("fingerprint", "component_id")
    return prints.join(names, "fingerprint").select(*prints.columns, "component_id")


def simhash(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, bound: int = BOUND) -> DataFrame:
    """Id, fingerprint (16 hex digits) and component_id of every row."""
    found = near_duplicates(checkpointed(fingerprints(docs, (doc_id,), text, size)), doc_id, bound)
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, bound: int = BOUND,
) -> DataFrame:
    """All columns of the one row that stays of each component: smallest id, nulls last, then smallest row hash.

    Equal rows count once. Columns are worked on by position, so they may have any names.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    id_at, text_at = (names[docs.columns.index(c)] for c in (doc_id, text))
    marked = docs.toDF(*names).withColumn("mark", F.xxhash64(*names))
    prints = checkpointed(fingerprints(marked, (id_at, "mark"), text_at, size))
    order = F.struct(F.col(id_at).isNull(), F.col(id_at).alias("id"), F.col("mark"))
    rows = checkpointed(prints.groupBy(id_at, "mark").agg(F.first("fingerprint").alias("fingerprint"), F.count("*").alias("n")))
    distinct = rows.groupBy("fingerprint").agg(F.min(order).alias("first"))
    roots = components(links(distinct.select("fingerprint"), bound), "a", "b")
    first = (
        distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .groupBy(F.coalesce("root", "fingerprint").alias("root")).agg(F.min("first").alias("first"))
        .select(F.col("first.id").alias("id"), F.col("first.mark").alias("first_mark"))
    )
    kept = marked.join(first, marked[id_at].eqNullSafe(first["id"]) & (marked["mark"] == first["first_mark"]), "left_semi")
    if rows.where("n > 1").limit(1).count():
        kept = kept.dropDuplicates([id_at, "mark"])
    return kept.drop("mark").toDF(*docs.columns)
