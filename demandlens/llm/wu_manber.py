"""Benchmark decontamination by Wu-Manber multi-pattern search.

The windows of all benchmark items are searched in every document at once. A table
says for each block of bytes how far the search may jump, so most of a text is never
looked at; where it says zero, the hash of the suffix block together with that of the
prefix picks the windows to compare directly. Many stretches of the buffer advance
side by side, one array operation for all of them.

Null texts have no words. An item without words has no window. A null item id marks
words as hit but is not listed; repeated ids are listed once.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.llm.rows import map_texts, pick

WINDOW = 10
#: Text of benchmark items that one pass over the documents looks for.
BLOCK_BYTES = 2 << 20
#: Bytes between the starts of neighbouring stretches.
STRETCH = 1024
BLANK = 32
#: Letters to lower case, digits and bytes of other scripts as they are, the rest to blanks.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else BLANK for b in range(256)
)
MULTIPLIER, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def windows(text: bytes | None, size: int) -> list[tuple[bytes, int]]:
    """Each window as it stands in a folded text, blanks around it, and its number of words."""
    found = words(text)
    if not found:
        return []
    size = min(size, len(found))
    return [(b" %b " % b" ".join(found[i:i + size]), size) for i in range(len(found) - size + 1)]


def at_bytes(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of a buffer that has seven more behind them."""
    return np.ndarray((len(buffer) - 7,), "<u8", buffer.data, 0, (1,))


class Tables:
    """Shift, suffix and prefix tables of patterns of similar length."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.least = min(map(len, patterns))
        self.block = min(8, self.least // 2 + 1)
        heads = np.frombuffer(b"".join(p[:self.least] for p in patterns), np.uint8).reshape(len(patterns), self.least)
        padded = np.zeros((len(patterns), self.least + 8), np.uint8)
        padded[:, :self.least] = heads
        jumps = self.least - self.block + 1
        bits = min(24, max(12, (8 * len(patterns) * jumps).bit_length()))
        self.down = np.uint64(64 - bits)
        self.mask = self.low(self.block)
        self.prefix_mask = self.low(min(8, self.least))
        self.shift = np.full(1 << bits, min(jumps, 255), np.uint8)
        blocks = [np.ascontiguousarray(padded[:, i:i + 8]).view("<u8")[:, 0] for i in range(jumps)]
        for i, block in enumerate(blocks):
            at = self.place(block & self.mask)
            np.minimum.at(self.shift, at, np.uint8(min(jumps - 1 - i, 255)))
        keys = self.key(blocks[-1] & self.mask, blocks[0] & self.prefix_mask)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    @staticmethod
    def low(size: int) -> np.uint64:
        return np.uint64((1 << 8 * size) - 1)

    def place(self, block: np.ndarray) -> np.ndarray:
        return (block * MULTIPLIER) >> self.down

    @staticmethod
    def key(suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return (suffix * MULTIPLIER) ^ (prefix * SECOND)

    def search(self, text: bytes, size: int) -> list[tuple[int, int]]:
        """(place, pattern) of every occurrence in the first ``size`` bytes; eight more must follow."""
        first = self.least - self.block  # where the last block of the leftmost window begins
        stop = size - self.block + 1
        if first >= stop:
            return []
        eight = at_bytes(np.frombuffer(text, np.uint8))
        at = np.arange(first, stop, STRETCH)
        end = np.append(at[1:], stop)
        tried = []
        while len(at):
            jump = self.shift[self.place(eight[at] & self.mask)]
            still = jump == 0
            if still.any():
                tried.append(at[still])
            at = at + np.maximum(jump, 1)
            inside = at < end
            if not inside.all():
                at, end = at[inside], end[inside]
        if not tried:
            return []
        last = np.concatenate(tried)
        begin = last - first
        keys = self.key(eight[last] & self.mask, eight[begin] & self.prefix_mask)
        low = np.searchsorted(self.keys, keys, side="left")
        high = np.searchsorted(self.keys, keys, side="right")
        some = np.flatnonzero(high > low)
        found = []
        for place, a, b in zip(begin[some].tolist(), low[some].tolist(), high[some].tolist(), strict=True):
            for i in self.order[a:b].tolist():
                if text.startswith(self.patterns[i], place, size):
                    found.append((place, i))
        return found


class Matcher:
    """All windows of some items, in tables by length, and the items of each window."""

    def __init__(self, items: list[tuple[str | None, bytes]], size: int):
        owners: dict[tuple[bytes, int], set[str | None]] = defaultdict(set)
        for item, text in items:
            for window in windows(text, size):
                owners[window].add(item)
        by_length: dict[int, list[tuple[bytes, int]]] = defaultdict(list)
        for window in owners:
            by_length[len(window[0]).bit_length()].append(window)
        self.groups = [
            (Tables([w for w, _ in group]), [n for _, n in group], [owners[w] for w in group])
            for group in by_length.values()
        ]

    def __call__(self, texts: list[bytes | None]) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]]]:
        """Of each text the number of words, the spans of hit words and the items found."""
        folded = [words(t) for t in texts]
        # A line end before each text keeps windows from reaching over; a blank stands before each word.
        text = b"".join(b"\n %b " % b" ".join(w) for w in folded)
        size = len(text)
        text += bytes(8)
        counts = [len(w) for w in folded]
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[str]] = [set() for _ in texts]
        hits = [(place, n[i], owner[i]) for tables, n, owner in self.groups for place, i in tables.search(text, size)]
        if hits:
            hits.sort(key=lambda hit: hit[0])
            buffer = np.frombuffer(text, np.uint8)
            lines = np.flatnonzero(buffer[:size] == 10)
            blanks = np.flatnonzero(buffer[:size] == BLANK)
            places = np.array([hit[0] for hit in hits])
            rows = np.searchsorted(lines, places, side="right") - 1
            firsts = np.searchsorted(blanks, places) - np.searchsorted(blanks, lines[rows])
            for row, first, (_, n, owner) in zip(rows.tolist(), firsts.tolist(), hits, strict=True):
                last, own = first + n - 1, spans[row]
                if own and first <= own[-1][1] + 1:
                    own[-1] = (own[-1][0], max(last, own[-1][1]))
                else:
                    own.append((first, last))
                items[row].update(i for i in owner if i is not None)
        return counts, spans, [sorted(i) for i in items]


@lru_cache(maxsize=2)
def matcher(items: tuple[tuple[str | None, bytes], ...], size: int) -> Matcher:
    return Matcher(list(items), size)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
    item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``keep``, n_words, spans (first and last hit word, from 0) and items (ids as strings) of every row.

    A hit word lies in an occurrence of ``size`` consecutive words of an item, or of all
    words of a shorter one. A pass over the documents looks for at most ``block_bytes`` of
    items, or one longer item, so what is sent to the tasks is bounded; a benchmark beyond
    that takes more passes over the same rows, without a shuffle.
    """
    items = pick(benchmark, item_id, item_text).select(
        F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("string").alias("text"),
    ).where("octet_length(text) > 0")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    context = docs.sparkSession.sparkContext
    df, kept = docs, list(keep)
    spans: list[Column] = []
    found: list[Column] = []
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        sent = context.broadcast(tuple(sorted(((r.id, r.text.encode()) for r in rows), key=repr)))
        last = block == blocks - 1
        df = map_texts(
            df, kept if last or text in kept else [*kept, text], text,
            f"n_words_{block} bigint, spans_{block} array<struct<first:int,last:int>>, items_{block} array<string>",
            lambda sent=sent: lambda texts: _columns(matcher(sent.value, size)(texts)),
        )
        kept += [f"n_words_{block}", f"spans_{block}", f"items_{block}"]
        spans.append(F.col(f"spans_{block}"))
        found.append(F.col(f"items_{block}"))
    return df.select(
        *(F.col(f"`{k}`") for k in keep), F.col("n_words_0").alias("n_words"),
        (F.flatten(F.array(*spans)) if blocks > 1 else spans[0]).alias("spans"),
        (F.array_distinct(F.flatten(F.array(*found))) if blocks > 1 else found[0]).alias("items"),
    )


def _columns(made: tuple[list, list, list]) -> list:
    counts, spans, items = made
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    return [counts, pa.array(spans, kind), items]


def hit_words(spans: Column) -> Column:
    """How many words lie in any of the spans; spans of several passes may overlap."""
    return F.size(F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["first"], s["last"]))))).cast("bigint")


def digest(found: DataFrame) -> DataFrame:
    """Counts in place of the spans and items of ``decontaminate``."""
    ids = F.array_sort("items")
    rest = [c for c in found.columns if c not in ("spans", "items")]
    return found.select(
        *rest, hit_words(F.col("spans")).alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )
