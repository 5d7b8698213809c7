"""Spelling variants: words one edit apart, by dense tiles of common prefixes and suffixes.

Two words differ by one inserted, deleted or replaced code point exactly if their common prefix and
suffix together reach the longer length minus one. Tiles compare whole blocks of words that way,
on matrices of code points padded to one width, once from the left and once from the right.

Which blocks meet: places 0 to m - 1 of the longer word are cut into ``q`` segments. A single edit lies in
one of them, so what stands before and after that segment is common to both words, counted from the left
and from the right. Words that agree there for one segment are a group; a pair counts in the segment that
its common prefix ends in, so it is found once. ``q`` grows, length by length, until no group has more than
``TILE`` words. With segments of one place a group holds the words that differ in that place alone, which
the alphabet bounds; so groups stay small however many words share a beginning.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from math import ceil, log2, log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.rows import checkpointed, map_slices

LETTERS, LEAST_LENGTH, LEAST_COUNT, RATIO = "A-Za-zÀ-ÿ", 7, 2, 10
#: One in so many (run, document) pairs loses a code point.
WORN = 31
#: Words of one group, at most, unless its segment is a single place.
TILE = 256
#: Compared code points that one step of a task holds.
CELLS = 1 << 22
#: Counted words that a task holds before it passes them on.
HELD = 200_000


def counted_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n): runs of letters of at least ``length`` code points, A-Z lower-cased, worn, and how often they occur.

    A run of a document loses one code point if ``WORN`` divides the CRC-32 of ``<doc_id>:<run>``; the CRC
    also names the place. A null id counts as empty text, a null text has no runs.
    """
    seek = re.compile(f"[{LETTERS}]{{{length},}}")

    def make():
        def count(texts: list, ids: pa.Array) -> Iterator[list]:
            found: Counter[str] = Counter()
            for one, body in zip(ids.cast(pa.string()).to_pylist(), texts, strict=True):
                if not body:
                    continue
                start = zlib.crc32(f"{'' if one is None else one}:".encode())
                for run, n in Counter(seek.findall(body.lower().decode("utf-8", "replace"))).items():
                    mark = zlib.crc32(run.encode(), start)
                    if mark % WORN == 0:
                        run = run[:mark % len(run)] + run[mark % len(run) + 1:]
                        if len(run) < length:
                            continue
                    found[run] += n
                if len(found) > HELD:
                    yield [list(found), list(found.values())]
                    found.clear()
            yield [list(found), list(found.values())]

        return count

    rows = map_slices(docs, [doc_id, text], "word string, n bigint", make)
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def segmented(words: DataFrame, segments: dict[int, int]) -> DataFrame:
    """(key, m, wide, middle, word, n): every word in the groups of its segments.

    ``segments`` has the q of the longer lengths m that need more than two. ``middle`` is what stands in the
    segment and one place after it, ``wide`` the segment's length.
    """
    size = F.char_length("word")
    more = F.create_map(*(F.lit(x) for kv in segments.items() for x in kv)) if segments else None
    q = F.lit(2) if more is None else F.coalesce(F.try_element_at(more, F.col("m")), F.lit(2))
    at = words.select("word", "n", size.alias("size"), F.explode(F.array(size, size + 1)).alias("m"))
    at = at.withColumn("q", F.least(q, "m")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("q") - 1)))
    at = at.withColumns({"low": F.expr("i * m div q").cast("int"), "high": F.expr("(i + 1) * m div q").cast("int")})
    part = lambda start, end: F.substring("word", start + 1, end - start)
    low, high, m, own = F.col("low"), F.col("high"), F.col("m"), F.col("size")
    key = F.concat_ws("|", m, low, part(F.lit(0), low), part(own - m + high, own))
    return at.select(
        key.alias("key"), "m", (high - low).alias("wide"), part(low, own - m + F.least(high + 1, m)).alias("middle"), "word", "n",
    )


def choose_segments(words: DataFrame, tile: int = TILE) -> dict[int, int]:
    """Segments by longer length, where two leave groups of more than ``tile`` words; one row a length comes to the driver."""
    segments: dict[int, int] = {}
    lengths: list[int] | None = None
    while lengths is None or lengths:
        groups = segmented(words, segments)
        if lengths is not None:
            groups = groups.where(F.col("m").isin(lengths))
        sizes = groups.groupBy("key", "m", "wide").agg(F.count("*").alias("members")).where(F.col("members") > tile)
        lengths = [r["m"] for r in sizes.where("wide > 1").select("m").distinct().collect()]
        segments |= {m: min(m, 2 * segments.get(m, 2)) for m in lengths}
    return segments


def near_pairs(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, near, near_n): all ordered pairs of distinct words that one edit tells apart. ``words`` is read several times."""
    groups = segmented(words, choose_segments(words, tile))
    dealt = groups.repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in (b for b in batches if b.num_rows):
            keys = batch.column(0)
            last = pc.index(pc.equal(keys, keys[-1]), True).as_py()
            if last or (rest and rest[-1].column(0)[-1] != keys[0]):
                # What stands before the last key of the batch is complete.
                yield from tiles(pa.Table.from_batches([*rest, batch.slice(0, last)]).combine_chunks())
                rest = []
            rest.append(batch.slice(last))
        if rest:
            yield from tiles(pa.Table.from_batches(rest).combine_chunks())

    return dealt.mapInArrow(run, "word string, near string, near_n bigint")


def tiles(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Near pairs within the groups of rows sorted by key."""
    if rows.num_rows < 2:
        return
    keys = rows.column("key").combine_chunks()
    new = np.concatenate(([True], np.asarray(pc.not_equal(keys[1:], keys[:-1]))))
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(new)))
    m, wide = (np.asarray(rows.column(c)) for c in ("m", "wide"))
    middle = rows.column("middle").to_pylist()
    text, n = rows.column("word"), rows.column("n")
    full = np.asarray(pc.utf8_length(text)) == m
    length = np.asarray(pc.utf8_length(rows.column("middle")))
    side = 2
    while side < 2 * sizes.max():
        chosen = np.flatnonzero((sizes > side // 2) & (sizes <= side) & (sizes > 1))
        order = chosen[np.argsort(wide[starts[chosen]], kind="stable")]
        step = 0
        while step < len(order):
            cells = side * side * (int(wide[starts[order[min(len(order) - 1, step + 4096)]]]) + 1)
            block = order[step:step + max(1, min(4096, CELLS // cells))]
            step += len(block)
            yield from tile(block, side, starts, sizes, wide, middle, full, length, text, n)
        side *= 2


def tile(block, side, starts, sizes, wide, middle, full, length, text, n) -> Iterator[pa.RecordBatch]:
    """Each word of the groups in ``block`` against each of its group: group x word x word x code point."""
    inside = np.arange(side) < sizes[block][:, None]
    at = np.where(inside, starts[block][:, None] + np.arange(side), 0)
    parts = [middle[i] for i in at.ravel()]
    left, right = code_points(parts, at.shape), code_points([p[::-1] for p in parts], at.shape)
    prefix = (left[:, :, None] != left[:, None]).argmax(axis=-1)
    suffix = (right[:, :, None] != right[:, None]).argmax(axis=-1)
    longer = np.maximum(length[at][:, :, None], length[at][:, None])
    near = (prefix + suffix >= longer - 1) & (prefix < wide[at][:, :, None])
    near &= (inside[:, :, None] & inside[:, None]) & (full[at][:, :, None] | full[at][:, None])
    near[:, np.arange(side), np.arange(side)] = False
    group, a, b = np.nonzero(near)
    if len(group):
        a, b = pa.array(at[group, a]), pa.array(at[group, b])
        yield pa.RecordBatch.from_arrays([flat(text.take(a)), flat(text.take(b)), flat(n.take(b))], names=["word", "near", "near_n"])


def flat(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks()


def code_points(parts: list[str], shape: tuple[int, int]) -> np.ndarray:
    """Code points of the parts, padded with zeros; one place wider than the longest, so that a difference is always found."""
    width = max(1, max(map(len, parts))) + 1
    return np.array(parts, dtype=f"<U{width}").view(np.uint32).reshape(*shape, width)


def variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_COUNT, ratio: int = RATIO, tile: int = TILE,
) -> DataFrame:
    """Word, form, root, n, n_near and form_n of every word that occurs ``least`` times.

    The form is the near word with the largest n, of several the first in code-point order, if its n is at least
    ``ratio`` times the word's. Root: the end of the chain of forms. Repeated rows count as often as they stand; tables without
    such words give no rows.
    """
    words = checkpointed(counted_words(docs, doc_id, text).where(F.col("n") >= least))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near"))
    found = near_pairs(words, tile).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    known = checkpointed(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *(F.when(-F.col("best.n") >= ratio * F.col("n"), c).alias(a) for a, c in (("form", F.col("best.near")), ("form_n", -F.col("best.n")))),
    ))
    roots = chain_ends(known, least, ratio)
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n",
    )


def chain_ends(known: DataFrame, least: int, ratio: int) -> DataFrame:
    """(word, root) of the words with a form, in as many doublings as the longest possible chain needs: n grows ``ratio`` times a step."""
    steps = known.where("form is not null").select("word", F.col("form").alias("root"))
    most = known.agg(F.max("n").alias("n")).first()["n"]
    longest = log10(max(1, most or 1) / least) / log10(ratio)
    for _ in range(ceil(log2(max(1, longest))) if longest > 1 else 0):
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = checkpointed(steps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return steps
