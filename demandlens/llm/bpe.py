"""Byte-level BPE, encoding and decoding, with a hierarchical-bitmap rank queue.

All distinct pre-tokens of a batch lie in one buffer as a linked list of symbols,
with a gap between pre-tokens. Each possible merge waits in the bucket of its rank;
a bitmap of bitmaps finds the lowest rank that has a bucket. All merges of that rank
are done at once, leftmost first where they overlap. An entry whose pair has changed
meanwhile is stale and skipped. The work is near linear in the bytes, also for one
very long pre-token.

Null texts count as empty. Empty texts give no ids. Texts are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from demandlens.llm.rows import map_texts

NONE = np.int32(2**31 - 1)
#: Distinct pieces, and ids of them, that a worker remembers before it starts anew; bounds its memory only.
REMEMBERED, REMEMBERED_CHARS = 600_000, 20_000_000
#: Words whose ids are gathered in one step.
STEP = 1 << 19


class RankQueue:
    """Positions by rank. Three levels of 64-bit words tell which ranks have any."""

    def __init__(self, ranks: int):
        self.levels = []
        while True:
            ranks = (ranks + 63) // 64
            self.levels.append([0] * ranks)
            if ranks == 1:
                break
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [positions]
            for level in self.levels:
                word, bit = rank >> 6, 1 << (rank & 63)
                known, level[word] = level[word], level[word] | bit
                if known:
                    break
                rank = word
        else:
            bucket.append(positions)

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank and its positions, ascending and without repeats."""
        if not self.buckets:
            return None
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            rank = rank << 6 | (word & -word).bit_length() - 1
        place = rank
        for level in self.levels:
            word, bit = place >> 6, 1 << (place & 63)
            level[word] ^= bit
            if level[word]:
                break
            place = word
        found = self.buckets.pop(rank)
        if len(found) == 1:
            return rank, found[0]
        places = np.sort(np.concatenate(found))
        return rank, places[np.concatenate(([True], places[1:] != places[:-1]))]

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Positions with their ranks, in any order, repeats allowed."""
        if len(ranks) == 0:
            return
        both = np.sort(ranks.astype(np.int64) << 32 | positions)
        both = both[np.concatenate(([True], both[1:] != both[:-1]))]
        ranks, positions = both >> 32, (both & 0xFFFFFFFF).astype(np.int32)
        edges = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for rank, a, b in zip(ranks[edges[:-1]].tolist(), edges, edges[1:], strict=False):
            self.push(rank, positions[a:b])


class Codec:
    """Ranks of byte strings, as in a tiktoken rank file, and a pattern that splits texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items() for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        pairs.sort()
        keys, values = zip(*pairs, strict=True) if pairs else ((0,), (NONE,))
        self.keys, self.values = np.array(keys, np.int64), np.array(values, np.int32)
        self.split = regex.compile(pattern).findall
        self.decimals = [str(i) for i in range(len(self.tokens))]

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def encode_words(self, words: list[bytes], one_by_one: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and where each word's ids start (one more entry than words)."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(words) else 0
        symbols = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        after = np.arange(1, total + 1, dtype=np.int32)
        before = np.arange(-1, total - 1, dtype=np.int32)
        filled = ends[lengths > 0]
        after[filled - 1] = -1
        before[filled - lengths[lengths > 0]] = -1
        rank = np.full(total, NONE, np.int32)  # of the pair that starts here
        alive = np.ones(total, bool)
        first = np.flatnonzero(after >= 0).astype(np.int32)
        rank[first] = self.ranks_of(symbols[first], symbols[after[first]])
        queue = RankQueue(len(self.tokens))
        first = first[rank[first] != NONE]
        queue.push_all(rank[first], first)
        odd: set[int] = set()
        while (popped := queue.pop()) is not None:
            r, places = popped
            places = places[rank[places] == r]  # the others are stale
            if len(places) > 1:
                if one_by_one:
                    queue.push(r, places[1:])
                    places = places[:1]
                else:  # of overlapping pairs every other one, from the left
                    chained = np.concatenate(([False], after[places[:-1]] == places[1:]))
                    if chained.any():
                        index = np.arange(len(places))
                        run = np.maximum.accumulate(np.where(chained, 0, index))
                        places = places[(index - run) % 2 == 0]
            if len(places) == 0:
                continue
            gone = after[places]
            rest = after[gone]
            symbols[places] = r
            alive[gone] = False
            rank[gone] = rank[places] = NONE
            after[places] = rest
            followed = rest >= 0
            before[rest[followed]] = places[followed]
            left = before[places]
            changed = np.concatenate((places[followed], left[left >= 0]))
            if len(changed):
                new = self.ranks_of(symbols[changed], symbols[after[changed]])
                rank[changed] = new
                some = new != NONE
                changed, new = changed[some], new[some]
                queue.push_all(new, changed)
                if not one_by_one and len(new) and int(new.min()) <= r:
                    # A lower rank came up: in these words the order of single merges counts.
                    odd.update(np.searchsorted(ends, changed[new <= r], side="right").tolist())
        ids = symbols[alive]
        kept = np.concatenate(([0], np.cumsum(alive)))
        starts = kept[np.concatenate(([0], ends)).astype(np.int64)]
        if odd:
            parts = [ids[starts[i]:starts[i + 1]] for i in range(len(words))]
            for i in odd:
                parts[i] = self.encode_words([words[i]], one_by_one=True)[0]
            starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            ids = np.concatenate(parts)
        return ids, starts

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Pieces(dict):
    """A number for each distinct piece of text, given on first sight; its pre-tokens wait in ``new``.

    A key that is a string stands after a blank; one in a tuple is the whole piece.
    """

    def __init__(self, split):
        self.split, self.new = split, []

    def __missing__(self, piece: str) -> int:
        self.new.append(self.split(piece[0] if type(piece) is tuple else " " + piece))
        self[piece] = number = len(self)
        return number


class Encoder:
    """What a worker keeps between slices and tasks: the pieces seen and their ids.

    Where the pattern never matches across the start of a run of white space
    (``before_spaces``), texts fall into pieces at blanks, and only distinct pieces
    meet the slower pattern. Else, and in texts with runs of blanks or other white
    space, a piece is one pre-token.
    """

    other_space = frozenset(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")

    def __init__(self, using: Codec, before_spaces: bool):
        self.using, self.before_spaces = using, before_spaces
        self.forget()

    def forget(self) -> None:
        self.pieces, self.ids = Pieces(self.using.split), np.zeros(0, np.int32)
        self.starts, self.kept = np.zeros(1, np.int64), 0

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.pieces) > REMEMBERED or self.kept > REMEMBERED_CHARS:
            self.forget()
        number, numbers = self.pieces.__getitem__, []
        for text in texts:
            if self.before_spaces and "  " not in text and "\n " not in text and self.other_space.isdisjoint(text):
                head, *rest = text.split(" ")
                row = array("i", (number((head,)),))
                row.extend(map(number, rest))
            else:
                row = array("i", map(number, zip(self.using.split(text))))  # noqa: B905
            numbers.append(row)
        if new := self.pieces.new:
            ids, starts = self.using.encode_words([w.encode() for words in new for w in words])
            self.kept += int(starts[-1])
            starts = starts[np.cumsum([len(words) for words in new])]
            self.starts = np.concatenate((self.starts, starts + self.starts[-1]))
            self.ids = np.concatenate((self.ids, ids))
            new.clear()
        out = []
        for row in numbers:
            found = [np.zeros(0, np.int32)]
            for at in range(0, len(row), STEP):
                words = np.frombuffer(row[at:at + STEP], np.int32)
                begin, length = self.starts[words], self.starts[words + 1] - self.starts[words]
                shift = begin - (np.cumsum(length) - length)
                found.append(self.ids[np.repeat(shift, length) + np.arange(int(length.sum()))])
            out.append(np.concatenate(found))
        return out


@lru_cache(maxsize=2)
def encoder(ranks: bytes, pattern: str, before_spaces: bool) -> Encoder:
    lines = (line.split() for line in ranks.splitlines() if line.strip())
    return Encoder(Codec({base64.b64decode(token): int(rank) for token, rank in lines}, pattern), before_spaces)


def bpe(
    docs: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",),
    text: str = "text", ids: bool = True, before_spaces: bool = True,
) -> DataFrame:
    """``keep``, token_ids (if ``ids``), n_tokens, ids_sha256 and decoded_sha256 of every row.

    ids_sha256 is of the decimal ids joined by a space; decoded_sha256 is of the bytes
    that the ids decode to. ``before_spaces`` says that the pattern never matches across
    the start of a run of white space, which holds for the usual byte-level ones. The rank file is read by the driver and sent to the tasks:
    its size is that of a vocabulary, whatever the size of ``docs``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())

    def make():
        encode = encoder(sent.value, pattern, before_spaces)
        using = encode.using

        def function(texts: list[bytes | None]) -> list:
            found = encode([(t or b"").decode(errors="replace") for t in texts])
            decimal, sha, digests = using.decimals.__getitem__, hashlib.sha256, []
            for row in found:  # one text's ids at a time as Python objects
                own = row.tolist()
                digests.append((sha(" ".join(map(decimal, own)).encode()).hexdigest(), sha(using.decode(own)).hexdigest()))
            sizes = [len(x) for x in found]
            column = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(np.concatenate(found) if found else [], pa.int32()))
            return [*([column.cast(pa.list_(pa.int32()))] if ids else []), sizes, *map(list, zip(*digests, strict=True))]

        return function

    result = "token_ids array<int>, " * ids + "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_texts(docs, list(keep), text, result, make)
