"""Documents that share most of their shingles, by prefixes of token combinations.

A set x can only reach the similarity with another set if at most ``missing(x)`` of its tokens lie outside that
one. Tokens are ordered by document frequency, rarest first; a prefix is as long as it takes that so many missing
tokens cannot spoil all of its signatures. A rare token is a signature by itself, and one missing token spoils it.
Frequent tokens fall into classes by hash; in a class every combination of ``K`` tokens is a signature, and it takes
all but K - 1 of the class's tokens to spoil them, so the prefix is extended until the budget is covered. Two similar sets
have a signature in common; dissimilar ones that share a frequent token seldom share K of one class. A token of a single
document covers budget and needs no signature, so most documents have none at all.

The number of classes grows with the set, which keeps combinations linear in its size. Both sides of a pair must use the
same number, so it goes by the doubling that the larger set's size lies in; a set serves the one or two doublings of its partners.

Candidates are verified by bits first, then by all tokens. Equal sets are one node throughout. Within the sets of one
signature one member at a time meets the others, as long as that closes groups; members that are connected need not
meet. What is left meets in tiles of bounded size.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.llm.components import components
from demandlens.llm.rows import checkpointed, map_slices, pick, to_arrow
from demandlens.llm.tokens import hashes, mixed, numbered

SIZE, PERCENT = 5, 80
#: Tokens of more sets than this are frequent; combinations of K of them are signatures.
RARE, K = 16, 2
#: One class for so many tokens of the larger set.
CLASS = 20
#: Share of the tokens, by hash, that the first sieve looks at: two fifths.
SIEVE, OF = 2, 5
#: Bits of a set's sketch, and rows of one side of a tile.
SKETCH, TILE = 1024, 512
#: Rows whose 8-byte marks are sent to all tasks, at most.
SENT = 2_000_000
#: A node's smallest signatures, so many, show where a pair with several in common has met before.
FIRST, NONE = 16, (1 << 63) - 1


def missing(n: int) -> int:
    """Tokens of a set of n that another set may lack at most."""
    return n - (PERCENT * n + 99) // 100


def missing_column(n: str) -> Column:
    return F.expr(f"{n} - ({PERCENT} * {n} + 99) div 100")


def token_sets(texts: list[bytes | None], size: int = SIZE, sieve: bool = False) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; with ``sieve`` the first sieve's share of them."""
    words = [(t or b"").lower().split() for t in texts]
    ids, known = numbered(chain.from_iterable(words))
    every = hashes(known)[ids]
    grams = every
    for k in range(1, size):
        grams = mixed(grams[:-1], every[k:]) if len(grams) > 1 else grams[:0]
    sets, at = [], 0
    for own in map(len, words):
        if own >= size:
            found = grams[at:at + own - size + 1]
        else:
            found = every[at:at + min(own, 1)]
            for k in range(1, own):
                found = mixed(found, every[at + k:at + k + 1])
        sets.append(np.unique(found[found % np.uint64(OF) < SIEVE] if sieve else found))
        at += own
    return sets


def digest(tokens: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None


def described(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, mark, n, set) of each row; ``set`` is a 128-bit digest, null for an empty set."""
    def make():
        def run(texts: list, ids: pa.Array, marks: pa.Array) -> Iterator[list]:
            sets = token_sets(texts, size)
            yield [ids, marks, [len(s) for s in sets], [digest(s) for s in sets]]

        return run

    return map_slices(docs, ["doc_id", "mark", "text"], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, mark bigint, n bigint, set binary", make)


def sieved(docs: DataFrame, sets: DataFrame, size: int) -> DataFrame:
    """The rows of ``sets`` but those with more tokens of their own than may be missing.

    Looks at the same share of all tokens in every document, so a token found once there stands in one document only.
    Repeated and null ids stay.
    """
    kind = to_arrow(docs.schema["doc_id"].dataType)

    def make():
        def run(texts: list, ids: pa.Array) -> Iterator[list]:
            parts = token_sets(texts, size, sieve=True)
            rows = np.repeat(np.arange(len(parts)), list(map(len, parts)))
            yield [np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64), ids.cast(kind).take(pa.array(rows))]

        return run

    given = docs.where(F.col("doc_id").isNotNull())
    tokens = map_slices(given, ["doc_id", "text"], f"token bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}", make)
    own = (
        tokens.groupBy("token").agg(F.count("*").alias("df"), F.min("doc_id").alias("doc_id"))
        .where("df = 1").groupBy("doc_id").agg(F.count("*").alias("own"))
    )
    whole = sets.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("n").alias("n"))
    gone = whole.join(own, "doc_id").where((F.col("rows") == 1) & (F.col("own") > missing_column("n"))).select("doc_id")
    return sets.where("n > 0").join(gone, "doc_id", "left_anti")


def sketch(tokens: np.ndarray) -> bytes:
    bits = np.zeros(SKETCH, bool)
    bits[(tokens >> np.uint64(20)) % np.uint64(SKETCH)] = True
    return np.packbits(bits).tobytes()


def nodes(docs: DataFrame, left: DataFrame, size: int) -> DataFrame:
    """(node, set, n, tokens, sketch) of the distinct sets of ``left``."""
    chosen = checkpointed(left.groupBy("set").agg(F.min("mark").alias("mark")).select("mark"))

    def make():
        def run(texts: list) -> Iterator[list]:
            sets = token_sets(texts, size)
            yield [[digest(s) for s in sets], [len(s) for s in sets], [s.view(np.int64) for s in sets], [sketch(s) for s in sets]]

        return run

    # Marks up to the bound go to all tasks, so that texts cross no shuffle; more of them are joined.
    marks = F.broadcast(chosen) if chosen.count() <= SENT else chosen
    texts = docs.select("mark", "text").join(marks, "mark", "left_semi")
    found = map_slices(texts, ["text"], "set binary, n bigint, tokens array<bigint>, sketch binary", make)
    found = checkpointed(found.withColumn("node", F.monotonically_increasing_id()))
    if found.groupBy("set").agg(F.count("*").alias("rows")).where("rows > 1").limit(1).count():  # equal rows, equal marks
        found = checkpointed(found.dropDuplicates(["set"]))
    return found


def doublings(n: int) -> set[int]:
    """The doublings of the larger set's size, in pairs with a set of n."""
    return {n.bit_length(), (100 * n // PERCENT).bit_length()}


def signatures_of(n: int, tokens: list[tuple[int, int]], rare: int, k: int) -> set[int]:
    """Signatures of a set of n tokens; ``tokens`` are those that other sets have too, as (document frequency, token), in order."""
    found: set[int] = set()
    budget = missing(n) + 1 - (n - len(tokens))
    if budget <= 0 or n * (100 - PERCENT) // PERCENT == 0:  # no other set of similar size can be similar enough
        return found
    for doubling in doublings(n):
        classes = max(1, (1 << doubling - 1) // CLASS)
        left, members = budget, defaultdict(list)
        for df, token in tokens:
            if df <= rare:
                found.add(token)
                left -= 1
            else:
                own = members[xxhash.xxh64_intdigest(token.to_bytes(8, "little", signed=True)) % classes]
                for others in combinations(own, k - 1):
                    key = np.array([doubling, *others, token], np.int64)
                    found.add(xxhash.xxh64_intdigest(key.tobytes()) - (1 << 63))
                own.append(token)
                left -= len(own) >= k
            if not left:
                break
    return found


def signatures(sets: DataFrame, rare: int = RARE, k: int = K) -> DataFrame:
    """(sig, node, n, own, sketch): the signatures of the nodes; ``own`` counts the tokens that no other node has."""
    # One shuffle serves the counts and the join with them.
    tokens = sets.select("node", F.explode("tokens").alias("token")).repartition("token")
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    listed = tokens.join(shared, "token").groupBy("node").agg(F.collect_list(F.struct("df", "token")).alias("shared"))
    given = sets.select("node", "n", "sketch").join(listed, "node").where(F.size("shared") >= F.col("n") - missing_column("n"))
    given = given.select("node", "n", "sketch", "shared.df", "shared.token")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (node, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                df, token = (np.asarray(batch.column(c)[i].values) for c in (3, 4))
                order = np.lexsort((token, df))
                sigs = list(signatures_of(n, list(zip(df[order].tolist(), token[order].tolist(), strict=True)), rare, k))
                if sigs:
                    one = batch.slice(i, 1).take(pa.array([0] * len(sigs)))
                    own = pa.array([n - len(df)] * len(sigs), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.int64()), *one.columns[:2], own, one.column(2)],
                                                     names=["sig", "node", "n", "own", "sketch"])

    return given.mapInArrow(run, "sig bigint, node bigint, n bigint, own bigint, sketch binary")


def similar_length(a: str, b: str) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def verified(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar: by sketches, which never rule out such a pair, then by all tokens."""
    def joined(pairs: DataFrame, column: str) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col(column).alias(f"{column}_{side}")), side)
        return pairs.select("a", "b", "n_a", "n_b", f"{column}_a", f"{column}_b")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (np.asarray(batch.column(i)) for i in (2, 3))
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(-1, SKETCH // 64) for i in (4, 5))
            yield batch.select([0, 1]).filter(pa.array(may_be_similar(n_a, n_b, a, b)))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                a, b = (np.asarray(batch.column(c)[i].values) for c in (4, 5))
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(a) + len(b) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    schema = "a bigint, b bigint"
    some = checkpointed(joined(pairs, "sketch").mapInArrow(likely, schema))
    return checkpointed(joined(some, "tokens").mapInArrow(similar, schema))


def labelled(entries: DataFrame, roots: DataFrame) -> DataFrame:
    return entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def links(sets: DataFrame, entries: DataFrame, tile: int = TILE) -> DataFrame:
    """Pairs (a, b) of similar nodes that connect all that are similar."""
    found = sets.sparkSession.createDataFrame([], "a bigint, b bigint")
    roots = sets.sparkSession.createDataFrame([], "node bigint, root bigint")
    before = None
    while True:
        at = labelled(entries, roots)
        # The member with the fewest tokens of its own is the one that most of a group of near copies are near to.
        hub = F.min(F.struct((F.col("own") / F.col("n")).alias("order"), "node", "n", "root")).alias("hub")
        groups = at.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high"), hub).where("low <> high")
        rows = checkpointed(at.join(groups.select("sig", "hub"), "sig"))
        open_rows = rows.count()
        if not open_rows:
            return found
        if before is not None and 2 * open_rows > before:
            break
        apart = rows.where((F.col("root") != F.col("hub.root")) & similar_length("n", "hub.n"))
        found = found.union(verified(sets, ordered(apart.select("node", "hub.node"))))
        roots = components(found, "a", "b")
        # The hub has met all the others of its signature.
        entries = rows.where("node <> hub.node").select(*entries.columns)
        before = open_rows
    return found.union(verified(sets, ordered(tile_pairs(rows.drop("hub"), tile))))


def ordered(pairs: DataFrame) -> DataFrame:
    a, b = (F.col(f"`{c}`") for c in ("x", "y"))
    return pairs.toDF("x", "y").select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def tile_pairs(rows: DataFrame, tile: int) -> DataFrame:
    """Pairs of nodes with one signature and different roots, of similar length.

    Members of a signature's largest root are only held against the others; both sides are dealt to tiles. A pair comes
    from the smallest signature that its nodes share; from others too only if that is not among the first of both.
    """
    firsts = F.concat(F.array_sort(F.collect_list("sig")), F.array_repeat(F.lit(NONE), FIRST))
    rows = rows.join(rows.groupBy("node").agg(F.slice(firsts, 1, FIRST).alias("first")), "node")
    parts = rows.groupBy("sig", "root").agg(F.count("*").alias("members"))
    sizes = parts.groupBy("sig").agg(F.sum("members").alias("all"), F.max(F.struct("members", "root")).alias("most"))
    sizes = sizes.select("sig", F.col("most.root").alias("main"), F.ceil(F.col("all") / tile).cast("int").alias("wide"),
                         F.ceil((F.col("all") - F.col("most.members")) / tile).cast("int").alias("high"))
    given = rows.join(sizes, "sig")
    own = lambda of, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(of)).cast("int")
    upto = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    left = given.select("sig", own("wide", 1).alias("i"), upto("high").alias("j"), F.lit(False).alias("other"),
                        (F.col("root") == F.col("main")).alias("main"), "node", "n", "root", "sketch", "first")
    right = given.where("root <> main").select(
        "sig", upto("wide").alias("i"), own("high", 2).alias("j"), F.lit(True).alias("other"),
        F.lit(False).alias("main"), "node", "n", "root", "sketch", "first")
    dealt = left.unionByName(right).repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        last = None
        for batch in (b for b in batches if b.num_rows):
            keys = np.stack([np.asarray(batch.column(i)) for i in range(3)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:], strict=False):
                key = tuple(keys[:, start].tolist())
                if rest and key != last:
                    yield from crossed(pa.Table.from_batches(rest))
                    rest = []
                rest.append(batch.slice(start, end - start))
                last = key
        if rest:
            yield from crossed(pa.Table.from_batches(rest))

    return dealt.mapInArrow(run, "a bigint, b bigint")


def crossed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs of the two sides of one tile that sizes, roots and sketches leave, unless a smaller signature has them."""
    node, n, root = (np.asarray(rows.column(c)) for c in ("node", "n", "root"))
    other, main = (np.asarray(rows.column(c)) for c in ("other", "main"))
    x, y = np.flatnonzero(~other), np.flatnonzero(other)
    if not len(x) or not len(y):
        return
    bits = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint64).reshape(-1, SKETCH // 64)
    sig, first = rows.column("sig")[0].as_py(), np.asarray(rows.column("first").combine_chunks().flatten()).reshape(-1, FIRST)
    for part in np.array_split(x, -(-len(x) // 64)):
        a, b = np.nonzero((root[part][:, None] != root[y])
                          & (100 * np.minimum(n[part][:, None], n[y]) >= PERCENT * np.maximum(n[part][:, None], n[y])))
        a, b = part[a], y[b]
        once = main[a] | (node[a] < node[b])  # two nodes apart from the largest root stand on both sides
        a, b = a[once], b[once]
        near = may_be_similar(n[a], n[b], bits[a], bits[b])
        a, b = a[near], b[near]
        met = ((first[a][:, :, None] == first[b][:, None, :]) & (first[a] < sig)[:, :, None]).any(axis=(1, 2))
        if not met.all():
            yield pa.RecordBatch.from_arrays([pa.array(node[a[~met]]), pa.array(node[b[~met]])], names=["a", "b"])


def may_be_similar(n_a: np.ndarray, n_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """False only where the sketches show more missing tokens than similar sets can have."""
    need = -(-PERCENT * (n_a + n_b) // (100 + PERCENT))
    lack_a, lack_b = (np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64) for x, y in ((a, b), (b, a)))
    return (lack_a <= n_a - need) & (lack_b <= n_b - need)


def similar_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, rare: int = RARE, k: int = K, tile: int = TILE,
) -> DataFrame:
    """Id, n_shingles and component_id of every row.

    The component is the smallest id reachable by links, nulls apart; null if all are. A null or wordless text has
    no shingles and stays alone. Equal sets are always linked; rows with equal ids are separate documents. Shingles are told apart by 64-bit hashes.
    """
    given = pick(docs, doc_id, text).toDF("doc_id", "text").withColumn("mark", F.xxhash64("doc_id", "text"))
    every = checkpointed(described(given, size))
    sets = nodes(given, sieved(given, every, size), size)
    found = links(sets, checkpointed(signatures(sets, rare, k)), tile)
    roots = components(found, "a", "b")
    least = every.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    member = least.join(sets.select("set", "node"), "set", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    linked = member.where("root is not null").groupBy("root").agg(F.min("least").alias("component_id"), F.sum("rows").alias("rows"))
    names = member.where("root is not null").select("set", "root").join(linked.where("rows > 1"), "root").select("set", "component_id")
    joined = every.join(names, "set", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")).toDF(
        doc_id, "n_shingles", "component_id")
