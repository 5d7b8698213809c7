"""Toxicity by a factorization machine over hashed terms.

Terms are words and their beginnings, hashed to buckets; a text is the set of its
buckets. The machine adds a weight for each bucket and the product of two short vectors
for each pair of buckets, so it learns pairs, such as an insult together with a group,
that weights alone miss, also where each member by itself is as common in both classes.

All buckets that enough documents of the sample hold take part. Those that differ between the classes are hardly
penalised; the others, most of them noise, are shrunk harder and move by the common scale of their slopes only.

Fitted in one task on at most ``per_class`` labelled rows of each class, those with the
smallest hash of the id; both classes weigh alike. The model has at most ``BUCKETS`` buckets. Texts are read whole.
Null texts count as empty; a text without a known term gets the score of its bias.
A label other than 0 or 1 is not learned; of several labels of an id the largest counts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.llm.rows import checkpointed, map_texts, pick
from demandlens.llm.wu_manber import FOLD

BUCKETS, FACTORS = 1 << 20, 6
PER_CLASS = 6000
#: Lengths of word beginnings, in characters.
STARTS = (5, 7)
#: Deviation between the classes from which a bucket counts as telling; documents of the sample that must hold
#: one, telling or not; penalty of either; share of the largest slope's scale that steps of the others are held to.
DEVIATION, LEAST, LEAST_OTHER = 4.0, 3, 8
SHRINK, SHRINK_OTHER, SCALE_OTHER = 2e-4, 2e-2, 0.3
START, START_OTHER = 0.02, 0.01
EPOCHS, STEPS, ROWS, STEP = 20, 240, 1024, 0.05
REMEMBERED = 400_000
THRESHOLD = 0.7


class Terms(dict):
    """The buckets of each distinct word."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > REMEMBERED:
            self.clear()
        parts = [word, *(f"{word[:n]}*" for n in STARTS if len(word) > n)]
        self[word] = made = tuple(xxhash.xxh64_intdigest(p) % BUCKETS for p in parts)
        return made


def buckets(text: bytes | None, terms: Terms) -> set[int]:
    folded = (text or b"").decode(errors="replace").lower().encode().translate(FOLD).decode(errors="replace")
    return {b for word in set(folded.split(" ")) if word for b in terms[word]}


def training_rows(
    docs: DataFrame, labels: DataFrame, learn: Column | None, doc_id: str, text: str, label: str, per_class: int,
) -> DataFrame:
    """(label, buckets) of the sample."""
    known = pick(labels, doc_id, label).toDF(doc_id, "label").where("label in (0, 1)")
    known = known.where(learn) if learn is not None else known
    known = known.groupBy(doc_id).agg(F.max("label").cast("int").alias("label"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    order = F.xxhash64(doc_id)

    def smallest(rows: DataFrame, *by, below: bool = False) -> DataFrame:
        """At most ``per_class`` rows of each class; ``below`` first drops hashes far above the last one taken."""
        parts = []
        for value in (0, 1):
            own = rows.where(F.col("label") == value)
            share = (1.5 * per_class + 100) / max(1, sizes.get(value, 0))
            if below and share < 1:
                own = own.where(by[0] < F.lit(int(-(2**63) + 2**64 * share)))
            parts.append(own.orderBy(*by).limit(per_class))
        return parts[0].union(parts[1])

    # At most per_class rows for each of two labels.
    drawn = smallest(known, order, F.col(doc_id), below=True)
    chosen = pick(docs, doc_id, text).join(F.broadcast(drawn), doc_id).withColumn("order", order)

    def make():
        terms = Terms()
        return lambda texts: [[sorted(buckets(t, terms)) for t in texts]]

    made = checkpointed(map_texts(chosen, ["label", "order"], text, "buckets array<int>", make))
    # Repeated ids may exceed the bound.
    return smallest(made, F.col("order"), F.col("buckets")).select("label", "buckets")


def firsts(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)


def columns_of(flat: np.ndarray, label: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the buckets that take part, whether each is telling, and the column of each entry (-1: none)."""
    names, at, held = np.unique(flat, return_inverse=True, return_counts=True)
    n, positive = len(label), label.sum()
    expected = held * positive / n
    spread = np.sqrt(np.maximum(expected * (1 - held / n) * (1 - positive / n), 1e-9))
    telling = np.abs(np.bincount(at, label[owner], len(names)) - expected) / spread >= DEVIATION
    kept = held >= np.where(telling, LEAST, LEAST_OTHER)
    return names[kept], telling[kept], np.where(kept, np.cumsum(kept) - 1, -1)[at]


def fit_machine(rows: pd.DataFrame) -> dict:
    """Weights and vectors by Adam over blocks of rows, held as lists of their buckets."""
    rng = np.random.default_rng(11)
    rows = rows.iloc[rng.permutation(len(rows))]
    label, n = rows["label"].to_numpy(np.float64), len(rows)
    owner = np.repeat(np.arange(n), [len(b) for b in rows["buckets"]])
    flat = np.concatenate([np.asarray(b, np.int64) for b in rows["buckets"]])
    names, telling, column = columns_of(flat, label, owner)
    owner, column, size = owner[column >= 0], column[column >= 0], len(names)
    even = n * np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, n - label.sum()))
    # A row per bucket, the weight first, then the vector; the last row holds the bias.
    values = np.zeros((size + 1, FACTORS + 1), np.float32)
    values[:size, 1:] = rng.normal(0, 1, (size, FACTORS)) * np.where(telling, START, START_OTHER)[:, None]
    loose = np.append(telling, True)[:, None]
    shrink = np.where(loose, SHRINK, SHRINK_OTHER).astype(np.float32)
    common = np.where(loose, 0, SCALE_OTHER).astype(np.float32)
    mean, square = np.zeros_like(values), np.zeros_like(values)
    blocks = []
    for start in range(0, n, ROWS):
        low, high = np.searchsorted(owner, (start, start + ROWS))
        row, col = owner[low:high] - start, column[low:high]
        by_column = np.argsort(col, kind="stable")
        begins = firsts(col[by_column])
        blocks.append((slice(start, min(n, start + ROWS)), row, col, firsts(row), row[by_column], col[by_column][begins], begins))
    step = 0
    for _ in range(max(EPOCHS, -(-STEPS // len(blocks)))):
        for part, row, col, row_begins, row_of, touched, begins in blocks:
            sums, squares = np.zeros((part.stop - part.start, FACTORS + 1), np.float32), np.zeros(part.stop - part.start, np.float32)
            if len(col):
                own = values[col]
                sums[row[row_begins]] = np.add.reduceat(own, row_begins, axis=0)
                squares[row[row_begins]] = np.add.reduceat((own[:, 1:] ** 2).sum(axis=1), row_begins)
            logit = values[size, 0] + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - squares)
            error = even[part] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label[part]) / len(logit)
            slope = shrink * values
            slope[size, 0] = error.sum()
            if len(col):
                back = error[:, None].astype(np.float32) * np.concatenate((np.ones((len(error), 1), np.float32), sums[:, 1:]), axis=1)
                back = np.add.reduceat(back[row_of], begins, axis=0)
                back[:, 1:] -= back[:, :1] * values[touched, 1:]
                slope[touched] += back
            step += 1
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope**2 - square)
            scale = np.sqrt(square / (1 - 0.99**step))
            largest = np.r_[scale[:size, 0].max(initial=0), np.full(FACTORS, scale[:size, 1:].max(initial=0))].astype(np.float32)
            values -= STEP * (mean / (1 - 0.9**step)) / (scale + common * largest + 1e-6)
    return {"bias": float(values[size, 0]), "names": names, "w": values[:size, 0], "v": values[:size, 1:]}


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic", per_class: int = PER_CLASS,
) -> dict:
    """bias, names of the buckets, their weights and vectors. ``learn`` picks labels by id."""
    rows = training_rows(docs, labels, learn, doc_id, text, label, per_class)

    def task(rows: pd.DataFrame) -> pd.DataFrame:
        made = fit_machine(rows)
        return pd.DataFrame({"bias": [made["bias"]], **{
            k: [np.ascontiguousarray(made[k], t).tobytes()] for k, t in (("names", np.int64), ("w", np.float32), ("v", np.float32))}})

    one = rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(task, "bias double, names binary, w binary, v binary").first()
    if one is None:
        return {"bias": -4.0, "names": np.zeros(0, np.int64), "w": np.zeros(0, np.float32), "v": np.zeros((0, FACTORS), np.float32)}
    return {
        "bias": one.bias, "names": np.frombuffer(one.names, np.int64), "w": np.frombuffer(one.w, np.float32),
        "v": np.frombuffer(one.v, np.float32).reshape(-1, FACTORS),
    }


def score(docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",), text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``keep``, score (0 to 1) and predicted (1 from ``threshold``) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        bias, w, v = (sent.value[k] for k in ("bias", "w", "v"))
        place = np.full(BUCKETS, -1, np.int32)
        place[sent.value["names"]] = np.arange(len(w))
        terms = Terms()

        def one(text: bytes | None) -> float:
            # In the order of buckets, so that equal texts have equal scores whatever the words before them.
            at = place[np.sort(np.fromiter(buckets(text, terms), np.int64))]
            at = at[at >= 0]
            vectors = v[at].astype(np.float64)
            return bias + float(w[at].sum(dtype=np.float64)) + 0.5 * float((vectors.sum(axis=0) ** 2 - (vectors**2).sum(axis=0)).sum())

        def function(texts):
            scores = 1 / (1 + np.exp(-np.clip([one(t) for t in texts], -30, 30)))
            return [scores, (scores >= threshold).astype(np.int32)]

        return function

    return map_texts(docs, list(keep), text, "score double, predicted int", make)
