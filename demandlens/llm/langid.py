"""Language identification by nearest centroid over normalised TF-IDF n-gram vectors.

A text is a vector of hashed byte n-gram counts, damped, weighted by inverse document
frequency and normalised. Each language has several centroids, found by spherical
k-means. The nearest centroid by cosine decides; a text too far from it is rejected.

How far is too far follows from the sample: its texts, cut to each of ``LENGTHS``, give the
cosines that texts of the language have at that length. Rejected is what falls below
``SLACK`` of their low quantile. Texts shorter than the least length are too short to tell.

Fitted on at most ``per_language`` rows of each language, those with the smallest hash
of the id; at most ``most_languages`` languages, the most frequent, so the model that
goes to the tasks has a bound. Texts are read whole, in fitting too. Null texts and texts
without a letter have no language: ``und``, rejected, score 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandlens.llm.rows import checkpointed, map_texts, pick

NONE = "und"
#: Hashed n-grams, and the sizes of n-grams in bytes.
BUCKETS, SIZES = 1 << 14, (1, 2, 3, 4)
PER_LANGUAGE, MOST_LANGUAGES, CENTROIDS, ROUNDS = 400, 400, 4, 12
#: Cosine distance from the nearest centroid beyond which a text is rejected.
FARTHEST = 0.98
#: Bytes of folded text at which cosines of the sample are taken, their low quantile, and the part of it that is enough.
LENGTHS, QUANTILE, SLACK = (16, 32, 64, 128, 512, 2048), 0.01, 0.5
#: Texts of a length that a language must have for a quantile.
ENOUGH = 20
#: Texts that are compared with the centroids at a time.
TOGETHER = 128
MULTIPLIER = np.uint32(2654435761)
letter = regex.compile(r"\p{L}").search


def folded(text: bytes) -> bytes:
    """Lower-case letters; runs of anything else are one blank."""
    return regex.sub(r"[^\p{L}]+", " ", text.decode(errors="replace").lower()).strip().encode()


def counts(text: bytes) -> np.ndarray:
    """Hashed n-gram counts of the folded text."""
    return counts_of(folded(text))


def counts_of(letters: bytes) -> np.ndarray:
    codes = np.frombuffer(b" " + letters + b" ", np.uint8).astype(np.uint32)
    total = np.zeros(BUCKETS, np.float32)
    grams = codes
    for size in range(1, max(SIZES) + 1):
        if size > 1:
            grams = (grams[:-1] << np.uint32(8)) | codes[size - 1:]
        if size in SIZES:
            at = ((grams + np.uint32(size)) * MULTIPLIER) >> np.uint32(32 - 14)
            total += np.bincount(at, minlength=BUCKETS)
    return total


def weighted(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = np.log1p(rows) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def clustered(rows: np.ndarray, centroids: int, rounds: int) -> np.ndarray:
    """Spherical k-means from spread-out first centroids; without random choices."""
    chosen = [rows.mean(axis=0)]
    for _ in range(min(centroids, len(rows)) - 1):
        chosen.append(rows[np.argmin(np.max(rows @ np.array(chosen).T, axis=1))])
    middle = np.array(chosen)
    for _ in range(rounds):
        middle /= np.maximum(np.linalg.norm(middle, axis=1, keepdims=True), 1e-12)
        near = np.argmax(rows @ middle.T, axis=1)
        middle = np.array([rows[near == i].mean(axis=0) if (near == i).any() else middle[i] for i in range(len(middle))])
    return middle / np.maximum(np.linalg.norm(middle, axis=1, keepdims=True), 1e-12)


def fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", learn: Column | None = None,
    per_language: int = PER_LANGUAGE, most_languages: int = MOST_LANGUAGES, centroids: int = CENTROIDS,
) -> dict:
    """The model: names of the languages, the centroids of each, inverse document frequencies, least cosines.

    ``learn`` picks rows by the columns named. One task clusters one language; the driver
    gets document frequencies and centroids only.
    """
    rows = pick(docs, doc_id, text, lang).where(learn if learn is not None else F.lit(True))
    rows = rows.where((F.col(lang) != NONE) & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), F.xxhash64(doc_id).alias("order"), F.col(text).alias("text"),
    )
    frequent = [r.lang for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()]
    first = rows.where(F.col("lang").isin(frequent)).select("lang", "order").withColumn(
        "at", F.row_number().over(Window.partitionBy("lang").orderBy("order")),
    ).where(F.col("at") <= per_language)
    upto = {r.lang: r.upto for r in first.groupBy("lang").agg(F.max("order").alias("upto")).collect()}
    if not upto:
        return {"names": [], "centroids": np.zeros((0, BUCKETS), np.float32), "owner": [], "idf": np.ones(BUCKETS, np.float32),
                "least": np.zeros((0, len(LENGTHS)))}
    limit = F.create_map(*(F.lit(x) for pair in upto.items() for x in pair))
    sample = checkpointed(rows.where(F.col("lang").isin(frequent) & (F.col("order") <= limit[F.col("lang")])))

    def make():
        def function(texts):
            found = [counts(t or b"") for t in texts]
            at = [np.flatnonzero(c) for c in found]
            return [[a.astype(np.int32).tolist() for a in at], [c[a].tolist() for c, a in zip(found, at, strict=True)]]

        return function

    # Equal orders (repeated ids) may exceed the bound; the window cuts them.
    vectors = checkpointed(map_texts(sample, ["lang", "order"], "text", "at array<int>, n array<float>", make).withColumn(
        "row", F.row_number().over(Window.partitionBy("lang").orderBy("order", "at", "n")),
    ).where(F.col("row") <= per_language))
    seen = vectors.select(F.explode("at").alias("at")).groupBy("at").count().collect()
    total = vectors.count()
    idf = np.full(BUCKETS, np.log(1 + total), np.float32)
    for r in seen:
        idf[r["at"]] = np.log((1 + total) / (1 + r["count"])) + 0.1

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        matrix = np.zeros((len(rows), BUCKETS), np.float32)
        for i, (at, n) in enumerate(zip(rows["at"], rows["n"], strict=True)):
            matrix[i, np.asarray(at, np.int64)] = n
        made = clustered(weighted(matrix, idf), centroids, ROUNDS)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "middle": [m.astype(np.float32).tobytes() for m in made]})

    middles = vectors.groupBy("lang").applyInPandas(cluster, "lang string, middle binary").collect()
    middles.sort(key=lambda r: (r.lang, r.middle))
    names = sorted({r.lang for r in middles})
    model = {
        "names": names, "owner": [names.index(r.lang) for r in middles], "idf": idf,
        "centroids": np.array([np.frombuffer(r.middle, np.float32) for r in middles]),
    }
    return model | {"least": least_cosines(sample, model)}


def least_cosines(sample: DataFrame, model: dict) -> np.ndarray:
    """For each language and each of ``LENGTHS`` the cosine below which a text is rejected."""
    sent = sample.sparkSession.sparkContext.broadcast(model)

    def make():
        names, owner = sent.value["names"], np.array(sent.value["owner"], np.int64)
        middles, idf = sent.value["centroids"], sent.value["idf"]

        def one(text: bytes | None, lang: str) -> list[float | None]:
            letters, own = folded(text or b""), middles[owner == names.index(lang)]
            cut = [counts_of(letters[:n]) for n in LENGTHS if len(letters) >= n]
            near = (weighted(np.array(cut), idf) @ own.T).max(axis=1).tolist() if cut else []
            return near + [None] * (len(LENGTHS) - len(near))

        return lambda texts, kept: [[one(t, lang) for t, lang in zip(texts, kept[0].to_pylist(), strict=True)]]

    marks = map_texts(sample, ["lang"], "text", "near array<double>", make, with_kept=True)
    at = [F.col("near")[i] for i in range(len(LENGTHS))]
    low = marks.groupBy("lang").agg(
        F.array(*(F.when(F.count(x) >= ENOUGH, F.percentile(x, F.lit(QUANTILE))) for x in at)).alias("low"),
    ).collect()
    least = np.zeros((len(model["names"]), len(LENGTHS)))
    for r in low:
        # A length that few texts reach is judged like the one before it.
        for i, x in enumerate(r.low):
            least[model["names"].index(r.lang), i:] = least[model["names"].index(r.lang), i - 1] if x is None and i else SLACK * (x or 0)
    return least


def identify(
    docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",), text: str = "text", farthest: float = FARTHEST,
) -> DataFrame:
    """``keep``, lang_pred, score (cosine with the nearest centroid, 0 to 1) and rejected of every row.

    ``farthest`` bounds the distance whatever the sample says.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        names, owner = sent.value["names"], np.array(sent.value["owner"], np.int64)
        middles, idf, least = sent.value["centroids"], sent.value["idf"], sent.value["least"]

        def function(texts):
            named, scores, far = [NONE] * len(texts), np.zeros(len(texts)), [True] * len(texts)
            usable = [i for i, t in enumerate(texts) if names and t and letter(t.decode(errors="replace"))]
            for at in range(0, len(usable), TOGETHER):
                part = usable[at:at + TOGETHER]
                letters = [folded(texts[i]) for i in part]
                near = weighted(np.array([counts_of(x) for x in letters]), idf) @ middles.T
                best = np.argmax(near, axis=1)
                reached = np.searchsorted(LENGTHS, [len(x) for x in letters], side="right")
                for i, b, n, row in zip(part, best.tolist(), reached.tolist(), near, strict=True):
                    named[i], scores[i] = names[owner[b]], min(1.0, max(0.0, float(row[b])))
                    far[i] = 1 - scores[i] > farthest or n > 0 and scores[i] < least[owner[b], n - 1]
            return [named, scores, [bool(x) for x in far]]

        return function

    return map_texts(docs, list(keep), text, "lang_pred string, score double, rejected boolean", make)
