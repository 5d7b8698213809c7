"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm import bpe, chat, langid, licenses, line_index, minhash, ngram_join, phrases, ppm, simhash, toxicity, variants, wu_manber

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(of: int):
    """crc32 of the id as text, modulo ``of``; null ids count as 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % of, F.lit(0))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN, ids=False,
    )


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"), remainder(10) != 0).select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wu_manber.digest(wu_manber.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
    ))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=remainder(3) != 1)
    return toxicity.score(docs, model).select("doc_id", (remainder(3) == 1).alias("held_out"), "score", "predicted")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_index.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash(table(spark, sf_dir, "documents"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edited_likeness(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, learn=remainder(4) != 2)
    return langid.identify(docs, model).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score", "rejected",
    )


#: Two turns that say the template's own control strings.
CONTROL = [(-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok")]


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = given.unionByName(spark.createDataFrame(CONTROL, "conv_id long, turn long, role string, text string"))
    typed = turns.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    return chat.digest(chat.format_chat(typed))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_ppm": op2_ppm,
    "op3_licenses": op3_licenses,
    "op4_decontaminate": op4_decontaminate,
    "op5_toxicity": op5_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_simhash": op7_simhash,
    "op8_minhash": op8_minhash,
    "op9_language": op9_language,
    "op10_chat": op10_chat,
    "op11_variants": op11_variants,
    "op12_phrases": op12_phrases,
    "op13_ngram_join": op13_ngram_join,
}

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {}

WORDS = "list_filter(string_split_regex(" + LOWER + ", '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"

ORACLE["op3_licenses"] = f"""
WITH phrase(p, label) AS (VALUES {", ".join(f"(string_split('{p}', ' '), '{label}')" for p, label in licenses.PHRASES.items())}),
template(t, need, label) AS (VALUES {", ".join(
    f"({words}, {ceil(licenses.SHARE * len(words))}, '{label}')"
    for label, words in ((k, licenses.template_words(t)) for k, t in licenses.TEMPLATES.items())
)}),
d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
spot AS (
  SELECT doc_id, label, i - 1 AS i FROM d, phrase, unnest(range(1, len(w) - len(p) + 2)) AS u(i)
  WHERE w[i] = p[1] AND w[i:i + len(p) - 1] = p
), base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM spot GROUP BY doc_id
), block AS (
  SELECT DISTINCT doc_id, list_distinct({WORDS.format("l")}) AS b FROM d, unnest(string_split(text, chr(10))) AS u(l)
), match AS (
  SELECT doc_id, label, len(list_intersect(t, b)) / len(t)::DOUBLE AS share FROM block, template
  WHERE len(b) >= need AND len(list_intersect(t, b)) >= need
), own AS (SELECT doc_id, max(share) AS share FROM match GROUP BY doc_id),
label AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM match UNION SELECT doc_id, label FROM spot) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id) LEFT JOIN label USING (doc_id)
"""

ORACLE["op10_chat"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES {", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in CONTROL)}
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(24 + length(role) + length(replace(replace(text, chr(92), chr(92) || chr(92)), '<', chr(92) || 'l')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

ORACLE["op4_decontaminate"] = f"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex({LOWER.format("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
                             lambda w: w <> '') AS w FROM documents
), b AS (
  SELECT item_id, list_filter(string_split_regex({LOWER.format("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
                              lambda w: w <> '') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM d, (SELECT DISTINCT n FROM bw) k, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n
), hit AS (
  SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, s)
), words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM hit, unnest(range(i, i + n)) AS t(j) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op6_line_dedup"] = f"""
WITH line AS (
  SELECT doc_id, i, l, {LOWER.format("trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
       unnest(ls) WITH ORDINALITY AS t(l, i)
), many AS (
  SELECT k, min(doc_id) AS first FROM line WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT doc_id, i, l, first IS NOT NULL AND first <> doc_id AS gone FROM line LEFT JOIN many USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# CRC-32 byte by byte; 3988292384 and 4294967295 are the fixed values of that checksum.
ORACLE["op11_variants"] = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), run AS (
  SELECT doc_id, {LOWER.format("r")} AS r, count(*) AS n
  FROM documents, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS u(r)
  WHERE length(r) >= 7 GROUP BY ALL
), marked AS (
  SELECT r, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || r)) AS h, t FROM run, crc
), sealed AS (
  SELECT r, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2),
    lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS c FROM marked
), worn AS (
  SELECT CASE WHEN c % 31 = 0 THEN left(r, (c % length(r))::BIGINT) || substr(r, (c % length(r))::BIGINT + 2) ELSE r END AS word, n FROM sealed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM worn WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), less AS (
  SELECT word, n, p, left(word, p) || substr(word, p + 2) AS rest FROM words, unnest(range(length(word))) AS u(p)
), near AS (
  SELECT a.word, b.word AS near, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN less b ON b.rest = a.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n FROM near GROUP BY word
), form AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
         CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, coalesce(form, word) AS root, form IS NULL AS done FROM form
  UNION ALL SELECT c.word, coalesce(f.form, c.root), f.form IS NULL FROM chain c JOIN form f ON f.word = c.root WHERE NOT c.done
)
SELECT word, form, root, n, n_near, form_n FROM form JOIN (SELECT word, root FROM chain WHERE done) USING (word)
"""

ORACLE["op12_phrases"] = f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda w: w <> '') AS w
  FROM documents, unnest(string_split_regex({LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS u(p)
), phrase AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM piece, unnest([1, 2, 3]) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i) WHERE len(w) >= k GROUP BY ALL
), total AS (SELECT lang, sum(a)::BIGINT AS n FROM phrase WHERE k = 1 GROUP BY lang),
candidate AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM phrase WHERE k > 1 AND a >= 10),
parts AS MATERIALIZED (
  SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS first, array_to_string(w[c + 1:], ' ') AS rest FROM candidate, unnest(range(1, k)) AS x(c)
), known AS MATERIALIZED (SELECT lang, phrase, a FROM phrase WHERE a >= 10),
half AS MATERIALIZED (SELECT p.*, l.a AS l FROM parts p JOIN known l ON l.lang = p.lang AND l.phrase = p.first),
cut AS (
  SELECT p.lang, p.phrase, p.a, p.c, p.l, r.a AS r, (1000000::HUGEINT * p.a * p.a) // (p.l::HUGEINT * r.a) AS score
  FROM half p JOIN known r ON r.lang = p.lang AND r.phrase = p.rest
), lowest AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), inner_part AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer FROM candidate, unnest([1, 2]) AS t(i) WHERE k = 3 GROUP BY ALL
), ranked AS (
  SELECT lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest LEFT JOIN inner_part USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

ORACLE["op13_ngram_join"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex({LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS u(i) WHERE len(w) > 0
), size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), link AS MATERIALIZED (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), edge AS MATERIALIZED (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least AS component_id
FROM d LEFT JOIN size USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a) USING (doc_id)
"""
