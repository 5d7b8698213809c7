"""License scans as an exact set-similarity join of text blocks with templates, in DataFrame functions only.

A block is a line of a text; block and template are sets of words. A block matches where it
contains at least ``share`` of a template's words. Words are ordered by the number of documents
that hold them, rarest first. Of a template of n words, of which o must be found, the first
n - o + 1 are its prefix: a match shares one of them (prefix filter). The block needs o words of
any template (length filter), and from the shared word on both sides must have enough left
(positional filter). What is left is counted exactly. Words in no template never count towards
an overlap, so blocks are cut to the templates' words first.

Null texts have no words. Rows are matched by id and text, so equal rows get equal labels.
"""

from __future__ import annotations

import re
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.llm.rows import pick

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, of any case.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHARE = 0.85

# Phrases that the query's contract names.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Usual wordings of public licences.
TEMPLATES = {
    "agpl-3": "licensed under the GNU Affero General Public License version 3",
    "apache-2": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted"
           " provided that the following conditions are met",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-sa": "licensed under the Creative Commons Attribution ShareAlike 4.0 International License",
    "cc0": "To the extent possible under law, all copyright and related rights have been waived to the public domain",
    "gpl-3": "This work is licensed under the GNU General Public License, version 3",
    "isc": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted",
    "lgpl-3": "licensed under the GNU Lesser General Public License version 3",
    "mit": "Released under the MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
                " and associated documentation files",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def template_words(text: str) -> list[str]:
    return list(dict.fromkeys(w.lower() for w in re.findall(r"[0-9A-Za-z]+", text)))


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    return F.filter(F.split(lowered(text), GAP), lambda w: w != "")


def places(found: Column, phrase: str) -> Column:
    """Numbers of the words at which the phrase starts."""
    parts = phrase.split(" ")
    starts = F.sequence(F.lit(0), F.greatest(F.size(found) - len(parts), F.lit(-1)))

    def same(i: Column) -> Column:
        return reduce(and_, (F.get(found, i + k).eqNullSafe(part) for k, part in enumerate(parts)))

    return F.when(F.size(found) >= len(parts), F.filter(starts, same)).otherwise(F.array().cast("array<int>"))


def phrase_places(rows: DataFrame, phrases: dict[str, str]) -> DataFrame:
    """``rows`` with n_words and places, an array of (label, at) over all phrases."""
    likely = "(?i)" + "|".join(GAP.join(p.split(" ")) for p in phrases)
    none = F.array().cast("array<string>")
    # Only texts that hold a phrase's letters are cut into words; the words decide.
    rows = rows.withColumn("found", F.when(F.col("text").rlike(likely), words(F.col("text"))).otherwise(none))

    def labelled(label: str):
        return lambda i: F.struct(F.lit(label).alias("label"), i.cast("bigint").alias("at"))

    at = F.flatten(F.array(*(F.transform(places(F.col("found"), p), labelled(label)) for p, label in phrases.items())))
    return rows.withColumns({"n_words": F.regexp_count("text", F.lit(WORD)).cast("bigint"), "places": at}).drop("found")


def global_order(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(word, rank) of the templates' words over all texts, rarest first; words of equal frequency by name."""
    known = F.array(*map(F.lit, vocabulary))
    seen = rows.select(F.explode(F.array_intersect(F.split(lowered(F.col("text")), GAP), known)).alias("word"))
    every = rows.sparkSession.createDataFrame([(w,) for w in vocabulary], "word string")
    counted = every.join(seen.groupBy("word").agg(F.count("*").alias("n")), "word", "left")
    # As many rows as the templates have words, whatever the texts.
    return counted.orderBy(F.coalesce("n", F.lit(0)), "word").select("word")


def template_matches(rows: DataFrame, templates: dict[str, str], share: float) -> DataFrame:
    """(id, hash, label, share of the template found) for every block of ``rows`` (id, hash, text) that matches."""
    sets = {label: template_words(text) for label, text in templates.items()}
    vocabulary = sorted({w for ws in sets.values() for w in ws})
    rank = {r.word: i for i, r in enumerate(global_order(rows, vocabulary).collect())}
    prefixes, least = [], min(ceil(share * len(ws)) for ws in sets.values())
    for label, ws in sorted(sets.items()):
        ws, need = sorted(ws, key=rank.get), ceil(share * len(ws))
        prefixes += [(ws[i], i, len(ws), need, label, ws) for i in range(len(ws) - need + 1)]
    # One row per prefix word of a template: its size does not depend on the texts.
    prefix = rows.sparkSession.createDataFrame(
        prefixes, "word string, at_t int, size_t int, need int, label string, template array<string>")
    known = F.array(*map(F.lit, sorted(vocabulary, key=rank.get)))
    rare = F.array(*map(F.lit, sorted({p[0] for p in prefixes}, key=rank.get)))
    likely = "(?i)(?:" + "|".join(sorted({re.escape(p[0]) for p in prefixes})) + ")"
    lines = rows.where(F.col("text").rlike(likely)).select("id", "hash", F.explode(F.split("text", "\n")).alias("line"))
    blocks = lines.where(F.col("line").rlike(likely))
    # array_intersect keeps the order of its first argument: the global one.
    blocks = blocks.select("id", "hash", F.array_intersect(known, F.split(lowered(F.col("line")), GAP)).alias("block"))
    blocks = blocks.where((F.size("block") >= least) & F.arrays_overlap("block", rare))
    met = blocks.select("id", "hash", "block", F.posexplode("block").alias("at_b", "word")).join(F.broadcast(prefix), "word")
    left = F.least(F.size("block") - F.col("at_b"), F.col("size_t") - F.col("at_t"))
    met = met.where((F.size("block") >= F.col("need")) & (F.col("at_t") + left >= F.col("need")))
    overlap = F.size(F.array_intersect("template", "block"))
    return met.where(overlap >= F.col("need")).select(
        "id", "hash", "label", (overlap / F.col("size_t")).alias("share"),
    )


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES, share: float = SHARE,
) -> DataFrame:
    """id, n_words, places (label, at) of phrases, and matches (label, share) of templates, of every row."""
    rows = pick(docs, doc_id, text).toDF("id", "text").withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    best = template_matches(rows, templates, share).groupBy("id", "hash", "label").agg(F.max("share").alias("share"))
    matches = best.groupBy("id", "hash").agg(F.array_sort(F.collect_list(F.struct("label", "share"))).alias("matches"))
    matches = matches.toDF("id_", "hash_", "matches")
    found = phrase_places(rows, phrases).drop("text")
    joined = found.join(matches, F.col("id").eqNullSafe(F.col("id_")) & (F.col("hash") == F.col("hash_")), "left")
    none = F.array().cast("array<struct<label:string,share:double>>")
    return joined.select(F.col("id").alias(doc_id), "n_words", "places", F.coalesce("matches", none).alias("matches"))


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    at = F.transform("places", lambda p: p["at"])
    base = F.transform("places", lambda p: p["label"])
    joined = lambda labels: F.concat_ws(",", F.array_sort(F.array_distinct(labels)))
    best = F.array_max(F.transform("matches", lambda m: m["share"]))
    return found.select(
        doc_id, "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, F.transform("matches", lambda m: m["label"]))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )
