"""Named entities in free text: dictionary lookup, or any Python extractor.

Entities are ``array<struct<name, provider>>``. The dictionary form is a column
expression. A callable runs through ``mapInPandas`` once per distinct
text, reports failures in an ``error`` column, and its results are staged by
text hash so that later runs only see new text and earlier failures.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from demandlens.rules import Term, check_dictionary

ENTITIES = ArrayType(StructType([
    StructField("name", StringType()), StructField("provider", StringType()),
]))
CERTIFICATION_JSON = StructType([StructField("certifications", ENTITIES)])
STAGED = StructType([
    StructField("text_hash", StringType()),
    StructField("entities", ENTITIES),
    StructField("error", StringType()),
])

Extractor = Callable[[str], Any]


def text_hash(text: str | Column) -> Column:
    return F.sha2(text, 256)


def dictionary_entities(text: str | Column, terms: tuple[Term, ...]) -> Column:
    """Entities with a pattern that occurs anywhere in ``text``; empty for NULL text.

    One pass over each text whatever the number of terms, in built-in functions: one regular expression shaped as a tree
    of the patterns' characters gives the longest pattern at each place, and a constant map adds those that it begins with.
    Entities come in the order of the terms.
    """
    check_dictionary(terms)
    if not terms:
        return F.array().cast(ENTITIES)
    clean = [(t.name.strip(), t.provider and t.provider.strip()) for t in terms]
    order = {entity: i for i, entity in enumerate(dict.fromkeys(clean))}
    named: dict[str, set[int]] = {}
    for term, entity in zip(terms, clean, strict=True):
        named.setdefault(term.pattern, set()).add(order[entity])
    # What a pattern implies: the entities of all patterns that it begins with.
    implied = {p: sorted(set().union(*(named.get(p[:n], ()) for n in range(len(p) + 1)))) for p in named}
    # As JSON, each is a single constant of the plan instead of one expression per term.
    entities = F.from_json(F.lit(json.dumps([{"name": n, "provider": p} for n, p in order])), ENTITIES)
    always = F.from_json(F.lit(json.dumps(sorted(named.get("", ())))), "array<int>")
    column = F.col(text) if isinstance(text, str) else text
    found = always
    if any(implied):
        by_pattern = F.from_json(F.lit(json.dumps(implied)), "map<string, array<int>>")
        places = F.regexp_extract_all(column, F.lit(longest_at_each_place(list(implied))), F.lit(1))
        found = F.array_union(always, F.flatten(F.transform(F.array_distinct(places), lambda p: F.element_at(by_pattern, p))))
    found = F.transform(F.array_sort(found), lambda i: F.element_at(entities, i + 1))
    return F.when(column.isNull(), F.array()).otherwise(found).cast(ENTITIES)


def longest_at_each_place(patterns: list[str]) -> str:
    """A regular expression whose group 1 is the longest of ``patterns`` that begins at a place; empty ones are left out.

    A match takes at most the place's character, so a pattern that begins inside another one is found too; a class of
    first characters passes over most places at once.
    """
    tree: dict = {}
    for pattern in filter(None, patterns):
        node = tree
        for char in pattern:
            node = node.setdefault(char, {})
        node[""] = {}

    def expression(node: dict) -> str:
        chain = ""
        while len(node) == 1 and "" not in node:  # characters that leave no choice
            (char, node), = node.items()
            chain += quoted(char)
        branches = [quoted(char) + expression(below) for char, below in node.items() if char]
        if not branches:
            return chain
        either = f"(?:{'|'.join(branches)})"
        return chain + either + ("?" if "" in node else "")

    starts = f"[{''.join(map(quoted, tree))}]"
    if any(ord(char) > 0xFFFF for char in tree):  # two code units, which a class in a lookbehind does not step over
        return f"(?={starts})(?=({expression(tree)}))"
    return f"{starts}(?<=(?=({expression(tree)})){starts})"


def quoted(char: str) -> str:
    return char if char.isascii() and char.isalnum() else f"\\x{{{ord(char):x}}}"


def json_entities(text: str | Column, schema: StructType = CERTIFICATION_JSON) -> Column:
    """The single array field of a JSON document; malformed text gives an empty one."""
    field, = schema.fields
    return F.coalesce(F.from_json(text, schema)[field.name], F.array().cast(field.dataType))


def _batch_runner(extractor: Extractor):
    """The function that runs in the workers.

    Its helpers are local, so that it travels there whole and the workers need
    no copy of this package.
    """

    def parsed(answer: Any) -> Iterator[dict[str, str | None]]:
        """Entities in an answer: JSON text, its parsed form, or a list."""
        if isinstance(answer, str):
            answer = json.loads(answer)
        if isinstance(answer, dict):
            answer = answer.get("certifications") or []
        for item in answer:
            fields = {f: item.get(f) for f in ("name", "provider")}
            if fields["name"] is not None:
                yield {f: None if v is None else str(v).strip() for f, v in fields.items()}

    def one(text: str | None) -> tuple[list[dict[str, str | None]], str | None]:
        merged: dict[str, dict[str, str | None]] = {}
        try:
            for entity in parsed(extractor(text)) if text else ():
                merged.setdefault(entity["name"], entity)
        except Exception as failure:  # noqa: BLE001 - any extractor failure becomes data
            return [], f"{type(failure).__name__}: {failure}"
        return list(merged.values()), None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [one(t) for t in batch["text"]]
            yield pd.DataFrame({
                "text_hash": batch["text_hash"],
                "entities": [found for found, _ in answers],
                "error": pd.Series([error for _, error in answers], dtype=object),
            })

    return run


def extract_texts(texts: DataFrame, extractor: Extractor) -> DataFrame:
    """Run ``extractor`` on ``texts`` (``text_hash``, ``text``); one STAGED row each.

    It gets whole texts; one with an input limit splits them by itself. An exception
    or an unreadable answer gives an empty list and its message in ``error``; it
    never stops the job and never looks like "nothing found".
    """
    return texts.select("text_hash", "text").mapInPandas(_batch_runner(extractor), schema=STAGED)


def pending_texts(docs: DataFrame, text: str, staged: DataFrame | None = None) -> DataFrame:
    """Distinct texts of ``docs`` without a successful staged result.

    Copies are merged before the shuffle. Without staged results the text is part of
    the key, so that copies meet in a hash table; ``first`` of a text would sort all
    rows with their texts. With them both steps use the hash, so the anti join needs
    no exchange of its own for the texts.
    """
    texts = docs.where(F.col(text).isNotNull()).select(text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    if staged is None:
        return texts.distinct()
    done = staged.where(F.col("error").isNull()).select("text_hash")
    return texts.groupBy("text_hash").agg(F.first("text").alias("text")).join(done, "text_hash", "left_anti")


def staged_entities(docs: DataFrame, key: str, text: str, staged: DataFrame) -> DataFrame:
    """``(key, cert_name, cert_provider)`` for documents with staged results.

    Texts without entities are dropped before the join; a text shared by very
    many documents is a hot key of an inner join, which AQE splits. Of several
    successful results of a text one counts.
    """
    found = staged.where(F.col("error").isNull() & (F.size("entities") > 0))
    found = found.groupBy("text_hash").agg(F.max("entities").alias("entities"))
    return (
        docs.select(key, text_hash(text).alias("text_hash"))
        .join(found.select("text_hash", "entities"), "text_hash")
        .select(key, F.inline("entities").alias("cert_name", "cert_provider"))
    )


def inline_entities(docs: DataFrame, key: str, entities: str | Column) -> DataFrame:
    """``(key, cert_name, cert_provider)`` from an entity column; no shuffle."""
    return (
        docs.select(key, F.inline(entities).alias("cert_name", "cert_provider"))
        .where(F.col("cert_name").isNotNull())
    )
