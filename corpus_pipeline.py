"""Documents to training tokens, in five stages; each calls one operator of ``demandlens.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of ``docs``.
Null and empty texts go in the first stage, which finds no letter in them; a null id is kept like any other
and is never the smallest of a group; equal rows count once from the third stage on; an empty table gives an
empty one. Further columns may have any names. Names that differ in case only (``LANG`` beside ``lang``) are
told apart; Spark reads and writes such Parquet files only with spark.sql.caseSensitive.
"""

from __future__ import annotations

import uuid
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm import bpe, langid, line_index, simhash, wu_manber
from demandlens.llm.rows import shared_folder

#: Columns that stages read by name.
KNOWN = ("doc_id", "text", "lang", "n_chars")


def any_columns(stage):
    """The stage with further columns named by position meanwhile, so that they cannot clash with results."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inside = docs.toDF(*(c if c in KNOWN else f"column{i}" for i, c in enumerate(docs.columns)))
        return stage(spark, inside, sf_dir).toDF(*docs.columns)

    return run


@any_columns
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or far from every language, go. Learns from the languages given."""
    found = langid.identify(docs, langid.fit(docs), tuple(docs.columns))
    return found.where("not rejected").select(*docs.columns)


@any_columns
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A line that stands in several documents stays in the first one only."""
    found = line_index.dedup_lines(docs, tuple(docs.columns))
    made = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return found.select(*(made[c].alias(c) if c in made else F.col(c) for c in docs.columns))


@any_columns
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group of SimHash fingerprints, over three-word shingles, that 3 differing bits or fewer connect."""
    return simhash.one_of_each(docs, size=simhash.SHINGLE, bound=simhash.BOUND)


@any_columns
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = wu_manber.decontaminate(docs, items, tuple(docs.columns))
    return found.where(F.size("spans") == 0).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and digests of ids and decoded text."""
    return bpe.bpe(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark),
    ("tokens", tokens),
]

#: XXH64 and the fitted language model have no SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; results between stages lie in the folder of spark.checkpoint.dir."""
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{number}-{name}")
        docs = spark.read.parquet(f"{base}/{number}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
