"""An order book read as postings: one order is one bronze-shaped posting.

Lets every plan of the package run on TPC-H-like tables. Each group of columns
costs a join, so callers name the groups they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from demandlens.operators.paths import conform
from demandlens.rules import Roles, Term
from demandlens.schema import BRONZE, TEXT_ID

# --- Fixed values of this feed ----------------------------------------------
ROLES = Roles(
    rules=(
        ("role_a", ("widget", "bolt")),
        ("role_b", ("gear", "red ")),
        ("role_c", ("ring",)),
    ),
    labels=(("role_a", "Role A"), ("role_b", "Role B"), ("role_c", "Role C")),
)
TERMS = (
    Term("Apache License, Version 2.0", "Apache License, Version 2.0", "Apache Software Foundation"),
    Term("MIT License", "MIT License", "MIT"),
    Term("GNU General Public License, version 3", "GNU General Public License, version 3",
         "Free Software Foundation"),
    Term("CC BY-NC 4.0", "CC BY-NC 4.0", "Creative Commons"),
)
CONTINENT_CODES = {"AFRICA": "AF", "ASIA": "AS", "EUROPE": "EU"}
# --- End of fixed values ----------------------------------------------------

OWNER, TAGS, TEXT = "owner", "tags", "text"
EVERYTHING = (OWNER, TAGS, TEXT)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and tag sets per order. The sets are bounded by the number of brands and types."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    joined = line.join(part, line.l_partkey == part.p_partkey)
    return joined.groupBy("l_orderkey").agg(
        F.min_by("p_name", F.struct("l_linenumber", "l_partkey")).alias("job_title"),
        F.sort_array(F.collect_set(F.lower("p_brand"))).alias("technology_slugs"),
        F.sort_array(F.collect_set(F.lower("p_type"))).alias("keyword_slugs"),
    )


def postings(spark: SparkSession, sf_dir: str, groups: tuple[str, ...] = EVERYTHING) -> DataFrame:
    """Bronze-shaped rows; columns of groups that are not asked for are NULL.

    The join on the order key comes last, so that its partitioning serves the
    per-posting steps that follow. With ``TEXT_ID`` in place of ``TEXT`` each row has
    one more column that names its text, for ``with_texts``.
    """
    key, owner = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, sf_dir, "orders")
    columns = {
        "job_id": key,
        "date_posted": F.to_date("o_orderdate"),
        "discovered_at": F.col("o_orderdate").cast("timestamp"),
        "closed_at": F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate").cast("timestamp")),
        "seniority": F.col("o_orderpriority"),
        "min_annual_salary_usd": F.col("o_totalprice") * 0.8,
        "max_annual_salary_usd": F.col("o_totalprice") * 1.2,
        "avg_annual_salary_usd": F.col("o_totalprice"),
        "remote": key % 2 == 0,
        "hybrid": key % 5 == 0,
        "url": F.concat(F.lit("https://jobs.example/"), key.cast("string")),
        "_raw_ingested_at": F.col("o_orderdate").cast("timestamp"),
        "_bronze_processed_at": F.col("o_orderdate").cast("timestamp"),
        "_source": F.lit("order_feed"),
        "_row_hash": F.xxhash64("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"),
    }
    shape = BRONZE
    if TEXT in groups or TEXT_ID in groups:
        documents = table(spark, sf_dir, "documents").select("doc_id", "text")
        text_id = key % documents.agg(F.count("*").alias("n")).scalar()
        if TEXT in groups:
            rows = rows.join(documents, F.col("doc_id") == text_id, "left")
            columns |= {"description": F.col("text")}
        if TEXT_ID in groups:
            columns |= {TEXT_ID: text_id}
            shape = StructType([*BRONZE.fields, StructField(TEXT_ID, LongType())])
    if OWNER in groups:
        # Lookups one after another on the order rows: Spark knows each table's
        # size and picks broadcast or shuffle per lookup.
        for name, columns_read, left, right in (
            ("customer", ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), "o_custkey", "c_custkey"),
            ("nation", ("n_nationkey", "n_name", "n_regionkey"), "c_nationkey", "n_nationkey"),
            ("region", ("r_regionkey", "r_name"), "n_regionkey", "r_regionkey"),
        ):
            side = table(spark, sf_dir, name).select(*columns_read)
            rows = rows.join(side, F.col(left) == F.col(right), "left")
        columns |= {
            "co_id": F.when(owner % 11 != 0, F.col("c_custkey").cast("string")),
            "co_name": F.col("c_name"),
            "co_domain": F.concat(F.lower("c_name"), F.lit(".example")),
            "co_industry": F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")),
            "location": F.col("n_name"),
            "country": F.col("n_name"),
            "loc_id": F.when(owner % 13 != 0, F.col("n_nationkey").cast("long")),
            "loc_continent": F.col("r_name"),
        }
    if TAGS in groups:
        rows = rows.join(order_tags(spark, sf_dir), key == F.col("l_orderkey"), "left")
        title = F.col("job_title")
        columns |= {
            "job_title": title,
            "normalized_title": F.when(key % 7 == 0, None).when(key % 3 == 0, "  ").otherwise(title),
            "technology_slugs": F.col("technology_slugs"),
            "keyword_slugs": F.col("keyword_slugs"),
        }
    return conform(rows.select(*[c.alias(n) for n, c in columns.items()]), shape)


def with_texts(rows: DataFrame, sf_dir: str) -> DataFrame:
    """``rows`` with the texts that their ``TEXT_ID`` names as ``description``; NULL where there is none.

    Meant as the last step of a plan: narrow rows meet the documents, and no later shuffle or sort carries the texts.
    Of several documents with one id the smallest text counts, so rows never multiply.
    """
    documents = table(rows.sparkSession, sf_dir, "documents")
    texts = documents.groupBy("doc_id").agg(F.min("text").alias("_text")).withColumnRenamed("doc_id", TEXT_ID)
    kept = [c for c in dict.fromkeys([*rows.columns, "description"]) if c != TEXT_ID]
    return rows.join(texts, TEXT_ID, "left").select(*[
        F.col("_text").alias(c) if c == "description" else F.col(c) for c in kept
    ])
