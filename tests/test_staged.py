"""Lines made in slices: the same rows, less on disk at a time."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import queries as q
from demandlens.plans.lines import COLUMNS
from demandlens.sources.parts import bucket
from demandlens.sources.staged import CLEANUP, staged

DAYS = [datetime(1999, 1 + i, 1 + i) for i in range(9)]
TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "ASIA"), (1, "EUROPE"), (2, None)]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "INDIA", 0), (1, "FRANCE", 1), (2, None, 2), (3, "PERU", None)]),
    "customer": (
        "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
        [(1, "Customer#1", 0, "MACHINERY"), (2, "Customer#2", 1, "FURNITURE"), (11, "Customer#1", 1, "BUILDING"), (13, "Customer#13", 2, None),
         (4, None, 3, "MACHINERY"), (5, "Customer#5", None, "BUILDING"), (2, "Customer#2", 1, "FURNITURE")],
    ),
    "part": (
        "p_partkey long, p_name string, p_brand string, p_type string",
        [(1, "red ring", "Brand#1", "LARGE"), (2, "hot bolt", "Brand#2", "SMALL"), (3, "blue gear", None, "SMALL"), (4, None, "Brand#1", None)],
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        [(i, (1, 2, 11, 13, 4, 5, None, 99)[i % 8], "OFP"[i % 3], 100.0 + i, DAYS[i % 9], "1-URGENT" if i % 4 else None) for i in range(40)]
        + [(3, 1, "F", 7.5, DAYS[8], "5-LOW"), (3, 1, "F", 7.5, DAYS[8], "5-LOW"), (None, 1, "O", 1.0, DAYS[4], "5-LOW"), (50, 2, None, None, None, None)],
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_linenumber int",
        [(i % 37, 1 + (i * 7) % 5, i // 37) for i in range(150)] + [(None, 1, 1), (2, None, 1), (50, 2, None), (0, 1, 0)],
    ),
    "documents": (
        "doc_id long, text string",
        [(0, "under the MIT License"), (1, "plain"), (2, None), (3, "CC BY-NC 4.0 and MIT License"), (3, "CC BY-NC 4.0 and MIT License"), (None, "x"), (5, "")],
    ),
}


@pytest.fixture
def tables(spark, tmp_path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def as_text(df):
    return sorted(str(row.asDict()) for row in df.collect())


@pytest.mark.parametrize("name", ["posting_lines", "posting_lines_star"])
def test_slices_give_the_rows_of_one_plan(spark, tables, name, monkeypatch):
    """Tags, owners and dimensions are shuffled in jobs that have ended; what is left shuffles lines and texts only."""
    whole = q.QUERIES[name](spark, tables)
    monkeypatch.setattr(q, "POSTINGS_A_SLICE", 20)
    assert q.slices(spark, tables) == 2
    sliced = q.QUERIES[name](spark, tables)
    assert sliced.columns == whole.columns
    assert [f.dataType.simpleString() for f in sliced.schema] == [f.dataType.simpleString() for f in whole.schema]
    rows = sliced.collect()
    assert sorted(str(r.asDict()) for r in rows) == as_text(whole) and len(rows) == 42
    assert any("MIT" in str(r["cert_names"]) for r in rows) and any(r["job_id"] is None for r in rows)
    plan = sliced._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "c_custkey" not in plan and plan.count("Join") == 1 and "Window" not in plan


def test_a_slice_is_chosen_before_any_shuffle(spark, tables):
    rows = q.lines(spark, tables, *[c for c in COLUMNS if c not in ("description", "cert_names")])
    plan = rows.where(bucket("job_id", 4) == 1)._jdf.queryExecution().optimizedPlan().toString()
    chosen = [line for line in plan.splitlines() if "Filter" in line and "xxhash64" in line]
    assert len(chosen) == 2 and "xxhash64(o_orderkey" in chosen[0] and "xxhash64(l_orderkey" in chosen[1], plan


def shuffled(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", files))


def test_shuffles_of_slices_are_deleted(spark):
    rows = spark.range(1000).select((F.col("id") % 100).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    counts = rows.groupBy("k", "v").count()
    set_before = spark.conf.get(CLEANUP)
    before = shuffled(spark)
    counts.write.format("noop").mode("overwrite").save()
    assert shuffled(spark) - before, "Spark itself keeps them"
    before = shuffled(spark)
    kept = staged(counts, "v", 3)
    assert not shuffled(spark) - before and spark.conf.get(CLEANUP) == set_before
    assert as_text(kept) == as_text(counts) and as_text(staged(counts)) == as_text(counts)
