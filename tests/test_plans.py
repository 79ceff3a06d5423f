"""Numbering, ranks, checkpoints and the shape of plans."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from weftgraph.catalog import all_queries
from weftgraph.operators import text
from weftgraph.plans.materialize import ensure_checkpoint_dir
from weftgraph.plans.ordering import check_limit, global_rank, top_k_per_group, with_dense_ids
from weftgraph.plans.sizing import broadcast_if_small, fits


def plan_of(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()


def test_dense_ids_follow_the_order(spark):
    data = spark.range(5000).select((F.lit(9999) - F.col("id")).alias("k")).repartition(7)
    numbered = with_dense_ids(data, ["k"], "n", start=3)
    assert numbered.filter((F.col("k") - 5000 + 3) != F.col("n")).count() == 0
    assert numbered.count() == 5000


def test_global_rank_equals_window_rank_with_one_hot_group(spark):
    data = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.pmod(F.hash("id"), F.lit(700)).alias("score"),
    )
    expected = data.withColumn("rank", F.rank().over(Window.partitionBy("g").orderBy(F.desc("score"))).cast("long"))
    found = global_rank(data, ["g"], "score").select("id", "g", "score", "rank")
    assert found.exceptAll(expected.select("id", "g", "score", "rank")).count() == 0
    assert found.count() == 6000


def test_top_k_limits_before_the_exchange(spark):
    data = spark.range(1000).select((F.col("id") % 2).alias("g"), "id")
    plan = plan_of(top_k_per_group(data, ["g"], [F.desc("id")], 3))
    # Once before the exchange and once after it.
    assert plan[: plan.index("(1)")].count("WindowGroupLimit") == 2


@pytest.mark.parametrize("value", [0, -1, True, "3", 2.0])
def test_bad_limits(value):
    with pytest.raises(ValueError):
        check_limit(value)


def test_broadcast_only_below_the_bound(spark):
    small = spark.range(10)
    assert fits(small, 10) and not fits(small, 9)
    assert "BroadcastHashJoin" in plan_of(spark.range(10**7).join(broadcast_if_small(small, 10), "id"))


def test_checkpoint_dir_of_the_session_is_kept(spark):
    first = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == first == spark.sparkContext.getCheckpointDir()


def test_filters_and_columns_reach_the_scan(spark, small):
    plan = plan_of(all_queries()["f1_inline_properties"](spark, small))
    assert "EqualTo(p_brand,Brand#12)" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string,p_type:string>" in plan


def test_stored_text_index_is_pruned_by_term(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    index = text.build_text_index(docs, "text").write(str(tmp_path / "index"))
    term = index.vocabulary().orderBy("term").first().term
    found = index.matching(spark.createDataFrame([(term,)], "term string"))
    plan = plan_of(found.postings)
    assert "PartitionFilters: [isnotnull(part#" in plan and f"GreaterThanOrEqual(term,{term})" in plan
    assert "ReadSchema: struct<id:bigint,dl:bigint,term:string,tf:bigint>" in plan


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cross_join(spark, small, name):
    if name.startswith("u8_fact_stream"):
        pytest.skip("runs a stream")
    plan = plan_of(all_queries()[name](spark, small))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
