"""Whole stages on small tables, and the shape of the plans that must hold at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfscout.operators import interactions as inter, reviews, scoring
from shelfscout.plans.eda import run_eda
from shelfscout.plans.features import run_features
from shelfscout.plans.recommend import run_recommendation
from shelfscout.plans.segments import run_segments
from shelfscout.queries import QUERIES
from shelfscout.sources import store, tables


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_stage(spark, folder, tmp_path):
    done = run_features(
        spark, tables.catalog(spark, folder), tables.interactions(spark, folder), str(tmp_path), "2024-06-01",
        numeric_columns=["price", "size", "reviews_count"], text_columns=["name", "short_description"],
        include_review_aggregates=True, svd_components=10,
    )
    metrics = {(r["config"], r["metric"]): r["value"] for r in done.metrics.collect()}
    assert metrics["pca_numeric", "cumulative_3"] == pytest.approx(1.0)
    assert metrics["pca_numeric", "relative_error"] < 1e-6
    assert 0 < metrics["svd_text", "relative_error"] < 1
    assert metrics["numeric", "n_rows"] == done.numeric.count() == done.text_vectors.count()
    assert store.read_projection(spark, f"{tmp_path}/model_svd").loadings.shape[1] == 10
    assert store.read_metrics(spark, f"{tmp_path}/metrics").count() == done.metrics.count()


def test_segment_stage(spark, folder, tmp_path):
    done = run_segments(
        spark, tables.catalog(spark, folder), str(tmp_path), numeric_columns=["price", "size"], min_freq=5, components=4, n_init=2
    )
    metrics = {(r["config"], r["metric"]): r["value"] for r in done.metrics.collect()}
    n = tables.catalog(spark, folder).count()
    assert sum(v for (c, m), v in metrics.items() if c.startswith("final_cluster") and m == "size") == n
    assert all(metrics[f"lloyd_seed={s}", "descent_ok"] == 1 for s in range(1, 6))
    assert metrics["K=10", "inertia"] <= metrics["K=4", "inertia"]
    assert metrics["ari", "n_pairs"] == 10 and metrics["ari", "min_ari"] <= metrics["ari", "mean_ari"] <= 1
    assert done.profiles.groupBy("cluster").count().agg(F.max("count")).first()[0] <= 5


def test_recommendation_stage(spark, folder, tmp_path):
    done = run_recommendation(
        spark, tables.interactions(spark, folder), tables.catalog(spark, folder), str(tmp_path),
        popularity_column=None, sizes=[3, 4], epochs=3, components=5,
    )
    rows = {(r["system"], r["config"]): r for r in done.comparison.collect()}
    assert {s for s, _ in rows} == {"popularity", "content", "mf", "hybrid"} and len(rows) == 9
    assert all(r["hr_5"] <= r["hr_10"] <= r["hr_20"] for r in rows.values())
    assert done.best_k in (3, 4) and done.losses == sorted(done.losses, reverse=True)
    pairs = inter.interaction_universe(tables.interactions(spark, folder), tables.catalog(spark, folder))
    train = inter.train_pairs(pairs, inter.hold_out(pairs, 42))
    assert done.top_n.join(train, ["user_id", "item_id"]).isEmpty()
    assert done.top_n.agg(F.max("rank")).first()[0] == 10
    assert done.examples.count() <= 10


def test_eda_tables(spark, folder):
    enriched = reviews.enrich(tables.interactions(spark, folder), tables.catalog(spark, folder), "item_id", ["name", "genres", "tags"])
    found = run_eda(enriched)
    total = enriched.count()
    assert found["votes"].agg(F.sum("n")).first()[0] == total
    assert found["playtime"].agg(F.sum("n")).first()[0] == total
    sizes = [r["n"] for r in found["top_items"].collect()]
    assert sizes == sorted(sizes) and len(sizes) <= 15


def test_scans_are_pruned_and_filters_pushed(spark, folder):
    plan = plan_of(QUERIES["positive_interactions"](spark, folder))
    assert "l_extendedprice" not in plan and "PushedFilters" in plan
    assert "Not(EqualTo(l_returnflag,R))" in plan


def test_top_k_is_cut_before_the_shuffle(spark, folder):
    assert plan_of(QUERIES["topk_per_user"](spark, folder)).count("WindowGroupLimit") == 2


def test_no_query_plans_a_product_of_rows(spark, folder):
    for name in ("popularity_hr", "holdout_split", "content_hr", "item_review_aggregates", "heldout_rank"):
        plan = plan_of(QUERIES[name](spark, folder))
        assert "CartesianProduct" not in plan, name


@pytest.fixture
def small_partitions(spark):
    """Thresholds of a small machine, so that a hot key shows up in a small table."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_user_is_split_and_results_stay(spark, small_partitions):
    """User 0 owns a third of all pairs; the join by user reads that partition in pieces."""
    pairs = spark.range(0, 60000, 1, 8).selectExpr("if(id % 3 = 0, 0, id % 5000 + 1) as user_id", "id as item_id")
    held = inter.hold_out(pairs, 42)
    train = inter.train_pairs(pairs, held)
    assert train.count() == 60000 - held.count()
    collected = train.groupBy().agg(F.count("*"))
    collected.collect()
    assert "skewed" in plan_of(collected)


def test_hot_item_ranks(spark, small_partitions):
    """Item 0 is in the history of everyone."""
    pairs = spark.range(0, 3000).selectExpr("id % 1000 as user_id", "if(id < 1000, 0, id % 97 + 1) as item_id").distinct()
    held = inter.hold_out(pairs, 1)
    train = inter.train_pairs(pairs, held)
    counts = pairs.groupBy("item_id").agg(F.count("*").cast("double").alias("score"))
    fast = scoring.popularity_ranks(counts, train, held)
    table = pairs.select("user_id").distinct().crossJoin(counts)
    slow = scoring.heldout_ranks_of_scores(table, train, held)
    both = fast.join(slow.withColumnRenamed("rank", "slow"), ["user_id", "item_id"])
    assert both.count() == held.count() and both.where("rank <> slow").isEmpty()
