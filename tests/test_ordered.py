"""Positions and exact quantiles, above all on groups that own most of the rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfscout.operators import numeric, ordered, sampling


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows in one group, a third of those with one value."""
    rng = np.random.default_rng(5)
    rows = [("hot", float(v)) for v in np.concatenate([rng.normal(size=2000), np.full(1000, 0.25)])]
    rows += [(f"g{i % 40}", float(v)) for i, v in enumerate(rng.integers(0, 50, 3000))]
    rows += [("single", 7.0), ("nulls", None)]
    return spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("walked_rows", [10**6, 20, 0])
def test_quantiles_equal_numpy_however_far_brackets_are_narrowed(skewed, walked_rows):
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    counts = ordered.value_counts(skewed, ["g"], "v")
    found = ordered.weighted_quantiles(counts, ["g"], "v", "weight", probabilities, walked_rows).collect()
    got = {(r["g"], r["prob"]): r["quantile"] for r in found}
    pdf = skewed.toPandas().dropna()
    want = {(g, p): np.quantile(part["v"], p) for g, part in pdf.groupby("g") for p in probabilities}
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == pytest.approx(value, abs=1e-12), key


@pytest.mark.parametrize("walked_rows", [10**6, 0])
def test_quantile_of_all_rows(spark, walked_rows):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    counts = ordered.value_counts(df, [], "v")
    rows = ordered.weighted_quantiles(counts, [], "v", "weight", [0.25, 0.5, 0.99], walked_rows).collect()
    assert sorted(r["quantile"] for r in rows) == pytest.approx([1.75, 2.5, 9.79])


@pytest.mark.parametrize("walked_rows", [10**6, 3, 0])
def test_quantiles_over_the_whole_range_of_doubles(spark, walked_rows):
    """Both ends of the range, neighbours, subnormal and infinite values, rows that repeat a value, a NULL group."""
    large, tiny = 1.7976931348623157e308, 5e-324
    values = [-float("inf"), -large, -1e300, -1.0, -tiny, 0.0, tiny, 2 * tiny, 1e-300, 1.0, np.nextafter(1.0, 2), 1e17, 1e17 + 16, large, float("inf")]
    rows = [(g, float(v), 1 + i % 3) for g in ("a", None) for i, v in enumerate(values * 2)]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    flat = sorted(v for g, v, n in rows if g for _ in range(n))
    ranks = range(0, len(flat), 3)
    probabilities = [i / (len(flat) - 1) for i in ranks]
    exact = [i for i, p in zip(ranks, probabilities) if (p * (len(flat) - 1)).is_integer()]
    found = ordered.weighted_quantiles(df, ["g"], "v", "n", probabilities, walked_rows).collect()
    for g in ("a", None):
        got = {r["prob"]: r["quantile"] for r in found if r["g"] == g}
        assert len(got) == len(probabilities)
        assert [got[i / (len(flat) - 1)] for i in exact] == [flat[i] for i in exact]


def test_narrowing_gathers_a_small_part(spark):
    """Of 200,000 distinct values only the bracket of the median is left for the walk; nothing is range-sorted."""
    df = spark.range(200_000).selectExpr("exp(id / 10000.0) AS v", "1 AS n")
    found = ordered.weighted_quantiles(df, [], "v", "n", [0.5])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert found.first()["quantile"] == pytest.approx(np.quantile(np.exp(np.arange(200_000) / 10000.0), 0.5), rel=1e-12)
    assert ordered.weighted_quantiles(df.limit(0), [], "v", "n", [0.5]).count() == 0


def test_position_is_dense_and_sorted(skewed):
    placed = ordered.with_position(skewed.where("v is not null"), ["g", "v"], "p").toPandas().sort_values("p")
    assert list(placed["p"]) == list(range(len(placed)))
    assert list(placed["g"]) == sorted(placed["g"])


def test_group_position_restarts(skewed):
    placed = ordered.with_group_position(skewed, ["g"], [F.desc("v")], "p").toPandas()
    for _, part in placed.groupby("g"):
        part = part.sort_values("p")
        assert list(part["p"]) == list(range(len(part)))
        values = part["v"].dropna().tolist()
        assert values == sorted(values, reverse=True)


def test_positions_use_many_tasks(skewed):
    """The hot group does not end in one sorted part."""
    skewed.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    held = ordered._numbered(skewed, ["g", "v"])
    skewed.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = held.where("g = 'hot'").select("_part").distinct().count()
    assert parts > 1


def test_impute_and_scale(spark):
    df = spark.createDataFrame([(1, "1", None), (2, None, None), (3, "3", None), (4, "inf", None)], "id int, a string, b string")
    stats = numeric.fit_columns(df, ["a", "b"], 0.0, 1.0)
    typed = numeric.coerced(df, ["a", "b"])
    got = {r["id"]: r["a"] for r in typed.select("id", numeric.imputed("a", stats["a"]).alias("a")).collect()}
    assert got == {1: 1.0, 2: 2.0, 3: 3.0, 4: 2.0}
    assert stats["b"].median == 0.0 and numeric.constant_columns(stats) == ["b"]
    block = numeric.numeric_block(df, "id", ["a", "b"], stats).toPandas()
    assert block["a"].mean() == pytest.approx(0) and block["a"].std(ddof=0) == pytest.approx(1)
    assert (block["b"] == 0).all()


def test_population_std(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 5.0)], "id int, a double")
    stats = numeric.fit_columns(df, ["a"], 0.0, 1.0)
    block = numeric.numeric_block(df, "id", ["a"], stats).orderBy("id").toPandas()
    assert block["a"].tolist() == pytest.approx([-1.224745, 0, 1.224745], abs=1e-6)


def test_bins(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([0, 0, 0, 0, 1, 2, 3, 10])], "id int, n double")
    assert sampling.bin_edges(df, "n") == [0.0, 0.5, 2.25, 10.0]
    rows = sampling.with_popularity_bin(df, "n").orderBy("id").collect()
    assert [r["popularity_bin"] for r in rows] == [0, 0, 0, 0, 1, 1, 2, 2]


def test_sample_size_rounds_half_to_even(spark):
    df = spark.createDataFrame([(i,) for i in range(25)], "id int")
    assert sampling.simple_sample(df, "id", 0.1, 42).count() == 2
    assert sampling.simple_sample(df, "id", 1.0, 42).count() == 25


def test_few_values_fall_back_to_plain_sample(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(30)], "id int, n double")
    plain = {r["id"] for r in sampling.simple_sample(df, "id", 0.2, 1).collect()}
    assert {r["id"] for r in sampling.popularity_sample(df, "n", "id", 0.2, 1).collect()} == plain
    with pytest.raises(ValueError):
        sampling.popularity_sample(df, "n", "id", 0.0, 1)


def test_histogram_puts_the_maximum_in_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(61)], "v double")
    bins = numeric.capped_histogram(df, "v", 60, cap=None).toPandas().set_index("bin")["n"]
    assert bins.sum() == 61 and bins.index.max() == 59 and bins[59] == 2


def test_approximate_quantiles_are_close(spark):
    df = spark.range(5000).selectExpr("cast(id as double) as v")
    near = {r["prob"]: r["quantile"] for r in ordered.approximate_quantiles(df, ["v"], [0.5, 0.9]).collect()}
    assert near == pytest.approx({0.5: 2499.5, 0.9: 4499.1}, abs=5)
