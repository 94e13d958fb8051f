"""Invariants of the fitted models."""

from __future__ import annotations

import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfscout.operators import clustering, factorization, labels, reduction, text
from shelfscout.operators.clustering import KMeansSpec


def dense(spark, x, key="id"):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], f"{key} long, vec array<double>").repartition(3)


def sparse(spark, x):
    rows = [(i, np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist()) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, indices array<int>, values array<double>").repartition(3)


def test_pca_equals_numpy(spark):
    x = np.random.default_rng(0).normal(size=(60, 5)) @ np.diag([5, 3, 2, 1, 0.5]) + 3
    rows = dense(spark, x)
    model = reduction.fit_pca(rows, 5, 5)
    centred = x - x.mean(axis=0)
    s = np.linalg.svd(centred, compute_uv=False)
    assert model.variance_ratio == pytest.approx(s**2 / (s**2).sum())
    assert model.loadings.T @ model.loadings == pytest.approx(np.eye(5), abs=1e-9)
    assert model.singular_values == pytest.approx(s)
    z = np.array([r["vec"] for r in reduction.project(rows, "id", model).orderBy("id").collect()])
    assert z == pytest.approx(centred @ model.loadings)
    two = model.first(2)
    err = reduction.reconstruction_error(rows, reduction.project(rows, "id", two), two).first()
    assert err["frobenius_error"] == pytest.approx(np.sqrt((s[2:] ** 2).sum()))


@pytest.mark.parametrize("form", [dense, sparse])
def test_svd_equals_numpy(spark, form):
    rng = np.random.default_rng(1)
    x = rng.random((50, 20)) * (rng.random((50, 20)) < 0.4)
    x[7] = 0
    rows = form(spark, x)
    model = reduction.fit_svd(rows, 20, 6, passes=30)
    s = np.linalg.svd(x, compute_uv=False)
    assert model.singular_values == pytest.approx(s[:6], rel=1e-5)
    assert model.loadings.T @ model.loadings == pytest.approx(np.eye(6), abs=1e-9)
    projected = reduction.project(rows, "id", model)
    err = reduction.reconstruction_error(rows, projected, model).first()
    assert err["relative_error"] == pytest.approx(np.sqrt((s[6:] ** 2).sum() / (s**2).sum()), rel=1e-4)
    if form is sparse:
        full = reduction.svd_variance(rows, projected, model)
        want = (x @ model.loadings).var(axis=0) / x.var(axis=0).sum()
        assert full.variance_ratio == pytest.approx(want)
        assert full.variance_ratio.sum() <= 1 + 1e-9


def test_svd_needs_two_columns(spark):
    with pytest.raises(ValueError):
        reduction.fit_svd(dense(spark, np.ones((5, 1))), 1, 1)


def test_share_not_reached_is_null(spark):
    cumulated = reduction.cumulative(reduction.spectrum(spark, [0.3, 0.3, 0.3]))
    got = {r["target"]: r["components"] for r in reduction.components_for_share(cumulated, [0.5, 0.95]).collect()}
    assert got == {0.5: 2, 0.95: None}


def test_singular_shares():
    model = reduction.Projection(np.eye(2), np.zeros(2), np.array([2.0, 1.0]), np.empty(0))
    assert reduction.singular_shares(model) == pytest.approx([0.8, 0.2])


def test_lloyd_example(spark):
    points = dense(spark, np.array([[0.0], [1.0], [10.0]]))
    start = np.array([[0.0], [10.0]])
    assert clustering.cluster_sse(clustering.assign_nearest(points, "id", start)).first()["sse"] == 1.0
    centres, sizes, before = clustering.cluster_means(points, start)
    assert (centres.ravel().tolist(), sizes.tolist(), before) == ([0.5, 10.0], [2.0, 1.0], 1.0)
    assert clustering.cluster_sse(clustering.assign_nearest(points, "id", centres)).first()["sse"] == 0.5


def test_empty_cluster_keeps_its_centre(spark):
    centres, _, _ = clustering.cluster_means(dense(spark, np.array([[0.0], [1.0]])), np.array([[0.0], [50.0]]))
    assert centres.ravel().tolist() == [0.5, 50.0]


def test_ties_take_the_lowest_cluster(spark):
    got = clustering.assign_nearest(dense(spark, np.array([[1.0]])), "id", np.array([[0.0], [2.0]])).first()
    assert got["cluster"] == 0


def test_wide_sums_do_not_depend_on_partitions(spark):
    x = np.random.default_rng(3).random((90, 300))
    points = dense(spark, x)
    found = [clustering._step(points.repartition(n), [x[:4]])[0] for n in (1, 3, 7)]
    grid = clustering._snapped(x)
    nearest = clustering._distances(grid, grid[:4]).argmin(axis=1)
    for centres, sizes, _ in found:
        assert sizes.tolist() == np.bincount(nearest, minlength=4).tolist()
        for c in range(4):
            assert (centres[c] == grid[nearest == c].sum(axis=0) / sizes[c]).all()


def test_kmeans_finds_clear_groups(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.05, (40, 3)) for c in (0, 2, 5)])
    points = dense(spark, x)
    three, one = clustering.fit_kmeans(points, "id", [KMeansSpec("3", 3, 1, 4), KMeansSpec("1", 1, 1, 1)], 3)
    assert sorted(three.sizes.tolist()) == [40, 40, 40]
    assert one.inertia == pytest.approx(((x - x.mean(0)) ** 2).sum(), rel=1e-4) and three.inertia < one.inertia
    again = clustering.fit_kmeans(points.repartition(7), "id", [KMeansSpec("3", 3, 1, 4)], 3)[0]
    assert (again.centres == three.centres).all() and again.inertia == pytest.approx(three.inertia)


def test_step_of_many_runs_works_in_strips():
    """Same sums as from all distances at once, but only a strip of them is held, however many rows come."""
    rng = np.random.default_rng(5)
    points = rng.integers(-3, 4, (40_000, 8)).astype(float)
    starts = np.arange(0, 121, 6)
    centres = points[rng.choice(len(points), 120)]
    met = clustering._Met(centres, starts)
    tracemalloc.start()
    met.meet(points)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 0.25 * 8 * len(points) * len(centres)
    for lo in range(0, 120, 6):
        d2 = ((points[:, None, :] - centres[None, lo : lo + 6, :]) ** 2).sum(axis=2)
        nearest = d2.argmin(axis=1)
        assert met.sizes[lo : lo + 6].tolist() == np.bincount(nearest, minlength=6).tolist()
        assert met.sse[lo : lo + 6].sum() == d2.min(axis=1).sum()
        assert all((met.sums[lo + c] == points[nearest == c].sum(axis=0)).all() for c in range(6))


def test_gram_product_takes_few_jobs(spark):
    """The partial tables are added up by all tasks at once, not in a job for each shuffle partition."""
    matrix = np.random.default_rng(6).integers(0, 3, (60, 20)).astype(float)
    rows = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(matrix)], "id long, vec array<double>").repartition(3, "id")
    basis = np.eye(20)[:, :4]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.sparkContext.setJobGroup("gram", "gram")
    try:
        product = reduction._gram_product(rows, basis, "vec")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("gram")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (product == matrix.T @ matrix @ basis).all()
    assert len(jobs) < 16


def test_kmeans_same_on_sparse_rows(spark):
    x = (np.random.default_rng(4).random((60, 12)) < 0.3).astype(float)
    a = clustering.fit_kmeans(dense(spark, x), "id", [KMeansSpec("", 3, 5, 3)], 12)[0]
    b = clustering.fit_kmeans(sparse(spark, x), "id", [KMeansSpec("", 3, 5, 3)], 12)[0]
    assert (a.centres == b.centres).all()


@pytest.mark.parametrize("form", [dense, sparse])
def test_silhouette_example(spark, form):
    points = form(spark, np.array([[0.0], [1.0], [10.0], [11.0]]))
    marks = spark.createDataFrame([(0, 0), (1, 0), (2, 1), (3, 1)], "id long, cluster int")
    got = clustering.silhouette_sampled(points, marks, "id", 1).first()
    assert got["silhouette"] == pytest.approx(0.8997, abs=1e-4) and got["n"] == 4


def test_silhouette_in_blocks(spark, monkeypatch):
    x = np.random.default_rng(6).normal(size=(50, 4))
    marks = spark.createDataFrame([(i, i % 3 if i else 9) for i in range(50)], "id long, cluster int")
    whole = clustering.silhouette_sampled(dense(spark, x), marks, "id", 4).first()["silhouette"]
    monkeypatch.setattr(clustering, "SAMPLE_BLOCK", 7)
    assert clustering.silhouette_sampled(dense(spark, x), marks, "id", 4).first()["silhouette"] == pytest.approx(whole)
    assert clustering.silhouette_sampled(dense(spark, x), marks, "id", 4, size=20).first()["n"] == 20


@pytest.mark.parametrize("other,want", [((1, 1, 0, 0), 1.0), ((0, 1, 0, 1), -0.5), ((0, 0, 1, 1), 1.0)])
def test_adjusted_rand(spark, other, want):
    df = spark.createDataFrame(list(zip((0, 0, 1, 1), other)), "a int, b int")
    assert clustering.adjusted_rand(df, "a", "b").first()["ari"] == pytest.approx(want)


def test_trivial_labelings_agree(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "a int, b int")
    assert clustering.adjusted_rand(df, "a", "b").first()["ari"] == 1.0


def test_stability(spark):
    x = np.concatenate([np.random.default_rng(2).normal(c, 0.05, (30, 2)) for c in (0, 2)])
    scores = clustering.stability(dense(spark, x), "id", 2, [0, 1, 2], 2, n_init=2)
    assert {r["ari"] for r in scores.collect()} == {1.0} and scores.count() == 3


def test_lift_example(spark):
    marks = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1)], "id long, cluster int")
    cells = spark.createDataFrame([(1, "t"), (2, "t"), (3, "u"), (1, "u")], "id long, token string")
    rows = clustering.cluster_profiles(marks, cells, "id").collect()
    got = {(r["cluster"], r["token"]): (r["lift"], r["rank"]) for r in rows}
    assert got == {(0, "t"): (2.0, 1), (0, "u"): (1.0, 2), (1, "u"): (1.0, 1)}
    assert clustering.cluster_profiles(marks, cells, "id", min_support=0.6).count() == 1


def test_idf_and_unit_rows(spark):
    docs = spark.createDataFrame([(1, "aa bb"), (2, "bb"), (3, "")], "id long, text string")
    weights, vocab = text.text_block(docs, "id", min_df=1, max_df=1.0)
    assert {r["token"]: (r["df"], r["idx"]) for r in vocab.collect()} == {"aa": (1, 0), "aa bb": (1, 1), "bb": (2, 2)}
    got = {(r["id"], r["token"]): r["weight"] for r in weights.collect()}
    one, two = math.log(4 / 2) + 1, math.log(4 / 3) + 1
    length = math.sqrt(2 * one**2 + two**2)
    assert got[1, "aa"] == pytest.approx(one / length) and got[1, "bb"] == pytest.approx(two / length)
    assert got[2, "bb"] == pytest.approx(1.0) and one == pytest.approx(1.6931, abs=1e-4)


def test_terms_of_repeated_and_missing_keys(spark):
    """Texts of one key, a missing one included, are one document; no bigram reaches across two texts."""
    rows = [(1, "aa bb aa"), (1, "bb aa"), (2, "Aa, bb"), (None, "cc cc"), (None, "cc"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "id long, text string")
    got = {(r["id"], r["token"]): r["tf"] for r in text.term_counts(docs, "id").collect()}
    assert got == {
        (1, "aa"): 3, (1, "bb"): 2, (1, "aa bb"): 1, (1, "bb aa"): 2, (2, "aa"): 1, (2, "bb"): 1, (2, "aa bb"): 1, (None, "cc"): 3, (None, "cc cc"): 1,
    }
    df = {r["token"]: (r["df"], r["n"]) for r in text.document_frequency(text.term_counts(docs, "id")).collect()}
    assert df["aa"] == (2, 4) and df["cc"] == (1, 3)
    weights, vocab = text.text_block(docs, "id", min_df=1, max_df=1.0, max_features=4)
    assert [r["token"] for r in vocab.orderBy("idx").collect()] == ["aa", "aa bb", "bb", "cc"]
    lengths = {r["id"]: r["l"] for r in weights.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("l")).collect()}
    assert lengths == pytest.approx({1: 1.0, 2: 1.0, None: 1.0})
    assert weights.count() == 7
    empty = text.text_block(docs.where("id = 4"), "id")
    assert empty[0].count() == empty[1].count() == 0


def test_terms_are_counted_in_bounded_partitions(spark, monkeypatch):
    """The occurrences of a partition are not gathered in an aggregate, and a partition holds a bounded amount of text."""
    docs = spark.range(400).select("id", F.concat_ws(" ", F.lit("word"), F.col("id").cast("string"), F.lit("word")).alias("text"))
    assert "HashAggregate" not in text.term_counts(docs, "id")._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(text, "MOST_BYTES", 500)
    assert text.term_counts(docs, "id").rdd.getNumPartitions() > 4
    weights, _ = text.text_block(docs, "id", min_df=1, max_df=1.0)
    assert weights.rdd.getNumPartitions() > 4 and weights.where("token = 'word'").count() == 400


def test_vocabulary_counts_occurrences(spark):
    tokens = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (3, "c")], "id long, token string")
    kept = labels.vocabulary(tokens, 2, None).orderBy("idx").collect()
    assert [(r["token"], r["n"], r["idx"]) for r in kept] == [("a", 2, 0), ("c", 2, 1)]
    assert [r["token"] for r in labels.vocabulary(tokens, 1, 2).orderBy("idx").collect()] == ["a", "c"]
    cells = labels.multi_hot(tokens, labels.vocabulary(tokens, 2, None), "id")
    assert sorted((r["id"], r["token"]) for r in cells.collect()) == [(1, "a"), (3, "c")]
    rows = labels.sparse_rows(cells, "id", keys=tokens.select("id").distinct()).collect()
    assert {r["id"]: r["indices"] for r in rows} == {1: [0], 2: [], 3: [1]}


def test_multi_hot_keeps_all_frequent_tokens(spark, tmp_path):
    """150 brands of 20 items each: none is left out for another."""
    from shelfscout.queries import QUERIES

    parts = spark.range(3000).select(
        F.col("id").alias("p_partkey"), F.lit("a b").alias("p_name"), F.concat(F.lit("Brand"), F.col("id") % 150).alias("p_brand"),
        F.lit("kind").alias("p_type"), F.lit(1).alias("p_size"), F.lit(1.0).alias("p_retailprice"),
    )
    parts.write.parquet(f"{tmp_path}/part.parquet")
    cells = QUERIES["multi_hot"](spark, str(tmp_path)).where("token LIKE 'developers__brand%'")
    assert cells.count() == 3000 and cells.select("idx").distinct().count() == 150


@pytest.fixture(scope="module")
def small_train(spark):
    rng = np.random.default_rng(8)
    pairs = {(int(u), int(i)) for u in range(60) for i in rng.choice(30, 3, replace=False)}
    pairs |= {(u, 0) for u in range(60)}
    return spark.createDataFrame(sorted(pairs), "user_id long, item_id long")


def test_factor_loss_falls(small_train):
    model = factorization.fit_factors(small_train, 4, epochs=6)
    assert len(model.losses) == 6
    assert all(b < a for a, b in zip(model.losses, model.losses[1:]))
    users = {r["user_id"]: np.array([r[f"p{j}"] for j in range(4)]) for r in model.users.collect()}
    items = {r["item_id"]: np.array([r[f"q{j}"] for j in range(4)]) for r in model.items.collect()}
    error = np.mean([(1 - users[r[0]] @ items[r[1]]) ** 2 for r in small_train.collect()])
    size = np.mean(np.square(list(users.values()))) + np.mean(np.square(list(items.values())))
    assert model.losses[-1] == pytest.approx(error + 0.01 * size)
    assert 0 < factorization.relative_decrease(model.losses) < 1


def test_one_pair_moves_as_in_plain_descent(spark):
    pairs = spark.createDataFrame([(1, 5)], "user_id long, item_id long")
    users = spark.createDataFrame([(1, 0.2, -0.1)], "user_id long, p0 double, p1 double")
    items = spark.createDataFrame([(5, 0.3, 0.4)], "item_id long, q0 double, q1 double")
    grid = factorization.build_grid(pairs, "user_id", "item_id")
    state = grid.move(grid.start(grid.users, 2, factors=users), grid.start(grid.items, 2, factors=items), 2, 0.03, 0.01)
    moved = grid.table(state, 2).first()
    p, q = np.array([0.2, -0.1]), np.array([0.3, 0.4])
    want = q + 0.03 * ((1 - p @ q) * p - 0.01 * q)
    assert [moved["q0"], moved["q1"]] == pytest.approx(want)


def test_constant_example_loss(spark):
    """Predictions .9 and 1.0 on ones: mean squared error .005."""
    pairs = spark.createDataFrame([(1, 5), (2, 5)], "user_id long, item_id long")
    users = spark.createDataFrame([(1, 0.9), (2, 1.0)], "user_id long, p0 double")
    items = spark.createDataFrame([(5, 1.0)], "item_id long, q0 double")
    grid = factorization.build_grid(pairs, "user_id", "item_id")
    seen = grid.move(grid.start(grid.users, 1, factors=users), grid.start(grid.items, 1, factors=items), 1, 0.03, 0.0)
    assert seen.error / seen.n == pytest.approx(0.005)


def test_cells_of_any_size_move_alike(spark):
    """A hot user and a hot item, small and large blocks, one slice or many, repeated pairs: the step of the dense formula."""
    rng = np.random.default_rng(4)
    pairs = [(int(u), int(i)) for u in range(40) for i in rng.choice(50, 4, replace=False)]
    pairs += [(0, i) for i in range(50)] + [(u, 7) for u in range(40)] + [(3, 3)] * 5
    train = spark.createDataFrame(pairs, "user_id long, item_id long")
    k, lr, reg = 3, 0.03, 0.01
    seen = []
    for rows, users_of_slice in ((7, 2), (1000, 256)):
        grid = factorization.build_grid(train, "user_id", "item_id", rows, users_of_slice)
        users, items = grid.start(grid.users, k), grid.start(grid.items, k)
        after = grid.move(users, items, k, lr, reg)
        tables = [
            {r[0]: np.array(r[1:]) for r in grid.table(s, k).collect()} for s in (users, items, after)
        ]
        seen.append(tables[2])
        p, q, moved = tables
        for i in q:
            met = np.array([p[u] for u, x in pairs if x == i])
            n, c = len(met), np.square(met).sum() / len(met) + reg
            step = (1 - max(1 - lr * c, 0) ** n) / (n * c)
            assert moved[i] == pytest.approx(q[i] + step * ((1 - met @ q[i]) @ met - n * reg * q[i]))
        assert after.n == len(pairs)
        assert after.error == pytest.approx(sum((1 - p[u] @ q[i]) ** 2 for u, i in pairs))
        assert after.square == pytest.approx(np.square(np.array(list(moved.values()))).mean())
    assert seen[0].keys() == seen[1].keys()
    assert all(seen[0][i] == pytest.approx(seen[1][i]) for i in seen[0])


def test_grid_does_not_grow_with_the_shuffle_partitions(spark):
    """Cells, and with them the messages of a half epoch, follow the ids; the number of tasks asked for cuts nothing smaller."""
    train = spark.range(6000).select((F.col("id") % 3000).alias("user_id"), (F.col("id") * 7 % 2000).alias("item_id"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        grid = factorization.build_grid(train, "user_id", "item_id")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    cells = spark.read.parquet(grid.cells).select("u", "i").distinct().count()
    assert cells <= grid.users.blocks * grid.items.blocks <= factorization.CELLS


def test_multi_hot_compares_cells_in_shares(spark):
    """Distinct cells in as many parts as there are tasks, however few bytes they have; a missing key is a row."""
    rows = [(i, t) for i in (*range(300), None) for t in ("a", "b", "a")]
    tokens = spark.createDataFrame(rows, "id long, token string")
    cells = labels.multi_hot(tokens, labels.vocabulary(tokens, 2, None), "id")
    assert cells.count() == cells.distinct().count() == 602
    assert cells.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_initial_spread(spark):
    ids = spark.range(4000).withColumnRenamed("id", "user_id")
    x = factorization.initial_factors(ids, "user_id", "p", 2, 42).select("p0", "p1").toPandas().to_numpy()
    assert abs(x.mean()) < 0.005 and x.std() == pytest.approx(0.1, rel=0.05)
    assert abs(np.corrcoef(x.T)[0, 1]) < 0.05


def test_sparse_products_fill_no_row(spark):
    """Products from stored values equal those of the filled-up matrix, empty and NULL rows included, in pieces of any size."""
    from shelfscout.operators import dense

    rng = np.random.default_rng(6)
    table = rng.standard_normal((30, 12)) * (rng.random((30, 12)) < 0.2)
    table[4] = 0
    cells = [np.flatnonzero(r) for r in table]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([None if i == 4 else c.tolist() for i, c in enumerate(cells)], pa.list_(pa.int32())),
         pa.array([None if i == 4 else table[i, c].tolist() for i, c in enumerate(cells)], pa.list_(pa.float64()))],
        names=["indices", "values"],
    )
    basis = rng.standard_normal((12, 3))
    for limit in (3, 20, 10_000):
        found, total = [], np.zeros((12, 3))
        old, dense.CHUNK_VALUES = dense.CHUNK_VALUES, limit
        try:
            for piece in dense.sparse_pieces(batch, 3):
                found.append(piece.times(basis))
                piece.add_transposed(found[-1], total)
        finally:
            dense.CHUNK_VALUES = old
        assert np.concatenate(found) == pytest.approx(table @ basis)
        assert total == pytest.approx(table.T @ (table @ basis))


def test_loadings_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(reduction, "BLOCK_VALUES", 40)  # several blocks
    rng = np.random.default_rng(7)
    table = rng.standard_normal((60, 25)) * (rng.random((60, 25)) < 0.3)
    rows = [(i, np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist()) for i, r in enumerate(table)]
    df = spark.createDataFrame(rows, "id long, indices array<int>, values array<double>")
    fits = [reduction.fit_svd(df.repartition(n), 25, 4, passes=30) for n in (1, 3, 7)]
    _, values, turned = np.linalg.svd(table, full_matrices=False)
    for fit in fits:
        assert fit.singular_values == pytest.approx(values[:4])
        assert np.abs(np.sum(fit.loadings * turned[:4].T, axis=0)) == pytest.approx(np.ones(4), abs=1e-4)
        assert fit.loadings == pytest.approx(fits[0].loadings, abs=1e-9)
        projected = {r["id"]: r["vec"] for r in reduction.project(df, "id", fit).collect()}
        assert np.array([projected[i] for i in range(60)]) == pytest.approx(table @ fit.loadings)
