"""Blocked scoring against a full score matrix."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfscout.operators import blocks, evaluation, interactions as inter, scoring

N_USERS, N_ITEMS, WIDTH = 23, 37, 5


@pytest.fixture(scope="module")
def world(spark):
    """Small integers as vectors, so that scores tie often; user 0 has seen almost every item."""
    rng = np.random.default_rng(3)
    u = rng.integers(-2, 3, (N_USERS, WIDTH)).astype(float)
    i = rng.integers(-2, 3, (N_ITEMS, WIDTH)).astype(float)
    pairs = {(a, b) for a in range(1, N_USERS) for b in rng.choice(N_ITEMS, 4, replace=False).tolist()}
    pairs |= {(0, b) for b in range(N_ITEMS - 2)}
    ids = lambda n: 100 + 7 * n
    frame = spark.createDataFrame([(int(a), ids(int(b))) for a, b in pairs], "user_id long, item_id long")
    held = inter.hold_out(frame, 42)
    train = inter.train_pairs(frame, held)
    vec = lambda rows, key, f: spark.createDataFrame(
        [(f(n), v.tolist(), (v[::-1] * 0.5).tolist()) for n, v in enumerate(rows)], f"{key} long, a array<double>, b array<double>"
    )
    return {
        "u": u, "i": i, "train": train, "held": held,
        "users": vec(u, "user_id", int), "items": vec(i, "item_id", ids), "ids": ids,
    }


def brute(world, score):
    """Ranks and masked score rows by full sort."""
    train = {(r["user_id"], r["item_id"]) for r in world["train"].collect()}
    ranks, top = {}, {}
    for r in world["held"].collect():
        user, held = r["user_id"], r["item_id"]
        order = sorted(
            ((-score[user, n], world["ids"](n)) for n in range(N_ITEMS) if (user, world["ids"](n)) not in train)
        )
        ranks[user] = [item for _, item in order].index(held) + 1
        top[user] = [item for _, item in order]
    return ranks, top


@pytest.mark.parametrize("sizes", [(1024, 4096), (4, 8), (1, 3)])
@pytest.mark.parametrize("limit", [blocks.BROADCAST_BYTES, 0])
def test_ranks_and_top_k(world, sizes, limit, monkeypatch):
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", limit)
    ready = scoring.prepare(
        world["users"], world["items"], world["train"], world["held"], ["a"], user_block=sizes[0], item_block=sizes[1]
    )
    ranks, top = brute(world, world["u"] @ world["i"].T)
    found = scoring.heldout_ranks(ready, [scoring.Blend("one")]).collect()
    assert {r["user_id"]: r["rank"] for r in found} == ranks
    best = scoring.top_k(ready, 6).toPandas().sort_values(["user_id", "rank"])
    got = best.groupby("user_id")["item_id"].apply(list).to_dict()
    assert got == {u: items[:6] for u, items in top.items()}


def test_hybrid_ends_reproduce_the_models(world):
    ready = scoring.prepare(world["users"], world["items"], world["train"], world["held"], ["a", "b"], user_block=4, item_block=8)
    ends = scoring.score_extremes(ready)
    a = world["u"] @ world["i"].T
    b = a * 0.25
    assert ends["a"] == (a.min(), a.max()) and ends["b"] == (b.min(), b.max())
    both = (*ends["a"], *ends["b"])
    found = scoring.heldout_ranks(ready, [scoring.Blend("x", 1.0, both), scoring.Blend("y", 0.0, both), scoring.Blend("z")])
    table = found.toPandas().pivot(index="user_id", columns="config", values="rank")
    assert (table["x"] == table["z"]).all() and (table["y"] == table["z"]).all()


def test_summary(world):
    ready = scoring.prepare(world["users"], world["items"], world["train"], world["held"], ["a"], user_block=4, item_block=8)
    score = world["u"] @ world["i"].T
    for r in scoring.score_summary(ready).collect():
        row = score[r["user_id"]]
        assert (r["n_items"], r["min_score"], r["max_score"], r["sum_score"]) == (N_ITEMS, row.min(), row.max(), row.sum())


def test_popularity_ranks_equal_the_full_matrix(spark, world):
    counts = np.random.default_rng(9).integers(0, 4, N_ITEMS).astype(float)
    scores = spark.createDataFrame([(world["ids"](n), float(c)) for n, c in enumerate(counts)], "item_id long, score double")
    ranks, _ = brute(world, np.tile(counts, (N_USERS, 1)))
    found = scoring.popularity_ranks(scores, world["train"], world["held"]).collect()
    assert {r["user_id"]: r["rank"] for r in found} == ranks


def test_popularity_example(spark):
    """Order a, b, c, d; train {a}; held d: 4 - 1 = 3."""
    scores = spark.createDataFrame([("a", 9.0), ("b", 5.0), ("c", 5.0), ("d", 1.0)], "item_id string, score double")
    train = spark.createDataFrame([(1, "a")], "user_id long, item_id string")
    held = spark.createDataFrame([(1, "d")], "user_id long, item_id string")
    assert scoring.popularity_ranks(scores, train, held).first()["rank"] == 3


def test_rank_of_a_score_table(spark):
    """a=3 (train), b=2, c=2, d=1; held c: rank 2, the tie goes to b."""
    scores = spark.createDataFrame([(1, "a", 3.0), (1, "b", 2.0), (1, "c", 2.0), (1, "d", 1.0), (2, "a", 1.0)], "user_id long, item_id string, score double")
    train = spark.createDataFrame([(1, "a")], "user_id long, item_id string")
    held = spark.createDataFrame([(1, "c"), (2, "zzz")], "user_id long, item_id string")
    rows = scoring.heldout_ranks_of_scores(scores, train, held).collect()
    assert [(r["user_id"], r["rank"]) for r in rows] == [(1, 2)]


def test_hit_rates(spark):
    ranks = spark.createDataFrame([(1, 3), (2, 7), (3, 20), (4, 50)], "user_id long, rank long")
    got = {r["k"]: r["hit_rate"] for r in evaluation.hit_rates(ranks).collect()}
    assert got == {5: 0.25, 10: 0.5, 20: 0.75}
    nobody = evaluation.hit_rates(ranks.where("rank < 0"))
    assert {r["hit_rate"] for r in nobody.collect()} == {0.0}


def test_hybrid_example(spark):
    df = spark.createDataFrame([(0.0, 2.0), (1.0, 4.0)], "c double, m double")
    score = scoring.hybrid_score(F.col("c"), F.col("m"), 0.3, (0.0, 1.0, 2.0, 4.0))
    assert [r[0] for r in df.select(score).collect()] == pytest.approx([0.0, 1.0], abs=1e-8)


def test_profile_counts_items_without_vector_as_zero(spark):
    train = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "user_id long, item_id long")
    vectors = spark.createDataFrame([(10, [1.0, 3.0])], "item_id long, vec array<double>")
    got = {r["user_id"]: r["profile"] for r in scoring.user_profiles(train, vectors, 2).collect()}
    assert got == {1: [0.5, 1.5], 2: [0.0, 0.0]}


def test_profile_sums_move_once_per_user(spark, monkeypatch):
    """Pairs that come by item lie by user before their vectors are put on; a repeated vector counts as often as it occurs."""
    train = spark.range(40).selectExpr("id AS item_id").crossJoin(spark.range(9).selectExpr("id AS user_id")).repartition(8, "item_id")
    vectors = spark.createDataFrame([(n, [float(n), 1.0]) for n in [*range(30), 29]], "item_id long, vec array<double>")
    written = []
    keep = scoring.spill
    monkeypatch.setattr(scoring, "spill", lambda df, *options: written.append(keep(df, *options)) or written[-1])
    sums = {r["user_id"]: (r["n"], r["sums"]) for r in scoring.vector_sums(train, vectors, "user_id", "item_id", "vec", 2).collect()}
    assert sums == {u: (41, [464.0, 31.0]) for u in range(9)}
    places = written[0].select("user_id", F.input_file_name().alias("file")).groupBy("user_id").agg(F.count_distinct("file").alias("files"))
    assert [r["files"] for r in places.collect()] == [1] * 9
    monkeypatch.setattr(scoring, "BROADCAST_BYTES", 0)
    again = scoring.vector_sums(train, vectors, "user_id", "item_id", "vec", 2)
    assert {r["user_id"]: (r["n"], r["sums"]) for r in again.collect()} == sums


def test_split_invariants(spark, folder):
    from shelfscout.queries.ranking import split

    pairs, train, held = split(spark, folder)
    users = inter.qualifying_users(pairs)
    assert held.count() == users.count()
    assert train.count() + held.count() == users.agg(F.sum("n_items")).first()[0]
    assert train.join(held, ["user_id", "item_id"]).isEmpty()


def test_histories_are_cut_but_whole(spark):
    pairs = spark.createDataFrame([(1, i) for i in range(2500)] + [(2, 5)], "user_id long, item_id long")
    rows = inter.user_histories(pairs).collect()
    assert max(len(r["items"]) for r in rows) <= 1000
    assert sum(len(r["items"]) for r in rows if r["user_id"] == 1) == 2500


def test_blocks_move_once_per_cell_not_once_per_pair(world, monkeypatch):
    """23 user blocks and 37 item blocks of one row make 851 pairs; a user block goes to each group of items only."""
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    ready = scoring.prepare(world["users"], world["items"], world["train"], world["held"], ["a"], user_block=1, item_block=1)
    rows, columns = blocks.grid(ready.n_blocks, N_ITEMS, ready.user_bytes, ready.item_bytes, 4)
    assert 4 <= rows * columns <= 8
    kinds = {r["_kind"]: r["count"] for r in ready.cells(["a"]).groupBy("_kind").count().collect()}
    assert kinds[blocks.LEFT] <= ready.n_blocks * columns and kinds[blocks.RIGHT] == N_ITEMS * rows
    assert sum(kinds.values()) < ready.n_blocks * N_ITEMS / 4


def test_a_group_of_users_is_bounded_in_bytes():
    rows, columns = blocks.grid(10_000, 3_000, 8 * blocks.HELD_BYTES, blocks.HELD_BYTES, 16)
    assert rows >= 8 and columns >= 2
    assert blocks.grid(10_000, 3_000, 800 * blocks.HELD_BYTES, blocks.HELD_BYTES, 16)[0] >= 800
    assert blocks.grid(1, 1, 0, 0, 200) == (1, 1)
