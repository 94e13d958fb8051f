"""Edges and degrees of the tag graph and of the user-item graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfscout.session import spill, task_count

# Tokens of a set that are paired at a time.
CHUNK = 128


def cooccurrence(tokens: DataFrame, key: str = "item_id", token: str = "token", min_weight: int = 1) -> DataFrame:
    """``(token_a, token_b, weight)``, token_a before token_b: the number of keys that hold both, at least ``min_weight``.

    Keys with one set of tokens are collapsed and weigh as many as they are. A set is cut into chunks of tokens, and
    each pair of chunks is a row of its own, so that a key with very many tokens is spread over the tasks; the pairs of a
    chunk pair are made within a task and added up there before they are shuffled. NULL keys and tokens take no part.
    """
    held = tokens.where(F.col(key).isNotNull() & F.col(token).isNotNull()).select(F.col(key).alias("_k"), F.col(token).alias("_t"))
    sets = held.groupBy("_k").agg(F.array_sort(F.collect_set("_t")).alias("_s")).where(F.size("_s") > 1)
    sets = spill(sets.groupBy("_s").agg(F.count("*").alias("_n")), "token-sets")
    starts = lambda at: F.sequence(at, F.size("_s"), F.lit(CHUNK))
    cut = sets.select("_s", "_n", F.explode(starts(F.lit(1))).alias("_i")).select("_s", "_n", "_i", F.explode(starts(F.col("_i"))).alias("_j"))
    chunks = cut.select("_n", F.slice("_s", F.col("_i"), CHUNK).alias("_a"), F.slice("_s", F.col("_j"), CHUNK).alias("_b"))
    # Few rows stand for many pairs.
    spread = chunks.repartition(task_count(tokens.sparkSession))
    pairs = spread.select("_n", "_b", F.explode("_a").alias("token_a")).select("_n", "token_a", F.explode("_b").alias("token_b"))
    edges = pairs.where("token_a < token_b").groupBy("token_a", "token_b").agg(F.sum("_n").alias("weight"))
    return edges.where(F.col("weight") >= min_weight)


def weighted_degree(edges: DataFrame) -> DataFrame:
    """``(token, degree, weighted_degree)`` of an undirected edge list."""
    ends = edges.select(F.explode(F.array("token_a", "token_b")).alias("token"), "weight")
    return ends.groupBy("token").agg(F.count("*").alias("degree"), F.sum("weight").alias("weighted_degree"))


def bipartite_degrees(pairs: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """``(side, degree, n_nodes)``: how many users and items have each degree in the graph of the distinct pairs."""
    found = None
    for side, column in (("user", user), ("item", item)):
        degrees = pairs.groupBy(column).agg(F.count("*").alias("degree"))
        part = degrees.groupBy("degree").agg(F.count("*").alias("n_nodes")).select(F.lit(side).alias("side"), "degree", "n_nodes")
        found = part if found is None else found.unionByName(part)
    return found
