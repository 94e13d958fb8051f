from __future__ import annotations

import math
import random

import pytest

from shelfscout.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, id int"


def brute(rows, every=20, top=20):
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    asked = {(i, tuple(v)) for i, v in whole if i % every == 0}
    for qi, qv in asked:
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in whole if i != qi)[:top]
        out += [(qi, r + 1, i, max(-(2**63), min(2**63 - 1, -s))) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def run(make, rows, **options):
    df = make([(i, v, "s", 1) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in topk.top_products(df, **options).select("query_id", "rank", "vec_id", "score").collect())


def as_float(v):
    import numpy as np

    return [None if x is None else float(np.float32(x)) for x in v]


@pytest.mark.parametrize("shape", ["unit", "lengths", "clusters", "copies"])
def test_against_brute_force(make, shape):
    rng = random.Random(shape)
    rows = []
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    for i in range(400):
        if shape == "clusters":
            v = [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]
        elif shape == "copies" and i % 3:
            v = [1.0, 0.5] + [0.0] * 6
        else:
            v = [rng.gauss(0, 1) for _ in range(8)]
        if shape == "lengths":
            v = [x * rng.paretovariate(0.7) for x in v]
        rows.append((i, as_float(v)))
    assert run(make, rows, bucket_rows=37, block_rows=7) == brute(rows)


def test_odd_vectors(make):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, []), (5, [3.0]), (6, [1.0, 2.0, 5.0]),
            (7, [float("inf"), 0.0]), (None, [1.0, 1.0]), (20, [0.0, 0.0]), (40, [-1.0, -2.0]), (8, [1.0, 2.0]), (9, [1.0, 2.0])]
    assert run(make, rows, bucket_rows=3, block_rows=2) == brute(rows)


def test_repeated_query_rows_are_answered_once_and_large_values_stay_whole(make):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [as_float([1e12])[0], 1.0]), (2, [as_float([3e11])[0], -1.0]), (20, [as_float([2e11])[0], 3.0])]
    assert run(make, rows, bucket_rows=2) == brute(rows)


def test_empty(spark):
    assert topk.top_products(spark.createDataFrame([], SCHEMA)).count() == 0
    assert topk.top_products(spark.createDataFrame([(3, [1.0], "s", 1)], SCHEMA)).count() == 0
