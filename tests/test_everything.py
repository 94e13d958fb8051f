"""Raw files in the original layout through all stages."""

from __future__ import annotations

import csv

import numpy as np

from shelfscout.plans.everything import run_everything
from shelfscout.sources import store
from shelfscout.sources.schema import CATALOG_COLUMNS, NUMERIC_COLUMNS

N_ITEMS, N_USERS = 40, 50
GENRES = ["Action", "RPG", "Indie", "Puzzle"]


def write_raw(root):
    rng = np.random.default_rng(0)
    reviews = root / "reviews"
    reviews.mkdir()
    with open(root / "catalog.csv", "w", newline="") as out:
        table = csv.DictWriter(out, CATALOG_COLUMNS)
        table.writeheader()
        for n in range(N_ITEMS):
            a, b = GENRES[n % 4], GENRES[(n // 4) % 4]
            row = {c: int(rng.integers(0, 100)) for c in NUMERIC_COLUMNS}
            row |= {"AppID": 1000 + n, "name": f"Game {n}", "short_description": f'A "{a}" game,\nwith {b}', "price": "" if n == 3 else 9.99}
            row |= {"estimated_owners": "0 - 20000", "release_date": "Oct 21, 2008" if n % 2 else "2020-02-03"}
            row |= {"windows": True, "mac": n % 2 == 0, "linux": False, "genres": f"['{a}']", "categories": f"['{b}', 'Co-op']"}
            row |= {"tags": f"{{'{a}': {n}, '{b} like': 5}}", "developers": f"['Studio {n % 3}']", "supported_languages": "['English']"}
            table.writerow(row)
    number = 0
    for n in range(N_ITEMS):
        with open(reviews / f"{1000 + n}.csv", "w", newline="") as out:
            table = csv.writer(out)
            table.writerow(["recommendationid", "author_steamid", "voted_up", "author_playtime_forever"])
            for u in sorted({0, *rng.choice(N_USERS, 8, replace=False).tolist()}):
                number += 1
                table.writerow([number, 76561197960265728 + u, bool(rng.random() < 0.8), float(rng.integers(1, 500))])
    return number


def test_everything(spark, tmp_path):
    n_reviews = write_raw(tmp_path)
    done = run_everything(
        spark, str(tmp_path / "reviews"), str(tmp_path / "catalog.csv"), str(tmp_path / "out"), "2024-06-01",
        features={"min_freq": 2, "svd_components": 5, "include_review_aggregates": True},
        segments={"min_freq": 2, "components": 4, "n_init": 2},
        recommend={"sizes": [3], "epochs": 3, "components": 4},
    )
    assert done.ingested.count == n_reviews and done.ingested.quarantine.isEmpty()
    assert done.features.numeric.count() == N_ITEMS
    assert len(done.features.numeric.first()["vec"]) == 30
    metrics = {(r["config"], r["metric"]): r["value"] for r in done.features.metrics.collect()}
    assert metrics["numeric", "constant_estimated_owners"] == 1
    assert done.segments.assignments.count() == N_ITEMS
    tokens = {r["token"] for r in spark.read.parquet(f"{tmp_path}/out/clustering/cluster_profiles").collect()}
    assert tokens and not any(":" in t for t in tokens)
    rows = {r["system"] for r in done.recommendation.comparison.collect()}
    assert rows == {"popularity", "content", "mf", "hybrid"}
    assert dict(done.recommendation.top_n.dtypes)["item_id"] == "string"
    assert {"votes", "playtime", "top_genres"} <= set(done.report) and done.report["votes"].count() == 2
    assert store.read_metrics(spark, f"{tmp_path}/out/recommendation/metrics").count() > 20
