"""Readers and sinks on files written by hand."""

from __future__ import annotations

import json

import numpy as np
import pytest

from shelfscout.operators.numeric import ColumnStats
from shelfscout.operators.reduction import Projection
from shelfscout.plans.ingest import run_ingest
from shelfscout.sources import catalog, reviews, store

HEADER = "recommendationid,author_steamid,voted_up,author_playtime_forever"


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "reviews"
    (root / "deep").mkdir(parents=True)
    (root / "10.csv").write_text(f"{HEADER}\n1,76561197960265729,True,5.0\n2,b,False,\n")
    (root / "deep" / "20.csv").write_text("note,author_playtime_forever,voted_up,author_steamid,recommendationid\n\"x, y\",7.5,true,c,3\n")
    (root / "30.csv").write_text("")
    (root / "40.csv").write_text("a,b\n1,2\n")
    (root / "50.csv").write_text(f"{HEADER}\n4,d,True,1\n5,e,True,1,extra,cells\n")
    (root / "60.csv").write_text(f"{HEADER}\n6,f,1,9\n")
    (root / "notes.txt").write_text("no review")
    meta = tmp_path / "catalog.csv"
    meta.write_text(
        'AppID,name,genres,tags,num_reviews_total,short_description\n'
        '10,One,"[\'RPG\', \'Action\']","{\'Co-op\': 3}",4,"two\nlines ""quoted"""\n'
        "20,Two,,,n/a,plain\n60,Six,['Indie'],,1,\n"
    )
    return root, meta


def test_files_are_read_by_name_and_bad_ones_left_out(spark, raw):
    scan = reviews.scan_reviews(spark, str(raw[0]))
    got = sorted((r["recommendationid"], r["author_steamid"], r["voted_up"], r["author_playtime_forever"], r["AppID"]) for r in scan.rows.collect())
    assert got == [(1, "76561197960265729", True, 5.0, "10"), (2, "b", False, None, "10"), (3, "c", True, 7.5, "20"), (6, "f", True, 9.0, "60")]
    reasons = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in scan.quarantine.collect()}
    assert reasons == {
        "30.csv": "empty file",
        "40.csv": "missing columns: recommendationid, author_steamid, voted_up, author_playtime_forever",
        "50.csv": "line with too many cells",
    }


def test_lines_only(spark, raw):
    scan = reviews.scan_reviews(spark, str(raw[0]), whole_files=False)
    assert {r["recommendationid"] for r in scan.rows.collect()} == {1, 2, 3, 4, 6}


def test_limit_takes_the_first_by_path(spark, raw):
    listed = reviews.list_review_files(spark, str(raw[0]), limit_files=2)
    assert [r["AppID"] for r in listed.orderBy("path").collect()] == ["10", "30"]
    with pytest.raises(ValueError):
        reviews.list_review_files(spark, str(raw[0]), limit_files=0)


def test_selected_items_and_no_file_left(spark, raw):
    items = spark.createDataFrame([("20",)], "AppID string")
    scan = reviews.scan_reviews(spark, str(raw[0]), items=items)
    assert [r["AppID"] for r in scan.rows.collect()] == ["20"]
    for key, message in (("30", "no review file could be read"), ("99", "no review files selected")):
        with pytest.raises(RuntimeError, match=message):
            reviews.scan_reviews(spark, str(raw[0]), items=spark.createDataFrame([(key,)], "AppID string"))


def test_line_breaks_in_cells(spark, tmp_path):
    root = tmp_path / "r"
    root.mkdir()
    (root / "1.csv").write_text(f'{HEADER},text\n1,a,True,2,"one\ntwo"\n2,b,False,3,x\n')
    scan = reviews.scan_reviews(spark, str(root), multi_line=True)
    assert sorted(r["recommendationid"] for r in scan.rows.collect()) == [1, 2]


def test_catalog_keeps_quoted_lines(spark, raw):
    rows = {r["AppID"]: r for r in catalog.scan_catalog(spark, str(raw[1])).collect()}
    assert rows["10"]["short_description"] == 'two\nlines "quoted"' and rows["20"]["genres"] is None
    pruned = catalog.scan_catalog(spark, str(raw[1]), ["AppID", "name"])
    assert pruned.columns == ["AppID", "name"]
    with pytest.raises(ValueError):
        catalog.scan_catalog(spark, str(raw[1]), ["AppID", "absent"])


def test_ingest(spark, raw, tmp_path):
    full = run_ingest(spark, str(raw[0]), str(raw[1]), str(tmp_path / "out"))
    assert full.path.endswith(store.FULL_NAME) and full.count == 4 and full.quarantine.count() == 3
    limited = run_ingest(spark, str(raw[0]), str(raw[1]), str(tmp_path / "out"), limit_files=1)
    assert limited.path.endswith(store.SAMPLE_NAME) and limited.count == 2
    found = store.scan_interactions(spark, str(tmp_path / "out"))
    assert found.count() == 4 and set(found.columns) >= {"AppID", "name", "genres", "tags", "voted_up"}
    with pytest.raises(FileNotFoundError):
        store.scan_interactions(spark, str(tmp_path / "nowhere"))


def test_models_survive_the_store(spark, tmp_path):
    model = Projection(np.random.default_rng(0).normal(size=(12, 3)), np.arange(12.0), np.array([3.0, 2, 1]), np.array([0.5, 0.3, 0.1]))
    store.write_projection(spark, model, str(tmp_path / "m"))
    again = store.read_projection(spark, str(tmp_path / "m"))
    for a, b in zip(vars(model).values(), vars(again).values()):
        assert (a == b).all()
    stats = {"a": ColumnStats(1.0, 0.0, 2.0, 1.5, 0.5)}
    store.write_column_stats(spark, stats, str(tmp_path / "s"))
    assert store.read_column_stats(spark, str(tmp_path / "s")) == stats


def test_evaluation_document(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({
        "mf_best_k": 10, "mf_loss_history": [0.9, 0.5],
        "evaluation": {
            "popularity_baseline": {"HR@5": 0.4, "HR@10": 0.5}, "content_based_baseline": {"HR@5": 0.1},
            "matrix_factorization": {"k=10": {"HR@10": 0.2}}, "hybrid": {"alpha=0.1": {"HR@10": 0.3}},
        },
    }, indent=2))
    got = {(r["system"], r["config"], r["k"]): r["hit_rate"] for r in store.flatten_evaluation(spark, str(path)).collect()}
    assert got == {
        ("popularity", "", 5): 0.4, ("popularity", "", 10): 0.5, ("content", "", 5): 0.1,
        ("mf", "k=10", 10): 0.2, ("hybrid", "alpha=0.1", 10): 0.3,
    }
    assert [(r["epoch"], r["loss"]) for r in store.flatten_losses(spark, str(path)).orderBy("epoch").collect()] == [(1, 0.9), (2, 0.5)]


def test_clustered_table_spreads_a_hot_key(spark, tmp_path):
    df = spark.range(20000).selectExpr("if(id % 3 = 0, 7, id) as item_id", "id as other")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    path = store.write_table(df, str(tmp_path / "t"), cluster_by="item_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(path)
    assert back.count() == 20000
    files = back.where("item_id = 7").selectExpr("_metadata.file_path as f").distinct().count()
    assert files > 1


def test_headers_with_quotes_and_beyond_one_read(spark, tmp_path):
    from shelfscout.sources.reviews import scan_reviews

    names = "recommendationid,author_steamid,voted_up,author_playtime_forever"
    (tmp_path / "1.csv").write_text(f'"x, y",{names}\n"k, l",9007199254740993,u2,True,7\n')
    (tmp_path / "2.csv").write_text(",".join(f"pad{i}" for i in range(12_000)) + f",{names}\n" + "," * 12_000 + "3,u3,False,1\n")
    scan = scan_reviews(spark, str(tmp_path))
    got = {r["recommendationid"]: r["author_steamid"] for r in scan.rows.collect()}
    assert got.get(9007199254740993) == "u2" and scan.quarantine.count() == 0 and len(got) == 2


def test_histogram_of_nothing(spark):
    from shelfscout.operators.numeric import capped_histogram

    assert capped_histogram(spark.createDataFrame([(None,)], "playtime double"), "playtime").count() == 0


def test_odd_names_and_long_headers(spark, tmp_path):
    wide = ",".join([HEADER, *(f"extra_{i:05d}" for i in range(9000))])
    assert len(wide) > 1 << 16
    for i, (name, header) in enumerate([("g[1]", HEADER), ("a b", HEADER), ("50%", HEADER), ("w{x}", wide), ("c+d", HEADER), ("q", f'"note, more",{HEADER}')]):
        start = '"k, l",' if name == "q" else ""
        (tmp_path / f"{name}.csv").write_text(f"{header}\n{start}{i},u{i},True,7\n")
    scan = reviews.scan_reviews(spark, str(tmp_path))
    assert {r["AppID"]: (r["recommendationid"], r["author_steamid"], r["author_playtime_forever"]) for r in scan.rows.collect()} == {
        n: (i, f"u{i}", 7.0) for i, n in enumerate(["g[1]", "a b", "50%", "w{x}", "c+d", "q"])
    }
    assert scan.quarantine.isEmpty()
    names = spark.createDataFrame([("g[1]",), ("a b",), ("50%",), ("w{x}",), ("c+d",)], "AppID string")
    assert reviews.scan_reviews(spark, str(tmp_path), items=names).rows.count() == 5


def test_paths_have_one_spelling(spark, raw):
    scan = reviews.scan_reviews(spark, str(raw[0]))
    assert {r["path"].split(str(raw[0]))[0] for r in scan.quarantine.collect()} == {"file://"}


def test_unreadable_file_is_named(spark, raw, monkeypatch):
    """A file that gives no line although it has bytes is left out, and the rest is read."""
    kept = reviews._below

    def broken(root):
        source = kept(root)

        def load(reader):
            found = source(reader)
            return found.where("_metadata.file_name <> '10.csv'") if "value" in found.columns else found

        return load

    monkeypatch.setattr(reviews, "_below", broken)
    scan = reviews.scan_reviews(spark, str(raw[0]))
    assert {r["path"].rsplit("/", 1)[1]: r["reason"] for r in scan.quarantine.collect()}["10.csv"] == "unreadable"
    assert {r["recommendationid"] for r in scan.rows.collect()} == {3, 6}


def test_any_hadoop_file_system_is_read(spark, raw):
    """A scheme that only Hadoop's configuration knows, as for object stores."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.lake.link./raw", f"file://{raw[0]}")
    scan = reviews.scan_reviews(spark, "viewfs://lake/raw")
    assert {r["recommendationid"] for r in scan.rows.collect()} == {1, 2, 3, 6}
    assert {r["path"] for r in scan.quarantine.collect()} == {f"viewfs://lake/raw/{n}.csv" for n in (30, 40, 50)}


def test_many_small_files_make_few_tasks(spark, tmp_path, monkeypatch):
    """600 files of a few bytes: a task of every 32 files would be 19."""
    for n in range(600):
        (tmp_path / f"{n}.csv").write_text(f"recommendationid,author_steamid,voted_up,author_playtime_forever\n{n},u,True,1\n")
    parts, written = {}, reviews.spill

    def watched(df, label="spill", *more):
        parts[label] = df.rdd.getNumPartitions()
        return written(df, label, *more)

    monkeypatch.setattr(reviews, "spill", watched)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    assert reviews.scan_reviews(spark, str(tmp_path)).rows.count() == 600
    assert parts["parsed"] <= 9
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
