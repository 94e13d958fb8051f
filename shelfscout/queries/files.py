"""Sources and sinks. Raw files are first written from the driver's tables into the scratch folder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfscout.functions import scalars as S
from shelfscout.functions.vectors import unit
from shelfscout.operators import numeric, reduction
from shelfscout.operators.clustering import assign_nearest
from shelfscout.queries.aggregates import ENRICHED, enriched
from shelfscout.queries.features import SEGMENT_TOKENS, tag_cells
from shelfscout.queries.models import item_numbers
from shelfscout.queries.ranking import HIT_RATES, POPULARITY, popularity_hr
from shelfscout.queries.registry import INTERACTIONS, query
from shelfscout.session import scratch_path
from shelfscout.sources import store, tables
from shelfscout.sources.catalog import scan_catalog
from shelfscout.sources.reviews import list_review_files, scan_reviews

# Spark names its files itself, so the item is named by the folder.
FOLDER_KEY = r"AppID=([^/]+)/[^/]*\.csv$"

_landed: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, folder: str, kind: str, write) -> str:
    """Raw files are written once per application and folder and then shared by the queries that read them."""
    key = (spark.sparkContext.applicationId, folder, kind)
    if key not in _landed:
        path = scratch_path(spark, kind)
        write(path)
        _landed[key] = path
    return _landed[key]


def land_reviews(spark: SparkSession, folder: str) -> str:
    """One review file per item in two column orders, and one supplier file per nation that is no review file."""

    def write(path: str) -> None:
        lines = tables.table(spark, folder, "lineitem")
        orders = tables.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
        rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("recommendationid"),
            F.col("o_custkey").cast("string").alias("author_steamid"),
            F.when(F.col("l_returnflag") != "R", "True").otherwise("False").alias("voted_up"),
            F.col("l_quantity").alias("author_playtime_forever"),
            F.col("l_partkey").alias("AppID"),
        )
        small = F.col("AppID") % 2 == 0
        plain = rows.where(small)
        turned = rows.where(~small).select(
            "author_playtime_forever", F.lit("x, y").alias("note"), "voted_up", "recommendationid", "author_steamid", "AppID"
        )
        for name, part in (("a", plain), ("b", turned)):
            part.repartition("AppID").write.partitionBy("AppID").option("header", True).csv(f"{path}/{name}")
        other = tables.table(spark, folder, "supplier").withColumn("AppID", F.col("s_nationkey"))
        other.repartition("AppID").write.partitionBy("AppID").option("header", True).csv(f"{path}/c")

    return _once(spark, folder, "raw-reviews", write)


def _write_csv(df: DataFrame, path: str) -> None:
    options = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(**options).csv(path)


def land_catalog(spark: SparkSession, folder: str) -> str:
    """Catalog CSV with a review count per item."""

    def write(path: str) -> None:
        votes = tables.table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("item_id")).agg(
            F.count("*").alias("num_reviews_total")
        )
        items = tables.catalog(spark, folder).join(votes, "item_id", "left")
        _write_csv(items.withColumnRenamed("item_id", "AppID"), path)

    return _once(spark, folder, "raw-catalog", write)


@query("scan_catalog", "SELECT doc_id::VARCHAR AS \"AppID\", md5(text) AS text_md5, lang FROM documents")
def scan_catalog_texts(spark, folder):
    """Quoted texts with line breaks, whole."""
    docs = tables.table(spark, folder, "documents").withColumnRenamed("doc_id", "AppID")
    path = _once(spark, folder, "raw-texts", lambda p: _write_csv(docs, p))
    return scan_catalog(spark, path).select("AppID", F.md5(F.col("text").cast("binary")).alias("text_md5"), "lang")


@query(
    "scan_catalog_pruned",
    """SELECT p_partkey::VARCHAR AS "AppID", p_name AS name, '[''' || p_type || ''']' AS genres, p_brand AS developers FROM part""",
)
def scan_catalog_pruned(spark, folder):
    return scan_catalog(spark, land_catalog(spark, folder), ["AppID", "name", "genres", "developers"])


REVIEWS = """SELECT l_orderkey * 8 + l_linenumber AS recommendationid, o_custkey::VARCHAR AS author_steamid,
  l_returnflag <> 'R' AS voted_up, l_quantity AS author_playtime_forever, l_partkey::VARCHAR AS "AppID"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@query("scan_reviews", REVIEWS)
def scan_review_files(spark, folder):
    return scan_reviews(spark, land_reviews(spark, folder), FOLDER_KEY).rows


@query(
    "reviews_with_item_key",
    f"""SELECT "AppID", count(*) AS n, sum(voted_up::INT)::BIGINT AS n_up FROM ({REVIEWS}) GROUP BY 1""",
)
def reviews_with_item_key(spark, folder):
    rows = scan_reviews(spark, land_reviews(spark, folder), FOLDER_KEY).rows
    return rows.groupBy("AppID").agg(F.count("*").alias("n"), F.sum(S.vote_int("voted_up")).alias("n_up"))


@query(
    "scan_quarantine",
    """SELECT 'missing columns: recommendationid, author_steamid, voted_up, author_playtime_forever' AS reason,
    count(DISTINCT s_nationkey) AS n FROM supplier""",
)
def scan_quarantine(spark, folder):
    left_out = scan_reviews(spark, land_reviews(spark, folder), FOLDER_KEY).quarantine
    return left_out.groupBy("reason").agg(F.count("*").alias("n"))


@query(
    "scan_limit_files",
    f"""WITH f AS (SELECT DISTINCT l_partkey FROM lineitem ORDER BY l_partkey % 2, l_partkey::VARCHAR LIMIT 10)
    SELECT "AppID", count(*) AS n FROM ({REVIEWS}) WHERE "AppID" IN (SELECT l_partkey::VARCHAR FROM f) GROUP BY 1""",
)
def scan_limit_files(spark, folder):
    """Reviews of the first ten files by path."""
    rows = scan_reviews(spark, land_reviews(spark, folder), FOLDER_KEY, limit_files=10).rows
    return rows.groupBy("AppID").agg(F.count("*").alias("n"))


@query("list_files", """SELECT l_partkey::VARCHAR AS "AppID", count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1""")
def list_files(spark, folder):
    found = list_review_files(spark, f"{land_reviews(spark, folder)}/*", FOLDER_KEY)
    return found.where(~F.col("path").contains("/c/")).groupBy("AppID").agg(F.count("*").alias("n"))


@query("sink_parquet_roundtrip", f"WITH {ENRICHED} SELECT * FROM enriched")
def sink_parquet_roundtrip(spark, folder):
    path = f"{scratch_path(spark, 'sink')}/{store.interactions_name(full=True)}"
    return spark.read.parquet(store.write_table(enriched(spark, folder), path, cluster_by="item_id"))


@query("scan_interactions", f"WITH {INTERACTIONS} SELECT user_id, item_id FROM interactions")
def scan_interactions(spark, folder):
    """Only the sample table is there, so the full one is looked for in vain; two columns are read."""
    out = scratch_path(spark, "processed")
    store.write_table(tables.interactions(spark, folder), f"{out}/{store.interactions_name(full=False)}")
    return store.scan_interactions(spark, out, ["user_id", "item_id"])


@query(
    "sink_features",
    f"""WITH {SEGMENT_TOKENS} SELECT 'numeric' AS block, count(*) AS n FROM part UNION ALL SELECT 'tags', count(*) FROM cells
    UNION ALL SELECT 'tags_vocabulary', count(*) FROM kept""",
)
def sink_features(spark, folder):
    block, _ = item_numbers(spark, folder)
    cells, vocabulary = tag_cells(spark, folder)
    out = scratch_path(spark, "features")
    written = store.write_features(out, {"numeric": block, "tags": cells}, {"tags": vocabulary})
    counts = [spark.read.parquet(p).agg(F.lit(p.rsplit("/", 1)[1]).alias("block"), F.count("*").alias("n")) for p in written]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("sink_models")
def sink_models(spark, folder):
    """Components and scaler written, read back and applied again."""
    block, joined = item_numbers(spark, folder)
    out = scratch_path(spark, "models")
    columns = ["price", "size"]
    stats = numeric.fit_columns(joined, columns)
    store.write_column_stats(spark, stats, f"{out}/scaler")
    model = reduction.fit_pca(block, 6, 3)
    store.write_projection(spark, model, f"{out}/pca")
    again = store.read_projection(spark, f"{out}/pca")
    if not np.allclose(again.loadings, model.loadings) or store.read_column_stats(spark, f"{out}/scaler") != stats:
        raise AssertionError("a model changed on its way through the store")
    return reduction.project(block, "item_id", again)


@query(
    "sink_metrics",
    f"WITH {POPULARITY}, r AS ({HIT_RATES}) SELECT 'recommendation' AS stage, 'popularity' AS config, 'hr_' || k AS metric, hit_rate AS value FROM r",
)
def sink_metrics(spark, folder):
    rows = popularity_hr(spark, folder).select(
        F.lit("recommendation").alias("stage"), F.lit("popularity").alias("config"),
        F.concat(F.lit("hr_"), "k").alias("metric"), F.col("hit_rate").alias("value"),
    )
    return store.read_metrics(spark, store.write_metrics(rows, scratch_path(spark, "metrics")))


@query("sink_factors")
def sink_factors(spark, folder):
    """Keyed vectors and labels written and read back together."""
    out = scratch_path(spark, "factors")
    rows = tables.vectors(spark, folder).select("id", unit("vec").alias("vec"))
    centres = np.array([r["vec"] for r in rows.orderBy("id").limit(6).collect()])
    vectors = spark.read.parquet(store.write_table(rows, f"{out}/vectors", cluster_by="id"))
    labels = spark.read.parquet(store.write_table(assign_nearest(rows, "id", centres), f"{out}/labels"))
    return vectors.join(labels.select("id", "cluster"), "id")


@query(
    "metrics_flatten",
    f"WITH {POPULARITY}, r AS ({HIT_RATES}) SELECT 'popularity' AS system, '' AS config, k, hit_rate FROM r UNION ALL SELECT 'mf', 'k=10', k, hit_rate FROM r",
)
def metrics_flatten(spark, folder):
    """A nested evaluation document written from the hit rates and taken apart again."""
    table = popularity_hr(spark, folder).select(F.concat(F.lit("HR@"), "k").alias("k"), "hit_rate")
    as_map = F.map_from_entries(F.collect_list(F.struct("k", "hit_rate")))
    document = table.agg(as_map.alias("m")).select(
        F.struct(F.col("m").alias("popularity_baseline"), F.create_map(F.lit("k=10"), F.col("m")).alias("matrix_factorization")).alias("evaluation")
    )
    path = scratch_path(spark, "document")
    document.coalesce(1).write.json(path)
    return store.flatten_evaluation(spark, path)
