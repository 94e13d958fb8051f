"""Joins, aggregates, set operations and the result tables of the exploratory report."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfscout.functions import scalars as S, tokens as T
from shelfscout.operators import interactions as inter, labels, numeric, ordered, reviews
from shelfscout.queries.cleaning import NUMBERS, TOKENS, WINSORIZED, _numbers
from shelfscout.queries.registry import CATALOG, INTERACTIONS, PAIRS, SPLIT, parse_labels, query, r6
from shelfscout.sources import tables
from shelfscout.sources.schema import LABEL_COLUMNS, SEGMENT_COLUMNS

TOP = 15

ENRICHED = f"""{INTERACTIONS}, {CATALOG.strip()},
enriched AS (SELECT i.*, c.name, c.genres, c.tags FROM interactions i JOIN catalog c ON i.item_id = c.item_id)"""


def enriched(spark, folder):
    return reviews.enrich(
        tables.interactions(spark, folder), tables.catalog(spark, folder), "item_id", ["name", "genres", "tags"]
    )


@query("enrich_reviews", f"WITH {ENRICHED} SELECT * FROM enriched")
def enrich_reviews(spark, folder):
    return enriched(spark, folder)


AGGREGATES = f"""{INTERACTIONS}, a AS (
  SELECT item_id, count(*) AS reviews_count, avg(voted_up::INT) AS voted_up_rate, avg(playtime) AS playtime_mean,
    median(playtime) AS playtime_median FROM interactions GROUP BY item_id)"""
FIGURES = ", ".join(f"{r6(c)} AS {c}" for c in ("voted_up_rate", "playtime_mean", "playtime_median"))


def _figures():
    return [S.rounded(c).alias(c) for c in ("voted_up_rate", "playtime_mean", "playtime_median")]


@query("item_review_aggregates", f"WITH {AGGREGATES} SELECT item_id, reviews_count, {FIGURES} FROM a")
def item_review_aggregates(spark, folder):
    stats = reviews.item_aggregates(tables.interactions(spark, folder), "item_id")
    return stats.select("item_id", "reviews_count", *_figures())


@query(
    "catalog_with_review_aggs",
    f"WITH {AGGREGATES} SELECT p_partkey AS item_id, p_name AS name, reviews_count, {FIGURES} FROM part LEFT JOIN a ON p_partkey = a.item_id",
)
def catalog_with_review_aggs(spark, folder):
    stats = reviews.item_aggregates(tables.interactions(spark, folder), "item_id")
    joined = reviews.with_item_aggregates(tables.catalog(spark, folder).select("item_id", "name"), stats, "item_id")
    return joined.select("item_id", "name", "reviews_count", *_figures())


@query(
    "interactions_in_catalog",
    f"""WITH {INTERACTIONS} SELECT user_id, item_id, playtime FROM interactions
    WHERE item_id IN (SELECT p_partkey FROM part WHERE p_size <= 25)""",
)
def interactions_in_catalog(spark, folder):
    """Votes on the items of a catalog of small parts."""
    small = tables.catalog(spark, folder).where("size <= 25").select("item_id")
    return tables.interactions(spark, folder).join(small, "item_id", "left_semi").select("user_id", "item_id", "playtime")


@query("distinct_positive_pairs", f"WITH {INTERACTIONS} SELECT DISTINCT user_id, item_id FROM interactions WHERE voted_up")
def distinct_positive_pairs(spark, folder):
    return inter.positive_pairs(tables.interactions(spark, folder))


@query(
    "distinct_review_counts",
    f"""WITH {INTERACTIONS}, c AS (SELECT item_id, count(*) AS n FROM interactions GROUP BY item_id)
    SELECT count(DISTINCT n) AS n_distinct FROM c""",
)
def distinct_review_counts(spark, folder):
    counts = tables.interactions(spark, folder).groupBy("item_id").agg(F.count("*").alias("n"))
    return counts.agg(F.count_distinct("n").alias("n_distinct"))


@query(
    "vote_distribution",
    """SELECT CASE l_returnflag WHEN 'A' THEN 'Recommended' WHEN 'R' THEN 'Not recommended' ELSE 'Unknown' END AS label,
    count(*) AS n FROM lineitem GROUP BY 1""",
)
def vote_distribution(spark, folder):
    votes = tables.raw_votes(spark, folder).select(S.vote_label("raw_vote").alias("label"))
    return reviews.label_counts(votes, "label")


@query(
    "raw_vote_counts",
    """SELECT CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'true' WHEN l_returnflag = 'A' THEN 'yes'
    WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN '0' WHEN l_returnflag = 'R' THEN 'not recommended'
    WHEN l_linestatus = 'O' THEN 'maybe' ELSE 'none' END AS vote, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC LIMIT 10""",
)
def raw_vote_counts(spark, folder):
    votes = tables.raw_votes(spark, folder).select(
        F.coalesce(F.lower(S.strip("raw_vote")), F.lit("none")).alias("vote")
    )
    return reviews.label_counts(votes, "vote", 10)


@query("reviews_per_item", f"WITH {ENRICHED} SELECT name, count(*) AS n FROM enriched WHERE name IS NOT NULL GROUP BY name")
def reviews_per_item(spark, folder):
    return enriched(spark, folder).where(F.col("name").isNotNull()).groupBy("name").agg(F.count("*").alias("n"))


@query(
    "top_items_by_reviews",
    f"""WITH {ENRICHED} SELECT * FROM (SELECT name, count(*) AS n FROM enriched WHERE name IS NOT NULL GROUP BY name
    ORDER BY n DESC, name LIMIT {TOP}) ORDER BY n, name""",
)
def top_items_by_reviews(spark, folder):
    return reviews.top_names(enriched(spark, folder), "name", TOP).orderBy("n", "name")


@query(
    "recommend_rate_top_items",
    f"""WITH {ENRICHED}, top AS (SELECT name, count(*) AS n FROM enriched GROUP BY name ORDER BY n DESC, name LIMIT {TOP})
    SELECT name, {r6('avg(voted_up::INT) * 100')} AS rate FROM enriched WHERE name IN (SELECT name FROM top) GROUP BY name""",
)
def recommend_rate_top_items(spark, folder):
    rates = reviews.vote_rate_of_top(enriched(spark, folder), "name", "voted_up", TOP)
    return rates.select("name", S.rounded("rate").alias("rate"))


@query(
    "user_histories",
    f"""WITH {PAIRS} SELECT user_id, (item_id // 1000)::BIGINT AS chunk, count(*) AS n_items,
    string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS items FROM pairs GROUP BY ALL""",
)
def user_histories(spark, folder):
    pairs = inter.interaction_universe(tables.interactions(spark, folder), tables.catalog(spark, folder))
    return inter.user_histories(pairs).withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


@query("token_frequency", f"WITH {TOKENS} SELECT token, count(*) AS n FROM tokens GROUP BY token")
def token_frequency(spark, folder):
    tokens = labels.item_tokens(tables.catalog(spark, folder), "item_id", LABEL_COLUMNS)
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


QUANTILES = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS prob, {r6(f'quantile_cont({c}, {p})')} AS quantile FROM lineitem"
    for c in ("l_extendedprice", "l_quantity", "l_discount")
    for p in (0.01, 0.5, 0.99)
)


@query("column_quantiles", QUANTILES)
def column_quantiles(spark, folder):
    lines = tables.table(spark, folder, "lineitem")
    found = ordered.column_quantiles(lines, ["l_extendedprice", "l_quantity", "l_discount"], [0.01, 0.5, 0.99])
    return found.select("column", "prob", S.rounded("quantile").alias("quantile"))


@query("column_quantiles_approx")
def column_quantiles_approx(spark, folder):
    """One-pass variant for tables too large to sort."""
    lines = tables.table(spark, folder, "lineitem")
    return ordered.approximate_quantiles(lines, ["l_extendedprice", "l_quantity", "l_discount"], [0.01, 0.5, 0.99])


@query(
    "column_moments",
    f"""SELECT {r6('avg(l_quantity)')} AS quantity_mean, {r6('stddev_pop(l_quantity)')} AS quantity_std,
    {r6('avg(l_discount)')} AS discount_mean, {r6('stddev_pop(l_discount)')} AS discount_std FROM lineitem""",
)
def column_moments(spark, folder):
    return tables.table(spark, folder, "lineitem").agg(
        *[
            S.rounded(f(f"l_{c}")).alias(f"{c}_{n}")
            for c in ("quantity", "discount")
            for n, f in (("mean", F.avg), ("std", F.stddev_pop))
        ]
    )


@query(
    "playtime_histogram",
    f"""WITH q AS (SELECT quantile_cont(value, 0.99) AS cap, min(value) AS lo FROM events),
    c AS (SELECT least(value, cap) AS v, lo, (cap - lo) / 60 AS w FROM events, q),
    b AS (SELECT least(floor((v - lo) / w), 59)::INT AS bin, lo, w FROM c)
    SELECT bin, {r6('any_value(lo) + bin * any_value(w)')} AS low, {r6('any_value(lo) + (bin + 1) * any_value(w)')} AS high,
    count(*) AS n FROM b GROUP BY bin""",
)
def playtime_histogram(spark, folder):
    bins = numeric.capped_histogram(tables.table(spark, folder, "events"), "value")
    return bins.select("bin", S.rounded("low").alias("low"), S.rounded("high").alias("high"), "n")


@query(
    "genre_counts",
    f"""WITH {ENRICHED}, g AS (SELECT trim(unnest(string_split(coalesce(tags, ''), ','))) AS genre FROM enriched)
    SELECT genre, count(*) AS n FROM g WHERE genre <> '' GROUP BY genre""",
)
def genre_counts(spark, folder):
    pieces = F.transform(F.split(F.coalesce("tags", F.lit("")), ","), S.strip)
    return reviews.token_counts(enriched(spark, folder), pieces, "genre")


@query(
    "top_genres",
    f"""WITH {ENRICHED}, g AS (SELECT trim(unnest(string_split(coalesce(genres, ''), ','))) AS genre FROM enriched)
    SELECT genre, count(*) AS n FROM g WHERE genre <> '' GROUP BY genre ORDER BY n DESC, genre LIMIT {TOP}""",
)
def top_genres(spark, folder):
    pieces = F.transform(F.split(F.coalesce("genres", F.lit("")), ","), S.strip)
    counts = reviews.token_counts(enriched(spark, folder), pieces, "genre")
    return counts.orderBy(F.desc("n"), "genre").limit(TOP).orderBy("n", "genre")


@query(
    "score_minmax",
    f"""WITH {INTERACTIONS}, s AS (SELECT user_id, item_id, sum(playtime) AS score FROM interactions GROUP BY ALL)
    SELECT min(score) AS low, max(score) AS high FROM s""",
)
def score_minmax(spark, folder):
    scores = tables.interactions(spark, folder).groupBy("user_id", "item_id").agg(F.sum("playtime").alias("score"))
    return scores.agg(F.min("score").alias("low"), F.max("score").alias("high"))


@query(
    "matrix_density",
    f"""WITH {PAIRS}, s AS (SELECT count(DISTINCT user_id) AS n_rows, count(DISTINCT item_id) AS n_columns, count(*) AS nnz FROM pairs)
    SELECT *, {r6('nnz / (n_rows * n_columns)')} AS density FROM s""",
)
def matrix_density(spark, folder):
    pairs = inter.interaction_universe(tables.interactions(spark, folder), tables.catalog(spark, folder))
    return labels.matrix_density(pairs, "user_id", "item_id").withColumn("density", S.rounded("density"))


@query(
    "review_coverage",
    f"WITH {AGGREGATES} SELECT {r6('avg((reviews_count IS NOT NULL)::INT)')} AS coverage FROM part LEFT JOIN a ON p_partkey = a.item_id",
)
def review_coverage(spark, folder):
    votes = tables.interactions(spark, folder).groupBy("item_id").agg(F.count("*").alias("reviews_count"))
    joined = tables.catalog(spark, folder).select("item_id").join(votes, "item_id", "left")
    return reviews.coverage(joined).select(S.rounded("coverage").alias("coverage"))


@query(
    "universe_counts",
    f"""WITH {PAIRS} SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items FROM pairs""",
)
def universe_counts(spark, folder):
    return reviews.universe_counts(
        inter.interaction_universe(tables.interactions(spark, folder), tables.catalog(spark, folder))
    )


@query(
    "union_reviews",
    f"""WITH {INTERACTIONS} SELECT item_id, count(*) AS n, count(DISTINCT user_id) AS n_users FROM
    (SELECT * FROM interactions UNION ALL SELECT user_id, event_id, event_type <> 'error', value FROM events) GROUP BY item_id""",
)
def union_reviews(spark, folder):
    """Two review sources with other column orders put together by name."""
    events = tables.table(spark, folder, "events").select(
        F.col("value").alias("playtime"),
        (F.col("event_type") != "error").alias("voted_up"),
        F.col("event_id").alias("item_id"),
        "user_id",
    )
    both = tables.interactions(spark, folder).unionByName(events)
    return both.groupBy("item_id").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"))


@query(
    "union_label_tokens",
    f"""WITH {CATALOG}, t AS (
      SELECT item_id, lower(unnest({parse_labels('genres', "[\\[\\]{}''\"]")})) AS token FROM catalog UNION ALL
      SELECT item_id, lower(unnest({parse_labels('categories', "[\\[\\]{}''\"]")})) FROM catalog UNION ALL
      SELECT item_id, lower(unnest({parse_labels('tags', "[\\[\\]{}''\"]")})) FROM catalog)
    SELECT item_id, token FROM t WHERE NOT regexp_matches(token, '^[0-9]+$')""",
)
def union_label_tokens(spark, folder):
    return labels.item_tokens(
        tables.catalog(spark, folder), "item_id", SEGMENT_COLUMNS, prefix=False, parser=T.segment_labels
    )


@query(
    "reviews_of_sampled_items",
    f"""WITH {INTERACTIONS}, ranked AS (
      SELECT p_partkey AS item_id, row_number() OVER (ORDER BY md5('42|' || p_partkey), p_partkey) AS r,
        count(*) OVER () AS n FROM part)
    SELECT user_id, item_id, playtime FROM interactions
    WHERE item_id IN (SELECT item_id FROM ranked WHERE r <= round_even(0.1 * n, 0))""",
)
def reviews_of_sampled_items(spark, folder):
    from shelfscout.operators.sampling import simple_sample

    items = simple_sample(tables.catalog(spark, folder).select("item_id"), "item_id", 0.1, 42)
    return tables.interactions(spark, folder).join(items, "item_id", "left_semi").select("user_id", "item_id", "playtime")


@query(
    "item_names",
    f"""WITH {INTERACTIONS}, u AS (SELECT DISTINCT item_id FROM interactions)
    SELECT u.item_id, coalesce(p_name, u.item_id::VARCHAR) AS item_name
    FROM u LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) ON p_partkey = u.item_id""",
)
def item_names(spark, folder):
    """Names from a catalog that lacks some of the items."""
    from shelfscout.operators.evaluation import named

    items = tables.interactions(spark, folder).select("item_id").distinct()
    return named(items, tables.catalog(spark, folder).where("size <= 25"))


@query(
    "candidate_pool",
    f"""WITH {SPLIT}, s AS (SELECT user_id, item_id, sum(playtime) AS score FROM interactions GROUP BY ALL)
    SELECT s.* FROM s ANTI JOIN train t ON s.user_id = t.user_id AND s.item_id = t.item_id""",
)
def candidate_pool(spark, folder):
    from shelfscout.operators.scoring import candidates
    from shelfscout.queries.ranking import played_scores, split

    _, train, _ = split(spark, folder)
    return candidates(played_scores(spark, folder), train)


@query("seed_pairs", "SELECT a.label AS seed_a, b.label AS seed_b FROM (SELECT DISTINCT label FROM embeddings) a JOIN (SELECT DISTINCT label FROM embeddings) b ON a.label < b.label")
def seed_pairs(spark, folder):
    """Pairs of a short run list, here the ten partitions named in the vector table."""
    from shelfscout.operators.clustering import seed_pairs as pairs_of

    return pairs_of(tables.vectors(spark, folder).select(F.col("label").alias("seed")).distinct())


@query(
    "constant_columns",
    f"WITH {WINSORIZED} "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\" FROM clipped HAVING min({c}) = max({c})" for c in NUMBERS),
)
def constant_columns(spark, folder):
    stats = numeric.fit_columns(_numbers(spark, folder), NUMBERS)
    return spark.createDataFrame([(c,) for c in numeric.constant_columns(stats)], "column string")
