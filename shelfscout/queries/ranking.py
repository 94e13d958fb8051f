"""Splits, ranks, top-k, samples and bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfscout.functions import scalars as S
from shelfscout.operators import evaluation, interactions as inter, labels, reduction, sampling, scoring
from shelfscout.queries.cleaning import TOKENS
from shelfscout.queries.registry import INTERACTIONS, PAIRS, SPLIT, query, r6
from shelfscout.session import spill
from shelfscout.sources import tables
from shelfscout.sources.schema import LABEL_COLUMNS

SEED = 42


def split(spark, folder):
    """``(pairs, train, held out)``; the pairs are written once as each branch starts from them."""
    pairs = spill(inter.interaction_universe(tables.interactions(spark, folder), tables.catalog(spark, folder)), "pairs")
    held = inter.hold_out(pairs, SEED)
    return pairs, inter.train_pairs(pairs, held), held


def played_scores(spark, folder):
    """A score table without a user-by-item product: total playtime of every pair that occurs."""
    return tables.interactions(spark, folder).groupBy("user_id", "item_id").agg(F.sum("playtime").alias("score"))


SCORES = "scores AS (SELECT user_id, item_id, sum(playtime) AS score FROM interactions GROUP BY ALL)"


@query("interaction_universe", f"WITH {PAIRS} SELECT user_id, item_id FROM pairs")
def interaction_universe(spark, folder):
    return inter.interaction_universe(tables.interactions(spark, folder), tables.catalog(spark, folder))


@query(
    "holdout_split",
    f"""WITH {SPLIT} SELECT user_id, item_id, 'held' AS part FROM held UNION ALL SELECT user_id, item_id, 'train' FROM train""",
)
def holdout_split(spark, folder):
    _, train, held = split(spark, folder)
    return held.withColumn("part", F.lit("held")).unionByName(train.withColumn("part", F.lit("train")))


@query(
    "qualifying_users",
    f"WITH {PAIRS} SELECT user_id, count(*) AS n_items FROM pairs GROUP BY user_id HAVING count(*) >= 2",
)
def qualifying_users(spark, folder):
    return inter.qualifying_users(interaction_universe(spark, folder))


@query(
    "dense_index",
    f"""WITH {PAIRS} SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS idx
    FROM (SELECT DISTINCT item_id FROM pairs)""",
)
def dense_index(spark, folder):
    return inter.dense_index(interaction_universe(spark, folder), "item_id")


@query(
    "train_matrix",
    f"""WITH {SPLIT},
    u AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS r FROM (SELECT DISTINCT user_id FROM pairs)),
    i AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS c FROM (SELECT DISTINCT item_id FROM pairs))
    SELECT r AS "row", c AS "column" FROM train JOIN u USING (user_id) JOIN i USING (item_id)""",
)
def train_matrix(spark, folder):
    pairs, train, _ = split(spark, folder)
    return inter.train_matrix(train, inter.dense_index(pairs, "user_id"), inter.dense_index(pairs, "item_id"))


@query(
    "train_matrix_density",
    f"""WITH {SPLIT}, s AS (SELECT (SELECT count(DISTINCT user_id) FROM pairs) AS n_rows,
      (SELECT count(DISTINCT item_id) FROM pairs) AS n_columns, (SELECT count(*) FROM train) AS nnz)
    SELECT *, round(nnz / (n_rows * n_columns), 9) + 0.0 AS density FROM s""",
)
def train_matrix_density(spark, folder):
    """Empty rows of users who are not tested count."""
    pairs, train, _ = split(spark, folder)
    size = pairs.agg(F.count_distinct("user_id").alias("u"), F.count_distinct("item_id").alias("i")).first()
    shape = labels.matrix_density(train, "user_id", "item_id", size["u"], size["i"])
    return shape.withColumn("density", S.rounded("density", 9))


@query(
    "topk_per_user",
    f"""WITH {INTERACTIONS}, {SCORES} SELECT * FROM (SELECT user_id, item_id, score,
      row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM scores) WHERE rank <= 10""",
)
def topk_per_user(spark, folder):
    return scoring.best_per_user(played_scores(spark, folder), 10).withColumn("rank", F.col("rank").cast("long"))


RANKED = f"""{SPLIT}, {SCORES},
pool AS (SELECT s.* FROM scores s ANTI JOIN train t ON s.user_id = t.user_id AND s.item_id = t.item_id),
ranked AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM pool),
ranks AS (SELECT r.user_id, r.item_id, r.rank FROM ranked r JOIN held h ON r.user_id = h.user_id AND r.item_id = h.item_id)"""


@query("heldout_rank", f"WITH {RANKED} SELECT * FROM ranks")
def heldout_rank(spark, folder):
    _, train, held = split(spark, folder)
    return scoring.heldout_ranks_of_scores(played_scores(spark, folder), train, held)


HIT_RATES = " UNION ALL ".join(
    f"SELECT {k} AS k, round(avg((rank <= {k})::INT), 4) + 0.0 AS hit_rate, count(*) AS n_tested FROM ranks" for k in (5, 10, 20)
)


@query("hit_rate_at_k", f"WITH {RANKED} {HIT_RATES}")
def hit_rate_at_k(spark, folder):
    return evaluation.hit_rates(heldout_rank(spark, folder))


POPULARITY = f"""{SPLIT},
popularity AS (SELECT u.item_id, coalesce(n, 0)::DOUBLE AS score FROM (SELECT DISTINCT item_id FROM pairs) u
  LEFT JOIN (SELECT item_id, count(*) AS n FROM interactions GROUP BY item_id) c ON u.item_id = c.item_id),
placed AS (SELECT item_id, row_number() OVER (ORDER BY score DESC, item_id) AS place FROM popularity),
ranks AS (
  SELECT h.user_id, h.item_id, any_value(p.place) - count(q.place) AS rank FROM held h JOIN placed p ON h.item_id = p.item_id
  LEFT JOIN train t ON t.user_id = h.user_id LEFT JOIN placed q ON q.item_id = t.item_id AND q.place < p.place
  GROUP BY h.user_id, h.item_id)"""


def popularity(spark, folder, pairs):
    """Number of votes of either kind stands in for the catalog's own count."""
    counts = tables.interactions(spark, folder).groupBy("item_id").agg(F.count("*").alias("recommendations"))
    return scoring.popularity_scores(pairs.select("item_id").distinct(), counts)


@query("popularity_scores", f"WITH {POPULARITY} SELECT item_id, score FROM popularity")
def popularity_scores(spark, folder):
    return popularity(spark, folder, interaction_universe(spark, folder))


@query("popularity_hr", f"WITH {POPULARITY} {HIT_RATES}")
def popularity_hr(spark, folder):
    pairs, train, held = split(spark, folder)
    ranks = scoring.popularity_ranks(popularity(spark, folder, pairs), train, held)
    return evaluation.hit_rates(ranks)


@query(
    "popularity_hr_train_counts",
    f"""WITH {SPLIT},
    popularity AS (SELECT u.item_id, coalesce(n, 0)::DOUBLE AS score FROM (SELECT DISTINCT item_id FROM pairs) u
      LEFT JOIN (SELECT item_id, count(*) AS n FROM train GROUP BY item_id) c ON u.item_id = c.item_id),
    placed AS (SELECT item_id, row_number() OVER (ORDER BY score DESC, item_id) AS place FROM popularity),
    ranks AS (
      SELECT h.user_id, h.item_id, any_value(p.place) - count(q.place) AS rank FROM held h JOIN placed p ON h.item_id = p.item_id
      LEFT JOIN train t ON t.user_id = h.user_id LEFT JOIN placed q ON q.item_id = t.item_id AND q.place < p.place
      GROUP BY h.user_id, h.item_id) {HIT_RATES}""",
)
def popularity_hr_train_counts(spark, folder):
    """Popularity that does not see the held-out votes."""
    pairs, train, held = split(spark, folder)
    counts = train.groupBy("item_id").agg(F.count("*").alias("recommendations"))
    scores = scoring.popularity_scores(pairs.select("item_id").distinct(), counts)
    return evaluation.hit_rates(scoring.popularity_ranks(scores, train, held))


@query(
    "token_vocabulary",
    f"WITH {TOKENS} SELECT token, n, idx FROM vocab",
)
def token_vocabulary(spark, folder):
    tokens = labels.item_tokens(tables.catalog(spark, folder), "item_id", LABEL_COLUMNS)
    return labels.vocabulary(tokens, 20, 100)


@query(
    "popularity_bins",
    f"""WITH {INTERACTIONS}, c AS (SELECT item_id, count(*) AS n FROM interactions GROUP BY item_id),
    q AS (SELECT quantile_cont(n, 0.25) AS a, quantile_cont(n, 0.5) AS b, quantile_cont(n, 0.75) AS c FROM c)
    SELECT item_id, n, (n > a)::INT + (n > b AND b > a)::INT + (n > q.c AND q.c > b)::INT AS popularity_bin FROM c, q""",
)
def popularity_bins(spark, folder):
    counts = spill(tables.interactions(spark, folder).groupBy("item_id").agg(F.count("*").alias("n")), "counts")
    return sampling.with_popularity_bin(counts, "n")


@query(
    "stratified_sample",
    """WITH c AS (SELECT p_partkey AS item_id, p_brand AS brand FROM part),
    r AS (SELECT item_id, brand, row_number() OVER (PARTITION BY brand ORDER BY md5('42|' || item_id), item_id) AS r,
      count(*) OVER (PARTITION BY brand) AS n FROM c)
    SELECT item_id, brand FROM r WHERE r <= round_even(0.1 * n, 0)""",
)
def stratified_sample(spark, folder):
    items = tables.catalog(spark, folder).select("item_id", F.col("developers").alias("brand"))
    return sampling.stratified_sample(items, "brand", "item_id", 0.1, SEED)


@query(
    "popularity_sample",
    f"""WITH {INTERACTIONS}, c AS (SELECT item_id, count(*) AS n FROM interactions GROUP BY item_id),
    q AS (SELECT quantile_cont(n, 0.25) AS a, quantile_cont(n, 0.5) AS b, quantile_cont(n, 0.75) AS c FROM c),
    b AS (SELECT item_id, n, (n > a)::INT + (n > b AND b > a)::INT + (n > q.c AND q.c > b)::INT AS bin FROM c, q),
    r AS (SELECT item_id, n, row_number() OVER (PARTITION BY bin ORDER BY md5('42|' || item_id), item_id) AS r,
      count(*) OVER (PARTITION BY bin) AS m FROM b)
    SELECT item_id, n FROM r WHERE r <= round_even(0.1 * m, 0)""",
)
def popularity_sample(spark, folder):
    counts = spill(tables.interactions(spark, folder).groupBy("item_id").agg(F.count("*").alias("n")), "counts")
    return sampling.popularity_sample(counts, "n", "item_id", 0.1, SEED)


@query(
    "simple_sample",
    """WITH r AS (SELECT s_suppkey AS item_id, row_number() OVER (ORDER BY md5('42|' || s_suppkey), s_suppkey) AS r,
      count(*) OVER () AS n FROM supplier) SELECT item_id FROM r WHERE r <= round_even(0.25 * n, 0)""",
)
def simple_sample(spark, folder):
    items = tables.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("item_id"))
    return sampling.simple_sample(items, "item_id", 0.25, SEED)


SHARES = """shares AS (SELECT row_number() OVER (ORDER BY p_brand)::INT AS component,
  count(*) / (SELECT count(*) FROM part) AS share FROM part GROUP BY p_brand),
cumulated AS (SELECT component, share, sum(share) OVER (ORDER BY component) AS cumulative FROM shares)"""


def _shares(spark, folder):
    """Share of the catalog per brand stands in for a list of variance ratios."""
    parts = tables.table(spark, folder, "part")
    counts = parts.groupBy("p_brand").agg(F.count("*").alias("n"))
    placed = inter.dense_index(counts, "p_brand", "component").join(counts, "p_brand")
    total = parts.count()
    return placed.select((F.col("component") + 1).cast("int").alias("component"), (F.col("n") / total).alias("share"))


@query("cumulative_variance", f"WITH {SHARES} SELECT component, {r6('share')} AS share, {r6('cumulative')} AS cumulative FROM cumulated")
def cumulative_variance(spark, folder):
    return reduction.cumulative(_shares(spark, folder)).select(
        "component", S.rounded("share").alias("share"), S.rounded("cumulative").alias("cumulative")
    )


@query(
    "components_for_share",
    f"WITH {SHARES} "
    + " UNION ALL ".join(
        f"SELECT {t}::DOUBLE AS target, min(component) FILTER (cumulative >= {t}) AS components FROM cumulated"
        for t in (0.5, 0.8, 0.9, 1.5)
    ),
)
def components_for_share(spark, folder):
    return reduction.components_for_share(reduction.cumulative(_shares(spark, folder)), [0.5, 0.8, 0.9, 1.5])


@query(
    "best_config",
    """WITH c AS (SELECT c_mktsegment AS config, row_number() OVER (ORDER BY c_mktsegment) AS position,
      round(avg((c_acctbal > 0)::INT), 4) + 0.0 AS hit_rate FROM customer GROUP BY c_mktsegment)
    SELECT config, hit_rate FROM c ORDER BY hit_rate DESC, position LIMIT 1""",
)
def best_config(spark, folder):
    """Market segments stand in for configurations and the share of good accounts for the hit rate."""
    customers = tables.table(spark, folder, "customer")
    rates = customers.groupBy(F.col("c_mktsegment").alias("config")).agg(
        S.rounded(F.avg((F.col("c_acctbal") > 0).cast("int")), 4).alias("hit_rate")
    )
    return evaluation.best_config(rates.withColumns({"k": F.lit(10), "position": F.col("config")}))
