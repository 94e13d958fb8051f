"""Projections, filters and value cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfscout.functions import scalars as S, tokens as T
from shelfscout.operators import interactions as inter, labels, numeric, ordered
from shelfscout.queries.registry import CATALOG, INTERACTIONS, MESSY, PAIRS, parse_labels, query, r6
from shelfscout.sources import tables

AS_OF = "2024-06-01"


@query("project_columns", f"WITH {INTERACTIONS} SELECT item_id, voted_up, playtime FROM interactions")
def project_columns(spark, folder):
    return tables.interactions(spark, folder).select("item_id", "voted_up", "playtime")


@query(
    "cast_keys",
    f"WITH {INTERACTIONS} SELECT user_id::VARCHAR AS user_id, item_id::VARCHAR AS item_id FROM interactions",
)
def cast_keys(spark, folder):
    return tables.interactions(spark, folder).select(
        F.col("user_id").cast("string").alias("user_id"), F.col("item_id").cast("string").alias("item_id")
    )


@query("cast_votes", f"WITH {INTERACTIONS} SELECT user_id, item_id, voted_up::INT AS vote FROM interactions")
def cast_votes(spark, folder):
    return tables.interactions(spark, folder).select("user_id", "item_id", S.vote_int("voted_up").alias("vote"))


@query("coerce_numeric", f"WITH {MESSY} SELECT event_id, {r6('value')} AS value, k FROM finite")
def coerce_numeric(spark, folder):
    return tables.messy_numbers(spark, folder).select(
        "event_id", S.rounded(S.finite(S.to_number("raw_value"))).alias("value"), S.to_number("raw_k").alias("k")
    )


@query(
    "null_infinities",
    f"""WITH {MESSY} SELECT count(*) AS n, count(parsed) AS n_parsed, count(value) AS n_finite
    FROM messy JOIN finite USING (event_id)""",
)
def null_infinities(spark, folder):
    raw = tables.messy_numbers(spark, folder).withColumn("parsed", S.to_number("raw_value"))
    return raw.agg(
        F.count("*").alias("n"), F.count("parsed").alias("n_parsed"), F.count(S.finite("parsed")).alias("n_finite")
    )


IMPUTED = f"""{MESSY},
filled AS (
  SELECT event_id, coalesce(value, (SELECT median(value) FROM finite), 0) AS value,
    coalesce(k, (SELECT median(k) FROM finite), 0) AS k, 0.0::DOUBLE AS empty FROM finite)"""


@query("impute_median", f"WITH {IMPUTED} SELECT event_id, {r6('value')} AS value, {r6('k')} AS k, empty FROM filled")
def impute_median(spark, folder):
    raw = _numbers(spark, folder)
    stats = numeric.fit_columns(raw, NUMBERS)
    typed = numeric.coerced(raw, NUMBERS)
    return typed.select("event_id", *[S.rounded(numeric.imputed(c, stats[c])).alias(c) for c in NUMBERS])


NUMBERS = ["value", "k", "empty"]


def _numbers(spark, folder):
    return tables.messy_numbers(spark, folder).select(
        "event_id", F.col("raw_value").alias("value"), F.col("raw_k").alias("k"), F.col("raw_empty").alias("empty")
    )


WINSORIZED = f"""{IMPUTED},
limits AS (
  SELECT quantile_cont(value, 0.01) AS v1, quantile_cont(value, 0.99) AS v2,
    quantile_cont(k, 0.01) AS k1, quantile_cont(k, 0.99) AS k2 FROM filled),
clipped AS (
  SELECT event_id, greatest(least(value, v2), v1) AS value, greatest(least(k, k2), k1) AS k, empty FROM filled, limits)"""


@query("winsorize", f"WITH {WINSORIZED} SELECT event_id, {r6('value')} AS value, {r6('k')} AS k, empty FROM clipped")
def winsorize(spark, folder):
    raw = _numbers(spark, folder)
    stats = numeric.fit_columns(raw, NUMBERS)
    typed = numeric.coerced(raw, NUMBERS)
    return typed.select("event_id", *[S.rounded(numeric.winsorized(c, stats[c])).alias(c) for c in NUMBERS])


STANDARDIZED = f"""WITH {WINSORIZED}, m AS (
  SELECT avg(value) AS vm, stddev_pop(value) AS vs, avg(k) AS km, stddev_pop(k) AS ks FROM clipped)
SELECT event_id, {r6('(value - vm) / vs')} AS value, {r6('(k - km) / ks')} AS k, 0.0::DOUBLE AS empty FROM clipped, m"""


@query("numeric_features", STANDARDIZED)
def numeric_features(spark, folder):
    block = numeric.numeric_block(_numbers(spark, folder), "event_id", NUMBERS)
    return block.select("event_id", *[S.rounded(c).alias(c) for c in NUMBERS])


@query(
    "standardize",
    f"""WITH b AS (SELECT p_partkey AS item_id, p_retailprice AS price, p_size::DOUBLE AS size FROM part),
    q AS (SELECT quantile_cont(price, 0.01) AS p1, quantile_cont(price, 0.99) AS p2,
      quantile_cont(size, 0.01) AS s1, quantile_cont(size, 0.99) AS s2 FROM b),
    c AS (SELECT item_id, greatest(least(price, p2), p1) AS price, greatest(least(size, s2), s1) AS size FROM b, q),
    m AS (SELECT avg(price) AS pm, stddev_pop(price) AS ps, avg(size) AS sm, stddev_pop(size) AS ss FROM c)
    SELECT item_id, {r6('(price - pm) / ps')} AS price, {r6('(size - sm) / ss')} AS size FROM c, m""",
)
def standardize(spark, folder):
    block = numeric.numeric_block(tables.catalog(spark, folder), "item_id", ["price", "size"])
    return block.select("item_id", S.rounded("price").alias("price"), S.rounded("size").alias("size"))


@query(
    "cap_p99",
    f"""WITH {INTERACTIONS}, q AS (SELECT quantile_cont(playtime, 0.99) AS cap FROM interactions)
    SELECT user_id, item_id, {r6('least(playtime, cap)')} AS playtime FROM interactions, q""",
)
def cap_p99(spark, folder):
    rows = tables.interactions(spark, folder)
    cap = ordered.column_quantiles(rows, ["playtime"], [0.99]).first()["quantile"]
    return rows.select("user_id", "item_id", S.rounded(S.clip("playtime", None, cap)).alias("playtime"))


@query("positive_interactions", f"WITH {INTERACTIONS} SELECT user_id, item_id FROM interactions WHERE voted_up")
def positive_interactions(spark, folder):
    return tables.interactions(spark, folder).where("voted_up").select("user_id", "item_id")


@query(
    "tagged_catalog",
    "SELECT doc_id, length(trim(text)) AS n FROM documents WHERE text IS NOT NULL AND length(trim(text)) > 2",
)
def tagged_catalog(spark, folder):
    docs = tables.documents(spark, folder)
    return docs.where(T.has_tags("text")).select("doc_id", F.length(F.trim("text")).cast("long").alias("n"))


@query(
    "drop_blank_tokens",
    f"""WITH {CATALOG} SELECT item_id, array_to_string(list_filter({parse_labels('categories')},
    lambda t: NOT regexp_matches(t, '^[0-9]+$')), '|') AS tokens FROM catalog""",
)
def drop_blank_tokens(spark, folder):
    return tables.catalog(spark, folder).select(
        "item_id", F.array_join(T.segment_labels("categories"), "|").alias("tokens")
    )


@query(
    "text_blob",
    """SELECT d.doc_id, md5(coalesce(d.lang, '') || ' ' || coalesce(d.text, '') || ' ' || coalesce(l.quality::VARCHAR, ''))
    AS blob_md5 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def text_blob(spark, folder):
    docs = tables.table(spark, folder, "documents").select("doc_id", "lang", "text")
    marks = tables.table(spark, folder, "labels").select("doc_id", "quality")
    blob = T.text_blob(["lang", "text", "quality"])
    return docs.join(marks, "doc_id", "left").select("doc_id", F.md5(blob.cast("binary")).alias("blob_md5"))


LABEL_TEXT = (
    "trim(regexp_replace(regexp_replace(coalesce({0}, ''), '[\"''\\[\\]{{}}:0-9]', ' ', 'g'), '\\s+', ' ', 'g'))"
)


@query(
    "content_blob",
    f"""WITH {PAIRS}, {CATALOG.strip()}, universe AS (SELECT DISTINCT item_id FROM pairs)
    SELECT u.item_id, coalesce(name, '') || ' ' || coalesce(short_description, '') || ' ' || {LABEL_TEXT.format('tags')}
    || ' ' || {LABEL_TEXT.format('genres')} || ' ' || {LABEL_TEXT.format('categories')} AS blob
    FROM universe u LEFT JOIN catalog c ON u.item_id = c.item_id""",
)
def content_blob(spark, folder):
    catalog = tables.catalog(spark, folder)
    pairs = inter.interaction_universe(tables.interactions(spark, folder), catalog)
    return pairs.select("item_id").distinct().join(catalog, "item_id", "left").select(
        "item_id", T.content_blob().alias("blob")
    )


@query(
    "vote_label",
    """SELECT l_partkey AS item_id, CASE l_returnflag WHEN 'A' THEN 'Recommended' WHEN 'R' THEN 'Not recommended'
    ELSE 'Unknown' END AS label FROM lineitem""",
)
def vote_label(spark, folder):
    return tables.raw_votes(spark, folder).select("item_id", S.vote_label("raw_vote").alias("label"))


DATES = """dates AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderpriority <> '5-LOW' AND o_orderkey % 3 <> 2 THEN o_orderdate::DATE END AS d
  FROM orders)"""


@query("parse_release_date", f"WITH {DATES} SELECT id, strftime(d, '%Y-%m-%d') AS release_date FROM dates")
def parse_release_date(spark, folder):
    day = S.release_date("release_date")
    return tables.raw_dates(spark, folder).select("id", F.date_format(day, "yyyy-MM-dd").alias("release_date"))


@query(
    "release_parts",
    f"WITH {DATES} SELECT id, year(d)::INT AS release_year, month(d)::INT AS release_month FROM dates",
)
def release_parts(spark, folder):
    parts = S.release_parts(S.release_date("release_date"))
    return tables.raw_dates(spark, folder).select("id", *[c.alias(n) for n, c in parts.items()])


@query(
    "release_age_days",
    f"WITH {DATES} SELECT id, date_diff('day', d, DATE '{AS_OF}')::INT AS release_age_days FROM dates",
)
def release_age_days(spark, folder):
    age = S.age_days(S.release_date("release_date"), AS_OF)
    return tables.raw_dates(spark, folder).select("id", age.alias("release_age_days"))


@query(
    "platform_flags",
    """SELECT l_orderkey, l_linenumber, (l_returnflag = 'A')::INT::DOUBLE AS windows,
    CASE l_linestatus WHEN 'O' THEN 1.0 ELSE NULL END::DOUBLE AS mac, (l_linenumber > 3)::INT::DOUBLE AS linux FROM lineitem""",
)
def platform_flags(spark, folder):
    lines = tables.table(spark, folder, "lineitem")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        S.flag(F.col("l_returnflag") == "A").alias("windows"),
        S.flag(F.when(F.col("l_linestatus") == "O", F.lit(" TRUE ")).otherwise(F.lit("n/a"))).alias("mac"),
        S.flag((F.col("l_linenumber") > 3).cast("int")).alias("linux"),
    )


@query(
    "numeric_column_set",
    f"""WITH {INTERACTIONS}, a AS (SELECT item_id, count(*) AS reviews_count, avg(voted_up::INT) AS voted_up_rate,
      avg(playtime) AS playtime_mean, median(playtime) AS playtime_median FROM interactions GROUP BY item_id)
    SELECT p_partkey AS item_id, p_retailprice AS price, p_size AS required_age, reviews_count,
      {r6('voted_up_rate')} AS voted_up_rate, {r6('playtime_mean')} AS playtime_mean, {r6('playtime_median')} AS playtime_median
    FROM part LEFT JOIN a ON p_partkey = a.item_id""",
)
def numeric_column_set(spark, folder):
    """The numeric set with review aggregates, cut to what this catalog holds."""
    from shelfscout.operators.reviews import item_aggregates, with_item_aggregates

    catalog = tables.catalog(spark, folder).withColumnRenamed("size", "required_age")
    joined = with_item_aggregates(catalog, item_aggregates(tables.interactions(spark, folder), "item_id"), "item_id")
    held = [c for c in numeric.numeric_column_set(with_reviews=True) if c in joined.columns]
    rates = {"voted_up_rate", "playtime_mean", "playtime_median"}
    return joined.select("item_id", *[S.rounded(c).alias(c) if c in rates else F.col(c) for c in held])


TOKENS = f"""{CATALOG}, tokens AS (
  SELECT item_id, 'genres__' || lower(unnest({parse_labels('genres')})) AS token FROM catalog UNION ALL
  SELECT item_id, 'categories__' || lower(unnest({parse_labels('categories')})) FROM catalog UNION ALL
  SELECT item_id, 'tags__' || lower(unnest({parse_labels('tags')})) FROM catalog UNION ALL
  SELECT item_id, 'developers__' || lower(unnest({parse_labels('developers')})) FROM catalog UNION ALL
  SELECT item_id, 'publishers__' || lower(unnest({parse_labels('publishers')})) FROM catalog UNION ALL
  SELECT item_id, 'supported_languages__' || lower(unnest({parse_labels('supported_languages')})) FROM catalog UNION ALL
  SELECT item_id, 'full_audio_languages__' || lower(unnest({parse_labels('full_audio_languages')})) FROM catalog),
vocab AS (SELECT token, n, (row_number() OVER (ORDER BY token) - 1)::INT AS idx FROM (
  SELECT token, count(*) AS n FROM tokens GROUP BY token HAVING count(*) >= 20 ORDER BY n DESC, token LIMIT 100))"""


@query("tokens_in_vocab", f"WITH {TOKENS} SELECT item_id, token FROM tokens WHERE token IN (SELECT token FROM vocab)")
def tokens_in_vocab(spark, folder):
    from shelfscout.sources.schema import LABEL_COLUMNS

    tokens = labels.item_tokens(tables.catalog(spark, folder), "item_id", LABEL_COLUMNS)
    return labels.in_vocabulary(tokens, labels.vocabulary(tokens, 20, 100)).select("item_id", "token")
