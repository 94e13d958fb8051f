"""Parsers, words, label blocks, TF-IDF and vector expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfscout.functions import scalars as S, tokens as T, vectors as V
from shelfscout.operators import labels, reduction, text
from shelfscout.operators.numeric import as_array, numeric_block
from shelfscout.queries.cleaning import LABEL_TEXT, TOKENS
from shelfscout.queries.registry import CATALOG, parse_labels, query, r6
from shelfscout.session import spill
from shelfscout.sources import tables
from shelfscout.sources.schema import LABEL_COLUMNS, SEGMENT_COLUMNS

CELLS = ["genres", "categories", "tags", "full_audio_languages"]
PLAIN, BRACES = "[\\[\\]''\"]", "[\\[\\]{}''\"]"


def _joined(parser: str) -> str:
    return ", ".join(f"array_to_string({parser.format(c)}, '|') AS {c}" for c in CELLS)


def _sql_cell(strip: str, digits: bool) -> str:
    parsed = parse_labels("coalesce({0}, '')", strip.replace("{", "{{").replace("}", "}}"))
    return parsed if digits else f"list_filter({parsed}, lambda t: NOT regexp_matches(t, '^[0-9]+$'))"


@query("multilabel_features", f"WITH {CATALOG} SELECT item_id, {_joined(_sql_cell(PLAIN, True))} FROM catalog")
def multilabel_features(spark, folder):
    return tables.catalog(spark, folder).select("item_id", *[F.array_join(T.labels(c), "|").alias(c) for c in CELLS])


@query("multilabel_clustering", f"WITH {CATALOG} SELECT item_id, {_joined(_sql_cell(BRACES, False))} FROM catalog")
def multilabel_clustering(spark, folder):
    return tables.catalog(spark, folder).select(
        "item_id", *[F.array_join(T.segment_labels(c), "|").alias(c) for c in CELLS]
    )


@query(
    "multilabel_text",
    f"WITH {CATALOG} SELECT item_id, {', '.join(f'{LABEL_TEXT.format(c)} AS {c}' for c in CELLS)} FROM catalog",
)
def multilabel_text(spark, folder):
    return tables.catalog(spark, folder).select("item_id", *[T.label_text(c).alias(c) for c in CELLS])


@query("prefixed_tokens", f"WITH {TOKENS} SELECT item_id, token FROM tokens")
def prefixed_tokens(spark, folder):
    return labels.item_tokens(tables.catalog(spark, folder), "item_id", LABEL_COLUMNS)


@query(
    "tag_votes",
    """SELECT p_partkey AS item_id, split_part(p_name, ' ', 1) AS tag, p_size AS votes FROM part UNION ALL
    SELECT p_partkey, split_part(p_name, ' ', 2), 7 FROM part""",
)
def tag_votes(spark, folder):
    return tables.catalog(spark, folder).select("item_id", F.explode(T.tag_votes("tags")).alias("tag", "votes"))


WORDS = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]{2,}')"
TERMS = f"""w AS (SELECT doc_id, {WORDS} AS w FROM documents),
grams AS (
  SELECT doc_id, unnest(w) AS token FROM w UNION ALL
  SELECT doc_id, unnest(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) FROM w),
terms AS (SELECT doc_id, token, count(*) AS tf FROM grams GROUP BY ALL)"""


@query("tokenize_words", f"SELECT doc_id, len({WORDS})::INT AS n, md5(array_to_string({WORDS}, ' ')) AS words_md5 FROM documents")
def tokenize_words(spark, folder):
    tokens = tables.documents(spark, folder).select("doc_id", T.words("text").alias("w"))
    return tokens.select("doc_id", F.size("w").alias("n"), F.md5(F.array_join("w", " ").cast("binary")).alias("words_md5"))


@query("ngrams_1_2", f"WITH {TERMS} SELECT token, count(*) AS n FROM grams GROUP BY token")
def ngrams_1_2(spark, folder):
    grams = tables.documents(spark, folder).select(F.explode(T.ngrams_1_2(T.words("text"))).alias("token"))
    return grams.groupBy("token").agg(F.count("*").alias("n"))


@query("document_frequency", f"WITH {TERMS} SELECT token, count(*) AS df, sum(tf)::BIGINT AS n FROM terms GROUP BY token")
def document_frequency(spark, folder):
    return text.document_frequency(text.term_counts(tables.documents(spark, folder), "doc_id"))


VOCABULARY = f"""{TERMS},
vocab AS (SELECT token, df, n, (row_number() OVER (ORDER BY token) - 1)::INT AS idx FROM (
  SELECT token, count(*) AS df, sum(tf)::BIGINT AS n FROM terms GROUP BY token
  HAVING count(*) >= 3 AND count(*) <= 0.95::DOUBLE * (SELECT count(*) FROM documents) ORDER BY n DESC, token LIMIT 5000)),
weighted AS (SELECT doc_id, t.token, idx, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w
  FROM terms t JOIN vocab v ON t.token = v.token)"""


@query("text_vocabulary", f"WITH {VOCABULARY} SELECT token, df, n, idx FROM vocab")
def text_vocabulary(spark, folder):
    return text.text_block(tables.documents(spark, folder), "doc_id")[1]


@query(
    "tfidf",
    f"WITH {VOCABULARY} SELECT doc_id, token, idx, {r6('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))')} AS weight FROM weighted",
)
def tfidf(spark, folder):
    weights, _ = text.text_block(tables.documents(spark, folder), "doc_id")
    return weights.withColumn("weight", S.rounded("weight"))


@query(
    "multi_hot",
    f"""WITH {TOKENS}, often AS (SELECT token, (row_number() OVER (ORDER BY token) - 1)::INT AS idx FROM (
      SELECT token FROM tokens GROUP BY token HAVING count(*) >= 20))
    SELECT DISTINCT item_id, t.token, idx FROM tokens t JOIN often v ON t.token = v.token""",
)
def multi_hot(spark, folder):
    """Every token of at least 20 occurrences has a column."""
    tokens = spill(labels.item_tokens(tables.catalog(spark, folder), "item_id", LABEL_COLUMNS), "tokens")
    return labels.multi_hot(tokens, labels.vocabulary(tokens, 20, None), "item_id")


SEGMENT_TOKENS = f"""{CATALOG}, seg AS (
  SELECT item_id, lower(unnest({parse_labels('genres', BRACES)})) AS token FROM catalog UNION ALL
  SELECT item_id, lower(unnest({parse_labels('categories', BRACES)})) FROM catalog UNION ALL
  SELECT item_id, lower(unnest({parse_labels('tags', BRACES)})) FROM catalog),
kept AS (SELECT token, (row_number() OVER (ORDER BY token) - 1)::INT AS idx FROM (
  SELECT token FROM seg WHERE NOT regexp_matches(token, '^[0-9]+$') GROUP BY token HAVING count(*) >= 30)),
cells AS (SELECT DISTINCT item_id, s.token, idx FROM seg s JOIN kept k ON s.token = k.token)"""


def tag_cells(spark, folder):
    catalog = tables.catalog(spark, folder).where(T.has_tags("tags"))
    tokens = spill(labels.item_tokens(catalog, "item_id", SEGMENT_COLUMNS, prefix=False, parser=T.segment_labels), "tags")
    vocab = labels.vocabulary(tokens, 30, None)
    return labels.multi_hot(tokens, vocab, "item_id"), vocab


@query("tag_matrix", f"WITH {SEGMENT_TOKENS} SELECT * FROM cells")
def tag_matrix(spark, folder):
    return tag_cells(spark, folder)[0]


@query(
    "matrix_shapes",
    f"""WITH {VOCABULARY}, {SEGMENT_TOKENS.strip()}
    SELECT 'text' AS block, (SELECT count(*) FROM documents) AS n_rows, (SELECT count(*) FROM vocab) AS n_columns, count(*) AS nnz FROM weighted
    UNION ALL SELECT 'tags', (SELECT count(*) FROM part), (SELECT count(*) FROM kept), count(*) FROM cells
    UNION ALL SELECT 'numeric', (SELECT count(*) FROM part), 2, 2 * (SELECT count(*) FROM part)""",
)
def matrix_shapes(spark, folder):
    docs, catalog = tables.documents(spark, folder), tables.catalog(spark, folder)
    weights, vocab = text.text_block(docs, "doc_id")
    cells, kept = tag_cells(spark, folder)
    numeric = as_array(numeric_block(catalog, "item_id", ["price", "size"]), "item_id", ["price", "size"])
    dense = numeric.select("item_id", F.posexplode("vec").alias("idx", "value"))
    blocks = [
        ("text", weights, "doc_id", docs.count(), vocab.count()),
        ("tags", cells, "item_id", catalog.count(), kept.count()),
        ("numeric", dense, "item_id", catalog.count(), 2),
    ]
    shapes = [
        labels.matrix_density(cells_, key, "idx", rows, columns).select(F.lit(name).alias("block"), "n_rows", "n_columns", "nnz")
        for name, cells_, key, rows, columns in blocks
    ]
    return shapes[0].unionByName(shapes[1]).unionByName(shapes[2])


EMB = "emb AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec, label FROM embeddings)"


@query(
    "l2_normalize",
    f"""WITH {EMB}, l AS (SELECT id, unnest(vec) AS x, generate_subscripts(vec, 1) - 1 AS dim, sqrt(list_dot_product(vec, vec)) AS n FROM emb)
    SELECT id, dim::INT AS dim, {r6('CASE WHEN n > 0 THEN x / n ELSE x END')} AS value FROM l""",
)
def l2_normalize(spark, folder):
    rows = tables.vectors(spark, folder).select("id", F.posexplode(V.unit("vec")).alias("dim", "value"))
    return rows.withColumn("value", S.rounded("value"))


@query(
    "vector_math",
    f"""WITH {EMB}, c AS (SELECT list(m ORDER BY dim) AS centre FROM (
      SELECT dim, avg(x) AS m FROM (SELECT unnest(vec) AS x, generate_subscripts(vec, 1) AS dim FROM emb) GROUP BY dim)),
    s AS (SELECT id, list_dot_product(vec, centre) AS dot, sqrt(list_dot_product(vec, vec)) AS norm,
      list_cosine_similarity(vec, centre) AS cosine, list_dot_product(vec, vec) - 2 * list_dot_product(vec, centre)
      + list_dot_product(centre, centre) AS d2 FROM emb, c)
    SELECT id, {r6('dot')} AS dot, {r6('norm')} AS norm, {r6('cosine')} AS cosine, {r6('d2')} AS d2,
      {r6('(dot - min(dot) OVER ()) / (max(dot) OVER () - min(dot) OVER () + 1e-9::DOUBLE)')} AS scaled FROM s""",
)
def vector_math(spark, folder):
    """Each vector against the mean of all."""
    rows = tables.vectors(spark, folder)
    width = rows.select(F.size("vec")).first()[0]
    mean = rows.agg(F.array(*[F.avg(F.col("vec")[j]) for j in range(width)])).first()[0]
    against = rows.select("id", "vec", F.lit(list(mean)).alias("centre")).select(
        "id",
        V.dot("vec", "centre").alias("dot"),
        V.norm("vec").alias("norm"),
        V.cosine("vec", "centre").alias("cosine"),
        V.squared_distance("vec", "centre").alias("d2"),
    )
    ends = against.agg(F.min("dot").alias("low"), F.max("dot").alias("high")).first()
    scaled = against.withColumn("scaled", V.min_max(F.col("dot"), ends["low"], ends["high"]))
    return scaled.select("id", *[S.rounded(c).alias(c) for c in ("dot", "norm", "cosine", "d2", "scaled")])


NUMERIC_LINES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})')} AS corr FROM lineitem"
        for i, a in enumerate(NUMERIC_LINES)
        for b in NUMERIC_LINES[i:]
    ),
)
def correlation_matrix(spark, folder):
    found = reduction.correlation_matrix(tables.table(spark, folder, "lineitem"), NUMERIC_LINES)
    return found.withColumn("corr", S.rounded("corr"))
