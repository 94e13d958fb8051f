"""The training-data queries: name -> function and, where SQL can follow, name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfscout.llm import alignment, attention, decontaminate, html, mixing, pii, quality, sharding, simhash, topk, toxicity, trie, urls
from shelfscout.llm.common import named, table
from shelfscout.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(configure(spark), folder)

        run.__name__, run.__doc__ = name, function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_sharding")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards; id and shard count decide the shard."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    placed = sharding.shuffle_into_shards(docs)
    return placed.select(
        "doc_id",
        sharding.record_size(named("text")).alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        sharding.shard_of(named("doc_id"), sharding.SHARDS + 1).alias("grown_shard"),
        "bucket",
    )


@query("op2_simhash")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query("op3_url_filter")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict for every page's url."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict", "block_score")


@query(
    "op4_source_mix",
    """
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS size
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source),
weighted AS (
  SELECT source, s, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM sources),
filled AS (
  SELECT *, row_number() OVER o AS k, 3.0::DOUBLE * s / w AS ratio,
    ((sum(s) OVER () - coalesce(sum(3 * s) OVER p, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER p, 0))) AS l
  FROM weighted
  WINDOW o AS (ORDER BY 3.0::DOUBLE * s / w, source NULLS LAST),
    p AS (ORDER BY 3.0::DOUBLE * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(l, k) AS l FROM filled WHERE l <= ratio),
targets AS (SELECT source, s, least(w * level.l, (3 * s)::DOUBLE) AS target FROM filled, level),
drawn AS (
  SELECT doc_id, size, s AS source_size, target, CASE WHEN s > 0 THEN target / s ELSE 0 END AS rate,
    ('0x' || substr(md5('42|' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn""",
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    planned = mixing.plan_mix(docs)
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


@query("op5_lm_score")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """log10 probability of every document under the attention model and under the unigram base."""
    return attention.score_texts(table(spark, folder, "documents").select("doc_id", "text"))


@query("op6_html_text")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html.extract(spark, pages).select("page_id", "url", "text", "n_chars")


@query("op7_decontamination")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and how much of it."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, folder, "benchmark"))


@query("op8_quality")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Perplexity of every document and whether it stays."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return quality.judge(docs, table(spark, folder, "labels"), carry=False)


@query("op9_pii")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find_pii(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    base = F.array(*[F.lit(k.name) for k in pii.KINDS if k.base])
    counted = [pii.of_kind(spans, name).alias(f"n_{name}") for name in ("email", "ip", "card", "phone")]
    return found.select(
        "doc_id",
        *counted,
        F.sha2(pii.joined(F.filter(spans, lambda s: F.array_contains(base, s.getField("kind")))).cast("binary"), 256).alias("base_sha256"),
        pii.joined(spans).alias("spans"),
    )


@query(
    "op10_top_products",
    """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20""",
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector."""
    return topk.top_products(table(spark, folder, "embeddings").select("vec_id", "embedding"))


@query("op11_toxicity")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.judge_toxicity(docs, table(spark, folder, "labels"))


@query("op12_alignment")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of two tokenizers over every document."""
    return alignment.alignment_counts(table(spark, folder, "documents").select("doc_id", "text"), carry=["doc_id"])


@query(
    "op13_prefix_trie",
    """
WITH own AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
    md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT conv_id, text, digest, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS at FROM own),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
    xor(4294967295::BIGINT, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, b: list_reduce(
        list_prepend(xor(crc, b), range(8)),
        lambda a, i: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)))) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM placed)),
rebuilt AS (
  SELECT c.conv_id, p.at AS place, p.text, p.digest FROM convs c JOIN placed p ON p.conv_id = c.base AND p.at < c.h
  UNION ALL
  SELECT c.conv_id, p.at + 4, p.text, p.digest FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.at >= c.h),
paths AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS key,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY place)
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
nodes AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM paths GROUP BY depth, key),
above AS (SELECT *, left(key, 32 * greatest(depth - 1, 0)) AS parent_key FROM nodes),
children AS (SELECT parent_key AS key, count(*) AS n_children FROM above WHERE depth > 0 GROUP BY parent_key),
subtrees AS (
  SELECT p.key, sum((m.n_convs - 1) * m.words)::BIGINT AS saved_tokens, (count(*) - count(c.key))::BIGINT AS n_leaves
  FROM nodes m LEFT JOIN children c ON c.key = m.key JOIN paths p ON p.conv_id = m.conv_id AND p.depth <= m.depth
  GROUP BY p.key),
ends AS (
  SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(key, depth) AS key FROM paths GROUP BY conv_id) GROUP BY key)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens,
  sha256(coalesce(e.ids, '')) AS ends_sha256
FROM above a JOIN subtrees s ON s.key = a.key LEFT JOIN nodes p ON a.depth > 0 AND p.key = a.parent_key
LEFT JOIN children c ON c.key = a.key LEFT JOIN ends e ON e.key = a.key""",
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Prefix trie of the rebuilt conversations."""
    return trie.conversation_trie(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))
