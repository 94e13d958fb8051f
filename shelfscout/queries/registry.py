"""Name -> query and name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

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


# Shared pieces of the SQL.

INTERACTIONS = """
interactions AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, l_returnflag <> 'R' AS voted_up, l_quantity AS playtime
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PAIRS = INTERACTIONS + """,
pairs AS (
  SELECT DISTINCT user_id, item_id FROM interactions
  WHERE voted_up AND item_id IN (SELECT p_partkey FROM part))"""

SPLIT = PAIRS + """,
held AS (
  SELECT user_id, item_id FROM (
    SELECT user_id, item_id, count(*) OVER (PARTITION BY user_id) AS n,
      row_number() OVER (PARTITION BY user_id ORDER BY md5('42|' || user_id || '|' || item_id), item_id) AS r
    FROM pairs) WHERE r = 1 AND n >= 2),
train AS (
  SELECT p.user_id, p.item_id FROM pairs p JOIN held h ON p.user_id = h.user_id AND p.item_id <> h.item_id)"""

CATALOG = """
catalog AS (
  SELECT p_partkey AS item_id, p_name AS name,
    '[''' || p_type || ''']' AS genres,
    '[''' || p_brand || ''', "Size ' || p_size || '"; ' || p_size || ']' AS categories,
    '{''' || split_part(p_name, ' ', 1) || ''': ' || p_size || ', ''' || split_part(p_name, ' ', 2) || ''': 7, ' || p_size || '}' AS tags,
    p_brand AS developers, p_type || '; ' || p_brand AS publishers,
    CASE WHEN p_size % 2 = 0 THEN '[''English'', ''German'']' ELSE '[]' END AS supported_languages,
    CASE WHEN p_size % 3 = 0 THEN '[''English'']' END AS full_audio_languages,
    'A ' || lower(p_type) || ' thing by ' || p_brand AS short_description,
    p_retailprice AS price, p_size AS size
  FROM part)"""

MESSY = """
messy AS (
  SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN NULL WHEN user_id % 7 = 0 THEN 'inf'::DOUBLE
      WHEN user_id % 11 = 0 THEN NULL ELSE value END AS parsed,
    regexp_extract(props, '(\\d+)', 1)::DOUBLE AS k
  FROM events),
finite AS (
  SELECT event_id, user_id, CASE WHEN isinf(parsed) THEN NULL ELSE parsed END AS value, k FROM messy)"""


def r6(expression: str) -> str:
    return f"round({expression}, 6) + 0.0"


def parse_labels(cell: str, strip: str = "[\\[\\]''\"]") -> str:
    """SQL for the multi-label parser."""
    return (
        f"list_filter(list_transform(string_split_regex(regexp_replace({cell}, '{strip}', '', 'g'), '[;,]'), "
        "lambda p: trim(p)), lambda p: p <> '')"
    )
