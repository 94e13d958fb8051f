"""Tag graph and user-item graph."""

from __future__ import annotations

from shelfscout.operators import graph, labels
from shelfscout.queries.cleaning import TOKENS
from shelfscout.queries.ranking import interaction_universe
from shelfscout.queries.registry import PAIRS, query
from shelfscout.sources import tables
from shelfscout.sources.schema import LABEL_COLUMNS

EDGES = f"""{TOKENS}, held AS (SELECT DISTINCT item_id, token FROM tokens),
edges AS (SELECT a.token AS token_a, b.token AS token_b, count(*) AS weight FROM held a JOIN held b ON a.item_id = b.item_id AND a.token < b.token
  GROUP BY ALL)"""


def edges(spark, folder):
    return graph.cooccurrence(labels.item_tokens(tables.catalog(spark, folder), "item_id", LABEL_COLUMNS))


@query("tag_cooccurrence", f"WITH {EDGES} SELECT * FROM edges")
def tag_cooccurrence(spark, folder):
    """Pairs of tokens with the number of items that hold both."""
    return edges(spark, folder)


@query(
    "tag_degrees",
    f"""WITH {EDGES} SELECT token, count(*) AS degree, sum(weight)::BIGINT AS weighted_degree FROM (
      SELECT token_a AS token, weight FROM edges UNION ALL SELECT token_b, weight FROM edges) GROUP BY token""",
)
def tag_degrees(spark, folder):
    return graph.weighted_degree(edges(spark, folder))


@query(
    "bipartite_degrees",
    f"""WITH {PAIRS}, d AS (SELECT 'user' AS side, count(*) AS degree FROM pairs GROUP BY user_id UNION ALL
      SELECT 'item', count(*) FROM pairs GROUP BY item_id) SELECT side, degree, count(*) AS n_nodes FROM d GROUP BY ALL""",
)
def bipartite_degrees(spark, folder):
    """Degree distribution of both sides of the graph of positive pairs."""
    return graph.bipartite_degrees(interaction_universe(spark, folder))
