"""Result tables of the exploratory report on the enriched table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfscout.functions.scalars import strip, vote_label
from shelfscout.operators import numeric, reviews


def run_eda(enriched: DataFrame, top: int = 15, playtime: str = "playtime", vote: str = "voted_up") -> dict[str, DataFrame]:
    """Votes, raw vote spellings, playtime histogram, top names, their vote rate, top genres."""
    genres = F.transform(F.split(F.coalesce("genres", F.lit("")), ","), strip)
    counts = reviews.token_counts(enriched, genres, "genre")
    raw = enriched.select(F.lower(strip(F.col(vote).cast("string"))).alias("vote"))
    return {
        "votes": reviews.label_counts(enriched.select(vote_label(vote).alias("label")), "label"),
        "raw_votes": reviews.label_counts(raw, "vote", 10),
        "playtime": numeric.capped_histogram(enriched, playtime),
        "top_items": reviews.top_names(enriched, "name", top).orderBy("n", "name"),
        "vote_rates": reviews.vote_rate_of_top(enriched, "name", vote, top),
        "top_genres": counts.orderBy(F.desc("n"), "genre").limit(top).orderBy("n", "genre"),
    }
