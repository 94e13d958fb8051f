"""Column lists of the catalog and the review files."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names of the input files.
NUMERIC_COLUMNS = [
    "required_age",
    "price",
    "dlc_count",
    "metacritic_score",
    "achievements",
    "recommendations",
    "user_score",
    "score_rank",
    "positive",
    "negative",
    "estimated_owners",
    "average_playtime_forever",
    "average_playtime_2weeks",
    "median_playtime_forever",
    "median_playtime_2weeks",
    "peak_ccu",
    "pct_pos_total",
    "num_reviews_total",
    "pct_pos_recent",
    "num_reviews_recent",
]
PLATFORM_COLUMNS = ["windows", "mac", "linux"]
DATE_COLUMNS = ["release_year", "release_month", "release_age_days"]
REVIEW_COLUMNS = ["reviews_count", "voted_up_rate", "playtime_mean", "playtime_median"]
LABEL_COLUMNS = [
    "genres",
    "categories",
    "tags",
    "developers",
    "publishers",
    "supported_languages",
    "full_audio_languages",
]
SEGMENT_COLUMNS = ["genres", "categories", "tags"]
TEXT_COLUMNS = ["name", "short_description", "about_the_game", "detailed_description"]
ITEM_KEY = "AppID"

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("recommendationid", T.LongType()),
        T.StructField("author_steamid", T.StringType()),
        T.StructField("voted_up", T.BooleanType()),
        T.StructField("author_playtime_forever", T.DoubleType()),
    ]
)

CATALOG_COLUMNS = [ITEM_KEY, *TEXT_COLUMNS, "release_date", *NUMERIC_COLUMNS, *PLATFORM_COLUMNS, *LABEL_COLUMNS]
