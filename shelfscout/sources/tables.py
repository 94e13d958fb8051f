"""The driver's star schema seen as catalog, interactions, texts and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    """``(user_id, item_id, voted_up, playtime)``: a line item is a vote of its customer on its part."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.col("l_returnflag") != "R").alias("voted_up"),
        F.col("l_quantity").alias("playtime"),
    )


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with their multi-label cells spelled the way the raw catalog spells them."""
    first, second = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    size = F.col("p_size").cast("string")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("['"), "p_type", F.lit("']")).alias("genres"),
        F.concat(F.lit("['"), "p_brand", F.lit("', \"Size "), size, F.lit('"; '), size, F.lit("]")).alias("categories"),
        F.concat(F.lit("{'"), first, F.lit("': "), size, F.lit(", '"), second, F.lit("': 7, "), size, F.lit("}")).alias("tags"),
        F.col("p_brand").alias("developers"),
        F.concat("p_type", F.lit("; "), "p_brand").alias("publishers"),
        F.when(F.col("p_size") % 2 == 0, F.lit("['English', 'German']")).otherwise(F.lit("[]")).alias("supported_languages"),
        F.when(F.col("p_size") % 3 == 0, F.lit("['English']")).alias("full_audio_languages"),
        F.concat(F.lit("A "), F.lower("p_type"), F.lit(" thing by "), "p_brand").alias("short_description"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("size"),
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label"
    )


def messy_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Event values as raw text with blanks, words and infinities among them."""
    value = F.col("value").cast("string")
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .when(F.col("user_id") % 7 == 0, F.lit("inf"))
        .when(F.col("user_id") % 11 == 0, F.lit(""))
        .when(F.col("event_type") == "click", F.concat(F.lit(" "), value))
        .otherwise(value)
        .alias("raw_value"),
        F.regexp_extract("props", r"(\d+)", 1).alias("raw_k"),
        F.when(F.col("event_type") == "purchase", F.lit("yes")).alias("raw_empty"),
    )


def raw_votes(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their vote in the many spellings a raw file may hold."""
    status = F.col("l_linestatus")
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("item_id"),
        F.when((F.col("l_returnflag") == "A") & (status == "O"), F.lit("True"))
        .when(F.col("l_returnflag") == "A", F.lit(" YES "))
        .when((F.col("l_returnflag") == "R") & (status == "O"), F.lit("0"))
        .when(F.col("l_returnflag") == "R", F.lit("not recommended"))
        .when(status == "O", F.lit("maybe"))
        .alias("raw_vote"),
    )


def raw_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates as text in two spellings, with junk in between."""
    day = F.col("o_orderdate")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("coming soon"))
        .when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "MMM d, yyyy"))
        .when(F.col("o_orderkey") % 3 == 1, F.date_format(day, "yyyy-MM-dd"))
        .alias("release_date"),
    )
