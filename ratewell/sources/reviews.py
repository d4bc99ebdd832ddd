"""Review-shaped views of the Parquet test tables, for queries, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.functions.text import review_text


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as reviews: user = customer, product = part and supplier, parent = part."""
    items = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    quantity = F.col("l_quantity")
    rating = F.when(quantity <= 4, 1).when(quantity <= 6, 2).when(quantity <= 10, 3).when(quantity <= 20, 4)
    no_user = (F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 7)
    purchased = F.when(F.col("l_returnflag") == "A", True).when(F.col("l_returnflag") == "R", False)
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.when(~no_user, F.col("o_custkey").cast("string")).alias("user_id"),
        F.concat_ws("-", "l_partkey", "l_suppkey").alias("prod_id"),
        F.col("l_partkey").cast("string").alias("parent_prod_id"),
        F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).alias("time"),
        (F.nullif(F.col("l_linenumber"), F.lit(1)) - 3).cast("int").alias("votes"),
        purchased.alias("purchased"),
        rating.otherwise(5).alias("rating"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Product information per parent product."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("parent_prod_id"),
        F.col("p_type").alias("main_category"),
        F.col("p_retailprice").alias("price"),
    )


def product_texts(spark: SparkSession, folder: str) -> DataFrame:
    """One text per parent product, from its name, brand and type."""
    title, comment = F.col("p_name"), F.concat_ws(" ", "p_brand", "p_type")
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("id"), title.alias("title"), comment.alias("comment")
    )
    return parts.select("id", review_text().alias("text"))


def text_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as review texts: the first line is the title, the rest the comment; a text of one
    line has no comment."""
    text = F.col("text")
    first_break = F.instr(text, "\n")
    title = F.when(first_break > 0, F.substring(text, F.lit(1), first_break - 1)).otherwise(text)
    comment = F.when(first_break > 0, F.substring(text, first_break + 1, F.length(text)))
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.nullif(title, F.lit("")).alias("title"),
        F.nullif(comment, F.lit("")).alias("comment"),
    )


def embedded(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings with a numeric target. The mask marks vectors with a first component from 0 up."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"),
        "embedding",
        F.col("label").cast("double").alias("rating"),
        (F.col("embedding")[0] >= 0).cast("int").alias("mask"),
        "label",
    )
