"""Schemas and fixed values of the review data model."""

from __future__ import annotations

from pyspark.sql import types as T

# The test schema is the train schema without the target.
TEST_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("prod_id", T.StringType()),
        T.StructField("parent_prod_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("comment", T.StringType()),
        T.StructField("time", T.LongType()),
        T.StructField("votes", T.IntegerType()),
        T.StructField("purchased", T.BooleanType()),
    ]
)
TRAIN_SCHEMA = T.StructType([*TEST_SCHEMA.fields, T.StructField("rating", T.IntegerType())])

# Encoded keys and the short prefix of their feature columns.
KEY_PREFIXES = {"user_id": "user", "prod_id": "prod", "parent_prod_id": "parent"}

# Separator, rating bounds, token limit, penalty grid and blend weights.
TEXT_SEPARATOR = " [SEP] "
RATING_MIN, RATING_MAX = 1.0, 5.0
MAX_TOKENS = 192
RIDGE_ALPHAS = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0)
BLEND_WEIGHTS = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8)
SPLIT_SEED = 42
