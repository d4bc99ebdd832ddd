"""Batch encoding of texts into vectors, and the encoders that need no pretrained weights."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewell.functions.hashing import hex_prefix
from ratewell.functions.text import word_tokens

Encoder = Callable[[list[str]], np.ndarray]
_SPACE = re.compile(r"[ \t\n\x0b\f\r]+")


def encode_batches(
    rows: DataFrame,
    load_encoder: Callable[[], Encoder],
    row_id: str = "id",
    text: str = "text",
    batch_rows: int = 128,
) -> DataFrame:
    """``(id, embedding)``: ``load_encoder`` runs once per task, its encoder once per batch.

    Rows stay in their partition and carry their id, so the result needs no row order.
    """
    schema = T.StructType(
        [rows.schema[row_id], T.StructField("embedding", T.ArrayType(T.FloatType(), False))]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load_encoder()
        for batch in batches:
            for start in range(0, len(batch), batch_rows):
                part = batch.iloc[start : start + batch_rows]
                vectors = np.asarray(encode(part[text].fillna("").tolist()), dtype=np.float32)
                yield pd.DataFrame({row_id: part[row_id].to_numpy(), "embedding": list(vectors)})

    return rows.select(row_id, text).mapInPandas(run, schema)


def hashing_encoder(dim: int = 64) -> Callable[[], Encoder]:
    """A stateless encoder: the mean over the words of a signed unit vector chosen by the word's hash.

    It stands for a model that has to be loaded; ``hashed_embeddings`` gives the same vectors without Python.
    """

    def load() -> Encoder:
        @lru_cache(maxsize=1 << 18)
        def slot(word: str) -> tuple[int, float]:
            number = int(hashlib.md5(word.encode()).hexdigest()[:8], 16)
            return number % dim, 1.0 if (number // dim) % 2 == 0 else -1.0

        def encode(texts: list[str]) -> np.ndarray:
            vectors = np.zeros((len(texts), dim))
            for row, text in enumerate(texts):
                slots = [slot(word) for word in _SPACE.split(text.lower()) if word]
                if slots:
                    where, signs = zip(*slots)
                    vectors[row] = np.bincount(where, signs, dim) / len(slots)
            return vectors

        return encode

    return load


def hashed_embeddings(rows: DataFrame, dim: int = 64, row_id: str = "id", text: str = "text") -> DataFrame:
    """``(id, embedding)`` as ``hashing_encoder`` gives them, all in built-in functions.

    A text's words are added up per slot before anything moves, so at most ``dim`` numbers of a text
    shuffle. A text without words, or null, has a zero vector.
    """
    words = rows.select(row_id, F.explode_outer(word_tokens(text)).alias("_word"))
    number = hex_prefix(F.md5("_word"), 8)
    sign = F.when(F.floor(number / dim) % 2 == 0, 1).otherwise(-1)
    slots = words.groupBy(row_id, (number % dim).cast("int").alias("slot")).agg(
        F.sum(sign).alias("total"), F.count("_word").alias("n")
    )
    entry = F.when(F.col("slot").isNotNull(), F.struct("slot", "total"))
    summed = slots.groupBy(row_id).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_totals"), F.greatest(F.sum("n"), F.lit(1)).alias("_n")
    )
    share = F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda i: (F.coalesce(F.element_at("_totals", i), F.lit(0)) / F.col("_n")).cast("float"),
    )
    return summed.select(row_id, share.alias("embedding"))


def _slots(rows: DataFrame, dim: int, row_id: str, text: str) -> DataFrame:
    """``(id, slot, tf)``: how often a text's words fall into each hash slot."""
    words = rows.select(row_id, F.explode(word_tokens(text)).alias("_word"))
    slot = (hex_prefix(F.md5("_word"), 8) % dim).cast("int")
    return words.groupBy(row_id, slot.alias("slot")).agg(F.count(F.lit(1)).alias("tf"))


def tfidf_embeddings(
    rows: DataFrame, dim: int = 256, row_id: str = "id", text: str = "text", fit_on: DataFrame | None = None
) -> DataFrame:
    """``(id, embedding)`` by hashed term frequencies, weighted by ``ln((n + 1) / (df + 1))``.

    All in built-in functions. The fitted model is one weight per slot, ``dim`` rows; fit it on
    training rows. A text without words has a zero vector.
    """
    source = rows if fit_on is None else fit_on
    total = source.agg(F.count(F.lit(1))).scalar()
    weights = _slots(source, dim, row_id, text).groupBy("slot").agg(F.count(F.lit(1)).alias("df"))
    weights = weights.select("slot", F.log((total + 1) / (F.col("df") + 1)).alias("idf"))
    # At most one row per slot.
    found = _slots(rows, dim, row_id, text).join(F.broadcast(weights), "slot")
    entry = F.struct("slot", (F.col("tf") * F.col("idf")).alias("value"))
    lists = found.groupBy(row_id).agg(F.map_from_entries(F.collect_list(entry)).alias("_values"))
    filled = rows.select(row_id).join(lists, row_id, "left")
    values = F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.coalesce(F.element_at("_values", i), F.lit(0.0)).cast("float")
    )
    return filled.select(row_id, values.alias("embedding"))


def tfidf_slots(
    rows: DataFrame, dim: int = 1 << 18, row_id: str = "id", text: str = "text", fit_on: DataFrame | None = None
) -> DataFrame:
    """``(id, slots, values)``: the weights of ``tfidf_embeddings`` in as many slots as a sparse model
    can use, listed in ascending order for the slots a text has. A text without words has empty lists.
    """
    source = rows if fit_on is None else fit_on
    total = source.agg(F.count(F.lit(1))).scalar()
    counts = _slots(source, dim, row_id, text).groupBy("slot").agg(F.count(F.lit(1)).alias("df"))
    weights = counts.select("slot", F.log((total + 1) / (F.col("df") + 1)).alias("idf"))
    found = _slots(rows, dim, row_id, text).join(weights, "slot")
    entries = F.sort_array(F.collect_list(F.struct("slot", (F.col("tf") * F.col("idf")).alias("value"))))
    listed = rows.select(row_id).join(found.groupBy(row_id).agg(entries.alias("_entries")), row_id, "left")
    return listed.select(
        row_id,
        F.coalesce(F.col("_entries.slot"), F.array().cast("array<int>")).alias("slots"),
        F.coalesce(F.col("_entries.value"), F.array().cast("array<double>")).alias("values"),
    )
