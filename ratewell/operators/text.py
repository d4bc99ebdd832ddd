"""Text profiles, the vocabulary and token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewell.functions.hashing import hex_prefix
from ratewell.functions.text import (
    attention_mask,
    pad_tokens,
    text_length,
    truncate_tokens,
    word_tokens,
)
from ratewell.operators.joins import HOT_MIN_ROWS, HOT_SHARE, lookup_join
from ratewell.schemas import MAX_TOKENS

PAD_ID, UNKNOWN_ID, FIRST_TOKEN_ID = 0, 1, 2
BUCKET_DIGITS = 4
#: Tokens of a text that are gathered at a time.
PART = 4096


def text_length_profile(rows: DataFrame, text: str = "text") -> DataFrame:
    """One row: mean, smallest and largest text length in characters."""
    length = text_length(text)
    return rows.agg(
        F.avg(length).alias("avg_text_len"),
        F.min(length).alias("min_text_len"),
        F.max(length).alias("max_text_len"),
    )


def token_coverage(rows: DataFrame, text: str = "text", max_len: int = MAX_TOKENS) -> DataFrame:
    """One row: share of texts within ``max_len`` words, and the 95th percentile of word counts.

    Texts are first counted per length, so the exact percentile reads one row per length.
    """
    lengths = (
        rows.select(F.size(word_tokens(text)).alias("words"))
        .groupBy("words")
        .agg(F.count(F.lit(1)).alias("texts"))
    )
    within = F.sum(F.when(F.col("words") <= max_len, F.col("texts")).otherwise(0))
    return lengths.agg(
        F.sum("texts").alias("texts"),
        (within / F.sum("texts")).alias("share_within"),
        F.percentile("words", 0.95, F.col("texts")).alias("p95_words"),
    )


def tokenize_truncate_pad(rows: DataFrame, text: str = "text", max_len: int = MAX_TOKENS) -> DataFrame:
    """Add ``n_tokens`` (of the whole text), ``tokens`` (``max_len`` entries) and ``attention_mask``."""
    words = rows.withColumn("_words", word_tokens(text))
    return words.select(
        *rows.columns,
        F.size("_words").alias("n_tokens"),
        pad_tokens("_words", max_len).alias("tokens"),
        attention_mask("_words", max_len).alias("attention_mask"),
    )


def token_counts(rows: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences per token over whole texts, combined on the map side."""
    return (
        rows.select(F.explode(word_tokens(text)).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("token_count"))
    )


def vocabulary(rows: DataFrame, text: str = "text", min_count: int = 1) -> DataFrame:
    """``(token, token_count, token_id)`` with dense ids, most frequent first, ties by token hash.

    One global row number would sort the whole vocabulary in one task. Here tokens of one count
    are divided by the first digits of their hash into up to 65,536 even buckets; running totals
    over the bucket sizes give each bucket its first id, and tokens are ranked inside buckets.
    The running total over counts has one row per distinct count, at most the square root of
    twice the number of tokens.
    """
    tokens = token_counts(rows, text).filter(F.col("token_count") >= min_count)
    # Never null, and known to be so: else the join below would filter one of its two readers of
    # the token counts, and they could no longer share one stage.
    bucket = F.coalesce(hex_prefix(F.col("_hash"), BUCKET_DIGITS), F.lit(0))
    tokens = tokens.withColumn("_hash", F.md5("token")).withColumn("_bucket", bucket)
    sizes = tokens.groupBy("token_count", "_bucket").agg(F.count(F.lit(1)).alias("_size"))

    def before(window) -> F.Column:
        return F.coalesce(F.sum("_size").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    by_count = sizes.groupBy("token_count").agg(F.sum("_size").alias("_size"))
    by_count = by_count.select("token_count", before(Window.orderBy(F.desc("token_count"))).alias("_higher"))
    same_count = Window.partitionBy("token_count").orderBy("_bucket")
    by_bucket = sizes.select("token_count", "_bucket", before(same_count).alias("_earlier"))
    first = by_bucket.join(by_count, "token_count")
    in_bucket = Window.partitionBy("token_count", "_bucket").orderBy("_hash", "token")
    ranked = tokens.withColumn("_rank", F.row_number().over(in_bucket) - 1)
    token_id = F.lit(FIRST_TOKEN_ID) + F.col("_higher") + F.col("_earlier") + F.col("_rank")
    return ranked.join(first, ["token_count", "_bucket"]).select(
        "token", "token_count", token_id.cast("bigint").alias("token_id")
    )


def encode_token_ids(
    rows: DataFrame,
    vocab: DataFrame,
    row_id: str = "id",
    text: str = "text",
    max_len: int | None = None,
) -> DataFrame:
    """``(id, input_ids, attention_mask)`` of whole texts, or cut and padded to ``max_len`` where one is
    given; tokens outside the vocabulary get 1.

    ``vocab`` is a written ``vocabulary`` of any size: it is joined, and Spark's own size check
    decides how.
    """
    tokens = word_tokens(text)
    if max_len is not None:
        tokens = truncate_tokens(tokens, max_len)
    ids = ids_by_join(rows.select(row_id, tokens.alias("_tokens")), vocab, row_id)
    if max_len is None:
        mask = F.transform("_ids", lambda _: F.lit(1)).alias("attention_mask")
        return ids.select(row_id, F.col("_ids").alias("input_ids"), mask)
    return ids.select(
        row_id,
        pad_tokens("_ids", max_len, PAD_ID).alias("input_ids"),
        attention_mask("_ids", max_len).alias("attention_mask"),
    )


def ids_by_join(
    rows: DataFrame,
    vocab: DataFrame,
    row_id: str = "id",
    tokens: str = "_tokens",
    share: float = HOT_SHARE,
    min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """``(id, _ids)`` for a vocabulary of any size. Frequent words take the hot-key path of the
    lookup join, and a text is gathered again from its own tokens: in parts of ``PART`` tokens, so
    that one very long text is work for several tasks, and then from its parts."""
    exploded = rows.select(row_id, F.posexplode_outer(tokens).alias("_pos", "token"))
    known = vocab.select("token", "token_id")
    found = lookup_join(exploded, known, "token", share=share, min_rows=min_rows, row_id=row_id)
    token_id = F.coalesce("token_id", F.lit(UNKNOWN_ID).cast("bigint")).alias("token_id")
    entry = F.when(F.col("token").isNotNull(), F.struct("_pos", token_id))
    part = F.floor(F.col("_pos") / PART).alias("_part")
    parts = found.groupBy(row_id, part).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    part_ids = F.transform("_entries", lambda e: e["token_id"]).alias("_ids")
    parts = parts.select(row_id, F.struct(F.coalesce("_part", F.lit(0)).alias("_part"), part_ids).alias("_part_ids"))
    gathered = parts.groupBy(row_id).agg(F.array_sort(F.collect_list("_part_ids")).alias("_parts"))
    return gathered.select(row_id, F.flatten(F.transform("_parts", lambda p: p["_ids"])).alias("_ids"))
