"""Text columns: review text, length, word tokens, fixed-length token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratewell.schemas import MAX_TOKENS, TEXT_SEPARATOR

PAD = "[PAD]"


def review_text(title: str = "title", comment: str = "comment", sep: str = TEXT_SEPARATOR) -> Column:
    """``title + sep + comment``; a null part counts as empty and the separator always stays."""
    return F.concat(F.coalesce(F.col(title), F.lit("")), F.lit(sep), F.coalesce(F.col(comment), F.lit("")))


def text_length(text: str | Column = "text") -> Column:
    return F.length(text)


def word_tokens(text: str | Column = "text") -> Column:
    """Lower-cased words of the whole text; an empty text has no words.

    Without a lambda, plans that tokenize the same texts twice compare as equal and share a stage.
    """
    words = F.split(F.lower(text), r"\s+")
    return F.array_remove(F.coalesce(words, F.array().cast("array<string>")), "")


def truncate_tokens(tokens: str | Column, max_len: int = MAX_TOKENS) -> Column:
    return F.slice(tokens, 1, max_len)


def pad_tokens(tokens: str | Column, max_len: int = MAX_TOKENS, pad: str | int = PAD) -> Column:
    """Exactly ``max_len`` entries: the first tokens, then padding."""
    kept = truncate_tokens(tokens, max_len)
    return F.concat(kept, F.array_repeat(F.lit(pad), F.lit(max_len) - F.size(kept)))


def attention_mask(tokens: str | Column, max_len: int = MAX_TOKENS) -> Column:
    """1 for a token, 0 for padding."""
    kept = F.least(F.size(tokens), F.lit(max_len))
    return F.concat(F.array_repeat(F.lit(1), kept), F.array_repeat(F.lit(0), F.lit(max_len) - kept))
