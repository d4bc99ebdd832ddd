"""URL filters: rules first, then the ratio of two character language models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewell.llm.common import platt, saved
from ratewell.operators.joins import lookup_join

#: Longest context in bytes.
ORDER = 5
#: Share of all gram rows from which a gram is hot.
HOT = 1e-4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: str = "url") -> dict[str, Column]:
    """``host`` (A-Z lower-cased) and ``path`` of a url; both empty without ``://`` or for null."""
    text = F.coalesce(F.col(url), F.lit(""))
    host = F.translate(F.regexp_extract(text, "://([^/?#]*)", 1), UPPER, LOWER)
    return {"host": host, "path": F.regexp_extract(text, "://[^/?#]*([^?#]*)", 1)}


def rule_columns(rules: list[tuple[str, str, str]]) -> dict[str, Column]:
    """``rule`` and ``ruled`` (its verdict) from ``host`` and ``path``; the longest matching rule wins,
    null where none fits. Rules are ``(verdict, host, path)``: a short list, part of the plan."""
    found = []
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        inside = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        found.append((inside & F.col("path").startswith(path), host + path, verdict))
    rule = F.coalesce(*[F.when(fits, F.lit(name)) for fits, name, _ in found], F.lit(None).cast("string"))
    ruled = F.coalesce(*[F.when(fits, F.lit(verdict)) for fits, _, verdict in found], F.lit(None).cast("string"))
    return {"rule": rule, "ruled": ruled}


def grams(rows: DataFrame) -> DataFrame:
    """``(row, label, gram, n)`` of ``(row, url, label)``: how often each byte follows each longest context in
    a url. A gram is a whole number of ``ORDER`` + 1 bytes, the context before its byte, so none shares a cell.

    Each url starts with as many blanks as the longest context and ends with a line break.
    """

    def run(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            if not len(batch):
                continue
            raw = [b" " * ORDER + (url or "").encode("utf-8", "replace") + b"\n" for url in batch["url"]]
            block = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
            sizes = np.array([len(part) for part in raw])
            owner = np.repeat(np.arange(len(raw)), sizes)
            at = np.flatnonzero(np.arange(len(block)) - np.repeat(np.cumsum(sizes) - sizes, sizes) >= ORDER)
            gram = np.zeros(len(at), np.int64)
            for back in range(ORDER, -1, -1):
                gram = (gram << 8) | block[at - back]
            found, n = np.unique(np.stack([owner[at], gram]), axis=1, return_counts=True)
            label = batch["label"].to_numpy()[found[0]]
            yield pd.DataFrame({"row": batch["row"].to_numpy()[found[0]], "label": label, "gram": found[1], "n": n})

    return rows.select("row", "url", "label").mapInPandas(run, "row bigint, label int, gram bigint, n bigint")


def gram_ratios(found: DataFrame) -> DataFrame:
    """``(gram, rows, ratio)``, written: log-probability of each gram's byte under the accepted urls less that
    under the rejected ones, by smoothed models of order 0 to ``ORDER``. ``found`` is a written ``grams``,
    label 0 or 1 for urls that teach and -1 for others, and ``rows`` counts its rows.

    Witten-Bell smoothing: a context that was followed by many different bytes leaves more to the next
    shorter context. Counts are exact and stay in tables that grow with the distinct grams; a window
    holds one context's following bytes, 256 at most.
    """
    taught = [F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in (0, 1)]
    counts = saved(found.groupBy("gram").agg(F.count("*").alias("rows"), *taught), "url-grams-counted")
    shorter = None
    for level in range(ORDER + 1):
        ending = F.col("gram").bitwiseAND((1 << 8 * (level + 1)) - 1).alias("gram")
        part = counts.groupBy(ending).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        context = Window.partitionBy(F.shiftright("gram", 8))
        part = part.select("*", *(f(k).over(context).alias(f"{name}{k}") for k in (0, 1) for name, f in FACTS.items()))
        if shorter is None:
            part = part.withColumns({"p0": F.lit(1 / 256), "p1": F.lit(1 / 256)})
        else:
            part = part.withColumn("shorter", F.col("gram").bitwiseAND((1 << 8 * level) - 1)).join(shorter, "shorter")
        shorter = saved(part.select(F.col("gram").alias("shorter"), *map(smoothed, (0, 1))), "url-level")
    ratio = (F.log("p1") - F.log("p0")).alias("ratio")
    ratios = shorter.select(F.col("shorter").alias("gram"), ratio).join(counts.select("gram", "rows"), "gram")
    return saved(ratios.select("gram", "rows", "ratio"), "url-ratios")


#: Per label, over the bytes that follow a context: all occurrences and the number of different bytes.
FACTS = {"total": lambda k: F.sum(f"n{k}"), "kinds": lambda k: F.count_if(F.col(f"n{k}") > 0)}


def smoothed(k: int) -> Column:
    """The probability of a gram's byte for one label, from its counts and that of the shorter context."""
    n, total, kinds, p = (F.col(f"{name}{k}") for name in ("n", "total", "kinds", "p"))
    return F.when(total > 0, (n + kinds * p) / (total + kinds)).otherwise(p).alias(f"p{k}")


def margin_rows(rows: DataFrame) -> DataFrame:
    """``(row, margin)`` of ``(row, url, label)``: the log-likelihood under accepted urls less that under
    rejected ones, per byte. Grams with at least ``HOT`` of the rows, such as a scheme's, are broadcast,
    at most 1 / ``HOT`` of them; the others are joined."""
    found = saved(grams(rows), "url-grams")
    scored = lookup_join(found, gram_ratios(found), "gram", weight="rows", share=HOT, min_rows=1, row_id="row")
    return scored.groupBy("row").agg((F.sum(F.col("n") * F.col("ratio")) / F.sum("n")).alias("margin"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` for every row of ``pages``.

    A rule's verdict stands. All urls that a rule allows or blocks teach the two models, and a url
    without a rule is allowed if its length-normalised log-likelihood difference is above the
    calibrated threshold, where a logistic curve through all taught urls gives one half.

    Null and malformed urls have an empty host and path and are judged by the models on their text.
    Repeated rows are judged alike. Without urls of both verdicts there is no model, every score is
    one half and such urls are allowed. Columns other than ``page_id`` and ``url`` are ignored.
    """
    rows = pages.select("page_id", "url").withColumns(parts())
    rows = rows.withColumns(rule_columns(rules))
    label = F.when(F.col("ruled").isNull(), -1).otherwise((F.col("ruled") == "allow").cast("int")).alias("label")
    rows = saved(rows.select(F.monotonically_increasing_id().alias("row"), "*", label), "url-rows")
    kinds = {row[0] for row in rows.select("label").distinct().collect()} - {-1}
    if len(kinds) < 2:
        scored, score = rows, F.lit(0.5)
    else:
        scored = saved(rows.join(margin_rows(rows), "row"), "url-margins")
        slope, intercept = platt(scored.where("label >= 0"))
        z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("margin") * slope + intercept))
        score = 1 / (1 + F.exp(-z))
    scored = scored.withColumn("score", score)
    verdict = F.coalesce("ruled", F.when(F.col("score") >= 0.5, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
