"""License scans by diagonal voting, in DataFrame functions only."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Longer templates; a passage that covers enough of one gets its label.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "released under the mit license": "mit-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-text",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd-text",
    "you may not use this file except in compliance with the license": "apache-text",
    "this program is free software you can redistribute it and or modify it": "gpl-text",
    "mozilla public license": "mpl",
    "all rights reserved": "all-rights-reserved",
}
#: Words of a rolling gram; the shortest phrase has two.
GRAM = 2
#: Diagonals at most this far apart belong to one passage: that many words were put in or left out.
NEIGHBOURS = 2
#: A passage covers this share of a template's grams, and is at most this many times its length.
COVERAGE, STRETCH = 0.8, 1.5
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def template_grams(spark: SparkSession, phrases: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """A row per rolling gram of each template: its two words, its place, and the template's facts."""
    rows = []
    for exact, group in ((True, phrases), (False, templates)):
        for text, label in group.items():
            words = text.split()
            for place, (one, two) in enumerate(zip(words, words[1:])):
                flag = "true" if exact else "false"
                rows.append(f"('{text}', '{label}', {flag}, {len(words) - 1}, {place}, '{one}', '{two}')")
    names = "template, label, exact, grams, place, one, two"
    frame = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({names})")
    return frame.withColumn("gram", F.xxhash64("one", "two"))


def scan(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score``.

    Every rolling gram of every text is looked up among the template positions (a few hundred rows,
    broadcast). A hit votes for a diagonal, its place in the text less that in the template. A phrase
    stands where all its grams vote for one diagonal. For the longer templates the votes of
    neighbouring diagonals are merged, and a passage counts if it covers enough of the template
    without being much longer, or if one of its diagonals does so alone, whatever stray grams stand
    beside it. ``score`` is the largest coverage of such a passage or diagonal, 1 for a phrase.
    Only A-Z are lower-cased.

    Null text counts as empty: no words, null places, empty labels, score 0. Repeated rows give
    repeated results: a row is told apart by its place in the input. Columns other than ``doc_id``
    and ``text`` are ignored.
    """
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), ascii_uppercase, ascii_lowercase)
    words = F.array_remove(F.split(text, SEPARATORS), "")
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words.alias("words"))
    rows = rows.withColumn("n_words", F.size("words").cast("bigint"))
    # A text of fewer than two words keeps one place, so that its row stays.
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - GRAM, F.lit(0))))
    places = rows.select("doc_id", "row", "n_words", "words", at.alias("at"))
    here, there = F.get("words", F.col("at")), F.get("words", F.col("at") + 1)
    places = places.withColumns({"here": here, "there": there}).drop("words")
    places = places.withColumn("gram", F.when(F.col("there").isNotNull(), F.xxhash64("here", "there")))
    known = F.broadcast(template_grams(docs.sparkSession, phrases, templates))
    same = [places.gram == known.gram, F.col("here") == F.col("one"), F.col("there") == F.col("two")]
    hits = places.join(known, same[0] & same[1] & same[2], "left")
    hits = hits.where(F.col("template").isNotNull() | (F.col("at") == 0))
    facts = ["row", "doc_id", "n_words", "template", "label", "exact", "grams"]
    diagonals = hits.groupBy(*facts, (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.countDistinct("at").alias("votes"), F.min("at").alias("low"), F.max("at").alias("high")
    )
    longest = F.ceil(F.col("grams") * STRETCH)
    short = (F.col("high") - F.col("low") + 1) <= longest
    diagonals = diagonals.withColumn("alone", F.when(short, F.col("votes")).otherwise(0))
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    # Phrases keep their diagonals apart: each is a place of its own.
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    opens = F.when(F.col("exact") | gap.isNull() | (gap > NEIGHBOURS), 1).otherwise(0)
    passages = diagonals.withColumn("opens", opens)
    passages = passages.withColumn("passage", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    passages = passages.groupBy(*facts, "passage").agg(
        F.sum("votes").alias("votes"),
        F.max("alone").alias("alone"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("diagonal").alias("start"),
    )
    base = F.coalesce(F.col("exact") & (F.col("votes") == F.col("grams")), F.lit(False))
    together = F.when(F.col("high") - F.col("low") + 1 <= longest, F.col("votes")).otherwise(0)
    covered = F.when(F.col("exact"), 0).otherwise(F.greatest(together, F.col("alone")))
    share = F.least(F.coalesce(covered, F.lit(0)) / F.coalesce("grams", F.lit(1)), F.lit(1.0))
    similar, cover = share >= COVERAGE, F.when(base, 1.0).otherwise(share)
    return (
        passages.withColumns({"base": base, "similar": similar, "cover": cover})
        .groupBy("row", "doc_id", "n_words")
        .agg(
            F.count_if("base").alias("n_base"),
            F.min(F.when(F.col("base"), F.col("start").cast("bigint"))).alias("first_word"),
            F.max(F.when(F.col("base"), F.col("start").cast("bigint"))).alias("last_word"),
            F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
            F.array_join(
                F.array_sort(F.collect_set(F.when(F.col("base") | F.col("similar"), F.col("label")))), ","
            ).alias("labels"),
            F.max("cover").alias("score"),
        )
        .drop("row")
    )
