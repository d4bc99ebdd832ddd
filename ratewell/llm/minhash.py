"""MinHash fingerprints, and near duplicates by signature bands."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewell.llm import groups, shingles
from ratewell.llm.common import saved

#: Hash functions of a fingerprint, of whose minima it keeps a byte each.
FUNCTIONS = 128
#: Bands of a fingerprint: at a likeness of 0.8 two texts share none with a chance of 5e-8.
BANDS = 32
#: Ids are dealt to ranges of so many rows on average, but to at most ``MOST_RANGES`` ranges, whose
#: bounds are quantiles of about ``SAMPLED`` ids a range.
RANGE_ROWS, MOST_RANGES, SAMPLED = 4_000, 10_000, 64


def bytes_of(texts: list[str]):
    """Fingerprints as rows of bytes."""
    return (shingles.signatures(texts, FUNCTIONS) & 0xFF).astype("uint8")


def likeness(one, other):
    """Estimated Jaccard similarity of two fingerprints (or rows of them), less the agreement by chance."""
    import numpy as np

    agree = (one == other).mean(-1)
    return np.clip((agree - 1 / 256) * 256 / 255, 0.0, 1.0)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint)`` per row, the fingerprint as hex digits."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            prints = [row.tobytes().hex() for row in bytes_of(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, fingerprint string")


def with_range(docs: DataFrame) -> DataFrame:
    """``docs`` with ``range``: ranges of ``doc_id`` follow each other and hold about equally many rows,
    however the ids lie. Null ids are range -1.

    The bounds come from a sample of ids; they only decide which task gets a row, so that no result
    depends on the sample. Equal ids, and those that doubles can't tell apart, share a range.
    """
    n = docs.count()
    ranges = max(1, min(n // RANGE_ROWS, MOST_RANGES))
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull()).sample(min(1.0, SAMPLED * ranges / max(n, 1)), seed=8)
    shares = [part / ranges for part in range(1, ranges)]
    found = ids.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0] if shares else None
    bounds = sorted({float(bound) for bound in found or []})
    known = F.col("doc_id").isNotNull()
    if not bounds:
        return docs.withColumn("range", F.when(known, 0).otherwise(-1))
    splits = [-math.inf, *bounds, math.inf]
    number = Bucketizer(splits=splits, inputCol="_place", outputCol="range", handleInvalid="keep")
    rows = number.transform(docs.withColumn("_place", F.col("doc_id").cast("double"))).drop("_place")
    return rows.withColumn("range", F.when(known, F.col("range").cast("int")).otherwise(-1))


def ranged(docs: DataFrame) -> DataFrame:
    """Rows in ascending ``doc_id`` (ties by a hash of the text, nulls first) within ranges that follow
    each other; the last row of a range is followed by a copy of the next range's first row, marked
    by ``halo``. The last range is followed by the first of all.

    Only ids are read to find the ranges, and of each range only its first key is broadcast.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = with_range(rows)
    # A struct orders by its first field; false before true puts null ids first.
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")
    firsts = saved(rows.groupBy("range").agg(F.min(key).alias("key")), "ranges")
    # One row per range, MOST_RANGES + 1 at most.
    order = Window.partitionBy(F.lit(0)).orderBy("range")
    all_of_them = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("range").over(order), F.last("range").over(all_of_them))
    halo = firsts.select("key.*", before.alias("before")).drop("known")
    halo = halo.withColumnsRenamed({"doc_id": "first_id", "tie": "first_tie"})
    match = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("tie") == F.col("first_tie"))
    rows = rows.join(F.broadcast(halo), match, "left")
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("halo"))
    copy = F.struct(F.col("before").alias("range"), F.lit(True).alias("halo"))
    places = F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy))
    rows = rows.select("doc_id", "text", "tie", F.explode(places).alias("place")).select("doc_id", "text", "tie", "place.*")
    return rows.repartition("range").sortWithinPartitions("range", "halo", "doc_id", "tie")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next one's, compared: ``(doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.

    The next document is the one that follows by ``doc_id``, ties by a hash of the text, null ids
    first; after the last comes the first, which for a single row is itself. Null texts count as
    empty. A text without words has a fingerprint of its own kind, equal to that of any other such
    text. Repeated rows follow each other. Columns other than ``doc_id`` and ``text`` are ignored;
    an empty table gives none. Tasks stream: a block of texts is in memory at a time.
    """

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        def rows():
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "range", "halo"))
                yield from zip(*columns)

        def compared(block, prints):
            """Rows of a block but the last, whose successor may be in the next block."""
            texts, edited = [], []
            for (_, text, part, halo), (_, after, next_part, _) in zip(block, block[1:]):
                half = len(text) // 2
                follows = part == next_part and not halo
                texts.append(follows)
                edited.append(text[: len(text) - half] + after[:half] if follows else "")
            other = bytes_of(edited)
            near_edited, near_next = likeness(prints[:-1], other), likeness(prints[:-1], prints[1:])
            kept = [i for i, follows in enumerate(texts) if follows]
            columns = [
                pa.array([block[i][0] for i in kept], kind),
                pa.array([len(block[i][1]) for i in kept], pa.int64()),
                pa.array([hashlib.sha256(edited[i].encode("utf-8", "replace")).hexdigest() for i in kept], pa.string()),
                pa.array([prints[i].tobytes().hex() for i in kept], pa.string()),
                pa.array([other[i].tobytes().hex() for i in kept], pa.string()),
                pa.array(near_edited[kept], pa.float64()),
                pa.array(near_next[kept], pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        block, prints, size, kind = [], np.zeros((0, FUNCTIONS), np.uint8), 0, pa.int64()
        for row in rows():
            block.append(row)
            size += len(row[1])
            if size >= shingles.CHUNK:
                prints = np.concatenate([prints, bytes_of([r[1] for r in block[len(prints) :]])])
                yield compared(block, prints)
                block, prints, size = block[-1:], prints[-1:], 0
        if len(block) > 1:
            prints = np.concatenate([prints, bytes_of([r[1] for r in block[len(prints) :]])])
            yield compared(block, prints)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    if docs.select("doc_id").isEmpty():
        rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.lit(0).alias("range"), F.lit(False).alias("halo"))
    else:
        rows = ranged(docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))).select("doc_id", "text", "range", "halo")
    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return rows.mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``(doc_id, class_id, n_links)`` by bands: documents that share a band of their fingerprints are
    compared, and a link needs a Jaccard similarity of their shingle sets of at least ``similarity``.

    Equal shingle sets are one node throughout, so copies are never paired with each other. The
    results are those of ``groups.linked``; see there for null, empty and repeated texts.
    """
    nodes, members = groups.nodes(docs, FUNCTIONS)
    rows = FUNCTIONS // BANDS

    def run(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            if not len(batch):
                continue
            prints = np.stack([np.frombuffer(raw, np.uint32) for raw in batch["sketch"]]) & 0xFF
            for band in range(BANDS):
                key = np.full(len(prints), band, np.int64)
                for row in range(rows):
                    key = key * 256 + prints[:, band * rows + row]
                yield pd.DataFrame({"bucket": key, "node": batch["node"]})

    buckets = nodes.select("node", "sketch").mapInPandas(run, "bucket bigint, node bigint")
    edges = groups.bucket_edges(saved(buckets, "bands"), nodes)
    return groups.linked(docs, nodes, members, edges, similarity)
