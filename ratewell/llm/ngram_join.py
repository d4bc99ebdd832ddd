"""Near-duplicate join on word 5-grams by chosen paths."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm import groups
from ratewell.llm.common import saved

#: Tokens of the fixed-size form of a set: position and value of so many MinHash values.
TOKENS = 64
#: Levels of splitting at most. Buckets are counted after every level; what is still together in a large
#: bucket after the last becomes one candidate group.
LEVELS = 10
#: A node this close to a large bucket's pivot has all its links among the nodes that are ``NEAR`` it, as
#: distances add up: 1 - 0.75 + 1 - 0.8 leaves a similarity of 0.55 to the pivot.
CLOSE, NEAR = 0.75, 0.3


def repeats(level: int) -> int:
    """So often, each time on its own paths, are the nodes of a large bucket split at a level after the first."""
    return 1 + level % 2


def chance(runs: int, levels: int, similarity: float = 0.8) -> float:
    """The chance that a pair at ``similarity`` meets in some bucket of the last of ``levels`` where its buckets
    were large at all others: ``runs`` times one level from the root, then ``repeats`` at every level.

    Through a level a pair goes as a branching process with one shared child on average does. The
    values that its two sketches share are the same in all runs, hence the mean over their number.
    """
    places = 1 / (similarity * TOKENS)
    found = 0.0
    for shared in range(TOKENS + 1):
        alive = 1.0
        for times in (*map(repeats, range(levels - 1, 0, -1)), runs):
            alive = 1 - (1 - alive * places) ** shared
            alive = 1 - (1 - alive) ** times
        found += math.comb(TOKENS, shared) * similarity**shared * (1 - similarity) ** (TOKENS - shared) * alive
    return found


def runs_for(recall: float) -> int:
    """Runs after which a pair at the threshold has met with a chance of ``recall``, whichever level its
    buckets are small at."""
    runs = 1
    while min(chance(runs, levels) for levels in range(1, LEVELS + 1)) < recall:
        runs += 1
    return runs


def child_paths(paths, sketches, similarity: float):
    """``(row, path)`` of the children: each path samples token positions, on average 1/similarity of
    them, and a node follows the values it has there, so that similar sets share a child."""
    import numpy as np

    from ratewell.llm.shingles import mix

    places = np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    drawn = mix(paths[:, None] ^ places)
    row, place = np.nonzero(drawn < np.uint64(int((1 << 64) / (similarity * TOKENS))))
    value = sketches[row, place].astype(np.uint64)
    return row, mix(mix(paths[row] + places[place]) ^ (value * np.uint64(0xC2B2AE3D27D4EB4F)))


def other_paths(paths, again: int) -> list:
    """``again`` arrays of starts that are unrelated to each other, equal where ``paths`` are equal."""
    import numpy as np

    from ratewell.llm.shingles import mix

    return [mix(paths ^ mix(np.full(1, 104729 * (k + 1), np.uint64))) for k in range(again)]


def split(rows: DataFrame, similarity: float, runs: int = 0, again: int = 1) -> DataFrame:
    """``(bucket, node)`` one level further down: below the root for each of ``runs``, or else below ``bucket``,
    ``again`` times by different paths. ``rows`` has ``node, sketch`` and, without runs, ``bucket``, the
    path so far."""

    def run(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            if not len(batch):
                continue
            sketches = np.stack([np.frombuffer(raw, np.uint32) for raw in batch["sketch"]])
            nodes = batch["node"].to_numpy()
            starts = [np.full(len(batch), 7919 * (r + 1), np.uint64) for r in range(runs)]
            for path in starts or other_paths(batch["bucket"].to_numpy(np.int64).view(np.uint64), again):
                row, path = child_paths(path, sketches, similarity)
                yield pd.DataFrame({"bucket": path.view(np.int64), "node": nodes[row]})

    columns = ["node", "sketch"] if runs else ["bucket", "node", "sketch"]
    return rows.select(*columns).mapInPandas(run, "bucket bigint, node bigint")


def with_agreement(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """``(node, pivot, agreement)``: the share of equal values of the two nodes' sketches."""

    def run(batches):
        import numpy as np

        for batch in batches:
            one, other = (
                np.array([np.frombuffer(raw, np.uint32) for raw in batch[c]]).reshape(len(batch), -1)
                for c in ("sketch", "pivot_sketch")
            )
            batch["agreement"] = groups.close_nodes(one, other) if len(batch) else np.zeros(0)
            yield batch[["node", "pivot", "agreement"]]

    known = sketches.select(F.col("node").alias("pivot"), F.col("sketch").alias("pivot_sketch"))
    rows = pairs.join(sketches, "node").join(known, "pivot").select("node", "pivot", "sketch", "pivot_sketch")
    return rows.mapInPandas(run, "node bigint, pivot bigint, agreement double")


def candidate_edges(nodes: DataFrame, similarity: float, recall: float) -> DataFrame:
    """Edges between nodes such that two similar nodes are connected with a chance of ``recall`` at least.

    In a large bucket a node is compared with the pivot once, however many buckets both share. Nodes close
    to it leave the bucket; for their sake all that are near the pivot are connected to it. A pivot
    that no other node is close to is connected to what looks like it. The others are split further.
    """
    sketches = nodes.select("node", "sketch")
    level, edges, small = split(sketches, similarity, runs_for(recall)), [], []
    for depth in range(1, LEVELS + 1):
        rows = saved(groups.counted_buckets(saved(level, "paths")), "buckets")
        small.append(rows.where(F.col("size") <= groups.SMALL).select("bucket", "node"))
        large = rows.where(F.col("size") > groups.SMALL).select("bucket", "node", "pivot")
        if large.isEmpty():
            break
        pairs = saved(with_agreement(large.select("node", "pivot").distinct(), sketches), "agreement")
        if depth == LEVELS:
            edges.append(pairs.select(F.col("node").alias("a"), F.col("pivot").alias("b")))
            break
        close = pairs.where(F.col("agreement") >= CLOSE)
        followed = close.where(F.col("node") != F.col("pivot")).select("pivot").distinct().withColumn("followed", F.lit(True))
        least = F.when(F.col("followed"), NEAR).otherwise(groups.LOOSE)
        near = pairs.join(followed, "pivot", "left").where(F.col("agreement") >= least)
        edges.append(near.select(F.col("node").alias("a"), F.col("pivot").alias("b")))
        apart = large.join(close.select("node", "pivot"), ["node", "pivot"], "left_anti").join(sketches, "node")
        level = split(apart, similarity, again=repeats(depth))
    # Small buckets of all levels together: sketches move once for all of them.
    out = reduce(DataFrame.unionByName, small).join(sketches, "node")
    return reduce(DataFrame.unionByName, edges, groups.small_bucket_edges(out))


def near_duplicates(docs: DataFrame, similarity: float = 0.8, recall: float = 0.999) -> DataFrame:
    """``(doc_id, class_id, copy_id, n_links)`` for every row: documents whose word 5-gram sets have a
    Jaccard similarity of at least ``similarity`` are linked.

    Equal sets are one node. Nodes are split recursively on sampled tokens that they share; small
    buckets are compared by brute force, and in large ones the nodes near the bucket's pivot form a
    candidate group while the others are split further. Enough runs are made that a pair at the
    threshold is found with a chance of ``recall``, whichever level its buckets become small at.
    Candidates are verified on whole sets.

    ``groups.linked`` states what null, empty and repeated texts give.
    """
    nodes, members = groups.nodes(docs, TOKENS)
    edges = candidate_edges(nodes, similarity, recall)
    return groups.linked(docs, nodes, members, edges, similarity)


def one_of_each(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """One document of each group of near duplicates: the row that has its class's id, and of several texts
    under that id the one that the class is named after.

    Rows of equal id and text are one document, of which one row stays. Documents without words
    stay, as they have no near duplicates. Texts that differ under one id, or without an id, stand or
    fall by themselves.
    """
    nodes, members = groups.nodes(docs, TOKENS)
    sets = groups.linked_sets(docs, nodes, candidate_edges(nodes, similarity, 0.999), similarity)
    named = sets.select(F.col("class_id").alias("kept_id"), F.col("class_key").alias("kept_key")).distinct()
    wordless = members.where(F.col("set_id").isNull()).select("doc_id", "text_key").distinct()
    kept = saved(named.union(wordless), "kept")
    same = docs.doc_id.eqNullSafe(kept.kept_id) & (groups.text_key(docs.text) == kept.kept_key)
    rows = docs.join(kept, same, "left_semi")
    # Combined before the shuffle, so that a row repeated very often is no single task's work.
    once = rows.groupBy("doc_id", groups.text_key(F.col("text")).alias("tie")).agg(F.first(F.struct("*")).alias("row"))
    return once.select("row.*")
