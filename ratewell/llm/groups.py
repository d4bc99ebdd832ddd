"""Nodes, candidate edges, exact links and components, shared by the near-duplicate operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.llm import shingles
from ratewell.llm.common import saved, text_slices

#: Buckets of up to so many nodes are compared pair by pair, by sketch, in a small part of a second.
SMALL = 2048
#: Sketch agreement below which two nodes aren't taken for candidates. At a similarity of 0.8 the
#: agreement of 64 values is lower with a chance under 1e-5.
LOOSE = 0.55
#: A task verifies two blocks of about so many nodes, and shingles, at most.
BLOCK_NODES, BLOCK_SHINGLES = 500, 500_000


def text_key(text) -> Column:
    """Digest of a text; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")))


def nodes(docs: DataFrame, functions: int) -> tuple[DataFrame, DataFrame]:
    """``(node, set_id, copies, first_doc, first_key, size, sketch)`` per distinct non-empty shingle set, and
    ``(doc_id, text_key, set_id)`` per row; both written. ``sketch`` holds MinHash values, 32 bits each.

    ``text_key`` tells apart the texts of one id, or of no id; ``first_key`` is that of ``first_doc``'s text."""

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        for batch in text_slices(batches, shingles.CHUNK):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            sets = shingles.shingle_sets(texts)
            prints = shingles.signatures(texts, functions)
            columns = [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets], pa.string()),
                pa.array(np.array([len(s) for s in sets], np.int32), pa.int32()),
                pa.array([row.tobytes() for row in prints], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "set_id", "size", "sketch"])

    rows = docs.select("doc_id", text_key(docs.text).alias("text_key"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    rows = rows.mapInArrow(run, f"doc_id {kind}, text_key string, set_id string, size int, sketch binary")
    rows = saved(rows, "shingle-sets")
    found = rows.where(F.col("set_id").isNotNull()).groupBy("set_id")
    found = found.agg(
        F.count("*").alias("copies"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"),
        F.first("size").alias("size"),
        F.first("sketch").alias("sketch"),
    )
    first = (F.col("first.doc_id").alias("first_doc"), F.col("first.text_key").alias("first_key"))
    found = found.select(F.monotonically_increasing_id().alias("node"), "set_id", "copies", *first, "size", "sketch")
    return saved(found, "nodes"), rows.select("doc_id", "text_key", "set_id")


def close_nodes(one, other):
    """Share of equal values of two sketches, or of rows of them."""
    return (one == other).mean(-1)


def alike(prints):
    """For each row of ``prints`` a row of its component, where rows with enough equal values are linked."""
    import numpy as np

    n, width = prints.shape
    linked = np.zeros((n, n), bool)
    columns = np.ascontiguousarray(prints.T)
    for at in range(0, n, 64):
        equal = np.zeros((min(64, n - at), n), np.uint8 if width < 256 else np.uint32)
        for column in columns:
            equal += column[at : at + 64, None] == column
        linked[at : at + 64] = equal >= LOOSE * width
    root = np.full(n, -1)
    for first in range(n):
        if root[first] < 0:
            root[first], new = first, np.array([first])
            while len(new):
                new = np.flatnonzero(linked[new].any(0) & (root < 0))
                root[new] = first
    return root


def small_bucket_edges(buckets: DataFrame) -> DataFrame:
    """``(a, b)`` edges that connect the nodes of each bucket that look alike, at most one per node.
    ``buckets`` has ``bucket, node, sketch`` with at most ``SMALL`` rows per bucket."""

    def run(batches):
        import numpy as np
        import pandas as pd

        def edges(rows):
            rows = list(dict(rows).items())
            if len(rows) < 2:
                return
            names = [node for node, _ in rows]
            for i, root in enumerate(alike(np.stack([np.frombuffer(sketch, np.uint32) for _, sketch in rows]))):
                if i != root:
                    yield (max(names[i], names[root]), min(names[i], names[root]))

        last, rows = None, []
        for batch in batches:
            found = set()
            for bucket, node, sketch in zip(batch["bucket"], batch["node"], batch["sketch"]):
                if bucket != last and len(rows) > 1:
                    found.update(edges(rows))
                if bucket != last:
                    last, rows = bucket, []
                rows.append((node, sketch))
            yield pd.DataFrame(sorted(found), columns=["a", "b"])
        if len(rows) > 1:
            yield pd.DataFrame(sorted(set(edges(rows))), columns=["a", "b"])

    dealt = buckets.select("bucket", "node", "sketch").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInPandas(run, "a bigint, b bigint")


def counted_buckets(buckets: DataFrame) -> DataFrame:
    """Rows of buckets with at least two nodes, with the bucket's ``size`` and smallest node ``pivot``. Of small
    buckets with the same nodes, told by size, pivot and a sum over hashes, one is kept."""
    members = F.bit_xor(F.xxhash64("node")).alias("members")
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("pivot"), members)
    sizes = sizes.where(F.col("size") > 1)
    small = sizes.where(F.col("size") <= SMALL).groupBy("size", "pivot", "members").agg(F.min("bucket").alias("bucket"))
    sizes = small.select("bucket", "size", "pivot").unionByName(sizes.where(F.col("size") > SMALL).drop("members"))
    return buckets.join(sizes, "bucket")


def bucket_edges(buckets: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidate edges of ``(bucket, node)``: pairs by sketch in small buckets, and in larger ones an
    edge from every node to the smallest, which keeps all their links within one candidate group."""
    rows = saved(counted_buckets(buckets), "buckets")
    small = rows.where(F.col("size") <= SMALL).join(nodes.select("node", "sketch"), "node")
    large = rows.where((F.col("size") > SMALL) & (F.col("node") != F.col("pivot")))
    star = large.select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    return small_bucket_edges(small).unionByName(star)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``edges`` (``a``, ``b``): equal roots for connected nodes.

    Each round every node moves to its smallest neighbour by a hash of the id, and edges within a
    place vanish. The hash makes about half of the places vanish a round whatever the graph's shape.
    """

    def order(node):
        return F.struct(F.xxhash64(node).alias("hash"), F.col(node).alias("node"))

    edges = saved(edges.where(F.col("a") != F.col("b")).distinct(), "edges")
    found = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min(order("b")).alias("low"))
        moves = low.select(F.col("a").alias("node"), F.least(order("a"), "low").getField("node").alias("root"))
        moves = saved(moves, "moves")
        if found is None:
            found = moves
        else:
            onward = moves.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = found.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            found = saved(found, "roots")
        for side in ("a", "b"):
            step = moves.withColumnsRenamed({"node": side, "root": "moved"})
            edges = edges.join(step, side).drop(side).withColumnRenamed("moved", side)
        edges = saved(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found


def shared_counts(sets: list):
    """Matrix of the sizes of all intersections of ``sets``, sorted distinct hashes each."""
    import numpy as np

    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    cuts = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    often = np.diff(np.append(cuts, len(flat)))
    out = np.zeros(n * n, np.int64)
    # Shingles of few sets: every pair of their sets. Of many: a product of membership matrices.
    for times in range(2, min(16, n) + 1):
        if len(some := cuts[often == times]):
            members = owner[some[:, None] + np.arange(times)]
            for i in range(times - 1):
                for j in range(i + 1, times):
                    out += np.bincount(members[:, i] * n + members[:, j], minlength=n * n)
    out = out.reshape(n, n)
    out += out.T
    some = np.flatnonzero(often > 16)
    dense = np.zeros((n, n), np.float32)
    for at in range(0, len(some), 512):
        part = some[at : at + 512]
        member = np.zeros((n, len(part)), np.float32)
        for column, k in enumerate(part):
            member[owner[cuts[k] : cuts[k] + often[k]], column] = 1
        dense += member @ member.T
    return out + dense.astype(np.int64)


def block_links(rows: list[tuple], similarity: float, cross: bool):
    """``(node, root, links)`` for ``rows`` of ``(block, node, copies, set)``: the copies at a node's other
    ends, and a node of its component among these. With ``cross``, pairs of one block don't count."""
    import numpy as np

    sets, copies = [row[3] for row in rows], np.array([row[2] for row in rows])
    sizes = np.array([len(s) for s in sets])
    both = shared_counts(sets)
    linked = both >= similarity * (sizes[:, None] + sizes - both) - 1e-9
    np.fill_diagonal(linked, False)
    if cross:
        block = np.array([row[0] for row in rows])
        linked &= block[:, None] != block
    root = np.arange(len(rows))
    while True:
        low = np.minimum(root, np.where(linked, root, len(rows)).min(1, initial=len(rows)))
        low = low[low]
        if (low == root).all():
            break
        root = low
    return [(rows[i][1], rows[r][1], n) for i, (r, n) in enumerate(zip(root, (linked @ copies).tolist()))]


def linked(docs: DataFrame, nodes: DataFrame, members: DataFrame, edges: DataFrame, similarity: float) -> DataFrame:
    """``(doc_id, class_id, copy_id, n_links)`` for every row of ``docs``, from ``linked_sets``.

    Null texts count as empty; a text without words has no links and its own id as both ids. A text
    of fewer than five words has one shingle, all its words. Repeated rows are copies. Null ids are
    kept; they are a class's id only if it has no other.
    """
    out = members.join(linked_sets(docs, nodes, edges, similarity), "set_id", "left")
    alone = F.col("set_id").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def linked_sets(docs: DataFrame, nodes: DataFrame, edges: DataFrame, similarity: float) -> DataFrame:
    """Verify candidates exactly: ``(set_id, class_id, class_key, copy_id, n_links)`` for every shingle set.

    Candidate edges only tell which nodes to bring together; within a candidate group every pair is
    compared on whole shingle sets, in blocks, so that a group of any size is split among tasks and
    pairs never leave a task as rows. ``n_links`` counts the other rows whose similarity is at least
    ``similarity``, copies included. ``class_id`` is the smallest id that links lead to, ``copy_id``
    the smallest id with an equal shingle set. ``class_key`` tells which text of ``class_id`` is meant.
    """
    facts = nodes.select("node", "set_id", "copies", "first_doc", "first_key", "size")
    groups = components(edges).join(facts, "node")
    groups = saved(groups, "candidates")
    sizes = groups.groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_NODES), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    groups = groups.join(sizes.select("root", blocks.alias("blocks")), "root")
    groups = groups.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    texts = docs.select(F.col("doc_id").alias("id"), text_key(docs.text).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    # Both sides are dealt by id and text, so that rows without an id meet their own node only.
    same = texts.id.eqNullSafe(groups.first_doc) & (texts.key == groups.first_key)
    rows = texts.join(groups, same).select("root", "blocks", "block", "node", "copies", "set_id", "text")

    def to_sets(batches):
        import hashlib

        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in text_slices(batches, shingles.CHUNK):
            sets = [s.tobytes() for s in shingles.shingle_sets(batch.column("text").to_pylist())]
            right = [hashlib.blake2b(s, digest_size=16).hexdigest() for s in sets]
            keep = pc.equal(batch.column("set_id"), pa.array(right, pa.string()))
            names = ["root", "blocks", "block", "node", "copies"]
            columns = [*(batch.column(name) for name in names), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "hashes"]).filter(keep)

    rows = rows.mapInArrow(to_sets, "root bigint, blocks int, block int, node bigint, copies bigint, hashes binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tasks = rows.withColumn("other", other)
    tasks = tasks.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})

    def verify(batches):
        import numpy as np
        import pyarrow as pa

        def table(found):
            kinds = {"node": pa.int64(), "root": pa.int64(), "links": pa.int64(), "split": pa.bool_()}
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found), kinds.values())], [*kinds])

        def links(key, rows):
            # Repeated rows of one id bring a node's set twice.
            once = list({row[1]: row for row in rows}.values())
            return [(*found, key[3] > 1) for found in block_links(once, similarity, key[1] != key[2])]

        last, rows = None, []
        for batch in batches:
            found = []
            columns = (batch.column(c).to_pylist() for c in ("root", "low", "high", "blocks", "block", "node", "copies"))
            for *key, block, node, copies, hashes in zip(*columns, batch.column("hashes")):
                if key != last and rows:
                    found += links(last, rows)
                    rows = []
                last = key
                # A view of the batch, not a copy.
                rows.append((block, node, copies, np.frombuffer(hashes.as_buffer(), np.uint64)))
            if found:
                yield table(found)
        if rows:
            yield table(links(last, rows))

    dealt = tasks.select("root", "low", "high", "blocks", "block", "node", "copies", "hashes")
    dealt = dealt.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
    found = saved(dealt.mapInArrow(verify, "node bigint, root bigint, links bigint, split boolean"), "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    whole = found.where(~F.col("split")).select("node", "root")
    # Only groups that were split among tasks have parts to connect.
    parts = components(found.where("split").select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = whole.unionByName(parts)
    facts = facts.join(roots, "node", "left")
    facts = facts.withColumn("root", F.coalesce("root", "node")).join(counts, "node", "left")
    first = F.min(F.struct(F.col("first_doc").isNull().alias("none"), "first_doc", "first_key"))
    classes = facts.groupBy("root").agg(first.alias("first"))
    classes = classes.select("root", F.col("first.first_doc").alias("class_id"), F.col("first.first_key").alias("class_key"))
    links = (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    return facts.join(classes, "root").select("set_id", "class_id", "class_key", F.col("first_doc").alias("copy_id"), links)
