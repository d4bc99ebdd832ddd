"""Prefix trie of conversations: a z-fast trie built in batches by joins.

A prefix is known by a 128-bit signature of its turns. The trie is compacted: a node is an edge of
turns down from its parent. Its handle is the prefix at the two-fattest depth of that edge, the one
divisible by the highest power of two, and a table from handles to nodes finds the edge at which a
conversation leaves the trie in as many lookups as its number of turns has binary digits.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewell.llm.common import placed, release, saved

#: Turns of an edge at most: longer conversations are strings of several layers, each with a root of its own.
SEGMENT = 1024
#: Conversations of up to so many turns are searched apart from longer ones, in four lookups.
SHORT = 15
#: Ids of a node's conversations that travel as one row.
CHUNK = 4096
#: Signature of the empty prefix.
ROOT = bytes(16)


def turns_of(rows: DataFrame) -> DataFrame:
    """``(conv_id, place, turn_key, chars)``: conversations in order of their turns, ``place`` from 1.

    Null turns come first; rows of one turn follow by the digest of role and text, repeated rows stay
    separate. Null roles and texts count as empty, rows without a conversation id take no part, other
    columns are ignored. Texts stay where they are: only their digest and length go on.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    turn_key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    conv_id = F.col("conv_id").cast("bigint").alias("conv_id")
    narrow = rows.select(conv_id, "turn", turn_key.alias("turn_key"), F.length(text).cast("bigint").alias("chars"))
    narrow = saved(narrow.where(F.col("conv_id").isNotNull()), "turns")
    return placed(narrow, ["turn", "turn_key"], "conv_id").drop("turn")


def with_shared_heads(turns: DataFrame, group: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as their group's first one does: ``(turns, conv_ids)``.

    Conversation c gets the first h turns of conversation c - c % ``group``, all if it has fewer, and
    then its own from the h-th on; h is the crc32 of c's digits modulo ``longest``. At most
    2 x ``group`` conversations share one head, each less than ``longest`` turns of it.
    """
    turns = saved(turns, "own-turns")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).alias("head")
    convs = convs.select("conv_id", "n", head, (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")).where(F.col("base") % group == 0)
    kept = F.least("head", F.coalesce("base_n", F.lit(0))).alias("kept")
    convs = saved(convs.join(bases, "base", "left").select("conv_id", "base", "head", kept), "conversations")
    own = turns.join(convs.select("conv_id", "head", "kept"), "conv_id").where(F.col("place") > F.col("head"))
    own = own.select("conv_id", (F.col("place") - F.col("head") + F.col("kept")).alias("place"), "turn_key", "chars")
    heads = turns.where(F.col("place") < longest).withColumnRenamed("conv_id", "base")
    lent = convs.where(F.col("kept") > 0).select("conv_id", "base", "kept").join(heads, "base")
    lent = lent.where(F.col("place") <= F.col("kept")).select("conv_id", "place", "turn_key", "chars")
    return own.unionByName(lent), convs.select("conv_id")


def strings_of(turns: DataFrame) -> DataFrame:
    """``(conv_id, layer, root, root_d, path)``: a string per conversation and ``SEGMENT`` turns; ``path`` has
    the signature ``k`` of every prefix that ends in it, and the characters ``d`` up to there; written.

    A signature is the exclusive or of a hash of each turn with its place, so that a conversation of any
    length is summed up piece by piece; ``root`` is the signature before the piece.
    """
    piece = F.floor((F.col("place") - 1) / SEGMENT).cast("int").alias("layer")
    hashes = [F.xxhash64(F.lit(seed), "place", "turn_key").alias(f"h{seed}") for seed in (1, 2)]
    rows = turns.select("conv_id", piece, "place", *hashes, "chars")
    upto = Window.partitionBy("conv_id", "layer").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    sums = {"h1": F.bit_xor("h1").over(upto), "h2": F.bit_xor("h2").over(upto), "chars": F.sum("chars").over(upto)}
    step = F.struct("place", "h1", "h2", "chars")
    pieces = rows.withColumns(sums).groupBy("conv_id", "layer").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    pieces = saved(pieces, "pieces")
    # Only later pieces need what came before them.
    long = pieces.where(F.col("layer") > 0).select("conv_id").distinct()
    last = F.element_at("steps", -1)
    before = Window.partitionBy("conv_id").orderBy("layer").rowsBetween(Window.unboundedPreceding, -1)
    ends = pieces.select("conv_id", "layer", last.alias("last")).join(long, "conv_id", "left_semi")
    offsets = ends.select(
        "conv_id",
        "layer",
        F.bit_xor("last.h1").over(before).alias("o1"),
        F.bit_xor("last.h2").over(before).alias("o2"),
        F.sum("last.chars").over(before).alias("od"),
    )
    later = pieces.where(F.col("layer") > 0).join(offsets.where(F.col("layer") > 0), ["conv_id", "layer"])
    none = {name: F.lit(0).cast("bigint") for name in ("o1", "o2", "od")}
    pieces = pieces.where(F.col("layer") == 0).withColumns(none).unionByName(later)

    def signature(one: Column, other: Column) -> Column:
        return F.unhex(F.concat(*(F.lpad(F.hex(h), 16, "0") for h in (one, other))))

    def entry(s: Column) -> Column:
        k = signature(s["h1"].bitwiseXOR(F.col("o1")), s["h2"].bitwiseXOR(F.col("o2")))
        return F.struct(k.alias("k"), (s["chars"] + F.col("od")).alias("d"))

    path = F.transform("steps", entry).alias("path")
    root = signature(F.col("o1"), F.col("o2")).alias("root")
    return saved(pieces.select("conv_id", "layer", root, F.col("od").alias("root_d"), path), "strings")


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    power = F.pow(F.lit(2), F.length(F.bin(low.bitwiseXOR(high))) - 1).cast("int")
    return (high - high % power).cast("int")


def located(active: DataFrame, nodes: DataFrame, lookups: int) -> DataFrame:
    """``active`` with ``x``, the depth at which each string leaves the trie, and ``exit``, the first
    signature of the edge within which it does, null at a node.

    The fat binary search keeps the deepest node whose handle the string has. The string may leave
    within that node's edge, or within that of a child whose handle lies deeper than it reaches, so the
    edge at that point is compared turn by turn.
    """
    handle = F.element_at("edge", two_fattest(F.col("top"), F.col("depth")) - F.col("top"))["k"]
    handles = nodes.select(
        handle.alias("probe"),
        F.col("key").alias("h_key"),
        F.col("top").alias("h_top"),
        F.col("depth").alias("h_depth"),
    )
    columns = [F.col(c) for c in active.columns]
    state = active.select(
        *columns,
        F.col("a").alias("low"),
        F.col("n").alias("high"),
        F.col("at").alias("v_key"),
        F.col("a").alias("v_top"),
        F.col("a").alias("v_depth"),
    )
    for _ in range(lookups):
        # Strings that have found their place probe their own end, so that they stay spread.
        seeking = F.col("low") < F.col("high")
        fat = F.when(seeking, two_fattest(F.col("low"), F.col("high"))).otherwise(F.col("n"))
        state = state.withColumn("fat", fat).withColumn("probe", F.element_at("path", F.col("fat"))["k"])
        state = state.join(handles, "probe", "left")
        hit = seeking & F.col("h_depth").isNotNull()
        state = state.select(
            *columns,
            F.when(hit, F.least("h_depth", "high")).otherwise(F.col("low")).alias("low"),
            F.when(seeking & ~hit, F.col("fat") - 1).otherwise(F.col("high")).alias("high"),
            *(F.when(hit, F.col(f"h_{c}")).otherwise(F.col(f"v_{c}")).alias(f"v_{c}") for c in ("key", "top", "depth")),
        )
    deep, n = F.col("v_depth"), F.col("n")
    reached = F.when(deep == F.col("a"), True).when(deep <= n, F.element_at("path", deep)["k"] == F.col("v_key"))
    p = F.when(F.coalesce(reached, F.lit(False)), deep).otherwise(F.col("v_top"))
    state = state.select(*columns, p.alias("p"))
    following = F.element_at("path", F.least(F.col("p") + 1, n))["k"]
    edges = nodes.select("first", F.col("depth").alias("e_depth"), "edge")
    state = state.withColumn("first", following).join(edges, "first", "left")
    on_edge = F.col("edge").isNotNull() & (F.col("p") < n)
    both = F.least(n - F.col("p"), F.size("edge"))
    equal = F.zip_with(
        F.slice("path", F.col("p") + 1, both), F.slice("edge", F.lit(1), both), lambda s, e: (s["k"] == e["k"]).cast("int")
    )
    x = F.col("p") + F.when(on_edge, F.aggregate(equal, F.lit(0), lambda total, one: total + one)).otherwise(0)
    state = state.select(*columns, "first", x.alias("x"), "p", F.col("e_depth"))
    inside = (F.col("x") > F.col("p")) & (F.col("x") < F.col("e_depth"))
    return state.select(*columns, "x", F.when(inside, F.col("first")).alias("exit"))


def split_edges(nodes: DataFrame, exits: DataFrame) -> DataFrame:
    """``nodes`` with a node at every depth ``x`` at which a string leaves within the edge ``exit``."""
    cuts = exits.where(F.col("exit").isNotNull()).groupBy(F.col("exit").alias("first"))
    cuts = cuts.agg(F.sort_array(F.collect_set("x")).alias("cuts"))
    nodes = nodes.join(cuts, "first", "left")
    bounds = F.concat(F.array("top"), F.coalesce("cuts", F.array().cast("array<int>")), F.array("depth"))
    nodes = nodes.withColumn("bounds", bounds)
    parts = F.transform(F.slice("bounds", F.lit(2), F.size("bounds") - 1), lambda high, i: F.struct(F.col("bounds")[i].alias("low"), high.alias("high")))
    nodes = nodes.withColumn("part", F.explode(parts))
    low, high = F.col("part.low"), F.col("part.high")
    above = F.element_at("edge", F.greatest(low - F.col("top"), F.lit(1)))
    kept = low == F.col("top")
    return nodes.select(
        "layer",
        F.when(kept, F.col("parent")).otherwise(above["k"]).alias("parent"),
        low.alias("top"),
        high.alias("depth"),
        F.when(kept, F.col("top_d")).otherwise(above["d"]).alias("top_d"),
        F.slice("edge", low - F.col("top") + 1, high - low).alias("edge"),
    ).transform(_named)


def _named(nodes: DataFrame) -> DataFrame:
    return nodes.select("layer", "parent", "top", "depth", "top_d", "edge", F.col("edge")[0]["k"].alias("first"), F.element_at("edge", -1)["k"].alias("key"))


def z_fast_trie(strings: DataFrame) -> DataFrame:
    """The compacted trie of ``strings_of``'s strings: ``(layer, parent, top, depth, top_d, edge, first, key)``
    for every node but the root, depths counted within the layer; written.

    A batch is searched as a whole. Edges are split where strings leave within them; of all strings that
    leave at one point by one turn one is put in with the rest of its turns as a new edge, and the others
    make the next batch, further down by at least one turn. The one is the longest in even batches and
    any, by a hash, in odd ones: each such batch leaves half of a group, on average, behind it.
    """
    end = F.element_at("path", -1)["k"]
    first = [F.first(c).alias(c) for c in ("layer", "root", "root_d", "path")]
    active = strings.groupBy(end.alias("end")).agg(*first)
    active = active.withColumns({"n": F.size("path"), "a": F.lit(0), "at": F.col("root"), "at_d": F.col("root_d")})
    active = saved(active.drop("root", "root_d"), "trie-strings")
    longest = active.agg(F.max("n")).first()[0] or 0
    kept, nodes, batch = list(active.columns), None, 0
    while True:
        if nodes is None:
            found = active.withColumns({"x": F.lit(0), "exit": F.lit(None).cast("binary")})
        else:
            found = located(active.where(F.col("n") <= SHORT), nodes, SHORT.bit_length())
            if longest > SHORT:
                long = located(active.where(F.col("n") > SHORT), nodes, longest.bit_length())
                found = found.unionByName(long)
        found = saved(found, "trie-located")
        rest = found.where(F.col("x") < F.col("n"))
        above = F.element_at("path", F.greatest("x", F.lit(1)))
        stays = F.col("x") == F.col("a")
        rest = rest.withColumns({
            "at": F.when(stays, F.col("at")).otherwise(above["k"]),
            "at_d": F.when(stays, F.col("at_d")).otherwise(above["d"]),
            "a": F.col("x"),
            "turn": F.element_at("path", F.col("x") + 1)["k"],
        })
        edge = F.slice("path", F.col("a") + 1, F.col("n") - F.col("a"))
        node = F.struct("layer", F.col("at").alias("parent"), F.col("a").alias("top"), F.col("n").alias("depth"), F.col("at_d").alias("top_d"), edge.alias("edge"))
        rank = F.struct(F.lit(0) if batch % 2 else -F.col("n"), F.xxhash64("end", F.lit(batch)), "end")
        added = rest.groupBy("turn").agg(F.min_by(node, rank).alias("node")).select("node.*")
        added = saved(_named(added), "trie-new")
        if nodes is None:
            nodes = added
        else:
            grown = saved(split_edges(nodes, found).unionByName(added), "trie-nodes")
            release(nodes)
            nodes = grown
        more = saved(rest.select(*kept).join(added.select(F.col("key").alias("end")), "end", "left_anti"), "trie-batch")
        release(active)
        release(found)
        active, batch = more, batch + 1
        if active.isEmpty():
            return nodes


def end_digests(ends: DataFrame) -> DataFrame:
    """``(key, n_ends, first, sha256)`` of ``(conv_id, key)``: how many conversations end at a node, the
    smallest, and the digest of their ids, ascending and joined by commas.

    Ids are joined in chunks of at most ``CHUNK`` where they lie sorted; the chunks of a node are hashed as
    a stream, so a node at which a third of all conversations end takes no more memory than any other.
    """

    def chunks(batches) -> Iterator:
        import pyarrow as pa

        key, ids, rows = None, [], []

        def done():
            if ids:
                rows.append((key, ids[0], len(ids), ",".join(map(str, ids))))

        def batch_of(rows):
            types = (pa.binary(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(types)]
            return pa.RecordBatch.from_arrays(columns, ["key", "low", "n", "ids"])

        for batch in batches:
            for conv_id, at in zip(batch.column("conv_id").to_pylist(), batch.column("key").to_pylist()):
                if at != key or len(ids) == CHUNK:
                    done()
                    key, ids = at, []
                ids.append(conv_id)
            yield batch_of(rows)
            rows.clear()
        done()
        yield batch_of(rows)

    def digests(batches) -> Iterator:
        import hashlib

        import pyarrow as pa

        key, n, first, hasher, rows = None, 0, None, None, []

        def batch_of(rows):
            types = (pa.binary(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(types)]
            return pa.RecordBatch.from_arrays(columns, ["key", "n_ends", "first", "sha256"])

        for batch in batches:
            for at, low, count, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "low", "n", "ids"))):
                if at != key:
                    if key is not None:
                        rows.append((key, n, first, hasher.hexdigest()))
                    key, n, first, hasher = at, 0, low, hashlib.sha256()
                else:
                    hasher.update(b",")
                hasher.update(ids.encode())
                n += count
            yield batch_of(rows)
            rows.clear()
        yield batch_of([(key, n, first, hasher.hexdigest())] if key is not None else [])

    dealt = ends.select("conv_id", "key").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    joined = dealt.mapInArrow(chunks, "key binary, low bigint, n bigint, ids string")
    joined = joined.repartition("key").sortWithinPartitions("key", "low")
    return joined.mapInArrow(digests, "key binary, n_ends bigint, first bigint, sha256 string")


def with_subtrees(nodes: DataFrame) -> DataFrame:
    """``nodes (key, parent, n, first, leaves, weighted, chars)`` with the sum (of ``first`` the least) of each
    over the node's subtree; written.

    In step i each node passes what it has gathered, from less than 2^i levels, to its ancestor 2^i levels
    up, so that a trie of any depth takes as many steps as its depth has binary digits.
    """
    sums = ("n", "leaves", "weighted", "chars")
    nodes = saved(nodes.withColumnRenamed("parent", "jump"), "subtrees")
    while not (live := nodes.where(F.col("jump").isNotNull())).isEmpty():
        gained = live.groupBy(F.col("jump").alias("key"))
        gained = gained.agg(*(F.sum(c).alias(f"g_{c}") for c in sums), F.min("first").alias("g_first"))
        onward = nodes.select(F.col("key").alias("step"), F.col("jump").alias("next"))
        # Above the root there is nothing; whoever is there asks for itself instead of crowding at one key.
        done = F.col("jump").isNull() | (F.col("jump") == F.lit(ROOT))
        step = F.when(done, F.col("key")).otherwise(F.col("jump"))
        grown = nodes.withColumn("step", step).join(onward, "step").join(gained, "key", "left")
        grown = grown.select(
            "key",
            F.when(~done, F.col("next")).alias("jump"),
            F.least("first", "g_first").alias("first"),
            *((F.col(c) + F.coalesce(f"g_{c}", F.lit(0))).alias(c) for c in sums),
        )
        grown = saved(grown, "subtrees")
        release(nodes)
        nodes = grown
    return nodes.drop("jump")


def prefix_trie(turns: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """A row per distinct prefix of the conversations: ``(conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256)``.

    ``turns`` is as of ``turns_of``; ``conv_ids`` lists all conversations once, also those without turns, which
    end at the root. ``conv_id`` is the smallest conversation that starts with the prefix. Sums over
    subtrees are made on the compacted trie and its edges expanded last: along an edge only depth and
    saved characters change. Equal conversations are one string. No conversation gives no row.
    """
    strings = strings_of(turns)
    ends = strings.groupBy("conv_id").agg(F.max(F.struct("layer", F.element_at("path", -1).alias("end"))).alias("last"))
    ends = conv_ids.join(ends, "conv_id", "left")
    ends = end_digests(ends.select("conv_id", F.coalesce("last.end.k", F.lit(ROOT)).alias("key")))
    ends = saved(ends, "trie-ends")
    nodes = z_fast_trie(strings)
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    root = ends.sparkSession.range(1).select(
        F.lit(0).alias("layer"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).alias("top"),
        F.lit(0).alias("depth"),
        F.lit(0).cast("bigint").alias("top_d"),
        F.array().cast(nodes.schema["edge"].dataType).alias("edge"),
        F.lit(ROOT).alias("first"),
        F.lit(ROOT).alias("key"),
    )
    every = nodes.unionByName(root).withColumnRenamed("first", "turn").join(children, "key", "left").join(ends, "key", "left")
    end_d = F.when(F.size("edge") > 0, F.element_at("edge", -1)["d"]).otherwise(F.col("top_d"))
    zero = F.lit(0).cast("bigint")
    every = every.withColumns({"end_d": end_d, "n_children": F.coalesce("n_children", zero), "n_ends": F.coalesce("n_ends", zero)})
    every = saved(every.drop("turn"), "trie-facts")
    summed = with_subtrees(
        every.select(
            "key",
            "parent",
            "first",
            F.col("n_ends").alias("n"),
            (F.col("n_children") == 0).cast("bigint").alias("leaves"),
            (F.col("n_ends") * F.col("end_d")).alias("weighted"),
            (F.col("end_d") - F.col("top_d")).alias("chars"),
        )
    )
    own = every.drop("n_ends", "first").join(summed, "key").where(F.col("n") > 0)
    # Every conversation below has (weighted / n - end_d) more characters; one copy of each edge is needed.
    below = F.col("weighted") - F.col("n") * F.col("end_d") - (F.col("chars") - (F.col("end_d") - F.col("top_d")))
    smallest = summed.where(F.col("key") == F.lit(ROOT)).select("first").scalar()
    at_root = F.col("parent").isNull() | (F.col("parent") == F.lit(ROOT))
    up = summed.select(F.col("key").alias("above"), F.col("first").alias("above_first"))
    own = own.withColumns({"below": below, "above": F.when(at_root, F.col("key")).otherwise(F.col("parent"))}).join(up, "above")
    own = own.withColumn("above_first", F.when(F.col("parent").isNull(), None).when(at_root, smallest).otherwise(F.col("above_first")))
    def place(entry: Column, i: Column) -> Column:
        before = F.when(i == 0, F.col("top_d")).otherwise(F.col("edge")[F.greatest(i - 1, F.lit(0))]["d"])
        return F.struct(i.alias("i"), before.alias("before"), (i == F.size("edge") - 1).alias("last"))

    # The root has no edge and stays one row.
    own = own.withColumn("places", F.transform("edge", place)).drop("edge")
    own = own.select("*", F.explode_outer("places").alias("turn")).drop("places")
    i, last = F.coalesce("turn.i", F.lit(0)), F.coalesce("turn.last", F.lit(True))
    depth = F.col("layer").cast("bigint") * SEGMENT + F.col("top") + F.coalesce(F.col("turn.i") + 1, F.lit(0))
    chars = F.coalesce(F.col("end_d") - F.col("turn.before"), zero)
    return own.select(
        F.col("first").alias("conv_id"),
        depth.cast("bigint").alias("depth"),
        F.when(i == 0, F.col("above_first")).otherwise(F.col("first")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.col("n_children")).otherwise(1).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("below") + (F.col("n") - 1) * chars).cast("bigint").alias("saved_tokens"),
        F.coalesce(F.when(last, F.col("sha256")), F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
