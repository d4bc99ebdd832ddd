"""Approximate nearest neighbours by inner product: a robust-pruned graph per shard, searched by beam."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewell.llm.common import saved

#: Distinct vectors of a shard on average, and queries that a task searches on average.
SHARD_ROWS, TASK_QUERIES = 5_000, 10_000
#: Out-edges of a node, width of the beam, relaxation of the pruning rule, nodes put in or searched at once.
DEGREE, BEAM, RELAXED, BATCH = 28, 56, 1.2, 256


class Graph:
    """Directed graph over the rows of ``points``; -1 pads ``edges``."""

    def __init__(self, points, edges=None, entry: int = 0):
        import numpy as np

        self.points = np.ascontiguousarray(points, np.float32)
        self.squares = (self.points**2).sum(1)
        self.edges = np.full((len(points), DEGREE), -1, np.int32) if edges is None else edges
        self.entry = entry

    def search(self, queries, beam: int = BEAM):
        """``(rows, squared distances)`` of the ``beam`` nearest nodes that greedy search meets, nearest first.

        All queries advance together: each expands the nearest node of its beam that it hasn't yet.
        """
        import numpy as np

        queries = np.ascontiguousarray(queries, np.float32)
        n, every = len(queries), np.arange(len(queries))
        norms = (queries**2).sum(1)
        rows = np.full((n, beam), -1, np.int32)
        far = np.full((n, beam), np.inf, np.float32)
        done = np.ones((n, beam), bool)
        seen = np.zeros((n, len(self.points) + 1), bool)
        seen[:, -1] = True
        rows[:, 0], done[:, 0], seen[:, self.entry] = self.entry, False, True
        far[:, 0] = norms + self.squares[self.entry] - 2 * queries @ self.points[self.entry]
        active = every
        while len(active):
            open_far = np.where(done[active], np.inf, far[active])
            at = open_far.argmin(1)
            live = np.isfinite(open_far[np.arange(len(active)), at])
            active, at = active[live], at[live]
            if not len(active):
                break
            done[active, at] = True
            near = self.edges[rows[active, at]]
            fresh = ~seen[active[:, None], near]
            seen[active[:, None], near] = True
            seen[:, -1] = True
            gaps = np.matmul(self.points[near], queries[active][:, :, None])[:, :, 0]
            gaps = norms[active, None] + self.squares[near] - 2 * gaps
            gaps[~fresh] = np.inf
            all_far = np.concatenate([far[active], gaps], 1)
            order = np.argsort(all_far, 1, kind="stable")[:, :beam]
            far[active] = np.take_along_axis(all_far, order, 1)
            rows[active] = np.take_along_axis(np.concatenate([rows[active], near], 1), order, 1)
            closed = np.concatenate([done[active], ~fresh], 1)
            done[active] = np.take_along_axis(closed, order, 1)
        rows[~np.isfinite(far)] = -1
        return rows, far

    def prune(self, nodes, candidates):
        """Diverse out-edges: the nearest candidate stays and drops all that are closer to it, by the
        relaxed rule, than to the node; and so on. ``candidates`` has a row per node, -1 for none."""
        import numpy as np

        points = self.points[candidates]
        squares = self.squares[candidates]
        gaps = self.squares[nodes, None] + squares - 2 * np.matmul(points, self.points[nodes][:, :, None])[:, :, 0]
        gaps[(candidates < 0) | (candidates == nodes[:, None])] = np.inf
        order = np.argsort(gaps, 1, kind="stable")
        candidates, gaps = np.take_along_axis(candidates, order, 1), np.take_along_axis(gaps, order, 1)
        points, squares = self.points[candidates], self.squares[candidates]
        between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(points, points.transpose(0, 2, 1))
        alive, every = np.isfinite(gaps), np.arange(len(nodes))
        alive[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
        out = np.full((len(nodes), DEGREE), -1, np.int32)
        for k in range(DEGREE):
            some = alive.any(1)
            if not some.any():
                break
            pick = alive.argmax(1)
            out[some, k] = candidates[every, pick][some]
            alive &= RELAXED**2 * between[every, pick] > gaps
            alive[every, pick] = False
        return out

    def build(self):
        """Put all nodes in, a batch at a time, from the one nearest the mean; returns the graph."""
        import numpy as np

        n = len(self.points)
        if n < 2:
            return self
        self.entry = int(((self.points - self.points.mean(0)) ** 2).sum(1).argmin())
        order = np.random.default_rng(6).permutation(n)
        order = order[order != self.entry]
        at = 0
        # Early batches are small, so that each finds a graph as large as itself.
        while at < len(order):
            batch = order[at : at + min(BATCH, at + 1)]
            at += len(batch)
            found, _ = self.search(self.points[batch])
            self.edges[batch] = self.prune(batch, found)
            source = np.repeat(batch, DEGREE)
            target = self.edges[batch].ravel()
            source, target = source[target >= 0], target[target >= 0]
            by = np.argsort(target, kind="stable")
            source, target = source[by], target[by]
            targets, first, count = np.unique(target, return_index=True, return_counts=True)
            for part in range(0, int(count.max(initial=0)), DEGREE):
                # Back edges; a node that many point to takes them in turns.
                mine = count > part
                nodes, begin = targets[mine], first[mine] + part
                width = np.minimum(count[mine] - part, DEGREE)
                steps = np.arange(DEGREE)
                back = source[np.minimum(begin[:, None] + steps, len(source) - 1)].astype(np.int32)
                back[steps >= width[:, None]] = -1
                for low in range(0, len(nodes), BATCH):
                    some = slice(low, low + BATCH)
                    both = np.concatenate([self.edges[nodes[some]], back[some]], 1)
                    self.edges[nodes[some]] = self.prune(nodes[some], both)
        return self


def lengths(vectors):
    """Norms in double precision, without overflow or underflow on the way."""
    import numpy as np

    largest = np.maximum(np.abs(vectors).max(1, initial=0), np.finfo(float).tiny)
    return largest, np.sqrt(((vectors / largest[:, None]) ** 2).sum(1))


def with_height(vectors):
    """Vectors scaled by one number to norms of at most 1, and one more component that gives all points
    length 1: then the nearest has the largest inner product."""
    import numpy as np

    largest, rest = lengths(vectors)
    top = largest.max(initial=np.finfo(float).tiny)
    scaled = vectors / top
    scaled /= max(float((largest / top * rest).max(initial=0)), np.finfo(float).tiny)
    return np.column_stack([scaled, np.sqrt(np.maximum(1 - (scaled**2).sum(1), 0))])


def norm_class(vector: Column) -> Column:
    """The power of two nearest to the vector's norm, by a norm that doesn't overflow on the way."""
    largest = F.array_max(F.transform(vector, F.abs))
    rest = F.aggregate(vector, F.lit(0.0), lambda total, x: total + (x / largest) * (x / largest))
    return F.round(F.log2(largest) + F.log2(rest) / 2).cast("int")


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``(vec_id, embedding)`` as doubles, one row per id. Out are null ids, vectors that are null, zero or
    hold a null or non-finite component, and those of another width than most."""
    values = F.col(vector).cast("array<double>")
    rows = rows.select(F.col(key).cast("bigint").alias("vec_id"), values.alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))
    widths = rows.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), "width")
    most = widths.first()
    rows = rows.where(F.size("embedding") == (most.width if most else 0))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def nearest(rows: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: of each query row (``is_query`` of ``vec_id``) the ``k`` rows, not itself,
    with the largest inner product that the search finds; ties to the smaller id.

    Equal vectors are one node, so that a vector that a third of all rows have takes one place.
    Nodes are dealt to shards by norm, to the nearest power of two, and within that by a hash; each
    shard has a graph of its vectors scaled to its own largest one, so that a few very long or very
    short vectors don't blur the distances among all others. Every query searches every shard. Scores
    are inner products of the original vectors in double precision.

    ``usable`` states which rows take no part; repeated ids count once, with their smallest vector.
    With fewer candidates than ``k`` all that are found come. An empty table gives none. Other
    columns are ignored.
    """
    import math

    every = saved(usable(rows, key, vector), "vectors")
    # The smallest k + 1 ids of each vector, in two steps that split a very common vector.
    part = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    early = F.row_number().over(Window.partitionBy("embedding", part).orderBy("vec_id"))
    members = every.withColumn("early", early).where(F.col("early") <= k + 1).drop("early")
    same = Window.partitionBy("embedding").orderBy("vec_id")
    members = members.withColumns({"place": F.row_number().over(same), "node": F.first("vec_id").over(same)})
    members = saved(members.where(F.col("place") <= k + 1), "vector-members")
    nodes = members.where(F.col("place") == 1)
    # At most about 2,100 classes, as doubles have so many exponents; shards are numbered through them.
    classes = nodes.groupBy(norm_class(F.col("embedding")).alias("norm")).count().orderBy("norm").collect()
    counts = [max(1, math.ceil(row["count"] / SHARD_ROWS)) for row in classes]
    first = {row.norm: sum(counts[:i]) for i, row in enumerate(classes)}
    shards = max(1, sum(counts))
    queries = every.where(is_query)
    turns = max(1, math.ceil(queries.count() / TASK_QUERIES))

    def index(frame):
        import numpy as np
        import pandas as pd

        frame = frame.sort_values("node")
        vectors = np.stack(frame["embedding"].to_numpy())
        graph = Graph(with_height(vectors)).build()
        cells = [frame["node"].to_numpy(np.int64).tobytes(), vectors.tobytes(), graph.edges.tobytes(), graph.entry]
        return pd.DataFrame([[int(frame["shard"].iloc[0]), *cells]], columns=["shard", "nodes", "vectors", "edges", "entry"])

    shard = F.lit(0)
    if classes:
        starts = F.create_map(*[F.lit(x) for item in first.items() for x in item])
        parts = F.create_map(*[F.lit(x) for row, n in zip(classes, counts) for x in (row.norm, n)])
        norm = norm_class(F.col("embedding"))
        shard = starts[norm] + F.pmod(F.xxhash64("node"), parts[norm])
    dealt = nodes.select("node", "embedding", shard.cast("int").alias("shard"))
    graphs = dealt.groupBy("shard").applyInPandas(index, "shard int, nodes binary, vectors binary, edges binary, entry int")
    graphs = saved(graphs, "graphs")
    turn = F.pmod(F.xxhash64("vec_id"), F.lit(turns)).cast("int")
    asked = queries.select(
        F.col("vec_id").alias("query_id"),
        "embedding",
        turn.alias("turn"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )
    given = graphs.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))

    def find(given, asked):
        import numpy as np
        import pandas as pd

        empty = pd.DataFrame({"query_id": [], "node": [], "score": []})
        if not len(given) or not len(asked):
            return empty
        row = given.iloc[0]
        names = np.frombuffer(row["nodes"], np.int64)
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(len(names), -1)
        graph = Graph(with_height(vectors), np.frombuffer(row["edges"], np.int32).reshape(len(names), -1), row["entry"])
        out = []
        for low in range(0, len(asked), BATCH):
            some = asked.iloc[low : low + BATCH]
            queries = np.stack(some["embedding"].to_numpy())
            largest, rest = lengths(queries)
            # The order of inner products doesn't depend on the query's own length.
            unit = queries / largest[:, None] / rest[:, None]
            found, _ = graph.search(np.column_stack([unit, np.zeros(len(unit))]), max(BEAM, 2 * k))
            query, place = np.nonzero(found >= 0)
            node = found[query, place]
            scores = np.einsum("ij,ij->i", queries[query], vectors[node])
            out.append(pd.DataFrame({"query_id": some["query_id"].to_numpy()[query], "node": names[node], "score": scores}))
        found = pd.concat(out).sort_values(["query_id", "score", "node"], ascending=[True, False, True])
        return found.groupby("query_id").head(k + 1)

    found = given.groupBy("shard", "turn").cogroup(asked.groupBy("shard", "turn"))
    found = found.applyInPandas(find, "query_id bigint, node bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "node")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1).drop("rank")
    found = found.join(members.select("node", "vec_id"), "node").where(F.col("vec_id") != F.col("query_id"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
