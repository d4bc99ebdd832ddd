"""Mixing: targets by the rule, sums of sources, copies of documents, reruns and edges."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewell.llm import mixing
from ratewell.llm.common import saved
from ratewell.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Shares in rounds, as the rule says it."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    got, stopped, rest = dict.fromkeys(names, 0.0), set(), share * sum(sizes.values())
    while rest > 1e-9 and len(stopped) < len(names):
        total = sum(weight[s] for s in names if s not in stopped)
        dealt = {s: rest * weight[s] / total for s in names if s not in stopped}
        rest = 0.0
        for s, more in dealt.items():
            got[s] += more
            if got[s] >= most * sizes[s]:
                rest += got[s] - most * sizes[s]
                got[s] = most * sizes[s]
                stopped.add(s)
    return got


def check(rows, docs):
    """``docs`` maps ids to source and size; returns the source sums."""
    sizes = collections.Counter()
    for source, size in docs.values():
        sizes[source] += size
    want, taken, largest = targets(sizes), collections.Counter(), collections.Counter()
    for row in rows:
        source, size = docs[row.doc_id]
        assert row.size == size and row.source_size == sizes[source]
        assert row.target == pytest.approx(want[source], rel=1e-9, abs=1e-6)
        assert row.taken in (0, size, 2 * size)
        if size:
            rate = want[source] / sizes[source]
            assert row.taken // size in (np.floor(rate - 1e-9), np.ceil(rate + 1e-9), round(rate))
        taken[source] += row.taken
        largest[source] = max(largest[source], size)
    for source in sizes:
        assert abs(taken[source] - want[source]) <= largest[source]
    return want, taken


def test_whole_table(spark):
    rows = QUERIES["op12_mixing"](spark, FOLDER).collect()
    texts = {r.doc_id: (r.source, len(r.text.split())) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    want, taken = check(rows, texts)
    assert np.median([abs(taken[s] - want[s]) for s in want]) < 0.002 * np.median(list(want.values()))


def random_docs(spark, n=3_000, partitions=3):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        source = ["hot", None, "", "a", "b", "é"][min(int(rng.exponential(1.2)), 5)]
        rows.append((i, source, "w " * int(min(rng.pareto(1.1) * 10, 600))))
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    return {i: (source, len(text.split())) for i, source, text in rows}, frame.repartition(partitions)


def test_hot_and_null_sources(spark, monkeypatch):
    """Several levels of groups; what a source takes is met closely although single texts are large."""
    monkeypatch.setattr(mixing, "GROUP", 8)
    docs, frame = random_docs(spark)
    want, taken = check(mixing.mix(frame).collect(), docs)
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 20 for s in want)


def test_reruns_agree_whatever_the_partitions(spark):
    docs, frame = random_docs(spark, 800)
    first = sorted((r.doc_id, r.taken) for r in mixing.mix(frame).collect())
    other = saved(random_docs(spark, 800, 11)[1].sort(F.desc("text")), "other-layout")
    assert sorted((r.doc_id, r.taken) for r in mixing.mix(other).collect()) == first


def test_fractions_keep_their_expectation(spark):
    """Over many seeds each document is taken as often as its fraction says, and words are kept in all."""
    rows = [("s", size, x, i) for i, (size, x) in enumerate([(1, 0.3), (5, 0.3), (40, 0.7), (41, 0.5), (300, 0.2), (2, 0.9)])]
    counts, n = collections.Counter(), 400
    unit = [F.struct(F.lit(float(size)).alias("size"), F.lit(x).alias("x"), F.lit(i).alias("doc_id")) for _, size, x, i in rows]
    pivots = spark.range(n).select(mixing.pivot(F.array(*unit), F.col("id")).alias("r"))
    for row in pivots.collect():
        every = [*row.r.done, row.r.open]
        assert all(u.x in (0, 1) for u in row.r.done) and len(every) == len(rows)
        assert sum(u.size * u.x for u in every) == pytest.approx(sum(size * x for _, size, x, _ in rows))
        counts.update({u.doc_id: u.x for u in every})
    for _, _, x, i in rows:
        assert abs(counts[i] / n - x) < 5 * np.sqrt(x * (1 - x) / n)


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 4)
    texts = [(1, "a", "x\ty\x0bz \x1c \xa0"), (2, "a", None), (3, "b", ""), (4, None, " \r\n"), (None, "b", "one two"), (None, None, "n")]
    texts += [(7, "c", "same words here")] * 23 + [(8, "", "w " * 30_000)]
    frame = spark.createDataFrame(texts, "doc_id bigint, source string, text string")
    frame = frame.withColumns({name: F.lit("odd") for name in ("size", "key", "m", "x", "target", "units", "group")})
    rows = mixing.mix(frame).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(i for i, _, _ in texts)
    assert [r["size"] for r in rows if r.doc_id == 1] == [5] and {r.taken for r in rows if r.doc_id in (2, 3, 4)} == {0}
    # All 23 equal rows together come near their target.
    mine = [r for r in rows if r.doc_id == 7]
    assert {r["size"] for r in mine} == {3} and abs(sum(r.taken for r in mine) - mine[0].target) <= 3
    assert sum(r.target for r in {r.source_size: r for r in rows}.values()) <= 1.5 * sum(r["size"] for r in rows) + 1e-6
    assert mixing.mix(frame.limit(0)).count() == 0
    assert [tuple(r) for r in mixing.mix(frame.where("doc_id = 2")).collect()] == [(2, 0, 0, 0.0, 0)]
