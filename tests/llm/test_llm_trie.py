"""The prefix trie against a trie of dictionaries, on hand-made and on random conversations."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewell.llm import trie
from ratewell.llm.common import placed, saved

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def in_order(rows):
    talks = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            talks[conv_id].append((turn is not None, turn or 0, digest, (role, text)))
    return {c: [t[-1] for t in sorted(turns)] for c, turns in talks.items()}


def brute_force(talks):
    members = collections.defaultdict(set)
    for c, turns in talks.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].add(c)
    below = collections.defaultdict(set)
    for node in members:
        for depth in range(len(node) + 1):
            below[node[:depth]].add(node)
    children = collections.Counter(node[:-1] for node in members if node)
    saving = {node: (len(m) - 1) * len(node[-1][1]) if node else 0 for node, m in members.items()}
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(talks[c]) == len(node))
        yield (
            min(m),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(m),
            children[node],
            sum(not children[v] for v in below[node]),
            sum(saving[v] for v in below[node]),
            hashlib.sha256(ends.encode()).hexdigest(),
        )


def rows_of(frame):
    return sorted(map(repr, map(tuple, frame.select(*COLUMNS).collect())))


def check(spark, rows, more_ids=()):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("odd") for c in ("place", "key", "n", "depth", "path")})
    turns = saved(trie.turns_of(frame), "test-turns")
    ids = turns.select("conv_id").union(spark.createDataFrame([(i,) for i in more_ids], "conv_id bigint")).distinct()
    talks = in_order(rows) | {i: [] for i in more_ids}
    assert rows_of(trie.prefix_trie(turns, ids)) == sorted(map(repr, brute_force(talks)))


EDGES = [
    (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "assistant", "b"),
    (3, 0, "user", "a"), (4, None, None, None), (4, 0, "user", "a"), (5, 0, "", ""), (5, 1, "user", "a"),
    (6, 0, "usera", ""), (7, 0, "user", "a"), (7, 0, "user", "a"), (7, 0, "assistant", "é" * 3000),
    (None, 0, "user", "nobody"), (-3, 0, "user", "a"), (-3, 1, "assistant", "c"), (-3, 2, None, "long " * 5000),
]


def test_edges(spark):
    check(spark, EDGES, more_ids=(50, -50))


def test_no_conversations(spark):
    frame = spark.createDataFrame([], SCHEMA)
    empty = trie.prefix_trie(*trie.with_shared_heads(trie.turns_of(frame), 100, 6))
    assert empty.columns == COLUMNS and empty.count() == 0
    alone = trie.prefix_trie(trie.turns_of(frame), spark.createDataFrame([(9,), (8,)], "conv_id bigint"))
    digest = hashlib.sha256(b"8,9").hexdigest()
    assert [tuple(r) for r in alone.collect()] == [(8, 0, None, 2, 0, 1, 0, digest)]


@pytest.mark.parametrize("segment, short, seed", [(1024, 15, 1), (8, 3, 2)])
def test_random_conversations(spark, monkeypatch, segment, short, seed):
    """Also with layers of few turns, as long conversations have, and with growing copies of one conversation."""
    monkeypatch.setattr(trie, "SEGMENT", segment)
    monkeypatch.setattr(trie, "SHORT", short)
    monkeypatch.setattr(trie, "CHUNK", 3)
    rng = np.random.default_rng(seed)
    talks, rows = [], []
    for _ in range(90):
        if talks and rng.random() < 0.7:
            old = talks[rng.integers(len(talks))]
            talk = old[: rng.integers(len(old) + 1)]
        else:
            talk = []
        talk = talk + [("user" if rng.random() < 0.5 else "bot", "xyz"[rng.integers(3)] * int(rng.integers(1, 3))) for _ in range(rng.integers(0, 12))]
        talks.append(talk or [("user", "x")])
    one = [("user", str(i % 3)) for i in range(40)]
    talks += [one[: i + 1] for i in range(40)]
    for c, talk in enumerate(talks):
        rows += [(c * 7 - 50, turn, role, text) for turn, (role, text) in enumerate(talk)]
    check(spark, [rows[i] for i in rng.permutation(len(rows))])


def test_shared_heads(spark):
    rows = [(c, t, "user", f"{c}-{t}") for c in [*range(100, 140), 200, 205, 300, -7] for t in range(c % 7 + 1)] + [(0, 0, "user", "zero")]
    talks = in_order(rows)
    want = {}
    for c in talks:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        want[c] = talks.get(base, [])[:h] + talks[c][h:]
    turns, ids = trie.with_shared_heads(trie.turns_of(spark.createDataFrame(rows, SCHEMA)), 100, 6)
    assert sorted(r.conv_id for r in ids.collect()) == sorted(want)
    assert rows_of(trie.prefix_trie(turns, ids)) == sorted(map(repr, brute_force(want)))


def test_places_of_a_key_in_many_ranges(spark):
    """One key has nearly all rows, most of them equal; places still count without gaps."""
    rows = [(1, i // 500) for i in range(3_000)] + [(2, i) for i in range(20)]
    frame = spark.createDataFrame(rows, "k int, v int").repartition(7)
    found = placed(frame, ["v"], "k").collect()
    for key in (1, 2):
        mine = sorted((r.place, r.v) for r in found if r.k == key)
        assert [p for p, _ in mine] == list(range(1, len(mine) + 1)) and [v for _, v in mine] == sorted(v for _, v in mine)
    assert sorted(r.place for r in placed(frame, ["v"]).collect()) == list(range(1, len(rows) + 1))
