"""Histogram trees and word vectors against plain loops."""

import collections
import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewell.operators import histogram_trees as trees
from ratewell.operators import word_vectors as words
from ratewell.operators.joins import join_matched

TEXTS = ["a b a c", "b c", "a", "", None, "c c c c", "b a d", "d e", "A  b\na c e e"]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=400), rng.integers(0, 4, 400).astype(float)
    rating = np.clip(np.round(3 + x + (y > 1) - 1.5 * ((x > 0.3) & (y < 1))), 1, 5)
    rows = [(i, float(a), float(b), 7.0, float(r)) for i, (a, b, r) in enumerate(zip(x, y, rating))]
    return rows, spark.createDataFrame(rows, "id int, x double, y double, flat double, rating double")


def grown(rows, n_trees, depth, bins, rate=trees.RATE):
    """Bins, boosted trees and predictions in units, by loops over rows."""
    columns = [[row[k] for row in rows] for k in (1, 2, 3)]
    binned = []
    for column in columns:
        low, high = min(column), max(column)
        cells = [min(trees.CELLS - 1, math.floor((v - low) / (high - low) * trees.CELLS)) if high > low else 0 for v in column]
        count, starts, before, seen = collections.Counter(cells), [], 0, 0
        for cell in sorted(count):
            if before * bins // len(rows) > seen:
                seen = before * bins // len(rows)
                starts.append(cell)
            before += count[cell]
        binned.append([sum(s <= c for s in starts) for c in cells])
    goal = [round(row[4] * trees.UNIT) for row in rows]
    fitted = [math.floor(sum(goal) / len(rows) + 0.5)] * len(rows)
    for _ in range(n_trees):
        node, rest = [0] * len(rows), [y - p for y, p in zip(goal, fitted)]
        for _ in range(depth):
            for at in set(node):
                mine = [i for i, n in enumerate(node) if n == at]
                best, total = (0.0, None), sum(rest[i] for i in mine)
                for f, values in enumerate(binned):
                    for cut in sorted({values[i] for i in mine})[:-1]:
                        left = [i for i in mine if values[i] <= cut]
                        g, n = sum(rest[i] for i in left), len(left)
                        gain = float(g) ** 2 / n + float(total - g) ** 2 / (len(mine) - n) - float(total) ** 2 / len(mine)
                        if gain > best[0]:
                            best = (gain, (f, cut))
                for i in mine:
                    node[i] = -1 - (2 * at + bool(best[1] and binned[best[1][0]][i] > best[1][1]))
            node = [-1 - n for n in node]
        for at in set(node):
            mine = [i for i, n in enumerate(node) if n == at]
            leaf = math.floor(rate * sum(rest[i] for i in mine) / len(mine) + 0.5)
            for i in mine:
                fitted[i] += leaf
    return fitted


def test_forest_equals_loops(points):
    rows, frame = points
    forest = trees.fit_forest(frame, ("x", "y", "flat"), trees=4, depth=3, bins=16)
    found = {r.id: r.prediction for r in trees.forest_predict(frame, forest).collect()}
    for i, units in enumerate(grown(rows, 4, 3, 16)):
        assert found[i] == pytest.approx(min(5, max(1, units / trees.UNIT)), abs=1e-9)


def test_forest_is_the_same_in_any_layout(spark, points, monkeypatch):
    """Also where predictions are written between trees."""
    _, frame = points
    whole = trees.fit_forest(frame, ("x", "y"), trees=5, depth=2)
    monkeypatch.setattr(trees, "STEP", 2)
    assert trees.fit_forest(frame.repartition(7).sort(F.desc("x")), ("x", "y"), trees=5, depth=2) == whole
    nodes = trees.forest_table(spark, whole)
    assert nodes.count() == 5 * 7 and nodes.where("value IS NOT NULL").count() == 5 * 4


def test_forest_learns_and_keeps_nulls(spark, points):
    rows, frame = points
    errors = []
    for n in (1, 20):
        scored = trees.forest_predict(frame, trees.fit_forest(frame, ("x", "y"), trees=n, depth=3))
        errors.append(scored.agg(F.avg(F.pow(F.col("prediction") - F.col("rating"), 2))).first()[0])
    assert errors[1] < 0.3 * errors[0]
    odd = spark.createDataFrame([(1, None, 1.0, 0.0, 2.0), (2, 0.1, 1.0, 0.0, None), (3, 99.0, -5.0, 0.0, 3.0)], frame.schema)
    forest = trees.fit_forest(frame.union(odd.where("id < 3")), ("x", "y"), trees=2, depth=2)
    assert forest == trees.fit_forest(frame, ("x", "y"), trees=2, depth=2)
    found = {r.id: r.prediction for r in trees.forest_predict(odd, forest).collect()}
    assert found[1] is None and 1 <= found[2] <= 5 and 1 <= found[3] <= 5
    empty = trees.fit_forest(frame.limit(0), ("x", "y"), trees=2, depth=2)
    assert empty.trees == [] and trees.forest_predict(frame, empty).first().prediction == 1.0


def information(texts, window=2, min_count=2):
    split = [(text or "").lower().split() for text in texts]
    total = collections.Counter(w for s in split for w in s)
    n = collections.Counter()
    for s in split:
        for i, word in enumerate(s):
            for other in s[i + 1 : i + 1 + window]:
                if total[word] >= min_count and total[other] >= min_count:
                    n[word, other] += 1
                    n[other, word] += 1
    of, every = collections.Counter(), sum(n.values())
    for (word, _), k in n.items():
        of[word] += k
    weights = {pair: math.log(k * every / of[pair[0]] / of[pair[1]]) for pair, k in n.items()}
    return n, {pair: w for pair, w in weights.items() if w > 0}


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def test_information_equals_loops(texts):
    counts, weights = information(TEXTS)
    pairs = words.cooccurrences(texts)
    assert {(r.word, r.other): r.n for r in pairs.collect()} == counts
    found = {(r.word, r.other): r.weight for r in words.positive_information(pairs).collect()}
    assert found.keys() == weights.keys() and all(found[p] == pytest.approx(w) for p, w in weights.items())


def test_pairs_of_a_word_with_itself_and_counts_in_both_directions(spark):
    frame = spark.createDataFrame([(0, "a a a b"), (1, "b A"), (2, None)], "id int, text string")
    found = {(r.word, r.other): r.n for r in words.cooccurrences(frame).collect()}
    # Of "a a a b": a-a thrice, each in both directions, and a-b twice; of "b a": once.
    assert found == {("a", "a"): 6, ("a", "b"): 3, ("b", "a"): 3}


def test_information_is_read_without_a_join(texts):
    found = words.positive_information(words.cooccurrences(texts))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Join" not in plan


def test_word_vectors_are_leading_eigenvectors(spark):
    rng = np.random.default_rng(2)
    made = [" ".join(f"w{rng.integers(0, 6) + 6 * (i % 3)}" for _ in range(30)) for i in range(60)]
    frame = spark.createDataFrame(list(enumerate(made)), "id int, text string")
    dim = 3
    found = {r.word: np.array(r.embedding) for r in words.word_vectors(frame, dim, steps=12).collect()}
    _, weights = information(made)
    names = sorted({word for word, _ in weights})
    matrix = np.array([[weights.get((a, b), 0.0) for b in names] for a in names])
    values = np.linalg.eigvalsh(matrix)
    top = values[np.argsort(-np.abs(values))][:dim]
    block = np.array([found[w] for w in names])
    # Stretched by the roots of the eigenvalues, so inner products of axes are those.
    assert sorted(found) == names and np.diag(block.T @ block) == pytest.approx(np.abs(top), rel=0.05)


def test_vectors_of_one_step_and_of_texts(spark, texts):
    _, weights = information(TEXTS)
    folder = words.scratch_path(spark, "test")
    matrix = words.write_table(words.positive_information(words.cooccurrences(texts)), folder, "matrix")
    start = {r.word: np.array([r.v0, r.v1]) for r in words.starting_block(matrix, 2).collect()}
    product = words.multiplied(matrix, words.starting_block(matrix, 2), 2)
    for row in product.collect():
        want = sum(w * start[b] for (a, b), w in weights.items() if a == row.word)
        assert (row.v0, row.v1) == pytest.approx(tuple(want))
    unit, _ = words.orthonormal(product, 2)
    block = np.array([[r.v0, r.v1] for r in unit.collect()])
    gram = block.T @ block
    assert all(gram[i, i] == pytest.approx(1) or gram[i, i] == 0 for i in range(2)) and abs(gram[0, 1]) < 1e-6
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0])], "word string, embedding array<double>")
    found = {r.id: r.embedding for r in words.text_vectors(texts, vectors, 2).collect()}
    assert found[0] == pytest.approx([2 / 3, 2 / 3], abs=1e-6) and found[3] == found[4] == found[5] == [0.0, 0.0] and len(found) == len(TEXTS)


def beside(frame):
    """The folders beside the one that a written frame is read from."""
    folder = Path(frame.inputFiles()[0].removeprefix("file:")).parent.parent
    return sorted(p.name for p in folder.iterdir() if any(p.rglob("*.parquet")))


def test_word_vectors_leave_no_table_but_themselves(texts):
    assert beside(words.word_vectors(texts, 2, steps=2)) == ["vectors"]


def test_a_product_is_written_and_its_parts_are_gone(spark):
    matrix = spark.createDataFrame([("a", "b", 2.0), ("b", "a", 2.0), ("b", "b", 0.5), ("c", None, 1.0)], "word string, other string, weight double")
    block = spark.createDataFrame([("a", 1.0, -1.0), ("b", 3.0, 0.0)], "word string, v0 double, v1 double")
    product = words.multiplied(matrix, block, 2)
    assert sorted(product.collect()) == [("a", 6.0, 0.0), ("b", 3.5, -2.0), ("c", None, None)]
    assert beside(product) == ["product"]


def test_text_vectors_keep_only_the_pooled_rows(spark, texts):
    vectors = spark.createDataFrame([("a", [1.0, 0.0])], "word string, embedding array<double>")
    found = words.text_vectors(texts, vectors, 2)
    assert "text-vectors" in found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()


def test_vectors_of_nothing(spark, texts):
    assert words.word_vectors(texts.limit(0), 2, steps=1).count() == 0
    assert words.word_vectors(texts.where("id = 2"), 2, steps=1).count() == 0


def test_join_matched(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, text string")
    right = spark.createDataFrame([(1, 0.5), (3, 0.7)], "id int, v double")
    found = {r.text: (r.v, r.matched) for r in join_matched(left, right).collect()}
    assert found == {"a": (0.5, True), "b": (None, False), "c": (None, False)}
    with pytest.raises(ValueError):
        join_matched(left, right, strict=True)
    assert join_matched(left.where("id = 1"), right.where("id = 1"), strict=True).count() == 1
