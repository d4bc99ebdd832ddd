"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import collections
import hashlib

import corpus_pipeline
import numpy as np
import pytest
from public_tokenizers import PATTERN, path
from pyspark.sql import functions as F

from ratewell.llm import ann, byte_bpe, chat, groups, licenses, minhash, ngram_join, packing, quality, toxicity, urls
from ratewell.llm.common import platt, remainder, saved

LONG = "long words of a very long text, " * 20_000
TEXTS = [
    (1, "a mit license and the MIT License"),
    (2, None),
    (3, ""),
    (None, "no id here but words are"),
    (4, LONG),
    (5, "one two three four five six seven"),
    (5, "one two three four five six seven"),
    (6, "One two, three four five six seven"),
    (7, "a b"),
    (8, "x" * 50_000),
    (9, " \n\t"),
]
CLASH = ("label", "rank", "id", "margin", "node", "set_id", "size", "row", "words", "length", "offset", "score", "range", "halo")


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    return saved(frame.withColumns({name: F.lit("odd") for name in CLASH}), "edge-docs")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (4, 0, 1), (5, 1, 0), (5, 1, None), (6, 1, 0), (7, 0, 1), (8, 0, 1), (None, 1, 1), (9, None, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def ids(rows, name="doc_id"):
    return collections.Counter(row[name] for row in rows)


WANT = collections.Counter(doc_id for doc_id, _ in TEXTS)


@pytest.mark.parametrize("module, modulus", [(quality, 4), (toxicity, 5)])
def test_classifiers(spark, docs, labels, module, modulus):
    for known in (labels, labels.limit(0)):
        model, rows = module.fit_and_margins(docs, known, remainder("doc_id", modulus) >= 0)
        found = rows.select("doc_id", model.score().alias("score")).collect()
        assert ids(found) == WANT
        scores = {row.doc_id: row.score for row in found}
        assert all(0 <= score <= 1 for score in scores.values()) and scores[2] == scores[3]
    assert set(scores.values()) == {0.5}
    model, rows = module.fit_and_margins(docs.limit(0), labels, remainder("doc_id", modulus) >= 0)
    assert rows.count() == 0


def test_licenses(docs):
    found = licenses.scan(docs).collect()
    assert ids(found) == WANT
    by_id = {row.doc_id: row for row in found}
    assert tuple(by_id[1])[1:6] == (7, 2, 1, 5, "mit")
    assert tuple(by_id[2])[1:] == (0, 0, None, None, "", "", 0.0) == tuple(by_id[3])[1:]
    assert by_id[4].n_words == 7 * 20_000 and licenses.scan(docs.limit(0)).count() == 0


def test_licenses_merge_neighbouring_diagonals(spark):
    text = "Permission is hereby granted, free of any charge, to any person obtaining a copy of this software"
    frame = spark.createDataFrame([(1, text), (2, "permission granted to a person")], "doc_id bigint, text string")
    found = {row.doc_id: row for row in licenses.scan(frame).collect()}
    assert found[1].labels == "mit-text" and 0.8 <= found[1].score < 1 and found[2].labels == ""


@pytest.mark.parametrize(
    "text, labels, score",
    [
        ("all rights reserved rights reserved", "all-rights-reserved", 1.0),
        ("rights reserved all rights reserved", "all-rights-reserved", 1.0),
        ("license mozilla public license public license", "mpl", 1.0),
        ("all rights are reserved", "", 0.5),
        ("all rights", "", 0.5),
        ("reserved rights all", "", 0.0),
        ("MIT LICENSE, all rights reserved reserved", "all-rights-reserved,mit", 1.0),
        # A-Z only: the Kelvin sign is no k, so it stays another word's letter.
        ("apache license \u212a", "apache", 1.0),
    ],
)
def test_licenses_with_stray_grams(spark, text, labels, score):
    frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    (found,) = licenses.scan(frame).collect()
    assert (found.labels, found.score) == (labels, score)


def test_licenses_equal_brute_force(spark):
    """Every labelled passage must hold enough of a template's grams on one diagonal or on close ones."""
    random = np.random.default_rng(3)
    templates = {"a b c d e f": "six", "a c": "two"}
    texts = [" ".join(random.choice(list("abcdefx"), size=random.integers(0, 14))) for _ in range(300)]
    texts += ["a b c d e f c d", "a b x c d e f", "c d a b c d e f e f", "a b c d e"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {row.doc_id: row for row in licenses.scan(frame, {}, templates).collect()}
    for doc_id, text in enumerate(texts):
        words, best, labels = text.split(), 0.0, set()
        for template, label in templates.items():
            own = template.split()
            grams = [*zip(own, own[1:])]
            lines = {}
            for at, gram in enumerate(zip(words, words[1:])):
                for place, other in enumerate(grams):
                    if gram == other:
                        lines.setdefault(at - place, set()).add(at)
            runs = [[d] for d in lines]
            merged = []
            for d in sorted(lines):
                if merged and d - merged[-1][-1] <= licenses.NEIGHBOURS:
                    merged[-1].append(d)
                else:
                    merged.append([d])
            for run in runs + merged:
                places = [at for d in run for at in lines[d]]
                if max(places) - min(places) + 1 <= np.ceil(len(grams) * licenses.STRETCH):
                    share = min(1.0, sum(len(lines[d]) for d in run) / len(grams))
                    best = max(best, share)
                    if share >= licenses.COVERAGE:
                        labels.add(label)
        assert (got[doc_id].labels, got[doc_id].score) == (",".join(sorted(labels)), pytest.approx(best)), text


def test_byte_bpe(docs):
    file = path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode_rows(docs, file, PATTERN)
    found = byte_bpe.decode_rows(encoded, file).collect()
    assert collections.Counter((r.doc_id, bytes(r.bytes).decode()) for r in found) == collections.Counter(
        (doc_id, text or "") for doc_id, text in TEXTS
    )
    digests = byte_bpe.round_trip_digests(docs, file, PATTERN).collect()
    assert ids(digests) == WANT and {r.n_tokens for r in digests if r.doc_id in (2, 3)} == {0}
    assert byte_bpe.encode_rows(docs.limit(0), file, PATTERN).count() == 0


@pytest.mark.parametrize("operator", [ngram_join.near_duplicates, minhash.near_duplicates])
def test_near_duplicates(docs, operator):
    found = operator(docs).collect()
    assert ids(found) == WANT
    by_id = {row.doc_id: tuple(row)[1:] for row in found}
    assert by_id[5] == by_id[6] == (5, 5, 2)
    assert by_id[2] == (2, 2, 0) and by_id[3] == (3, 3, 0) and by_id[None] == (None, None, 0)
    assert operator(docs.limit(0)).count() == 0


def test_one_of_each(docs):
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert ids(kept.collect()) == collections.Counter([1, 2, 3, None, 4, 5, 7, 8, 9])


def test_one_of_each_by_text(spark):
    """Texts under one id, or without an id, stand or fall by themselves."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(30)) for c in "xyz")
    rows = [(1, one), (2, two), (2, one), (None, one + " more"), (None, three), (None, three), (None, three + " more"), (2, None)]
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(kept) == 4 and {tuple(r) for r in kept if r.doc_id} == {(1, one), (2, two), (2, None)}
    assert [r.text for r in kept if r.doc_id is None][0] in (three, three + " more")


@pytest.mark.parametrize("stage, bad", [("toxicity", 1), ("quality", 0)])
def test_stages_judge_rows_by_their_own_text(spark, tmp_path, stage, bad):
    good, poor = "a calm and kind sentence about the garden. ", "ZZQX!! ##9 zorg blarg "
    texts = [(i, (poor if i % 2 else good) * (2 + i % 7)) for i in range(120)]
    known = [(i, bad if i % 2 else 1 - bad, bad if i % 2 else 1 - bad) for i in range(120)]
    spark.createDataFrame(known, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    texts += [(key, text * n) for key in (None, 1000) for text in (good, poor) for n in (3, 4, 5)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    kept = dict(corpus_pipeline.STAGES)[stage](spark, frame, str(tmp_path)).collect()
    for key in (None, 1000):
        assert sorted(r.text for r in kept if r.doc_id == key) == [good * n for n in (3, 4, 5)]


def test_split_groups_give_the_same_links(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words[:30], f"odd{i}", *words[30 + i % 3 :]])) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = sorted(map(tuple, ngram_join.near_duplicates(frame, 0.6).collect()))
    monkeypatch.setattr(groups, "BLOCK_NODES", 7)
    assert sorted(map(tuple, ngram_join.near_duplicates(frame, 0.6).collect())) == whole
    assert {row[1] for row in whole} == {0}


@pytest.mark.parametrize("small", [32, 4])
def test_pairs_in_large_buckets_are_found(spark, monkeypatch, small):
    """Sketches of frequent values only, as of texts made of frequent passages: all first buckets are large."""
    monkeypatch.setattr(groups, "SMALL", small)
    random, n = np.random.default_rng(11), 1000
    one = random.integers(0, 20, (n, ngram_join.TOKENS)).astype(np.uint32)
    other = np.where(random.random(one.shape) < 0.8, one, random.integers(0, 20, one.shape)).astype(np.uint32)
    rows = [(i, bytearray(sketch.tobytes())) for i, sketch in enumerate(np.concatenate([one, other]))]
    nodes = saved(spark.createDataFrame(rows, "node bigint, sketch binary"), "frequent-sketches")
    edges = {(e.a, e.b) for e in ngram_join.candidate_edges(nodes, 0.8, 0.999).collect()}
    root = list(range(2 * n))

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for a, b in edges:
        root[find(a)] = find(b)
    assert sum(find(i) == find(i + n) for i in range(n)) >= 0.997 * n
    # Unrelated nodes aren't drawn together.
    assert len({find(i) for i in range(n)}) > 0.9 * n


def test_followed_pivots_keep_their_neighbours_links(spark, monkeypatch):
    """A node that leaves a large bucket because it is close to the pivot stays connected to its own copies."""
    monkeypatch.setattr(groups, "SMALL", 4)
    random, n = np.random.default_rng(15), 60
    centre = random.integers(0, 1 << 32, ngram_join.TOKENS, dtype=np.uint32)
    rows = []
    for i in range(n):
        mine = centre.copy()
        mine[random.permutation(ngram_join.TOKENS)[: 10 * (i % 2) + 4]] = random.integers(0, 1 << 32, 10 * (i % 2) + 4, dtype=np.uint32)
        rows.append((i, bytearray(mine.tobytes())))
    nodes = saved(spark.createDataFrame(rows, "node bigint, sketch binary"), "close-sketches")
    edges = ngram_join.candidate_edges(nodes, 0.8, 0.999)
    assert {r.root for r in groups.components(edges).collect()} and groups.components(edges).select("root").distinct().count() == 1


@pytest.mark.parametrize("levels", [1, 2, 5, ngram_join.LEVELS])
def test_runs_suit_the_depth(levels):
    """Sketches at the threshold, walked to each level: as many pairs meet as promised."""
    runs, n = ngram_join.runs_for(0.999), 1500
    random = np.random.default_rng(12)
    one = random.integers(0, 1 << 32, (n, ngram_join.TOKENS), dtype=np.uint32)
    both = np.concatenate([one, np.where(random.random(one.shape) < 0.8, one, one + np.uint32(1))])
    row = np.arange(2 * n)
    roots = [ngram_join.child_paths(np.full(2 * n, 7919 * (r + 1), np.uint64), both, 0.8) for r in range(runs)]
    row, path = (np.concatenate(part) for part in zip(*roots))
    for level in range(1, levels + 1):
        first, other = ({(r % n, p) for r, p in zip(row[side].tolist(), path[side].tolist())} for side in (row < n, row >= n))
        shared = first & other
        if level == levels:
            break
        # Whoever met goes on; the others can't meet any more.
        together = np.array([(r % n, p) in shared for r, p in zip(row.tolist(), path.tolist())])
        row, path = row[together], path[together]
        starts = ngram_join.other_paths(path, ngram_join.repeats(level))
        row = np.tile(row, len(starts))
        parent, path = ngram_join.child_paths(np.concatenate(starts), both[row], 0.8)
        row = row[parent]
    assert len({r for r, _ in shared}) >= 0.997 * n


def test_alike_rows_share_a_component():
    random = np.random.default_rng(16)
    prints = random.integers(0, 1 << 32, (150, 64), dtype=np.uint32)
    prints[100] = prints[3]
    prints[149, :40] = prints[100, :40]
    prints[20, :35] = prints[21, :35]
    root = groups.alike(prints)
    assert root[3] == root[100] == root[149] == 3 and root[20] != root[21] and len(set(root.tolist())) == 148


def test_nearest(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(40, [0.0, 1.0]), (41, [2.0, 1.0]), (41, [2.0, 1.0])]
    rows += [(42, None), (43, [0.0, 0.0]), (44, [nan, 1.0]), (45, [inf, 1.0]), (46, [None, 1.0]), (None, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("node", F.lit(1))
    found = {}
    for row in ann.nearest(frame, F.col("vec_id") % 20 == 0, 5).collect():
        found.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    assert sorted(found) == [0, 20, 40]
    assert sorted(found[0]) == [(1, 41, 2.0), (2, 1, 1.0), (3, 2, 1.0), (4, 3, 1.0), (5, 4, 1.0)]
    assert sorted(found[40]) == [(1, 41, 1.0), *((r, r - 2, 0.0) for r in (2, 3, 4, 5))]
    assert ann.nearest(frame.limit(0), F.col("vec_id") % 20 == 0, 5).count() == 0


@pytest.mark.parametrize("long", [1.0, 1e4, 1e25, 1e-30, 1e150])
def test_nearest_with_uneven_norms(spark, long):
    """A few vectors that are far longer or shorter than all others leave the recall as it is."""
    rng = np.random.default_rng(14)
    vectors = rng.normal(size=(1_200, 16))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    vectors[5] *= long
    vectors[40] *= long
    frame = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id bigint, embedding array<double>")
    found = {}
    for row in ann.nearest(frame, F.col("vec_id") % 20 == 0, 20).collect():
        found.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    assert sorted(found) == list(range(0, 1_200, 20))
    hits = 0
    for query, ranked in found.items():
        scores = vectors @ vectors[query]
        best = [i for i in np.lexsort((np.arange(len(scores)), -scores)) if i != query][:20]
        assert [r for r, _, _ in sorted(ranked)] == list(range(1, 21))
        assert all(score == pytest.approx(scores[i], rel=1e-12) for _, i, score in ranked)
        hits += len(set(best) & {i for _, i, _ in ranked})
    assert hits >= 0.9 * 20 * len(found)


def test_reply_trees(spark):
    rows = [(1, 0, None, "user", "q", 0.0), (1, 1, 0, "assistant", "bad", 0.1), (1, 2, 0, "assistant", "good", 0.9)]
    rows += [(1, 3, 2, "user", None, None), (2, 0, None, None, "<|user|> \\ [INST]", 1.0), (None, 7, 5, "user", "", 0.0)]
    rows += [(3, i, i - 1 if i else None, "user", str(i), 0.0) for i in range(70)]
    frame = spark.createDataFrame(rows, "conv_id bigint, node bigint, parent bigint, role string, text string, score double")
    frame = frame.withColumn("leaf", F.lit("odd"))
    found = {row.conv_id: row for row in chat.conversations(frame).collect()}
    assert chat.read_turns(found[1].formatted) == [("user", "q"), ("assistant", "good"), ("user", "")]
    assert chat.read_turns(found[2].formatted) == [("", "<|user|> \\ [INST]")]
    assert chat.read_turns(found[3].formatted) == [("user", str(i)) for i in range(70)] and found[None].n_turns == 1
    start, stop = found[1].loss[0]
    assert found[1].formatted[start:stop] == "good"
    assert chat.conversations(frame, keep=2).where("conv_id = 1").count() == 2
    assert chat.conversations(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chat.conversations(spark.createDataFrame([(1, 0, 1, "a", "b", 0.0), (1, 1, 0, "a", "b", 0.0)], frame.drop("leaf").schema))


def test_edited_fingerprints(docs):
    found = minhash.edited_fingerprints(docs).collect()
    assert ids(found) == WANT
    prints = collections.defaultdict(set)
    for row in found:
        prints[row.doc_id].add(row.fingerprint)
    assert len(prints[5]) == 1 and prints[2] == prints[3] == prints[9] and prints[5] == prints[6]
    assert minhash.edited_fingerprints(docs.limit(0)).count() == 0
    assert [tuple(r)[5:] for r in minhash.edited_fingerprints(docs.where("doc_id = 1")).collect()][0][1] == 1.0


def test_ranges_of_uneven_ids(spark, monkeypatch):
    """A few far ids don't put all others into one range, and the next document is found across ranges."""
    monkeypatch.setattr(minhash, "RANGE_ROWS", 20)
    far = [-(1 << 62), 1 << 62, (1 << 62) + 1]
    rows = [(i, f"words of text number {i} and {i * i} more") for i in [*range(400), *far]]
    frame = spark.createDataFrame([*rows, (None, "no id")], "doc_id long, text string").repartition(5)
    sizes = {r["range"]: r["count"] for r in minhash.with_range(frame).groupBy("range").count().collect()}
    assert sizes.pop(-1) == 1 and len(sizes) > 15 and max(sizes.values()) < 60
    texts = ["no id"] + [text for _, text in sorted(rows)]
    edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, [*texts[1:], texts[0]])]
    want = collections.Counter(hashlib.sha256(text.encode()).hexdigest() for text in edited)
    found = minhash.edited_fingerprints(frame).collect()
    assert collections.Counter(row.edited_sha256 for row in found) == want


def test_urls(spark):
    rules = [("block", "net", "/"), ("allow", "org", "/")]
    rows = [(i, f"http://a.{'net' if i % 2 else 'org'}/{'bad' if i % 2 else 'fine'}/{i}") for i in range(40)]
    rows += [(50, None), (51, ""), (52, "no scheme"), (53, "x://B.COM"), (54, "x://b.com/fine/77"), (54, "x://b.com/fine/77")]
    rows += [(55, "x://b.com/bad/77"), (None, "x://n.NET/a?b#c")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("label", F.lit("odd"))
    found = urls.judge(frame, rules).collect()
    assert ids(found, "page_id") == collections.Counter(i for i, _ in rows)
    by_id = {row.page_id: row for row in found}
    assert tuple(by_id[53])[1:4] == ("b.com", "", None) and tuple(by_id[None])[1:5] == ("n.net", "/a", "net/", "block")
    assert by_id[54].score > by_id[55].score and by_id[50].host == by_id[52].path == ""
    assert urls.judge(frame.limit(0), rules).count() == 0
    assert {r.score for r in urls.judge(frame, rules[:1]).collect()} == {0.5}


def test_url_models_keep_contexts_apart(spark):
    """Scores equal those of models with exact counts, also with more contexts than any small table holds."""
    random = np.random.default_rng(13)
    texts = ["".join(map(chr, random.integers(97, 123, 300))) for _ in range(600)]
    urls_of = [f"http://a.{('net', 'org', 'com')[i % 3]}/{text}" for i, text in enumerate(texts)]
    counts = [collections.defaultdict(collections.Counter) for _ in range(2)]

    def steps(url):
        text = " " * urls.ORDER + url + "\n"
        for at in range(urls.ORDER, len(text)):
            yield text[at], [text[at - order : at] for order in range(urls.ORDER + 1)]

    def margin(url):
        logs, size = [0.0, 0.0], 0
        for byte, contexts in steps(url):
            size += 1
            for label in (0, 1):
                p = 1 / 256
                for context in contexts:
                    after = counts[label].get(context)
                    if after:
                        p = (after[byte] + len(after) * p) / (after.total() + len(after))
                logs[label] += np.log(p)
        return float(logs[1] - logs[0]) / size

    for i, url in enumerate(urls_of):
        if i % 3 < 2:
            for byte, contexts in steps(url):
                for context in contexts:
                    counts[i % 3][context][byte] += 1
    want = [margin(url) for url in urls_of]
    known = [(m, i % 3) for i, m in enumerate(want) if i % 3 < 2]
    slope, intercept = platt(spark.createDataFrame(known, "margin double, label int"))
    frame = spark.createDataFrame(list(enumerate(urls_of)), "page_id bigint, url string")
    for row in urls.judge(frame, [("block", "net", "/"), ("allow", "org", "/")]).collect():
        z = max(-30.0, min(30.0, want[row.page_id] * slope + intercept))
        assert row.score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-3)


def test_packing(docs):
    found = packing.packed(docs, path("word_bpe_49k.json")).collect()
    assert ids([row for row in found if row.piece == 0]) == WANT
    tokens = collections.Counter()
    places = collections.defaultdict(int)
    for row in sorted(found, key=lambda row: (row.sequence_id, row.offset)):
        assert row.offset == places[row.sequence_id]
        places[row.sequence_id] += row.length
        tokens[row.doc_id] += row.length
    assert max(places.values()) <= packing.SEQUENCE and tokens[2] == tokens[3] == 1 and tokens[4] == 8 * 20_000 + 1
    assert packing.packed(docs.limit(0), path("word_bpe_49k.json")).count() == 0


def test_best_two_fit_replaces_the_smallest():
    # Greedy: 6 + 3 leaves a gap of 1; two pieces of 2 fit it instead of the 3.
    made = packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)
    assert made[0] == (1, [(6, 1), (2, 2)])
    assert sum(n * dict(filling).get(3, 0) for n, filling in made) == 1
