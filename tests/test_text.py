import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewell.functions.text import word_tokens
from ratewell.operators import encoders, text

random.seed(3)
WORDS = ["the"] * 200 + [f"w{i}" for i in range(60)] * 3 + [f"rare{i}" for i in range(90)]
TEXTS = [" ".join(random.choices(WORDS, k=random.randint(0, 30))) for _ in range(80)]
TEXTS += ["", "  ", "One\tTWO\n three  ", "word"]


@pytest.fixture(scope="module")
def rows(spark):
    data = [*enumerate(TEXTS), (1_000, None)]
    return spark.createDataFrame(data, "id long, text string").repartition(6)


def split_words(value):
    return [w for w in re.split(r"\s+", (value or "").lower()) if w]


def test_tokenize_truncate_pad(rows):
    for row in text.tokenize_truncate_pad(rows, max_len=8).collect():
        words = split_words(row["text"])
        kept = words[:8]
        assert row["n_tokens"] == len(words)
        assert row["tokens"] == kept + ["[PAD]"] * (8 - len(kept))
        assert row["attention_mask"] == [1] * len(kept) + [0] * (8 - len(kept))


@pytest.mark.parametrize("min_count", [1, 2, 5])
def test_vocabulary_is_dense_and_ordered_by_count(rows, min_count):
    counts = Counter(w for value in TEXTS for w in split_words(value))
    kept = {w: n for w, n in counts.items() if n >= min_count}
    got = sorted(text.vocabulary(rows, min_count=min_count).collect(), key=lambda r: r["token_id"])
    assert {r["token"]: r["token_count"] for r in got} == kept
    assert [r["token_id"] for r in got] == list(range(2, 2 + len(kept)))
    assert [r["token_count"] for r in got] == sorted(kept.values(), reverse=True)


def check_ids(encoded, ids):
    encoded = encoded.collect()
    assert len(encoded) == len(TEXTS) + 1
    texts = dict(enumerate(TEXTS))
    for row in encoded:
        words = split_words(texts.get(row["id"]))[:10]
        assert row["input_ids"] == [ids.get(w, 1) for w in words] + [0] * (10 - len(words))
        assert sum(row["attention_mask"]) == len(words)


def test_token_ids_keep_order_and_mark_unknown_words(rows):
    vocab = text.vocabulary(rows, min_count=2)
    ids = {r["token"]: r["token_id"] for r in vocab.collect()}
    check_ids(text.encode_token_ids(rows, vocab, max_len=10), ids)


def test_token_ids_of_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(text, "PART", 100)
    texts = [" ".join(f"v{i * k % 37}" for i in range(n)) for k, n in ((5, 1000), (7, 193), (3, 2))] + ["", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    vocab = text.vocabulary(rows)
    ids = {r["token"]: r["token_id"] for r in vocab.collect()}
    found = {r["id"]: r for r in text.encode_token_ids(rows, vocab).collect()}
    assert sorted(found) == list(range(len(texts)))
    for i, value in enumerate(texts):
        assert found[i]["input_ids"] == [ids[w] for w in split_words(value)]
        assert found[i]["attention_mask"] == [1] * len(split_words(value))


def test_token_ids_with_hot_words(rows):
    vocab = text.vocabulary(rows)
    ids = {r["token"]: r["token_id"] for r in vocab.collect()}
    tokens = rows.select("id", word_tokens("text").alias("_tokens"))
    for row in text.ids_by_join(tokens, vocab, share=0.05, min_rows=1).collect():
        words = split_words(dict(enumerate(TEXTS)).get(row["id"]))
        assert row["_ids"] == [ids[w] for w in words]


def test_token_coverage(rows):
    lengths = [len(split_words(t)) for t in TEXTS] + [0]
    row = text.token_coverage(rows, max_len=10).first()
    assert row["texts"] == len(lengths)
    assert row["share_within"] == pytest.approx(np.mean(np.array(lengths) <= 10))
    assert row["p95_words"] == pytest.approx(np.percentile(lengths, 95))


def test_encode_batches_is_independent_of_batches_and_partitions(rows):
    def vectors(frame, batch_rows):
        encoded = encoders.encode_batches(frame, encoders.hashing_encoder(16), batch_rows=batch_rows)
        return {r["id"]: r["embedding"] for r in encoded.collect()}

    first = vectors(rows, 128)
    assert first == vectors(rows.repartition(2), 3)
    assert len(first) == len(TEXTS) + 1 and all(len(v) == 16 for v in first.values())
    single = first[TEXTS.index("word")]
    assert sorted(abs(x) for x in single) == [0.0] * 15 + [1.0]
    assert first[1_000] == [0.0] * 16


def test_hashed_embeddings_equal_the_loaded_encoder(rows):
    loaded = {r["id"]: r["embedding"] for r in encoders.encode_batches(rows, encoders.hashing_encoder(16)).collect()}
    built_in = {r["id"]: r["embedding"] for r in encoders.hashed_embeddings(rows, 16).collect()}
    assert built_in.keys() == loaded.keys()
    assert all(built_in[i] == pytest.approx(loaded[i], abs=1e-6) for i in loaded)


def test_encoder_is_loaded_per_task_and_given_whole_texts(spark):
    long_text = "x " * 50_000
    frame = spark.createDataFrame([(1, long_text), (2, "y")], "id long, text string").coalesce(1)

    def load():
        return lambda texts: np.array([[len(t)] for t in texts])

    got = {r["id"]: r["embedding"] for r in encoders.encode_batches(frame, load).collect()}
    assert got == {1: [float(len(long_text))], 2: [1.0]}


def test_tfidf_weights_rare_words_higher(rows):
    # More buckets than words, so that words rarely meet.
    vectors = {r["id"]: r["embedding"] for r in encoders.tfidf_embeddings(rows, dim=4096).collect()}
    documents = len(TEXTS) + 1
    containing = sum("word" in split_words(t) for t in TEXTS)
    weight = np.log((documents + 1) / (containing + 1))
    assert max(vectors[TEXTS.index("word")]) == pytest.approx(weight, rel=1e-5)
    assert sum(vectors[1_000]) == 0.0
