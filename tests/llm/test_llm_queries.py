"""The registered queries at a small size: SQL, brute force, round trips and held-out accuracy."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from public_tokenizers import PATTERN, path

import corpus_pipeline
from ratewell.llm import chat, minhash, ngram_join, shingles
from ratewell.llm.common import saved, table
from ratewell.llm.oracle import NGRAM_JOIN
from ratewell.llm.packing import SEQUENCE
from ratewell.llm.queries import QUERIES, RULES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return {row.doc_id: row.text or "" for row in table(spark, FOLDER, "documents").collect()}


def labels_of(spark, column):
    return {row.doc_id: row[column] for row in table(spark, FOLDER, "labels").collect()}


@pytest.mark.parametrize(
    "name, column, modulus, held, threshold, least",
    [("op1_quality", "quality", 4, 2, 0.7, 0.97), ("op3_toxicity", "toxic", 5, 0, 0.5, 0.9)],
)
def test_classifiers_on_held_out_rows(spark, documents, name, column, modulus, held, threshold, least):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert sorted(row.doc_id for row in rows) == sorted(documents)
    known = labels_of(spark, column)
    right = []
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % modulus == held)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= threshold)
        if row.held_out and row.doc_id in known:
            right.append(row.predicted == known[row.doc_id])
    assert np.mean(right) >= least


def test_byte_bpe_equals_the_library(spark, documents):
    import base64

    import tiktoken

    with open(path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for row in QUERIES["op4_byte_bpe"](spark, FOLDER).collect():
        ids = library.encode_ordinary(documents[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(documents[row.doc_id].encode()).hexdigest()


def test_nearest_by_brute_force(spark):
    rows = table(spark, FOLDER, "embeddings").collect()
    ids = np.array([row.vec_id for row in rows])
    vectors = np.array([row.embedding for row in rows], float)
    found = {}
    for row in QUERIES["op6_nearest"](spark, FOLDER).collect():
        found.setdefault(row.query_id, {})[row["rank"]] = (row.vec_id, row.score)
    assert sorted(found) == sorted(i for i in ids.tolist() if i % 20 == 0)
    hits = 0
    for query, ranked in found.items():
        scores = vectors @ vectors[ids == query][0]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query][:20]
        assert sorted(ranked) == list(range(1, 21))
        assert all(abs(score - scores[ids == vec][0]) < 1e-12 for vec, score in ranked.values())
        hits += len({vec for vec, _ in ranked.values()} & set(ids[order].tolist()))
    assert hits >= 0.95 * 20 * len(found)


def test_chat_digests(spark):
    talks = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for row in table(spark, FOLDER, "conversations").orderBy("conv_id", "turn").collect():
        talks.setdefault(row.conv_id, []).append((row.role, row.text or ""))
    rows = QUERIES["op7_chat"](spark, FOLDER).collect()
    assert sorted(row.conv_id for row in rows) == sorted(talks)
    for row in rows:
        turns = talks[row.conv_id]
        said = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        assert (row.n_turns, row.loss_chars) == (len(turns), len(said))
        assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert row.formatted_chars == len(chat.format_turns(turns)[0])


def test_minhash_against_exact_similarity(spark, documents):
    ids = sorted(documents)
    errors = []

    def jaccard(one, other):
        one, other = (set(s.tolist()) for s in shingles.shingle_sets([one, other]))
        return len(one & other) / len(one | other) if one or other else 1.0

    rows = {row.doc_id: row for row in QUERIES["op8_minhash"](spark, FOLDER).collect()}
    assert sorted(rows) == ids
    for i, doc_id in enumerate(ids):
        text, after = documents[doc_id], documents[ids[(i + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = rows[doc_id]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        errors += [row.near_edited - jaccard(text, edited), row.near_next - jaccard(text, after)]
    assert abs(np.mean(errors)) < 0.01 and np.abs(errors).max() < 0.25
    prints = {}
    for doc_id, text in documents.items():
        assert prints.setdefault(text, rows[doc_id].fingerprint) == rows[doc_id].fingerprint


def test_minhash_bands_equal_sql(spark):
    docs = table(spark, FOLDER, "documents")
    docs.createOrReplaceTempView("documents")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = sorted(connection.execute(NGRAM_JOIN).fetchall())
    got = minhash.near_duplicates(docs).select("doc_id", "class_id", "copy_id", "n_links").collect()
    assert sorted(map(tuple, got)) == want


def test_url_rules(spark):
    import re

    pages = {row.page_id: row.url for row in table(spark, FOLDER, "pages").collect()}
    rows = QUERIES["op9_urls"](spark, FOLDER).collect()
    assert sorted(row.page_id for row in rows) == sorted(pages)
    for row in rows:
        found = re.search(r"://([^/?#]*)([^?#]*)", pages[row.page_id])
        host, where = (found[1].lower(), found[2]) if found else ("", "")
        assert (row.host, row.path) == (host, where)
        fits = [
            (len(h + p), h + p, verdict)
            for verdict, h, p in RULES
            if (host == h or host.endswith("." + h)) and where.startswith(p)
        ]
        if fits:
            assert (row.rule, row.verdict) == max(fits)[1:]
        else:
            assert row.rule is None and row.verdict in ("allow", "block")


def check_packing(rows, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("word_bpe_49k.json"))
    by_doc, by_sequence = {}, {}
    for row in rows:
        by_doc.setdefault(row.doc_id, []).append(row)
        by_sequence.setdefault(row.sequence_id, []).append(row)
    assert sorted(by_doc) == sorted(texts)
    for doc_id, pieces in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 0], "<u4")
        pieces.sort(key=lambda row: row.piece)
        assert [row.piece for row in pieces] == list(range(-(-len(ids) // SEQUENCE)))
        for row in pieces:
            part = ids[row.start : row.start + row.length]
            assert row.start == row.piece * SEQUENCE and len(part) == row.length
            assert row.length == SEQUENCE or row.start + row.length == len(ids)
            assert row.ids_crc32 == zlib.crc32(part.tobytes())
    for pieces in by_sequence.values():
        at = 0
        for row in sorted(pieces, key=lambda row: row.offset):
            assert row.offset == at
            at += row.length
        assert at <= SEQUENCE
    return len(by_sequence), sum(row.length for row in rows)


def test_packing_is_gapless_and_tight(spark, documents):
    sequences, tokens = check_packing(QUERIES["op10_packing"](spark, FOLDER).collect(), documents)
    assert sequences <= -(-tokens // SEQUENCE) * 1.01 + 1


def test_pipeline_stages(spark, documents):
    """Each stage on its own input: who goes, who stays, and the columns."""
    docs, toxic, quality = table(spark, FOLDER, "documents"), labels_of(spark, "toxic"), labels_of(spark, "quality")
    for (name, stage), (labels, bad) in zip(corpus_pipeline.STAGES[:2], ((toxic, 1), (quality, 0))):
        kept = saved(stage(spark, docs, FOLDER), name)
        assert kept.columns == docs.columns
        before, after = ({row.doc_id for row in frame.collect()} for frame in (docs, kept))
        assert after <= before
        wrong = [i for i in before & set(labels) if (labels[i] == bad) == (i in after)]
        assert len(wrong) <= 0.03 * len(before & set(labels))
        docs = kept
    kept = saved(corpus_pipeline.STAGES[2][1](spark, docs, FOLDER), "kept")
    assert kept.columns == docs.columns
    classes = {}
    for row in ngram_join.near_duplicates(docs).collect():
        classes.setdefault(row.class_id, []).append(row.doc_id)
    assert sorted(row.doc_id for row in kept.collect()) == sorted(classes)
    packed = corpus_pipeline.STAGES[3][1](spark, kept, FOLDER)
    from pyspark.sql import functions as F

    check_packing(packed.withColumn("ids_crc32", F.crc32("ids")).collect(), {i: documents[i] for i in classes})
