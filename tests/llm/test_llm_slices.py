"""Tasks that read whole texts take them in slices of bounded size, however many a batch holds."""

import numpy as np
import pyarrow as pa

from ratewell.llm.common import text_slices
from ratewell.llm.quality import Discriminant
from ratewell.llm.toxicity import BUCKET_BITS, Classifier


def test_slices_hold_all_rows_in_order():
    texts = ["a" * 30, None, "", "ü" * 40, "b" * 500, None, "c" * 99, "d", None]
    batches = [pa.record_batch({"n": list(range(k, k + 9)), "text": pa.array(texts)}) for k in (0, 9)]
    batches.append(batches[0].slice(0, 0))
    found = list(text_slices(batches, 100))
    assert [n for part in found for n in part.column("n").to_pylist()] == list(range(18))
    assert [text for part in found for text in part.column("text").to_pylist()] == texts * 2
    for part in found:
        sizes = [len((text or "").encode()) for text in part.column("text").to_pylist()]
        assert sum(sizes) <= 100 or sizes[0] == sum(sizes) == 500


def test_classifiers_keep_rows_by_small_slices(spark):
    docs = spark.range(0, 4000, 1, 1).selectExpr("id AS doc_id", "repeat('word of a text ', 100) AS text")
    docs = docs.selectExpr("doc_id", "CASE WHEN doc_id % 1000 > 0 THEN text END AS text", "'x' AS other")

    def few(scores):
        return np.full(len(scores), len(scores) < 1000)

    for model in (Classifier(np.zeros(1 << BUCKET_BITS, np.float32), 0.0), Discriminant({})):
        kept = model.rows_where(docs, few)
        assert kept.columns == docs.columns
        assert sorted(row.doc_id for row in kept.collect()) == list(range(4000))
