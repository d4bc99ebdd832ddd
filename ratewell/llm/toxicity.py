"""Toxicity by subword-bag embeddings averaged into a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.llm.common import majority_labels, platt, saved, text_slices

#: Hashed subword vectors, and their width.
BUCKET_BITS, WIDTH = 16, 8
#: Subwords are the byte n-grams of these lengths within a lower-cased word and the blank on either side.
SIZES = (3, 4, 5)
#: A text is scored as its worst window of this many words.
WINDOW = 32
#: Zero vectors added to every mean, so that a window of a few odd subwords stays unremarkable.
BLANKS = 80
#: The embeddings are fitted to windows of at most so many labelled documents of each class, in so many
#: rounds: after each, a document's worst window under the model so far takes part.
FIT_DOCS, ROUNDS = 2000, 3
CHUNK = 1 << 19


def subwords(texts: list[str]) -> Iterator[tuple]:
    """For blocks of texts: ``(first text, buckets, valid, window starts, text of each window)``.

    ``buckets`` has a row per n-gram length and a column per byte; ``valid`` marks the n-grams that
    lie in one word. A text without words has one window without subwords. A block holds whole
    texts, about half a megabyte or one longer text.
    """
    import numpy as np

    word = np.zeros(256, np.uint8)
    for low, high in ((48, 58), (97, 123), (128, 256)):
        word[low:high] = np.arange(low, high)
    start = 0
    while start < len(texts):
        parts, size, stop = [], 0, start
        while stop < len(texts) and (stop == start or size < CHUNK):
            parts.append(b" " + (texts[stop] or "").lower().encode("utf-8", "replace") + b" ")
            size += len(parts[-1])
            stop += 1
        block = word[np.frombuffer(b"".join(parts) + bytes(max(SIZES)), np.uint8)]
        inside = block > 0
        first_bytes = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        ends = np.cumsum([len(part) for part in parts])
        begins = ends - [len(part) for part in parts]
        bounds = np.searchsorted(first_bytes, np.append(begins, ends[-1]))
        starts, owner = [], []
        for i in range(len(parts)):
            words = first_bytes[bounds[i] : bounds[i + 1]]
            heads = words[::WINDOW] - 1
            # A last window of a few words joins the one before.
            if len(heads) > 1 and len(words) % WINDOW and len(words) % WINDOW < WINDOW // 2:
                heads = heads[:-1]
            heads = heads if len(heads) else begins[i : i + 1]
            heads[0] = begins[i]
            starts.append(heads)
            owner.append(np.full(len(heads), i))
        n = size
        value = block.astype(np.uint32) + np.uint32(1)
        code = np.zeros(n, np.uint32)
        buckets, valid = np.empty((len(SIZES), n), np.int32), np.empty((len(SIZES), n), bool)
        middle = np.ones(n, bool)
        for length in range(1, max(SIZES) + 1):
            code = code * np.uint32(16777619) + value[length - 1 : length - 1 + n] * np.uint32(2654435761)
            if length > 2:
                middle &= inside[length - 2 : length - 2 + n]
            if length in SIZES:
                k = SIZES.index(length)
                mixed = (code ^ (code >> np.uint32(15))) * np.uint32(2246822519 + 2 * length)
                buckets[k] = (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)
                valid[k] = middle
        if len(first_bytes):
            # A word that repeats the one before counts once. Sums of n-gram codes tell words apart.
            sums = np.add.reduceat(np.where(valid[0], buckets[0] * 40503 + buckets[1], 0), first_bytes - 1, dtype=np.int64)
            again = np.append(False, sums[1:] == sums[:-1])
            valid[:, first_bytes[0] - 1 :] &= ~np.repeat(again, np.diff(np.append(first_bytes - 1, n)))
        yield start, buckets, valid, np.concatenate(starts), np.concatenate(owner)
        start = stop


def window_bags(texts: list[str], keys: list[int], weights=None) -> list[bytes]:
    """Subword buckets (32-bit integers) of one window per text: the worst one under ``weights``, or
    without weights the one that the text's key, a whole number, chooses."""
    import numpy as np

    bags = []
    for first, buckets, valid, starts, owner in subwords(texts):
        stops = np.append(starts[1:], buckets.shape[1])
        rows = np.searchsorted(owner, np.arange(owner[-1] + 1))
        means = None if weights is None else window_means(buckets, valid, starts, weights)
        for i, (row, count) in enumerate(zip(rows, np.bincount(owner))):
            w = row + (keys[first + i] % count if means is None else int(means[row : row + count].argmax()))
            part = slice(starts[w], stops[w])
            bags.append(buckets[:, part][valid[:, part]].tobytes())
    return bags


def window_means(buckets, valid, starts, weights):
    """Mean subword weight of each window; 0 where a window has none."""
    import numpy as np

    total = np.zeros(buckets.shape[1], np.float32)
    for row, mask in zip(buckets, valid):
        total += weights[row] * mask
    counts = np.add.reduceat(valid.sum(0, dtype=np.int32), starts)
    return np.add.reduceat(total, starts, dtype=np.float64) / (counts + BLANKS)


def _bags(sample: DataFrame, weights=None) -> tuple[list, list[int]]:
    """The bag of one window per document, and the labels, in the order of ``rank`` and ``id``."""
    import numpy as np

    def run(batches):
        for batch in batches:
            keys = [int(rank) for rank in batch["rank"]]
            batch["bag"] = window_bags(batch.pop("text").tolist(), keys, weights)
            yield batch

    rows = sample.mapInPandas(run, "rank bigint, id string, label int, bag binary").collect()
    rows.sort(key=lambda row: (row.rank, row.id))
    return [np.frombuffer(row.bag, np.int32) for row in rows], [row.label for row in rows]


def train(bags: list, labels: list[int], epochs: int = 8, rate: float = 0.01, decay: float = 1e-5):
    """Embeddings and softmax weights trained together by Adam on mini-batches; returns the weight of
    each bucket in the difference of the two logits, and the bias.

    A bag's logits are linear in the mean of its subword vectors, so a bucket's vector times the
    difference of the two weight columns is all that scoring needs.
    """
    import numpy as np

    rng = np.random.default_rng(20)
    size, y = 1 << BUCKET_BITS, np.asarray(labels)
    vectors = rng.normal(0, 0.1, (size, WIDTH)).astype(np.float32)
    weights, bias = rng.normal(0, 0.3, (WIDTH, 2)).astype(np.float32), np.zeros(2, np.float32)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (vectors, weights, bias)]
    share = np.array([0.5 / max((y == c).sum(), 1) for c in (0, 1)]) * len(y)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), 128):
            rows = order[at : at + 128]
            lengths = np.array([max(len(bags[r]), 1) for r in rows])
            flat = np.concatenate([bags[r] if len(bags[r]) else np.zeros(1, np.int32) for r in rows])
            scale = np.array([len(bags[r]) > 0 for r in rows], np.float32) / (lengths + BLANKS)
            begins = np.append(0, np.cumsum(lengths)[:-1])
            hidden = np.add.reduceat(vectors[flat], begins) * scale[:, None]
            logits = hidden @ weights + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= (share[y[rows]] / len(rows))[:, None]
            back = (p @ weights.T) * scale[:, None]
            grad = np.stack([np.bincount(flat, np.repeat(back[:, k], lengths), size) for k in range(WIDTH)], 1)
            step += 1
            grads = (grad + decay * vectors, hidden.T @ p + decay * weights, p.sum(0))
            for param, gradient, (m, v) in zip((vectors, weights, bias), grads, state):
                m += 0.1 * (gradient - m)
                v += 0.01 * (gradient**2 - v)
                param -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    toward = weights[:, 1] - weights[:, 0]
    return (vectors @ toward).astype(np.float32), float(bias[1] - bias[0])


def margins(texts: list[str], weights, bias: float) -> list[float]:
    """Difference of the two logits in the worst window of each text."""
    import numpy as np

    out = []
    for _, buckets, valid, starts, owner in subwords(texts):
        means = window_means(buckets, valid, starts, weights)
        worst = np.maximum.reduceat(means, np.searchsorted(owner, np.arange(owner[-1] + 1)))
        out.extend((worst + bias).tolist())
    return out


class Classifier:
    """Subword weights and the curve that turns a margin into a score."""

    def __init__(self, weights, bias: float, slope: float = 1.0, intercept: float = 0.0):
        self.weights, self.bias, self.slope, self.intercept = weights, bias, slope, intercept

    def margin_rows(self, docs: DataFrame) -> DataFrame:
        weights, bias = self.weights, self.bias

        def run(batches):
            import pyarrow as pa

            for batch in text_slices(batches, CHUNK):
                found = margins(batch.column("text").to_pylist(), weights, bias)
                columns = [batch.column("doc_id"), pa.array(found, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "margin"])

        rows = docs.select("doc_id", "text")
        return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, margin double")

    def score(self, margin: str = "margin") -> Column:
        z = F.col(margin) * self.slope + self.intercept
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))

    def rows_where(self, docs: DataFrame, decide) -> DataFrame:
        """The rows of ``docs`` for whose own text ``decide`` holds, given an array of scores."""
        weights, bias, slope, intercept = self.weights, self.bias, self.slope, self.intercept

        def run(batches):
            import numpy as np
            import pyarrow as pa

            for batch in text_slices(batches, CHUNK):
                found = np.array(margins(batch.column("text").to_pylist(), weights, bias), float)
                score = 1 / (1 + np.exp(-np.clip(found * slope + intercept, -30, 30)))
                yield batch.filter(pa.array(decide(score)))

        return docs.mapInArrow(run, docs.schema)


def fit_and_margins(
    docs: DataFrame, labels: DataFrame, train_if: Column, fit_docs: int = FIT_DOCS
) -> tuple[Classifier, DataFrame]:
    """Fit to labelled documents for which ``train_if`` holds; return the classifier and
    ``(doc_id, margin)`` of every row of ``docs``, written.

    The embeddings are fitted to windows of at most ``fit_docs`` documents per class, those with the
    smallest id hash. The score curve is fitted to all labelled training rows, and every
    window of every text is scored. Null texts count as empty, and all texts without words get one
    score. Documents without an id are scored but never learned from; repeated rows are scored
    alike; a document with several labels has the majority's. Without both classes every score is
    one half. Columns other than ``doc_id`` and ``text`` are ignored.
    """
    import numpy as np

    known = majority_labels(labels, "toxic").where(train_if)
    ranked = known.withColumn("rank", F.abs(F.hash("doc_id")).cast("bigint"))
    chosen = [ranked.where(F.col("label") == c).orderBy("rank", "doc_id").limit(fit_docs) for c in (0, 1)]
    # At most 2 x fit_docs ids: the broadcast is bounded whatever the size of the corpus.
    picked = F.broadcast(saved(chosen[0].unionByName(chosen[1]), "toxicity-ids"))
    sample = docs.select("doc_id", "text").join(picked, "doc_id")
    sample = sample.groupBy("rank", F.col("doc_id").cast("string").alias("id"), "label")
    sample = saved(sample.agg(F.coalesce(F.min("text"), F.lit("")).alias("text")).repartition(16, "id"), "toxicity-fit")
    sample = sample.select("rank", "id", "label", "text")
    bags, y = _bags(sample)
    if len(set(y)) < 2:
        model = Classifier(np.zeros(1 << BUCKET_BITS, np.float32), 0.0)
        return model, saved(model.margin_rows(docs), "toxicity-margins")
    weights, bias = train(bags, y)
    for _ in range(ROUNDS - 1):
        worst, labels_of = _bags(sample, weights)
        # Windows of harmless documents add up; of a toxic one only the worst is sure to be toxic.
        harmless = [bag for bag, label in zip(bags, y) if not label]
        harmless += [bag for bag, label in zip(worst, labels_of) if not label]
        toxic = [bag for bag, label in zip(worst, labels_of) if label]
        bags, y = harmless + toxic, [0] * len(harmless) + [1] * len(toxic)
        weights, bias = train(bags, y)
    model = Classifier(weights, bias)
    scored = saved(model.margin_rows(docs), "toxicity-margins")
    model.slope, model.intercept = platt(scored.join(known, "doc_id"))
    return model, scored
