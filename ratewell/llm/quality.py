"""Quality by a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.llm.common import majority_labels, platt, saved, text_slices

FEATURES = (
    "bytes words word_length upper symbols points digits marks distinct repeated_lines line_length capitals nonascii"
).split()
#: Share of the pooled covariance, and of a diagonal one, in each class covariance.
POOLED, DIAGONAL = 0.1, 0.05
CHUNK = 1 << 19


def statistics(texts: list[str | None]):
    """One row of transformed statistics per text: logarithms of sizes, log-odds of smoothed shares.

    Null counts as empty. Shares of an empty text are those of the smoothing alone.
    """
    import numpy as np

    # Classes of bytes: 1 white space, 2 upper case, 3 lower case, 4 digit, 5 full stop or comma,
    # 6 other ASCII mark, 7 part of a non-ASCII character, 8 its first byte, 9 line break.
    kind = np.full(256, 6, np.uint8)
    kind[[9, 11, 12, 13, 32]], kind[10] = 1, 9
    kind[65:91], kind[97:123], kind[48:58], kind[[44, 46]] = 2, 3, 4, 5
    kind[128:192], kind[192:256] = 7, 8
    out = np.empty((len(texts), len(FEATURES)))

    def odds(part, whole):
        return np.log((part + 0.5) / (whole - part + 0.5))

    start = 0
    while start < len(texts):
        parts, size, stop = [], 0, start
        while stop < len(texts) and (stop == start or size < CHUNK):
            parts.append((texts[stop] or "").encode("utf-8", "replace") + b"\n")
            size += len(parts[-1])
            stop += 1
        lengths = np.array([len(part) for part in parts])
        begins = np.append(0, np.cumsum(lengths)[:-1])
        kinds = kind[np.frombuffer(b"".join(parts), np.uint8)]

        def per_text(mask):
            return np.add.reduceat(mask, begins, dtype=np.int64).astype(float)

        blank = (kinds == 1) | (kinds == 9)
        first = ~blank
        first[1:] &= blank[:-1]
        upper = kinds == 2
        capital_word = np.zeros(len(kinds), bool)
        capital_word[:-1] = first[:-1] & upper[:-1] & upper[1:]
        distinct, repeated = np.zeros((2, len(parts)))
        for i, text in enumerate(texts[start:stop]):
            distinct[i] = len(set((text or "").split()))
            lines = [line for line in (text or "").split("\n") if line.strip()]
            repeated[i] = len(lines) - len(set(lines))
        chars = lengths - 1 - per_text(kinds == 7)
        words, lines = per_text(first), per_text(kinds == 9)
        letters = per_text(upper | (kinds == 3) | (kinds == 8))
        marks = per_text(kinds == 6)
        out[start:stop] = np.stack(
            [
                np.log1p(lengths - 1),
                np.log1p(words),
                np.log((letters + 1) / (words + 1)),
                odds(per_text(upper), letters),
                odds(marks, chars),
                odds(per_text(kinds == 5), chars),
                odds(per_text(kinds == 4), chars),
                np.log((marks + 1) / (words + 1)),
                # Long texts repeat more words; the log of the count takes the length out.
                np.log((distinct + 1) / (words + 1)) + 0.3 * np.log1p(words),
                odds(repeated, np.maximum(lines, repeated)),
                np.log((words + 1) / (lines + 1)),
                odds(per_text(capital_word), words),
                odds(per_text(kinds == 8), letters),
            ],
            1,
        )
        start = stop
    return out


def statistics_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)`` with the statistics of each row's whole text."""

    def run(batches):
        import pyarrow as pa

        for batch in text_slices(batches, CHUNK):
            x = statistics(batch.column("text").to_pylist())
            offsets = pa.array(range(0, x.size + 1, x.shape[1]), pa.int32())
            columns = [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "x"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, x array<double>")


def moments(labelled: DataFrame) -> dict:
    """Per label the count, the sums and the sums of products of ``x``; each task adds up its own rows."""
    import numpy as np

    d = len(FEATURES)

    def run(batches):
        import pandas as pd

        totals = {}
        for batch in batches:
            for label, rows in batch.groupby("label"):
                x = np.column_stack([np.ones(len(rows)), np.stack(rows["x"].to_numpy())])
                totals[label] = totals.get(label, 0) + x.T @ x
        for label, total in totals.items():
            cells = {"label": label, "cell": np.arange(total.size, dtype=np.int32), "value": total.ravel()}
            yield pd.DataFrame(cells)

    cells = labelled.select("label", "x").mapInPandas(run, "label int, cell int, value double")
    out = {}
    for label, cell, value in cells.groupBy("label", "cell").agg(F.sum("value")).collect():
        out.setdefault(label, np.zeros((d + 1) ** 2))[cell] = value
    return {label: total.reshape(d + 1, d + 1) for label, total in out.items()}


class Discriminant:
    """A mean and a Cholesky factor per class; the score follows the difference of the log-densities."""

    def __init__(self, totals: dict, pooled: float = POOLED, diagonal: float = DIAGONAL):
        import numpy as np

        d, self.slope, self.intercept, self.parts = len(FEATURES), 1.0, 0.0, []
        self.known = all(label in totals and totals[label][0, 0] > 1 for label in (0, 1))
        if not self.known:
            return
        means = [totals[c][0, 1:] / totals[c][0, 0] for c in (0, 1)]
        spreads = [totals[c][1:, 1:] / totals[c][0, 0] - np.outer(m, m) for c, m in zip((0, 1), means)]
        together = (spreads[0] + spreads[1]) / 2
        for mean, spread in zip(means, spreads):
            mixed = (1 - pooled - diagonal) * spread + pooled * together + diagonal * np.diag(np.diag(together))
            factor = np.linalg.cholesky(mixed + 1e-4 * np.eye(d))
            # The inverse factor turns a Mahalanobis distance into one product and a sum of squares.
            self.parts.append((mean, np.linalg.inv(factor), np.log(np.diag(factor)).sum()))

    def margins(self, x):
        """Log-density under class 1 less that under class 0, for the rows of ``x``."""
        import numpy as np

        if not self.known:
            return np.zeros(len(x))
        low, high = (-0.5 * (((x - m) @ inverse.T) ** 2).sum(1) - log_det for m, inverse, log_det in self.parts)
        # A root keeps the far tails, where the normal law says little, from ruling the curve.
        return np.sign(high - low) * np.sqrt(np.abs(high - low))

    def margin_rows(self, rows: DataFrame) -> DataFrame:
        margins = self.margins

        def run(batches):
            import pyarrow as pa

            for batch in batches:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                columns = [batch.column("doc_id"), pa.array(margins(x), pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "margin"])

        return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, margin double")

    def score(self, margin: str = "margin") -> Column:
        z = F.col(margin) * self.slope + self.intercept
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))

    def rows_where(self, docs: DataFrame, decide) -> DataFrame:
        """The rows of ``docs`` for whose own text ``decide`` holds, given an array of scores."""
        margins, slope, intercept = self.margins, self.slope, self.intercept

        def run(batches):
            import numpy as np
            import pyarrow as pa

            for batch in text_slices(batches, CHUNK):
                found = margins(statistics(batch.column("text").to_pylist()))
                score = 1 / (1 + np.exp(-np.clip(found * slope + intercept, -30, 30)))
                yield batch.filter(pa.array(decide(score)))

        return docs.mapInArrow(run, docs.schema)


def fit_and_margins(docs: DataFrame, labels: DataFrame, train_if: Column) -> tuple[Discriminant, DataFrame]:
    """Fit to all labelled documents for which ``train_if`` holds; return the discriminant and
    ``(doc_id, margin)`` of every row of ``docs``.

    Texts are read once: their statistics, some 100 bytes a document, are written, and moments,
    score curve and scores come from them. Null texts count as empty, and all empty texts get one
    score. Rows without an id are scored but never learned from, repeated rows are scored alike, a
    document with several labels has the majority's. With fewer than two documents of a class every
    score is one half. Columns other than ``doc_id`` and ``text`` are ignored.
    """
    rows = saved(statistics_rows(docs), "quality-statistics")
    known = majority_labels(labels, "quality").where(train_if)
    labelled = rows.join(known, "doc_id")
    model = Discriminant(moments(labelled))
    if model.known:
        margins = model.margin_rows(labelled.select("doc_id", "x"))
        model.slope, model.intercept = platt(margins.join(known, "doc_id"))
    return model, model.margin_rows(rows)
