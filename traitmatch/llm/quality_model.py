"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting of shallow trees, one feature (then one pair) at a time, adds each
tree into that feature's lookup table over quantile bins.  Scoring is one bin
search and one table addition per feature and pair, vectorised over a batch.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitmatch.llm.common import arrow_batch, byte_slices, schema_of, texts_of
from traitmatch.llm.labels import labelled_sample
from traitmatch.llm.langid import remainder
from traitmatch.llm.quality_rules import base_counts, ratio

MAX_TRAIN_ROWS = 20_000    # documented bound of the training sample (labelled documents)
BINS = 32
PAIR_BINS = 8
ROUNDS = 200
PAIR_ROUNDS = 60
N_PAIRS = 6
RATE = 0.1
LEAF_HESSIAN = 2.0         # least sum of p(1-p) in a leaf
RIDGE = 1.0
THRESHOLD = 0.3

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
PUNCTUATION = b".,;:!?'\"()-"
FEATURES = ("log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "zstd_ratio", "upper_share",
            "digit_share", "punctuation_share", "distinct_share", "non_ascii_share", "words_per_line", "bar_share",
            "bang_share", "longest_word", "short_word_share")
FIELDS = [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]


def features(text: str | None) -> list[float]:
    """Feature values of a whole text (all 0 for a null or empty one)."""
    text = text or ""
    raw = text.encode()
    if not raw:
        return [0.0] * len(FEATURES)
    n, chars, symbols, dups, repeated, _ = base_counts(text)
    size, words = len(raw), raw.split()
    lengths = list(map(len, words)) or [0]
    lines = raw.count(b"\n") + 1
    share = lambda chars_: (size - len(raw.translate(None, chars_))) / size
    return [math.log1p(n), chars / max(1, n), symbols / len(text), dups / lines, repeated / max(1, n), ratio(raw),
            share(UPPER), share(DIGITS), share(PUNCTUATION), len(set(words)) / max(1, n),
            (size - len(text)) / size, n / lines, raw.count(b"|") / size, raw.count(b"!") / size,
            float(max(lengths)), sum(x <= 3 for x in lengths) / max(1, n)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and position of the best split of binned gradients (0: no split)."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + RIDGE) + gr ** 2 / (hr + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    gain[(hl < LEAF_HESSIAN) | (hr < LEAF_HESSIAN)] = 0
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Step per bin of a tree with up to three leaves."""
    edges, (_, cut) = [0, len(g)], best_cut(g, h)
    if not cut:
        return np.zeros(len(g))
    left, right = best_cut(g[:cut], h[:cut]), best_cut(g[cut:], h[cut:])
    edges.append(cut)
    if max(left[0], right[0]) > 0:
        edges.append(left[1] if left[0] >= right[0] else cut + right[1])
    edges.sort()
    out = np.zeros(len(g))
    for a, b in zip(edges, edges[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and step table of the best cut of rows with a cut of columns on each side."""
    best, out = 0.0, np.zeros_like(g)
    base = g.sum() ** 2 / (h.sum() + RIDGE)
    for i in range(1, g.shape[0]):
        gain, table = -base, np.zeros_like(g)
        for side in (slice(0, i), slice(i, None)):
            gs, hs = g[side].sum(axis=0), h[side].sum(axis=0)
            _, j = best_cut(gs, hs)
            for cols in ((slice(0, j), slice(j, None)) if j else (slice(None),)):
                gain += gs[cols].sum() ** 2 / (hs[cols].sum() + RIDGE)
                table[side, cols] = gs[cols].sum() / (hs[cols].sum() + RIDGE)
        if gain > best:
            best, out = gain, table
    return best, out


class AdditiveModel:
    """Intercept, one table per feature, one per chosen pair."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        n, d = x.shape
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(d)]
        self.pair_cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) for j in range(d)]
        rate = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.intercept = math.log(rate / (1 - rate))
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        f = np.full(n, self.intercept)
        bins = self._bins(x, self.cuts)
        for _ in range(ROUNDS):
            for j, table in enumerate(self.tables):
                p = sigmoid(f)
                step = RATE * shallow_tree(np.bincount(bins[j], y - p, len(table)),
                                           np.bincount(bins[j], p * (1 - p), len(table)))
                table += step
                f += step[bins[j]]
        coarse = self._bins(x, self.pair_cuts)
        shape = [len(c) + 1 for c in self.pair_cuts]

        def cells(a, b, values):
            return np.bincount(coarse[a] * shape[b] + coarse[b], values, shape[a] * shape[b]).reshape(shape[a], shape[b])

        p = sigmoid(f)
        gains = sorted(((pair_tree(cells(a, b, y - p), cells(a, b, p * (1 - p)))[0], a, b)
                        for a in range(d) for b in range(a + 1, d)), reverse=True)
        self.pairs = [(a, b) for gain, a, b in gains[:N_PAIRS] if gain > 0]
        self.pair_tables = [np.zeros((shape[a], shape[b])) for a, b in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for (a, b), table in zip(self.pairs, self.pair_tables):
                p = sigmoid(f)
                step = RATE * pair_tree(cells(a, b, y - p), cells(a, b, p * (1 - p)))[1]
                table += step
                f += step[coarse[a], coarse[b]]

    @staticmethod
    def _bins(x: np.ndarray, cuts: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)]

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.intercept)
        for table, b in zip(self.tables, self._bins(x, self.cuts)):
            f += table[b]
        if self.pairs:
            coarse = self._bins(x, self.pair_cuts)
            for (a, b), table in zip(self.pairs, self.pair_tables):
                f += table[coarse[a], coarse[b]]
        return sigmoid(f)


def training_rows(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Feature matrix and labels of a labelled sample, in an order that is theirs alone."""
    width = len(FEATURES)

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 1):
                rows = [features(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["y", "x"])

    table = sample.select("y", "text").mapInArrow(run, "y int, x array<double>").toArrow()     # a row a sampled document
    y = np.array(table.column("y").to_pylist(), float)
    x = np.array(table.column("x").to_pylist(), float).reshape(len(y), width)
    order = np.lexsort([*x.T, y])
    return x[order], y[order]


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS,
                  threshold: float = THRESHOLD) -> DataFrame:
    """Quality score of every whole text; one row per input row, repeated rows included.

    Learns from at most ``max_rows`` labelled documents (0 or 1) whose crc32(id) mod 5
    is not 0: ids are chosen by their hash, and a repeated label or document counts
    once (see :func:`traitmatch.llm.labels.labelled_sample`), so the scores are the
    same however the rows are dealt out.  A null text scores as an empty one;
    a null id stays null (``held_out`` false); without any label the score is 0.5;
    an empty table gives no rows; other columns are ignored.
    """
    rows = texts_of(docs, id_col, text_col)
    x, y = training_rows(labelled_sample(rows, labels, label_col, 5, 0, max_rows))
    model = AdditiveModel(x, y) if len(y) else None
    shared = docs.sparkSession.sparkContext.broadcast(model)     # a few thousand numbers
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in byte_slices(batch, 2):
                matrix = np.array([features(t) for t in part.column(2).to_pylist()]).reshape(-1, len(FEATURES))
                score = model.score(matrix) if model else np.full(len(matrix), 0.5)
                yield arrow_batch(FIELDS, [part.column(0), part.column(1), score, (score >= threshold).astype(np.int32)])

    return rows.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(run, schema_of(FIELDS))
